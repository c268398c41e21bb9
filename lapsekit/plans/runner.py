"""Running several data sets, later ones building on earlier ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lapsekit.operators.sampling import sample_fraction
from lapsekit.plans.steps import apply_steps
from lapsekit.sources.files import newest_path, read_newest, write_table
from lapsekit.sources.publish import fingerprint, input_state, pointer, publish, read_published
from lapsekit.sources.sql import query_tables, read_database


class RunError(RuntimeError):
    """At least one data set failed; all failures are listed."""


@dataclass
class RunResult:
    frames: dict[str, DataFrame] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)
    unchanged: list[str] = field(default_factory=list)


class _Catalog:
    """Finds a table by frame name, by the output path of an earlier data set, or by file pattern."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame]):
        self.spark = spark
        self.known: dict[str, DataFrame] = dict(tables)
        # Versions of the published tables of this run, by name and by path.
        self.versions: dict[str, str] = {}

    def find(self, ref: Any, **csv: Any) -> DataFrame:
        if isinstance(ref, DataFrame):
            return ref
        if ref in self.known:
            return self.known[ref]
        return read_published(self.spark, ref, **csv) if _published(self.spark, ref) else read_newest(self.spark, ref, **csv)

    def fingerprint(self, spec: Mapping[str, Any], sample: Any, keys: Any) -> str | None:
        """A digest of all a data set is made from, or ``None`` where a part of it has no state that could be compared."""
        joined = [s.get("right") for s in spec.get("steps", []) if s.get("op") == "join"]
        refs, states = [*([spec["input"]] if "input" in spec else []), *joined], []
        if spec.get("reader", "file") == "sql":
            return None
        for ref in refs:
            if isinstance(ref, str) and ref in self.versions:
                states.append(self.versions[ref])
            elif not isinstance(ref, str) or ref in self.known:
                return None
            else:
                states.append(input_state(self.spark, ref if _published(self.spark, ref) else newest_path(self.spark, ref)))
        return fingerprint([states, spec.get("steps", []), sample, keys, spec.get("sep"), spec.get("multiline")])

    def load(self, spec: Mapping[str, Any]) -> DataFrame:
        if spec.get("reader", "file") != "sql":
            return self.find(spec["input"], **{k: spec[k] for k in ("sep", "multiline") if k in spec})
        if "conn_env" in spec:
            return read_database(self.spark, spec["query"], spec["conn_env"], spec.get("params"), spec.get("split"))
        return query_tables(self.spark, spec["query"], spec.get("params"), self.known)


def _published(spark: SparkSession, ref: str) -> bool:
    return not set("*?[{") & set(ref) and pointer(spark, ref) is not None


def run_datasets(
    spark: SparkSession,
    datasets: Sequence[Mapping[str, Any]],
    defaults: Mapping[str, Any] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    write: bool = True,
    fail: bool = True,
) -> RunResult:
    """Load, sample, transform and save each data set.

    A data set has ``name``, ``input`` (a name, path or glob) or ``reader: sql``,
    ``steps``, and optionally ``output``, ``sample``, ``sample_keys``, ``enabled``, and
    ``sep`` and ``multiline`` for CSV. Later data sets
    find earlier ones by name or output path: once written they are read back, so
    nothing is computed twice; with ``write=False`` everything stays one lazy
    plan. A failing data set does not stop the others; the failures are raised
    together at the end unless ``fail`` is off.

    With ``publish: true`` an output changes all at once (see :mod:`lapsekit.sources.publish`), and a data set whose
    input files, joined tables, steps and sampling are those of the published version is not computed
    again; it is named in ``unchanged``.
    """
    catalog, result = _Catalog(spark, tables or {}), RunResult()
    for spec in datasets:
        if spec.get("enabled") is False:
            continue
        name, stage, output = spec["name"], "load", spec.get("output")
        try:
            keys = spec.get("sample_keys", (defaults or {}).get("sample_keys"))
            state = None
            if write and output and spec.get("publish"):
                state = catalog.fingerprint(spec, spec.get("sample", (defaults or {}).get("sample")), keys)
                before = pointer(spark, output)
                if state is not None and before and before["fingerprint"] == state:
                    df = read_published(spark, output)
                    result.unchanged.append(name)
                    result.frames[name] = catalog.known[name] = catalog.known[output] = df
                    catalog.versions[name] = catalog.versions[output] = before["version"]
                    continue
            df = catalog.load(spec)
            stage = "processing"
            # Without keys whole rows are hashed, so a sample is the same on every partitioning.
            df = sample_fraction(df, spec.get("sample", (defaults or {}).get("sample")), keys=keys or df.columns)
            df = apply_steps(df, spec.get("steps", []), catalog.find)
            if write and output:
                stage = "save"
                if spec.get("publish"):
                    publish(df, output, state)
                    df = read_published(spark, output)
                    catalog.versions[name] = catalog.versions[output] = pointer(spark, output)["version"]
                else:
                    write_table(df, output)
                    df = read_newest(spark, output)
        except Exception as error:
            result.errors.append(f"{name}: {stage} error: {error}")
            continue
        result.frames[name] = df
        catalog.known[name] = df
        if output:
            catalog.known[output] = df
    if result.errors and fail:
        raise RunError("; ".join(result.errors))
    return result

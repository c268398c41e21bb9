"""Step lists: declarative cleaning and joining as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from lapsekit.operators import aggregates, columns, derive, joins, labels, rows

Step = Mapping[str, Any]
Resolver = Callable[[Any], DataFrame]


class StepError(ValueError):
    """A malformed step, named by its number."""


def _label(df: DataFrame, **options: Any) -> DataFrame:
    statuses = options.get("keep_statuses")
    if isinstance(statuses, str):
        options["keep_statuses"] = [s.strip() for s in statuses.split(",") if s.strip()] or None
    return labels.create_churn_label(df, **options)


def _dedup(df: DataFrame, ignore_index: bool = True, **options: Any) -> DataFrame:
    # Rows carry no index, so ``ignore_index`` has nothing to do.
    return rows.drop_duplicates(df, **options)


STEPS: dict[str, Callable[..., DataFrame]] = {
    "lowercase_categoricals": derive.lowercase_categoricals,
    "disambiguate_city_state": rows.disambiguate_city_state,
    "group_by_features": derive.group_by_features,
    "groupby_aggregate": aggregates.groupby_aggregate,
    "dropna_rows": rows.dropna_rows,
    "dropna_columns": columns.dropna_columns,
    "drop_duplicates": _dedup,
    "rename_columns": columns.rename_columns,
    "drop_columns": columns.drop_columns,
    "select_columns": columns.select_columns,
    "make_label": _label,
    "join": joins.join,
}


def apply_steps(df: DataFrame, steps: Sequence[Step], resolve: Resolver | None = None) -> DataFrame:
    """Fold the steps over the frame.

    A step is ``{"op": name, **parameters}``. The ``right`` of a join is a frame,
    or anything ``resolve`` turns into one (a path or a table name). Unknown and
    malformed steps raise :class:`StepError` with the step's number.
    """
    for number, step in enumerate(steps, start=1):
        options = dict(step)
        op = options.pop("op", None)
        if not op:
            raise StepError(f"step {number} has no 'op'")
        if op not in STEPS:
            raise StepError(f"step {number}: unknown op {op!r}; known: {sorted(STEPS)}")
        if op == "join" and not isinstance(options.get("right"), DataFrame):
            if resolve is None:
                raise StepError(f"step {number}: nothing resolves the right side {options.get('right')!r}")
            options["right"] = resolve(options["right"])
        try:
            df = df.transform(STEPS[op], **options)
        except TypeError as error:
            raise StepError(f"step {number} ({op}): {error}") from error
    return df

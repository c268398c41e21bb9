"""CSV and Parquet files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lapsekit.sources.quoted import read_quoted_csv

# Fields read as missing by default in data-frame CSV readers (fixed values).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
PARQUET_ENDINGS = (".parquet", ".pq")


def _is_parquet(path: str) -> bool:
    return path.lower().rstrip("/").endswith(PARQUET_ENDINGS)


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    header: bool = True,
    names: Sequence[str] | None = None,
    multiline: bool = True,
) -> DataFrame:
    """CSV as text columns, missing-value tokens as null.

    Types are not guessed: guessing turns ``014`` into 14. Cast with a schema
    afterwards. ``names`` names the columns of a file without a header.
    ``multiline`` allows line breaks inside quotes. Files are then read by many tasks too, but
    their lines are scanned three times; without it (in a run: ``multiline: false`` in the data set) once.
    """
    reader = spark.read.option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", multiline)
    if names:
        reader = reader.schema(", ".join(f"`{n}` string" for n in names))
    raw = reader.option("header", header).csv(path)
    if multiline:
        raw = read_quoted_csv(spark, path, raw.columns, sep, header)
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_table(spark: SparkSession, path: str, sep: str = ",", strict: bool = False, multiline: bool = True) -> DataFrame:
    """Parquet by ending, CSV otherwise; ``strict`` refuses other endings."""
    if _is_parquet(path):
        return spark.read.parquet(path)
    if strict and not path.lower().rstrip("/").endswith((".csv", ".tsv")):
        raise ValueError(f"unsupported file type: {path}")
    return read_csv(spark, path, sep=sep, multiline=multiline)


def read_headerless_tsv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Tab-separated text without a header, columns named by position."""
    return read_csv(spark, path, sep="\t", header=False, names=names)


def newest_path(spark: SparkSession, pattern: str) -> str:
    """The lexicographically last file or table folder matching a glob.

    The file system lists what the glob itself matches, not the files inside tables.
    Sort-friendly names (dates) make this the newest; hidden names do not count.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    found = [s.getPath() for s in listed or []]
    matches = [str(p.toString()) for p in found if not p.getName().startswith(("_", "."))]
    if not matches:
        raise FileNotFoundError(f"nothing matches {pattern}")
    return max(matches)


def read_newest(spark: SparkSession, pattern: str, sep: str = ",", multiline: bool = True) -> DataFrame:
    return read_table(spark, newest_path(spark, pattern), sep=sep, multiline=multiline)


def read_typed_or_raw(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """The cast copy named by ``cast.output`` if it exists, else the file at ``path``."""
    typed = (spec.get("cast") or {}).get("output")
    if typed:
        try:
            return read_table(spark, typed)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return read_table(spark, spec["path"])


def _same_place(a: str, b: str) -> bool:
    clean = [unquote(urlparse(p).path).rstrip("/") for p in (a, b)]
    return clean[0] == clean[1] or clean[1].startswith(clean[0] + "/")


def write_table(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write Parquet by ending, CSV with a header otherwise, replacing what is there.

    The result is a folder of part files. A path the frame is read from is refused.
    """
    if any(_same_place(path, source) for source in df.inputFiles()):
        raise ValueError(f"{path} is being read by the same plan")
    writer = df.write.mode("overwrite")
    if _is_parquet(path):
        writer.parquet(path)
    else:
        writer.option("header", True).option("sep", sep).option("escape", '"').csv(path)

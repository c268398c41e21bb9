"""Cleaning and scoring a stream.

Steps that look at one row at a time mean the same on a stream as on a table.
Steps that compare rows (aggregates, duplicates, labels) do not and are refused.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lapsekit.operators.models import predict
from lapsekit.plans.steps import apply_steps
from lapsekit.session import shared_folder

ROW_LOCAL = {
    "lowercase_categoricals",
    "group_by_features",
    "dropna_rows",
    "rename_columns",
    "drop_columns",
    "select_columns",
}


def clean_stream(df: DataFrame, steps: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Apply row-local steps to a streaming (or any) frame."""
    refused = sorted({str(s.get("op")) for s in steps} - ROW_LOCAL)
    if refused:
        raise ValueError(f"not row-local, so not defined on a stream: {refused}")
    return apply_steps(df, steps)


def score_stream(model: PipelineModel, df: DataFrame, id_cols: Iterable[str]) -> DataFrame:
    """Predictions and class probabilities for arriving rows."""
    return predict(model, df, id_cols)


def write_stream(df: DataFrame, path: str, checkpoint: str | None = None, once: bool = False) -> StreamingQuery:
    """Append a stream to Parquet with exactly-once file commits.

    The progress folder defaults to a fresh one in the shared folder; pass the
    same one again to continue after a restart.
    """
    place = checkpoint or shared_folder(df.sparkSession, "stream")
    writer = df.writeStream.format("parquet").option("checkpointLocation", place).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(path)

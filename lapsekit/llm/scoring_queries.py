"""Queries that score every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsekit.llm import langid, toxicity
from lapsekit.llm.registry import query, table


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))

"""Queries that rewrite or encode every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsekit.llm import piecewise, pseudonyms
from lapsekit.llm.registry import query, table


@query("op2_pii_pseudonyms")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.report(table(spark, sf_dir, "documents"))


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.encode(table(spark, sf_dir, "documents"))

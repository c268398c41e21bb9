"""The documents table cleaned in five stages: each stage's result is written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapsekit.llm import decontamination, minhash, piecewise, pseudonyms, toxicity
from lapsekit.llm.idfilter import bitmap, rows_by_bitmap
from lapsekit.llm.registry import small_batches
from lapsekit.session import materialize

ROW = "__row"

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the lexicon is learned from the labelled ones.

    Each row is judged by its own text, whatever its id; null and empty texts stay, repeated rows share
    their fate. Without labels no entries are learned and the fixed ones decide.
    """
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that with the smallest id (null ids last).

    A row is named by its id and text together, so an id that stands on several texts loses none of
    them, and rows that repeat both become one. Null and empty texts resemble nothing; an
    empty table stays empty.
    """
    small_batches(spark)
    rows = docs.withColumn(ROW, F.xxhash64("doc_id", "text"))
    classes = minhash.near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias(ROW), F.col("component_id").alias("component")).distinct()
    copies = rows.groupBy(ROW).agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("n"))
    placed = materialize(classes.join(copies, ROW), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(ROW).alias("stays"))).alias("first")
    gone = placed.join(placed.groupBy("component").agg(first), "component").where(F.col(ROW) != F.col("first.stays"))
    gone = materialize(gone.select(F.col(ROW).alias("__gone")), "gone")
    # Only rows that go or are repeated are shuffled.
    marked = bitmap(gone.unionByName(placed.where("n > 1").select(F.col(ROW).alias("__gone"))))
    perhaps = rows_by_bitmap(rows, marked, True, ROW)
    rest = perhaps.join(gone, F.col(ROW) == F.col("__gone"), "left_anti").dropDuplicates(["doc_id", "text"])
    return rows_by_bitmap(rows, marked, False, ROW).unionByName(rest).drop(ROW)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null and empty texts stay, an empty benchmark drops nothing."""
    small_batches(spark)
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become pseudonyms, equal ones in all rows; null and empty texts stay as they are."""
    small_batches(spark)
    return pseudonyms.pseudonymised(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as sampled piece ids, one row per document; null and empty texts have none."""
    small_batches(spark)
    return piecewise.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("pieces", encode_pieces),
]
# A learned lexicon, sketches and sampled pieces are beyond SQL; tests compare the rows with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Reading, writing and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.operators.sampling import sample_fraction
from lapsekit.session import shared_folder
from lapsekit.sources.files import (
    read_headerless_tsv,
    read_newest,
    read_table,
    read_typed_or_raw,
    write_table,
)
from lapsekit.sources.sql import query_tables
from workloads.registry import query, table


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, d):
    return read_table(spark, f"{d}/orders.parquet", strict=True)


@query("read_newest_file", "SELECT * FROM supplier")
def read_newest_file(spark, d):
    return read_newest(spark, f"{d}/*.parquet")


@query("typed_or_raw", "SELECT o_orderkey, o_orderstatus FROM orders")
def typed_or_raw(spark, d):
    spec = {"cast": {"output": f"{d}/orders.typed.parquet"}, "path": f"{d}/orders.parquet"}
    return read_typed_or_raw(spark, spec).select("o_orderkey", "o_orderstatus")


@query(
    "sql_source_params",
    """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 1000 GROUP BY o_orderpriority""",
)
def sql_source_params(spark, d):
    text = """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
              FROM {orders} WHERE o_orderstatus = :status AND o_totalprice >= :least
              GROUP BY o_orderpriority"""
    return query_tables(spark, text, {"status": "F", "least": 1000}, {"orders": table(spark, d, "orders")})


@query("write_roundtrip", "SELECT * FROM lineitem")
def write_roundtrip(spark, d):
    place = shared_folder(spark, "roundtrip") + ".parquet"
    write_table(table(spark, d, "lineitem"), place)
    return read_table(spark, place)


@query(
    "csv_roundtrip",
    """SELECT CAST(doc_id AS STRING) AS doc_id, CASE WHEN text <> '' THEN text END AS text, lang,
              CASE WHEN doc_id % 7 <> 0 THEN source END AS source
       FROM documents""",
)
def csv_roundtrip(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", "text", "lang", F.when(F.col("doc_id") % 7 != 0, F.col("source")).otherwise("N/A").alias("source")
    )
    place = shared_folder(spark, "roundtrip") + ".csv"
    write_table(docs, place)
    return read_table(spark, place)


@query(
    "csv_parallel_quoted",
    """SELECT CAST(doc_id AS STRING) AS doc_id,
              CASE WHEN text <> '' THEN replace(replace(text, '. ', '.' || chr(10)), ' e', ' "e') END AS text, lang
       FROM documents""",
)
def csv_parallel_quoted(spark, d):
    """Texts with line breaks and quotes inside quotes, read by one task per byte range."""
    broken = F.replace(F.replace("text", F.lit(". "), F.lit(".\n")), F.lit(" e"), F.lit(' "e'))
    place = shared_folder(spark, "quoted") + ".csv"
    write_table(table(spark, d, "documents").select("doc_id", broken.alias("text"), "lang"), place)
    return read_table(spark, place)


@query(
    "tsv_headerless",
    """SELECT CAST(c_custkey AS STRING) AS code, c_name AS place, c_mktsegment AS region,
              CAST(c_nationkey AS STRING) AS province FROM customer""",
)
def tsv_headerless(spark, d):
    place = shared_folder(spark, "roundtrip")
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    customers.write.option("sep", "\t").option("header", False).csv(place)
    return read_headerless_tsv(spark, place, ["code", "place", "region", "province"])


@query("sample_fraction")
def sample_rows(spark, d):
    return sample_fraction(table(spark, d, "lineitem"), 0.1, 42, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("sample_fraction_off", "SELECT o_orderkey FROM orders")
def sample_off(spark, d):
    return sample_fraction(table(spark, d, "orders").select("o_orderkey"), None)

"""Type casting from text with bad values in it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.functions.casts import category_rank
from lapsekit.operators.casting import cast_many, cast_report, cast_table
from workloads.registry import query, table

# The same text in both engines, apart from the names of the formatting functions.
INT_TEXT = """CASE WHEN o_orderkey % 13 = 0 THEN 'x' WHEN o_orderkey % 17 = 0 THEN '1.5'
              ELSE CAST(o_orderkey AS STRING) END"""
WHOLE_TEXT = "CASE WHEN o_orderkey % 17 = 0 THEN '1.5' ELSE CAST(o_orderkey AS STRING) END"
FLOAT_TEXT = """CASE WHEN o_orderkey % 11 = 0 THEN 'n/k' WHEN o_orderkey % 5 = 0 THEN '1e3'
                ELSE CAST(o_orderkey AS STRING) END"""
BOOL_TEXT = """CASE o_orderkey % 5 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 't' END"""
BOOL_VALUE = "CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END"
SPARK_TIME = "date_format(o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 60), 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
DUCK_TIME = "strftime(o_orderdate + to_seconds(o_orderkey % 60), '%Y-%m-%d %H:%M:%S.%f')"
TIME_TEXT = "CASE WHEN o_orderkey % 13 = 0 THEN 'bad' ELSE {time} END"
TIME_FORMAT = "%Y-%m-%d %H:%M:%S.%f"
DUCK_PARSED = f"try_strptime({TIME_TEXT.format(time=DUCK_TIME)}, '{TIME_FORMAT}')"
KNOWN_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


def _orders(spark, d, **texts):
    orders = table(spark, d, "orders")
    return orders.select("o_orderkey", *[F.expr(text).alias(name) for name, text in texts.items()])


def _cast(df, **specs):
    return cast_table(df, {"o_orderkey": {"type": "int"}, **specs}, mode="coerce")


@query(
    "cast_int_coerce",
    f"""SELECT o_orderkey, CASE WHEN regexp_full_match(t, '[0-9]+') THEN TRY_CAST(t AS BIGINT) END AS value
        FROM (SELECT o_orderkey, {INT_TEXT} AS t FROM orders)""",
)
def cast_int_coerce(spark, d):
    return _cast(_orders(spark, d, value=INT_TEXT), value={"type": "int"})


@query(
    "cast_int_truncate",
    f"SELECT o_orderkey, CAST(trunc(CAST({WHOLE_TEXT} AS DOUBLE)) AS BIGINT) AS value FROM orders",
)
def cast_int_truncate(spark, d):
    return _cast(_orders(spark, d, value=WHOLE_TEXT), value={"type": "int", "nullable": False})


@query("cast_float_coerce", f"SELECT o_orderkey, TRY_CAST({FLOAT_TEXT} AS DOUBLE) AS value FROM orders")
def cast_float_coerce(spark, d):
    return _cast(_orders(spark, d, value=FLOAT_TEXT), value={"type": "float"})


@query("cast_bool", f"SELECT o_orderkey, {BOOL_VALUE} AS value FROM orders")
def cast_bool(spark, d):
    return _cast(_orders(spark, d, value=BOOL_TEXT), value={"type": "bool"})


@query("cast_datetime", f"SELECT o_orderkey, {DUCK_PARSED} AS value FROM orders")
def cast_datetime(spark, d):
    text = TIME_TEXT.format(time=SPARK_TIME)
    return _cast(_orders(spark, d, value=text), value={"type": "datetime", "format": TIME_FORMAT, "drop_tz": True})


@query(
    "cast_datetime_zone",
    "SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 60) + INTERVAL 3 HOUR AS value FROM orders",
)
def cast_datetime_zone(spark, d):
    text = "date_format(o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 60), 'yyyy-MM-dd HH:mm:ss') || '-0300'"
    spec = {"type": "datetime", "format": "%Y-%m-%d %H:%M:%S%z", "drop_tz": True}
    return _cast(_orders(spark, d, value=text), value=spec)


@query(
    "cast_category",
    """SELECT o_orderkey, p AS value, CASE p WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 END AS rank
       FROM (SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
                                THEN o_orderpriority END AS p FROM orders)""",
)
def cast_category(spark, d):
    df = _orders(spark, d, value="o_orderpriority")
    df = _cast(df, value={"type": "category", "categories": KNOWN_PRIORITIES, "ordered": True})
    return df.withColumn("rank", category_rank(F.col("value"), KNOWN_PRIORITIES))


TEXT_TABLE = {
    "amount": FLOAT_TEXT,
    "number": INT_TEXT,
    "flag": BOOL_TEXT,
    "placed": TIME_TEXT.format(time=SPARK_TIME),
    "status": "CASE WHEN o_orderkey % 3 = 0 AND o_orderstatus = 'P' THEN 'Z' ELSE o_orderstatus END",
    "note": "o_orderpriority",
}
TEXT_SCHEMA = {
    "o_orderkey": {"type": "int", "nullable": False},
    "amount": {"type": "float"},
    "number": {"type": "int"},
    "flag": {"type": "bool"},
    "placed": {"type": "datetime", "format": TIME_FORMAT},
    "status": {"type": "category", "categories": ["F", "O", "P"]},
    "note": {"type": "string"},
}


@query(
    "cast_table",
    f"""SELECT o_orderkey, TRY_CAST({FLOAT_TEXT} AS DOUBLE) AS amount,
               CASE WHEN regexp_full_match({INT_TEXT}, '[0-9]+') THEN TRY_CAST({INT_TEXT} AS BIGINT) END AS number,
               {BOOL_VALUE} AS flag, {DUCK_PARSED} AS placed,
               CASE WHEN NOT (o_orderkey % 3 = 0 AND o_orderstatus = 'P') THEN o_orderstatus END AS status,
               o_orderpriority AS note
        FROM orders""",
)
def cast_whole_table(spark, d):
    return cast_table(_orders(spark, d, **TEXT_TABLE), TEXT_SCHEMA, mode="coerce")


_REPORT = f"""
    SELECT 'amount' AS name, count(*) FILTER (o_orderkey % 11 = 0) AS new_missing FROM orders
    UNION ALL SELECT 'number', count(*) FILTER (o_orderkey % 13 = 0 OR o_orderkey % 17 = 0) FROM orders
    UNION ALL SELECT 'flag', count(*) FILTER (o_orderkey % 5 = 3) FROM orders
    UNION ALL SELECT 'placed', count(*) FILTER (o_orderkey % 13 = 0) FROM orders
    UNION ALL SELECT 'status', count(*) FILTER (o_orderkey % 3 = 0 AND o_orderstatus = 'P') FROM orders"""


@query("cast_report", f"SELECT name, new_missing FROM ({_REPORT}) WHERE new_missing > 0")
def cast_missing_report(spark, d):
    return cast_report(_orders(spark, d, **TEXT_TABLE), TEXT_SCHEMA)


@query(
    "cast_many",
    """SELECT 'customer' AS dataset, count(*) AS n_rows, count(c_acctbal) AS n_present FROM customer
       UNION ALL SELECT 'supplier', count(*), count(s_acctbal) FILTER (s_suppkey % 4 <> 0) FROM supplier""",
)
def cast_several_tables(spark, d):
    tables = {
        "customer": table(spark, d, "customer").selectExpr("c_custkey AS k", "CAST(c_acctbal AS STRING) AS v"),
        "supplier": table(spark, d, "supplier").selectExpr(
            "s_suppkey AS k", "CASE WHEN s_suppkey % 4 = 0 THEN '?' ELSE CAST(s_acctbal AS STRING) END AS v"
        ),
        "broken": table(spark, d, "nation").selectExpr("n_nationkey AS k"),
    }
    schema = {"k": {"type": "int"}, "v": {"type": "float"}}
    done, errors = cast_many(
        tables,
        {"customer": {}, "supplier": {"mode": "coerce"}, "broken": {}},
        defaults={"schema": schema, "mode": "strict"},
        fail_fast=False,
    )
    assert list(errors) == ["broken"]
    counts = [
        df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n_present"))
        for name, df in done.items()
    ]
    return counts[0].unionByName(counts[1])

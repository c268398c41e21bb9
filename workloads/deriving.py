"""Row-wise features, text and time."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F, types as T

from lapsekit.functions.text import prefix, strip_accents
from lapsekit.operators import derive as D
from workloads.registry import query, rounded, table

# Three measures with nulls, all null on some rows.
WIDE = """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_quantity END AS a,
    CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_tax * 100 END AS b,
    CASE WHEN l_orderkey % 2 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS c FROM {lineitem}"""
DUCK_WIDE = WIDE.replace("{lineitem}", "lineitem")
_KEYS = "l_orderkey, l_linenumber, l_partkey"
_N = "((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT)"
_SUM = "(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0))"


def _wide(spark, d):
    return spark.sql(WIDE, lineitem=table(spark, d, "lineitem"))


@query("rowwise_sum", f"SELECT {_KEYS}, round({_SUM}, 6) AS total FROM ({DUCK_WIDE})")
def rowwise_sum(spark, d):
    return rounded(D.group_by_features(_wide(spark, d), {"total": ["a", "b", "c"]}), ["total"])


@query("rowwise_mean", f"SELECT {_KEYS}, round({_SUM} / nullif({_N}, 0), 6) AS g__mean FROM ({DUCK_WIDE})")
def rowwise_mean(spark, d):
    made = D.group_by_features(_wide(spark, d), {"mean": ["a", "b", "c"]}, "mean", prefix="g_")
    return rounded(made, ["g__mean"])


@query("rowwise_minmax", f"SELECT *, least(a, b, c) AS low, greatest(a, b, c) AS high FROM ({DUCK_WIDE})")
def rowwise_minmax(spark, d):
    groups = {"low": ["a", "b", "c"], "high": ["a", "b", "c"]}
    return D.group_by_features(_wide(spark, d), groups, ["min", "max"], keep_original=True)


_LIST = "list_filter([a, b, c], lambda x: x IS NOT NULL)"


@query(
    "rowwise_multi",
    f"""SELECT {_KEYS}, {_N}::BIGINT AS n, len(list_distinct({_LIST})) AS n_values,
          round(coalesce(a, 1) * coalesce(b, 1) * coalesce(c, 1), 4) AS product,
          coalesce(a <> 0, false) OR coalesce(b <> 0, false) OR coalesce(c <> 0, false) AS some,
          coalesce(a <> 0, true) AND coalesce(b <> 0, true) AND coalesce(c <> 0, true) AS every,
          round(CASE WHEN {_N} > 1 THEN list_var_samp({_LIST}) END, 5) AS spread,
          round(CASE WHEN {_N} > 1 THEN list_stddev_samp({_LIST}) END, 5) AS deviation,
          round(list_aggregate({_LIST}, 'quantile_cont', 0.5), 6) AS middle, a AS same FROM ({DUCK_WIDE})""",
)
def rowwise_multi(spark, d):
    cols = ["a", "b", "c"]
    functions = {
        "n": "count",
        "n_values": "nunique",
        "product": "prod",
        "some": "any",
        "every": "all",
        "spread": "var",
        "deviation": "std",
        "middle": "median",
        "same": "max",
    }
    made = D.group_by_features(_wide(spark, d), {**dict.fromkeys(functions, cols), "same": "a"}, functions)
    made = rounded(made, ["product"], 4)
    return rounded(rounded(made, ["spread", "deviation"], 5), ["middle"])


@F.pandas_udf(T.DoubleType())
def _span(a: pd.Series, b: pd.Series) -> pd.Series:
    return (a - b).abs()


@query("rowwise_udf", f"SELECT {_KEYS}, c, round(abs(a - b), 6) AS span FROM ({DUCK_WIDE})")
def rowwise_udf(spark, d):
    return rounded(D.group_by_features(_wide(spark, d), {"span": ["a", "b"]}, _span), ["span"])


@query(
    "rowwise_callable",
    f"SELECT {_KEYS}, c, CASE WHEN b = 0 OR a IS NULL OR b IS NULL THEN NULL ELSE round(a / b, 6) END AS ratio FROM ({DUCK_WIDE})",
)
def rowwise_callable(spark, d):
    return rounded(D.group_by_features(_wide(spark, d), {"ratio": ["a", "b"]}, F.try_divide), ["ratio"])


_SNAKE = r"regexp_replace(lower({c}), '[\s\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\v]+', '_', 'g')"


@query("lowercase_cols", f"SELECT doc_id, {_SNAKE.format(c='text')} AS text, source FROM documents")
def lowercase_cols(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return D.lowercase_categoricals(docs, ["text", "doc_id", "no_such_column"])


@query(
    "lowercase_all",
    f"""SELECT c_custkey, {_SNAKE.format(c="c_name")} AS c_name, c_nationkey, c_acctbal,
               {_SNAKE.format(c="c_mktsegment")} AS c_mktsegment FROM customer""",
)
def lowercase_all(spark, d):
    return D.lowercase_categoricals(table(spark, d, "customer"))


@query("strip_accents", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def without_accents(spark, d):
    return table(spark, d, "documents").select("doc_id", strip_accents(F.col("text")).alias("text"))


@query("prefix_slice", "SELECT c_custkey, substring(c_name, 1, 3) AS short FROM customer")
def prefix_slice(spark, d):
    return table(spark, d, "customer").select("c_custkey", prefix(F.col("c_name"), 3).alias("short"))


_ORDER_LINES = """SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate AS ordered,
    {micros} AS shipped FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey"""
_SPARK_SHIPPED = "l_shipdate - make_dt_interval(0, 0, l_linenumber, l_partkey % 60)"
_DUCK_SHIPPED = "l_shipdate - to_minutes(l_linenumber) - to_seconds(l_partkey % 60)"
DUCK_ORDER_LINES = _ORDER_LINES.format(micros=_DUCK_SHIPPED, lineitem="lineitem", orders="orders")


def _order_lines(spark, d):
    text = _ORDER_LINES.format(micros=_SPARK_SHIPPED, lineitem="{lineitem}", orders="{orders}")
    return spark.sql(text, lineitem=table(spark, d, "lineitem"), orders=table(spark, d, "orders"))


def _hours(a, b):
    return f"floor((epoch_us({b}) - epoch_us({a})) / 3600000000)::BIGINT"


@query("hours_between", f"SELECT *, {_hours('ordered', 'shipped')} AS lag_hours FROM ({DUCK_ORDER_LINES})")
def hours_between(spark, d):
    return D.add_hours_between(_order_lines(spark, d), "ordered", "shipped", "lag_hours")


_LAGS = {
    "payment_lag_hours": ("purchased", "approved"),
    "estimated_shipping_lag_hours": ("approved", "estimated"),
    "actual_and_estimated_shipping_lag_hours": ("estimated", "delivered"),
    "customer_review_response_lag_hours": ("reviewed", "answered"),
    "approval_and_arrival_lag_hours": ("approved", "delivered"),
}
_LIFE = """SELECT o_orderkey, o_orderdate AS purchased,
    o_orderdate + {h} AS approved, o_orderdate + INTERVAL '20' DAY AS estimated,
    CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderdate + INTERVAL '10' DAY + {h} + {h} END AS delivered,
    o_orderdate + INTERVAL '30' DAY AS reviewed, o_orderdate + INTERVAL '29' DAY + {h} AS answered FROM {orders}"""
DUCK_LIFE = _LIFE.format(h="to_minutes(o_custkey)", orders="orders")


@query(
    "order_lags",
    f"SELECT *, {', '.join(f'{_hours(a, b)} AS {name}' for name, (a, b) in _LAGS.items())} FROM ({DUCK_LIFE})",
)
def order_lags(spark, d):
    text = _LIFE.format(h="make_dt_interval(0, 0, CAST(o_custkey AS INT))", orders="{orders}")
    return D.add_order_lags(spark.sql(text, orders=table(spark, d, "orders")), _LAGS)

"""Grouped aggregates and column statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.operators import aggregates as A, stats as S
from lapsekit.operators.quantiles import exact_quantiles, soft_bounds
from workloads.registry import query, rounded, table
from workloads.tables import DUCK_DIRTY, dirty_orders

# Lines with nulls injected in the summed, averaged and "first" columns.
LINES = """SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_orderkey END AS order_id, l_linenumber, l_partkey,
    l_suppkey, CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_quantity END AS qty, l_extendedprice AS price,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_returnflag END AS flag, l_shipdate AS shipped FROM {lineitem}"""
DUCK_LINES = LINES.replace("{lineitem}", "lineitem")
_FIRST = "arg_min({c}, row(l_linenumber, l_partkey, l_suppkey, price)) FILTER ({c} IS NOT NULL) AS {c}"


def _lines(spark, d):
    return spark.sql(LINES, lineitem=table(spark, d, "lineitem"))


@query(
    "groupby_aggregate",
    f"""SELECT order_id, coalesce(sum(qty), 0.0) AS qty, round(avg(price), 6) AS price, min(shipped) AS shipped,
               {", ".join(_FIRST.format(c=c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "flag"))}
        FROM ({DUCK_LINES}) GROUP BY order_id""",
)
def groupby_aggregate(spark, d):
    grouped = A.groupby_aggregate(
        _lines(spark, d),
        "order_id",
        sum_cols=["qty"],
        mean_cols=["price"],
        min_cols=["shipped"],
        order_by=["l_linenumber", "l_partkey", "l_suppkey", "price"],
    )
    return rounded(grouped, ["price"])


@query(
    "groupby_no_first",
    f"""SELECT flag, round(sum(price), 2) AS price, min(qty) AS qty FROM ({DUCK_LINES}) GROUP BY flag""",
)
def groupby_no_first(spark, d):
    grouped = A.groupby_aggregate(_lines(spark, d), ["flag"], ["price"], min_cols="qty", first_for_rest=False)
    return rounded(grouped, ["price"], 2)


@query(
    "payments_per_order",
    f"""SELECT order_id, coalesce(sum(qty), 0.0) AS total, max(qty) AS largest, count(qty) AS n
        FROM ({DUCK_LINES}) GROUP BY order_id""",
)
def payments_per_order(spark, d):
    return A.amounts_per_key(_lines(spark, d), "order_id", "qty")


@query(
    "nunique_per_group",
    f"""SELECT order_id, count(DISTINCT flag) AS n_flags FROM ({DUCK_LINES})
        WHERE order_id IS NOT NULL GROUP BY order_id""",
)
def nunique_per_group(spark, d):
    return A.distinct_per_group(_lines(spark, d), "order_id", "flag", "n_flags")


@query("value_counts", f"SELECT priority, count(*) AS n FROM ({DUCK_DIRTY}) WHERE priority IS NOT NULL GROUP BY 1")
def value_counts(spark, d):
    return A.value_counts(dirty_orders(spark, d), "priority", name="n")


@query(
    "value_counts_norm",
    f"""SELECT priority, count(*)::DOUBLE / (SELECT count(priority) FROM ({DUCK_DIRTY})) AS share
        FROM ({DUCK_DIRTY}) WHERE priority IS NOT NULL GROUP BY 1""",
)
def value_shares(spark, d):
    return A.value_counts(dirty_orders(spark, d), "priority", normalize=True)


@query("distinct_values", f"SELECT DISTINCT priority FROM ({DUCK_DIRTY})")
def distinct_values(spark, d):
    return A.distinct_values(dirty_orders(spark, d), "priority")


@query(
    "distinct_count",
    """SELECT 'l_partkey' AS name, count(DISTINCT l_partkey) AS n_distinct FROM lineitem
       UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) FROM lineitem
       UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem""",
)
def distinct_count(spark, d):
    return A.distinct_counts(table(spark, d, "lineitem"), ["l_partkey", "l_shipdate", "l_returnflag"])


@query("distinct_count_approx")
def distinct_count_approx(spark, d):
    return A.distinct_counts(table(spark, d, "lineitem"), ["l_partkey", "l_orderkey"], approximate=True)


@query(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, count(*) FILTER ({c} IS NULL) AS n_null FROM ({DUCK_DIRTY})"
        for c in ("o_orderkey", "custkey", "price", "priority", "status")
    ),
)
def null_counts(spark, d):
    return S.null_counts(dirty_orders(spark, d))


_MEASURES = ["l_quantity", "l_extendedprice", "l_linenumber"]


@query(
    "describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 5) AS std,
            min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50,
            quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c})::DOUBLE AS max FROM lineitem"""
        for c in _MEASURES
    ),
)
def describe(spark, d):
    found = S.describe(table(spark, d, "lineitem"), _MEASURES)
    return rounded(rounded(found, ["mean"]), ["std"], 5)


def _bounds_sql(cols, source):
    parts = [
        f"""SELECT '{c}' AS name, quantile_cont({c}::DOUBLE, 0.01) AS lo, quantile_cont({c}::DOUBLE, 0.99) AS hi
            FROM {source}"""
        for c in cols
    ]
    return f"""SELECT name, round(lo - 0.1 * (hi - lo), 6) AS low, round(hi + 0.1 * (hi - lo), 6) AS high
        FROM ({" UNION ALL ".join(parts)})"""


@query("quantile_bounds", _bounds_sql(["l_quantity", "l_extendedprice"], "lineitem"))
def quantile_bounds(spark, d):
    return rounded(soft_bounds(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"]), ["low", "high"])


_PROBABILITIES = [0.0, 0.001, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]


@query(
    "quantiles_by_rank",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, round(quantile_cont({c}::DOUBLE, {p}), 6) AS value, {i} AS place FROM {source}"""
        for c, source in (
            ("l_quantity", "lineitem"),
            ("l_extendedprice", "lineitem"),
            ("l_discount", "lineitem"),
            ("l_partkey", "lineitem"),
        )
        for i, p in enumerate(_PROBABILITIES)
    ),
)
def quantiles_by_rank(spark, d):
    lines = table(spark, d, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]
    found = exact_quantiles(lines, cols, _PROBABILITIES)
    listed = found.select("name", F.posexplode("quantiles").alias("place", "value"))
    return listed.select("name", F.round("value", 6).alias("value"), "place")


@query(
    "datetime_summary",
    """SELECT 'l_shipdate' AS name, min(l_shipdate) AS earliest, max(l_shipdate) AS latest,
              (epoch_us(max(l_shipdate)) - epoch_us(min(l_shipdate))) / 86400000000.0::DOUBLE AS range_days FROM lineitem""",
)
def datetime_summary(spark, d):
    return S.datetime_summary(table(spark, d, "lineitem"))


@query(
    "datetime_summary_events",
    """SELECT 'ts' AS name, min(ts) AS earliest, max(ts) AS latest,
              round((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0::DOUBLE, 9) AS range_days FROM events""",
)
def datetime_summary_events(spark, d):
    return rounded(S.datetime_summary(table(spark, d, "events")), ["range_days"], 9)


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for i, a in enumerate(_CORR)
        for b in _CORR[i + 1 :]
    ),
)
def corr_matrix(spark, d):
    return rounded(S.correlation_pairs(table(spark, d, "lineitem"), _CORR), ["corr"])


@query(
    "histogram",
    """WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
         b AS (SELECT least(floor((l_quantity - lo) / ((hi - lo) / 10)), 9)::INT AS bin, count(*) AS n
               FROM lineitem, e GROUP BY 1)
       SELECT i::INT AS bin, round(lo + i * (hi - lo) / 10, 6) AS low, round(lo + (i + 1) * (hi - lo) / 10, 6) AS high,
              coalesce(n, 0) AS n
       FROM range(10) t(i) CROSS JOIN e LEFT JOIN b ON b.bin = t.i""",
)
def histogram(spark, d):
    return rounded(S.histogram(table(spark, d, "lineitem"), "l_quantity", 10), ["low", "high"])


@query(
    "corr_matrix_wide",
    """SELECT 'x' || a.i AS column_a, 'x' || b.i AS column_b, round(corr(
           CASE WHEN (vec_id + a.i) % 11 <> 0 THEN embedding[a.i + 1] END::DOUBLE, CASE WHEN (vec_id + b.i) % 11 <> 0 THEN embedding[b.i + 1] END::DOUBLE), 6) AS corr
       FROM embeddings, range(64) a(i), range(64) b(i) WHERE a.i < b.i GROUP BY a.i, b.i""",
)
def corr_matrix_wide(spark, d):
    """All coordinates against each other, in tiles of 24; one value in eleven of each is missing."""
    vectors = table(spark, d, "embeddings")
    wide = vectors.select(*[F.when((F.col("vec_id") + i) % 11 != 0, F.col("embedding")[i]).alias(f"x{i}") for i in range(64)])
    return rounded(S.correlation_tiles(wide, tile=24), ["corr"])

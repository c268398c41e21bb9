"""Profiles and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.operators import profiling as P, sketches as S, validation as V
from lapsekit.session import shared_folder
from workloads.registry import query, rounded, table
from workloads.tables import DUCK_DIRTY, dirty_orders


@query(
    "profile_numeric",
    """WITH s AS (SELECT 'l_quantity' AS name, 'floating' AS dtype, count(*) AS n, count(l_quantity) AS p,
                       quantile_cont(l_quantity, 0.01) AS lo, quantile_cont(l_quantity, 0.99) AS hi FROM lineitem
         UNION ALL SELECT 'l_extendedprice', 'floating', count(*), count(l_extendedprice),
                       quantile_cont(l_extendedprice, 0.01), quantile_cont(l_extendedprice, 0.99) FROM lineitem
         UNION ALL SELECT 'l_partkey', 'integer', count(*), count(l_partkey),
                       quantile_cont(l_partkey::DOUBLE, 0.01), quantile_cont(l_partkey::DOUBLE, 0.99) FROM lineitem)
       SELECT name, dtype, n AS row_count, (n - p)::DOUBLE / n AS null_rate,
              round(lo - 0.1 * (hi - lo), 6) AS low, round(hi + 0.1 * (hi - lo), 6) AS high FROM s""",
)
def profile_numeric(spark, d):
    found = P.profile(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_partkey"])
    return rounded(found.select("name", "dtype", "row_count", "null_rate", "low", "high"), ["low", "high"])


@query(
    "profile_categories",
    f"""SELECT 'priority' AS name, 'string' AS dtype, count(*) FILTER (priority IS NULL) / count(*)::DOUBLE AS null_rate,
               array_to_string(list_sort(list(DISTINCT priority) FILTER (priority IS NOT NULL)), '|') AS categories,
               NULL::TIMESTAMP AS earliest, NULL::TIMESTAMP AS latest FROM ({DUCK_DIRTY})
        UNION ALL SELECT 'status', 'string', 0.0, array_to_string(list_sort(list(DISTINCT status)), '|'), NULL, NULL FROM ({DUCK_DIRTY})
        UNION ALL SELECT 'placed', 'datetime64', 0.0, NULL, min(o_orderdate), max(o_orderdate) FROM orders""",
)
def profile_categories(spark, d):
    dates = table(spark, d, "orders").selectExpr("o_orderkey", "o_orderdate AS placed")
    df = dirty_orders(spark, d).select("o_orderkey", "priority", "status").join(dates, "o_orderkey")
    return P.profile(df, ["priority", "status", "placed"]).select(
        "name", "dtype", "null_rate", F.array_join("categories", "|").alias("categories"), "earliest", "latest"
    )


def _number_sql(t: str, c: str, kind: str) -> str:
    return f"""SELECT '{t}' AS dataset, '{c}' AS name, '{kind}' AS dtype, count(*) AS row_count, count_if({c} IS NULL) / count(*)::DOUBLE AS null_rate,
        round(quantile_cont({c}::DOUBLE, 0.01) - 0.1 * (quantile_cont({c}::DOUBLE, 0.99) - quantile_cont({c}::DOUBLE, 0.01)), 5) AS low,
        round(quantile_cont({c}::DOUBLE, 0.99) + 0.1 * (quantile_cont({c}::DOUBLE, 0.99) - quantile_cont({c}::DOUBLE, 0.01)), 5) AS high,
        NULL::VARCHAR AS categories FROM {t}"""


def _text_sql(t: str, c: str) -> str:
    return f"""SELECT '{t}', '{c}', 'string', count(*), count_if({c} IS NULL) / count(*)::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
        CASE WHEN count(DISTINCT {c}) <= 50 THEN array_to_string(list_sort(list(DISTINCT {c})), '|') END FROM {t}"""


_PROFILED = {
    "customer": [("c_custkey", "integer"), ("c_name", ""), ("c_nationkey", "integer"), ("c_acctbal", "floating"), ("c_mktsegment", "")],
    "supplier": [("s_suppkey", "integer"), ("s_name", ""), ("s_nationkey", "integer"), ("s_acctbal", "floating")],
}


@query("profile_many", " UNION ALL ".join(_number_sql(t, c, k) if k else _text_sql(t, c) for t, cs in _PROFILED.items() for c, k in cs))
def profile_several(spark, d):
    tables = {t: table(spark, d, t).select(*[c for c, _ in cs]) for t, cs in _PROFILED.items()}
    found = rounded(P.profile_many(tables), ["low", "high"], 5).withColumn("categories", F.array_join("categories", "|"))
    return found.select("dataset", "name", "dtype", "row_count", "null_rate", "low", "high", "categories")


_MERGED = {
    "l_quantity": "floating", "l_extendedprice": "floating", "l_partkey": "integer", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "",
}


@query(
    "profile_merged",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, count(*) AS row_count, count_if({c} IS NULL) / count(*)::DOUBLE AS null_rate,
            {f"min({c})::DOUBLE" if k in ("floating", "integer") else "NULL::DOUBLE"} AS lowest,
            {f"max({c})::DOUBLE" if k in ("floating", "integer") else "NULL::DOUBLE"} AS highest,
            {f"array_to_string(list_sort(list(DISTINCT {c})), '|')" if k == "string" else "NULL::VARCHAR"} AS categories,
            {f"min({c})::TIMESTAMP" if not k else "NULL::TIMESTAMP"} AS earliest, {f"max({c})::TIMESTAMP" if not k else "NULL::TIMESTAMP"} AS latest,
            true AS quantiles_within, true AS distinct_within FROM lineitem"""
        for c, k in _MERGED.items()
    ),
)
def profile_merged(spark, d):
    """Two halves profiled apart, stored, merged and held against the whole table: counts, lists and extremes are equal,
    quantiles within twice the stated rank error, numbers of values within a twentieth."""
    lines = table(spark, d, "lineitem").select(*_MERGED)
    halves = []
    for side in (0, 1):
        place = shared_folder(spark, "profile") + ".parquet"
        S.sketch_profile(lines.where(F.pmod(F.xxhash64("l_partkey", "l_quantity"), F.lit(2)) == side)).write.parquet(place)
        halves.append(spark.read.parquet(place))
    merged = S.merge_profiles(*halves)
    errors = S.quantile_rank_errors(lines, merged, [0.01, 0.25, 0.5, 0.75, 0.99]).groupBy("name").agg(F.max("error").alias("error"))
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in _MERGED])
    exact = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("values_exact")) for c in _MERGED])).alias("e")).select("e.*")
    profiled = S.profile_from_sketches(merged).join(merged.select("name", "lowest", "highest"), "name")
    joined = profiled.join(errors, "name", "left").join(exact, "name")
    return joined.select(
        "name", "row_count", "null_rate", "lowest", "highest", F.array_join("categories", "|").alias("categories"), "earliest", "latest",
        F.coalesce(F.col("error") <= 2 * S.RANK_ERROR, F.lit(True)).alias("quantiles_within"),
        (F.abs(F.col("n_values") - F.col("values_exact")) <= 0.05 * F.col("values_exact")).alias("distinct_within"),
    )


def _outside_sql(c: str) -> str:
    bounds = f"(SELECT quantile_cont({c}::DOUBLE, 0.01) AS lo, quantile_cont({c}::DOUBLE, 0.99) AS hi FROM orders)"
    return f"""SELECT '{c}' AS name, 'bounds' AS check, round(avg(({c} NOT BETWEEN lo - 0.1 * (hi - lo) AND hi + 0.1 * (hi - lo))::INT), 9) AS observed,
        0.01::DOUBLE AS threshold, avg(({c} NOT BETWEEN lo - 0.1 * (hi - lo) AND hi + 0.1 * (hi - lo))::INT) <= 0.01 AS passed FROM orders, {bounds}"""


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "suite_roundtrip",
    " UNION ALL ".join([
        *[f"SELECT '{c}' AS name, 'null_rate' AS check, round(avg(({c} IS NULL)::INT) * 100 - avg(({c} IS NULL)::INT) * 100, 9) AS observed, "
          f"5.0::DOUBLE AS threshold, true AS passed FROM orders" for c in _ORDER_COLUMNS],
        *[_outside_sql(c) for c in ("o_orderkey", "o_custkey", "o_totalprice")],
        *[f"SELECT '{c}', 'categories', avg(({c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM orders))::INT), 0.02, true FROM orders" for c in ("o_orderstatus", "o_orderpriority")],
        "SELECT 'o_orderdate', 'dates', avg((o_orderdate < (SELECT min(o_orderdate) FROM orders))::INT), 0.01, true FROM orders",
    ]),
)
def suite_roundtrip(spark, d):
    """A profile saved as JSON, read back and used: the table passes its own profile."""
    orders = table(spark, d, "orders")
    place = shared_folder(spark, "suite")
    P.save_suite(spark, P.suite_from_profile(P.profile(orders)), place)
    found = V.validate(orders, P.load_suite(spark, place))
    return rounded(found.select("name", "check", "observed", "threshold", "passed"), ["observed"], 9)


# A fixed profile of the orders table, and a drifted copy of the table to check against it.
SUITE = {
    "columns": {
        "o_orderkey": {"dtype": "integer", "null_rate": 0.0},
        "o_totalprice": {"dtype": "floating", "null_rate": 0.05, "num_bounds": {"low": 50000.0, "high": 300000.0}},
        "o_orderstatus": {"dtype": "string", "null_rate": 0.0, "categories": ["F", "O", "P"]},
        "o_orderdate": {
            "dtype": "datetime64",
            "null_rate": 0.0,
            "datetime_bounds": {"low": "1996-01-01", "high": "2000-12-31"},
        },
        "o_clerk": {"dtype": "string", "null_rate": 0.0},
    },
    "row_count": 15000,
}
DRIFTED = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
    o_orderdate, o_custkey FROM {orders}"""
DUCK_DRIFTED = DRIFTED.replace("{orders}", "orders")
_CHECKS = {
    "null_rate": [
        ("o_orderkey", "avg((o_orderkey IS NULL)::INT) * 100.0 - 0.0", 5.0),
        ("o_totalprice", "avg((o_totalprice IS NULL)::INT) * 100.0 - 5.0", 5.0),
        ("o_orderstatus", "avg((o_orderstatus IS NULL)::INT) * 100.0 - 0.0", 5.0),
        ("o_orderdate", "avg((o_orderdate IS NULL)::INT) * 100.0 - 0.0", 5.0),
    ],
    "bounds": [
        ("o_totalprice", "avg((o_totalprice NOT BETWEEN 50000.0 AND 300000.0)::INT)", 0.01),
    ],
    "categories": [
        ("o_orderstatus", "avg((o_orderstatus NOT IN ('F', 'O', 'P'))::INT)", 0.02),
    ],
    "dates": [
        (
            "o_orderdate",
            "avg((o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate > TIMESTAMP '2000-12-31')::INT)",
            0.01,
        ),
    ],
}
_STRUCTURE = """SELECT 'o_clerk' AS name, 'missing_column' AS check, count(*) / count(*)::DOUBLE AS observed,
        0.0::DOUBLE AS threshold, false AS passed FROM orders
    UNION ALL SELECT 'o_custkey', 'extra_column', 1.0, 0.0, false"""


def _check_sql(check: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS name, '{check}' AS check, round({value}, 6) AS observed, {limit}::DOUBLE AS threshold,
            {value} <= {limit} AS passed FROM ({DUCK_DRIFTED})"""
        for c, value, limit in _CHECKS[check]
    )


def _drifted(spark, d):
    return spark.sql(DRIFTED, orders=table(spark, d, "orders"))


def _findings(spark, d, *checks):
    found = V.validate(_drifted(spark, d), SUITE)
    found = found.filter(F.col("check").isin(*checks)) if checks else found
    return rounded(found.select("name", "check", "observed", "threshold", "passed"), ["observed"])


@query("validate_nulls", _check_sql("null_rate"))
def validate_nulls(spark, d):
    return _findings(spark, d, "null_rate")


@query("validate_bounds", _check_sql("bounds"))
def validate_bounds(spark, d):
    return _findings(spark, d, "bounds")


@query(
    "validate_bounds_with_nulls",
    f"""SELECT 'o_totalprice' AS name, round(avg(CASE WHEN o_totalprice BETWEEN 50000.0 AND 300000.0 THEN 0 ELSE 1 END), 6)
        AS observed FROM ({DUCK_DRIFTED})""",
)
def validate_bounds_with_nulls(spark, d):
    found = V.validate(_drifted(spark, d), SUITE, count_nulls=True).filter("check = 'bounds'")
    return rounded(found.select("name", "observed"), ["observed"])


@query("validate_categories", _check_sql("categories"))
def validate_categories(spark, d):
    return _findings(spark, d, "categories")


@query("validate_dates", _check_sql("dates"))
def validate_dates(spark, d):
    return _findings(spark, d, "dates")


@query("validate_structure", _STRUCTURE)
def validate_structure(spark, d):
    return _findings(spark, d, "missing_column", "extra_column")


@query("validate_report", " UNION ALL ".join([_STRUCTURE, *[_check_sql(c) for c in _CHECKS]]))
def validate_report(spark, d):
    return _findings(spark, d)


@query(
    "novel_categories",
    f"""SELECT 'o_orderstatus' AS name, o_orderstatus AS value, count(*) AS n FROM ({DUCK_DRIFTED})
        WHERE o_orderstatus NOT IN ('F', 'O', 'P') GROUP BY 2""",
)
def novel_categories(spark, d):
    return V.novel_categories(_drifted(spark, d), SUITE)


_LONG = {"line": "l_orderkey || '-' || l_linenumber", "price": "CAST(floor(l_extendedprice) AS BIGINT)::VARCHAR", "flag": "l_returnflag"}


@query(
    "validate_categories_long",
    f"""WITH t AS (SELECT {", ".join(f"{v} AS {c}" for c, v in _LONG.items())}, l_partkey FROM lineitem)
        """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS name, 'categories' AS check, round(count_if({c} IS NOT NULL AND {c} NOT IN
                (SELECT {c} FROM t WHERE l_partkey % 10 <> 0 AND {c} IS NOT NULL)) / count(*)::DOUBLE, 9) AS observed, 0.02::DOUBLE AS threshold,
            count_if({c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM t WHERE l_partkey % 10 <> 0 AND {c} IS NOT NULL)) / count(*)::DOUBLE <= 0.02 AS passed,
            (SELECT count(DISTINCT {c}) FROM t WHERE l_partkey % 10 <> 0)::VARCHAR || ' known' AS detail FROM t"""
        for c in _LONG
    ),
)
def validate_categories_long(spark, d):
    """Baselines as long as the table: every line, price and flag of nine parts in ten, against all lines."""
    lines = table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), F.floor("l_extendedprice").cast("long").cast("string").alias("price"),
        F.col("l_returnflag").alias("flag"), "l_partkey",
    )
    known = V.category_table(lines.where("l_partkey % 10 <> 0"), list(_LONG))
    return rounded(V.validate_long_categories(lines, known, list(_LONG)), ["observed"], 9)


@query(
    "validate_many",
    f"""SELECT 'drifted' AS dataset, name, "check", passed FROM ({" UNION ALL ".join(_check_sql(c) for c in _CHECKS)})
        WHERE NOT passed
        UNION ALL SELECT 'drifted', 'o_clerk', 'missing_column', false
        UNION ALL SELECT 'no_suite', NULL, 'suite', false
        UNION ALL SELECT 'unreadable', NULL, 'load', false""",
)
def validate_several(spark, d):
    def load(spec):
        return spark.read.parquet(spec["path"]) if "path" in spec else spec["df"]

    datasets = {
        "drifted": {"df": _drifted(spark, d), "suite": SUITE, "strict_structure": False},
        "off": {"enabled": False},
        "no_suite": {"path": f"{d}/customer.parquet"},
        "unreadable": {"path": f"{d}/no_such_table.parquet", "suite": SUITE},
    }
    found = V.validate_many(spark, datasets, load)
    return V.failures(found).select("dataset", "name", "check", "passed")

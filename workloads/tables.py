"""Columns, rows, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.operators import columns as C, rows as R
from lapsekit.operators.ordering import sort_rows, top_k
from lapsekit.operators.stats import unpack
from workloads.registry import query, table

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
# Orders with nulls injected by rule (see FIXTURES.md).
DIRTY = """SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS custkey,
    CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS priority,
    o_orderstatus AS status
  FROM {orders}"""
DUCK_DIRTY = DIRTY.replace("{orders}", "orders")
CITIES = """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN concat('solo', p_partkey) ELSE p_name END AS city,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS state FROM {part}"""
DUCK_CITIES = CITIES.replace("{part}", "part")


def dirty_orders(spark, d):
    return spark.sql(DIRTY, orders=table(spark, d, "orders"))


def cities(spark, d):
    return spark.sql(CITIES, part=table(spark, d, "part"))


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def drop_some(spark, d):
    return C.drop_columns(table(spark, d, "orders"), ["o_totalprice", "o_orderpriority", "no_such_column"])


@query("select_include", "SELECT l_extendedprice, l_orderkey FROM lineitem")
def select_include(spark, d):
    return C.select_columns(table(spark, d, "lineitem"), include=["l_extendedprice", "absent", "l_orderkey"])


@query("select_exclude", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def select_exclude(spark, d):
    return C.select_columns(table(spark, d, "customer"), exclude=["c_nationkey", "c_acctbal"])


@query("rename_columns", "SELECT s_suppkey AS seller_id, s_name AS seller, s_nationkey, s_acctbal FROM supplier")
def rename_some(spark, d):
    return C.rename_columns(table(spark, d, "supplier"), {"s_suppkey": "seller_id", "s_name": "seller", "x": "y"})


@query("dropna_columns", f"SELECT o_orderkey, custkey, priority, status FROM ({DUCK_DIRTY})")
def dropna_by_share(spark, d):
    return C.dropna_columns(dirty_orders(spark, d), min_missing_ratio=0.4)


@query("dropna_columns_named", f"SELECT o_orderkey, custkey, price, status FROM ({DUCK_DIRTY})")
def dropna_named(spark, d):
    return C.dropna_columns(dirty_orders(spark, d), cols=["priority", "custkey", "status"], min_missing_ratio=0.3)


@query(
    "feature_types",
    f"""SELECT 'custkey' AS name, 'numeric' AS kind, count(custkey) AS n_present FROM ({DUCK_DIRTY})
        UNION ALL SELECT 'price', 'numeric', count(price) FROM ({DUCK_DIRTY})
        UNION ALL SELECT 'priority', 'categorical', count(priority) FROM ({DUCK_DIRTY})""",
)
def inferred_features(spark, d):
    df = dirty_orders(spark, d)
    numeric, categorical = C.feature_types(df, "status", ["o_orderkey"])
    kinds = {**dict.fromkeys(numeric, "numeric"), **dict.fromkeys(categorical, "categorical")}
    row = df.agg(*[F.count(c).alias(c) for c in kinds])
    return unpack(
        row, [F.struct(F.lit(c).alias("name"), F.lit(k).alias("kind"), F.col(c).alias("n_present")) for c, k in kinds.items()]
    )


@query("dropna_any", f"SELECT * FROM ({DUCK_DIRTY}) WHERE custkey IS NOT NULL AND priority IS NOT NULL")
def dropna_any(spark, d):
    return R.dropna_rows(dirty_orders(spark, d), ["custkey", "priority"])


@query(
    "dropna_all",
    f"SELECT * FROM ({DUCK_DIRTY}) WHERE custkey IS NOT NULL OR priority IS NOT NULL OR price IS NOT NULL",
)
def dropna_all(spark, d):
    return R.dropna_rows(dirty_orders(spark, d), ["custkey", "priority", "price"], how="all")


@query(
    "dropna_thresh",
    f"""SELECT * FROM ({DUCK_DIRTY})
        WHERE (custkey IS NOT NULL)::INT + (priority IS NOT NULL)::INT + (price IS NOT NULL)::INT >= 2""",
)
def dropna_thresh(spark, d):
    return R.dropna_rows(dirty_orders(spark, d), ["custkey", "priority", "price"], how="all", thresh=2)


def _doubled(df, key):
    return df.unionByName(df.filter(F.col(key) % 10 == 0))


@query("dedup_all", f"SELECT * FROM ({DUCK_DIRTY})")
def dedup_all(spark, d):
    return R.drop_duplicates(_doubled(dirty_orders(spark, d), "o_orderkey"), "all")


@query("dedup_none_all", f"SELECT * FROM ({DUCK_DIRTY}) WHERE o_orderkey % 10 <> 0")
def dedup_none_all(spark, d):
    return R.drop_duplicates(_doubled(dirty_orders(spark, d), "o_orderkey"), "all", keep=False)


def _dedup_sql(direction):
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return f"""SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, l_returnflag
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"""


def _lines(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag"
    )


@query("dedup_first", _dedup_sql("ASC"))
def dedup_first(spark, d):
    return R.drop_duplicates(_lines(spark, d), "l_orderkey", "first", LINE_ORDER).drop("l_suppkey")


@query("dedup_last", _dedup_sql("DESC"))
def dedup_last(spark, d):
    return R.drop_duplicates(_lines(spark, d), "l_orderkey", "last", LINE_ORDER).drop("l_suppkey")


@query(
    "dedup_none",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem
       WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) = 1)""",
)
def dedup_none(spark, d):
    return R.drop_duplicates(_lines(spark, d), "l_orderkey", keep=False)


_RATES = """SELECT l_orderkey, l_partkey, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_discount + 0.0 END AS rate
    FROM {lineitem}"""


@query("filter_nonzero", f"SELECT * FROM ({_RATES.format(lineitem='lineitem')}) WHERE rate IS NULL OR rate <> 0")
def filter_nonzero(spark, d):
    return R.filter_not_equal(spark.sql(_RATES, lineitem=table(spark, d, "lineitem")), "rate", 0.0)


@query("filter_below", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 10")
def filter_small(spark, d):
    return R.filter_below(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 10)


@query("filter_members", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')")
def filter_statuses(spark, d):
    return R.filter_members(table(spark, d, "orders"), "o_orderstatus", ["F", "P"]).select("o_orderkey")


@query(
    "single_type_groups",
    """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
       WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1)""",
)
def single_type(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return R.single_valued_groups(lines, "l_orderkey", "l_returnflag")


@query(
    "conflict_pairs",
    f"""SELECT DISTINCT city, state FROM ({DUCK_CITIES}) WHERE state IS NOT NULL AND city IN
        (SELECT city FROM ({DUCK_CITIES}) GROUP BY city HAVING count(DISTINCT state) > 1) ORDER BY city, state""",
)
def conflict_pairs(spark, d):
    return R.conflicting_pairs(cities(spark, d), "city", "state")


_DISAMBIGUATED = f"""SELECT p_partkey, CASE WHEN city IN
    (SELECT city FROM ({DUCK_CITIES}) GROUP BY city HAVING count(DISTINCT state) > 1)
    THEN city || '_' || state ELSE city END AS city, state FROM ({DUCK_CITIES})"""


@query("disambiguate", _DISAMBIGUATED)
def disambiguate(spark, d):
    return R.disambiguate_city_state(cities(spark, d), "city", "state")


@query("disambiguate_shuffled", _DISAMBIGUATED)
def disambiguate_shuffled(spark, d):
    return R.disambiguate_city_state(cities(spark, d), "city", "state")


@query(
    "below_quantile",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice < (SELECT quantile_cont(o_totalprice, 0.01) FROM orders)""",
)
def below_quantile(spark, d):
    return R.filter_below_quantile(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 0.01)


@query(
    "fillna_zero",
    f"""SELECT o_orderkey, coalesce(custkey, 0) AS custkey, coalesce(price, 0) AS price,
               coalesce(priority, '0') AS priority, status FROM ({DUCK_DIRTY})""",
)
def fillna_zero(spark, d):
    return R.fill_null(dirty_orders(spark, d), 0)


@query(
    "replace_values",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
              CASE o_orderpriority WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def replace_labels(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return R.replace_values(orders, {"F": "filled", "O": "open", "5-LOW": "low"})


@query(
    "top_k",
    "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey DESC, l_partkey DESC LIMIT 10",
)
def largest(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return top_k(lines, ["l_extendedprice", "l_orderkey", "l_partkey"], 10)


@query(
    "bottom_k",
    f"SELECT o_orderkey, price FROM ({DUCK_DIRTY}) ORDER BY price ASC NULLS LAST, o_orderkey LIMIT 10",
)
def smallest(spark, d):
    return top_k(dirty_orders(spark, d).select("o_orderkey", "price"), ["price", "o_orderkey"], 10, largest=False)


@query("sort_rows", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY c_mktsegment, c_acctbal")
def sorted_customers(spark, d):
    return sort_rows(table(spark, d, "customer").select("c_mktsegment", "c_acctbal", "c_custkey"), ["c_mktsegment", "c_acctbal"])

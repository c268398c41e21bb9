"""Feature preparation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lapsekit.operators import features as X, hashing as H
from workloads.registry import query, rounded, table
from workloads.tables import DUCK_DIRTY, dirty_orders

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
# Customers with gaps in one number and in the category.
GAPPED = """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance,
    CAST(c_nationkey AS DOUBLE) AS nation, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment,
    CAST(3 AS DOUBLE) AS constant FROM {customer}"""
DUCK_GAPPED = GAPPED.replace("{customer}", "customer")


def _gapped(spark, d):
    return spark.sql(GAPPED, customer=table(spark, d, "customer"))


@query(
    "get_dummies",
    f"""SELECT o_orderkey, custkey, price, priority,
               (status IS NOT DISTINCT FROM 'F')::INT AS "status_F", (status IS NOT DISTINCT FROM 'O')::INT AS "status_O",
               (status IS NOT DISTINCT FROM 'P')::INT AS "status_P" FROM ({DUCK_DIRTY})""",
)
def get_dummies(spark, d):
    return X.get_dummies(dirty_orders(spark, d), ["status"])


@query(
    "get_dummies_nulls",
    f"""SELECT o_orderkey, custkey, price, status,
        {", ".join(f"(priority IS NOT DISTINCT FROM '{p}')::INT AS " + '"priority_' + p + '"' for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))}
        FROM ({DUCK_DIRTY})""",
)
def get_dummies_nulls(spark, d):
    return X.get_dummies(dirty_orders(spark, d), "priority")


_FILLED = f"""SELECT c_custkey, coalesce(balance, (SELECT median(balance) FROM ({DUCK_GAPPED}))) AS balance, nation,
    coalesce(segment, (SELECT segment FROM ({DUCK_GAPPED}) WHERE segment IS NOT NULL
                       GROUP BY 1 ORDER BY count(*) DESC, segment LIMIT 1)) AS segment, constant FROM ({DUCK_GAPPED})"""


@query("impute_median", f"SELECT c_custkey, round(balance, 6) AS balance FROM ({_FILLED})")
def impute_median(spark, d):
    return rounded(X.impute_median(_gapped(spark, d).select("c_custkey", "balance"), "balance"), ["balance"])


@query("impute_mode", f"SELECT c_custkey, segment FROM ({_FILLED})")
def impute_mode(spark, d):
    return X.impute_mode(_gapped(spark, d).select("c_custkey", "segment"), ["segment"])


@query(
    "standardize",
    f"""SELECT c_custkey,
          round((balance - (SELECT avg(balance) FROM ({DUCK_GAPPED}))) / (SELECT stddev_pop(balance) FROM ({DUCK_GAPPED})), 5) AS balance,
          round((nation - (SELECT avg(nation) FROM ({DUCK_GAPPED}))) / (SELECT stddev_pop(nation) FROM ({DUCK_GAPPED})), 5) AS nation,
          segment, 0.0::DOUBLE AS constant FROM ({DUCK_GAPPED})""",
)
def standardize(spark, d):
    cols = ["balance", "nation", "constant"]
    return rounded(X.standardize(_gapped(spark, d), cols), cols, 5)


def _slots(df, column, names):
    values = vector_to_array(column)
    return [F.round(values[i], 5).alias(n) for i, n in enumerate(names)]


@query(
    "one_hot",
    f"""SELECT c_custkey, {", ".join(f"(segment = '{s}')::INT::DOUBLE AS {s.lower()}" for s in SEGMENTS)}
        FROM ({_FILLED})""",
)
def one_hot(spark, d):
    df = _gapped(spark, d)
    vectors = X.preprocessor([], ["segment"]).fit(df).transform(df)
    return vectors.select("c_custkey", *_slots(vectors, "features", [s.lower() for s in SEGMENTS]))


@query(
    "one_hot_unseen",
    """SELECT c_custkey, (c_mktsegment = 'AUTOMOBILE')::INT::DOUBLE AS automobile,
              (c_mktsegment = 'FURNITURE')::INT::DOUBLE AS furniture, (c_mktsegment = 'HOUSEHOLD')::INT::DOUBLE AS household,
              (c_mktsegment = 'MACHINERY')::INT::DOUBLE AS machinery FROM customer""",
)
def one_hot_unseen(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    seen = customers.filter("c_mktsegment <> 'BUILDING'")
    vectors = X.preprocessor([], ["c_mktsegment"]).fit(seen).transform(customers)
    names = [s.lower() for s in SEGMENTS if s != "BUILDING"]
    return vectors.select("c_custkey", *_slots(vectors, "features", names))


@query(
    "feature_matrix",
    f"""WITH f AS ({_FILLED})
        SELECT c_custkey, round((balance - (SELECT avg(balance) FROM f)) / (SELECT stddev_pop(balance) FROM f), 5) AS balance,
               round((nation - (SELECT avg(nation) FROM f)) / (SELECT stddev_pop(nation) FROM f), 5) AS nation,
               0.0::DOUBLE AS constant, {", ".join(f"(segment = '{s}')::INT::DOUBLE AS {s.lower()}" for s in SEGMENTS)} FROM f""",
)
def feature_matrix(spark, d):
    df = _gapped(spark, d)
    vectors = X.preprocessor(["balance", "nation", "constant"], ["segment"]).fit(df).transform(df)
    names = ["balance", "nation", "constant", *[s.lower() for s in SEGMENTS]]
    return vectors.select("c_custkey", *_slots(vectors, "features", names))


@query(
    "dated_feature_matrix",
    """WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS v FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - m) / v, 5) AS quantity,
              (l_returnflag = 'A')::INT::DOUBLE AS a, (l_returnflag = 'N')::INT::DOUBLE AS n, (l_returnflag = 'R')::INT::DOUBLE AS r,
              floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3600000000)::DOUBLE AS lag
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey, s""",
)
def dated_feature_matrix(spark, d):
    from lapsekit.operators.derive import add_order_lags

    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    pipeline, gaps = X.dated_feature_pipeline(
        ["l_quantity"], ["l_returnflag"], {"lag": ("o_orderdate", "l_shipdate")}
    )
    df = add_order_lags(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), gaps)
    # The scaling and the flags are learned from the lines alone, as the SQL's s, so the passes of the
    # fit read lineitem and only the transform pays for the join.
    vectors = pipeline.fit(lines).transform(df)
    return vectors.select(
        "l_orderkey", "l_linenumber", "l_partkey", *_slots(vectors, "features", ["quantity", "a", "n", "r", "lag"])
    )


_HASHED = "SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_orderkey || '-' || l_linenumber AS line, l_partkey::VARCHAR AS part, l_returnflag AS flag FROM lineitem"


def _vocabulary_sql(c: str) -> str:
    digest = f"md5('{c}=' || {c})"
    return f"""SELECT '{c}' AS name, {c} AS value, count(*) AS n, CAST(('0x' || substr({digest}, 1, 8))::BIGINT % 1024 AS INTEGER) AS slot,
        CASE WHEN ('0x' || substr({digest}, 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS sign FROM h WHERE l_orderkey % 5 <> 0 AND {c} IS NOT NULL GROUP BY {c}"""


_VOCABULARY = f"WITH h AS MATERIALIZED ({_HASHED}), v AS ({' UNION ALL '.join(_vocabulary_sql(c) for c in ('line', 'part', 'flag'))})"


def _hashed_lines(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
        F.col("l_partkey").cast("string").alias("part"), F.col("l_returnflag").alias("flag"),
    )


@query(
    "one_hot_hashed",
    f"""{_VOCABULARY}, e AS (
            {" UNION ALL ".join(f"SELECT rid, slot, sign FROM h JOIN v ON name = '{c}' AND value = {c}" for c in ("line", "part", "flag"))}
        ), s AS (SELECT rid, slot, sum(sign) AS value FROM e GROUP BY ALL HAVING sum(sign) <> 0)
        SELECT h.l_orderkey, h.l_linenumber, coalesce(string_agg(slot || ':' || value, ' ' ORDER BY slot), '') AS slots
        FROM h LEFT JOIN s USING (rid) GROUP BY h.rid, h.l_orderkey, h.l_linenumber""",
)
def one_hot_hashed(spark, d):
    """A column with a category per line next to others, in 1,024 slots; lines of each fifth order are unseen."""
    lines = _hashed_lines(spark, d)
    known = H.hash_vocabulary(lines.where("l_orderkey % 5 <> 0"), ["line", "part", "flag"], 1024)
    slotted = H.hashed_slots(lines, known, ["line", "part", "flag"])
    text = F.array_join(F.transform("slots", lambda e: F.concat_ws(":", e["slot"], e["value"])), " ")
    return slotted.select("l_orderkey", "l_linenumber", text.alias("slots"))


@query(
    "hash_collisions",
    f"""{_VOCABULARY}, f AS (SELECT slot, count(*) AS together FROM v GROUP BY slot)
        SELECT name, count(*) AS n_values, count(DISTINCT slot) AS n_slots, CAST(count_if(together > 1) AS BIGINT) AS n_shared,
               round(sum(CASE WHEN together > 1 THEN n ELSE 0 END) / sum(n)::DOUBLE, 9) AS shared_rows FROM v JOIN f USING (slot) GROUP BY name""",
)
def hash_collisions(spark, d):
    known = H.hash_vocabulary(_hashed_lines(spark, d).where("l_orderkey % 5 <> 0"), ["line", "part", "flag"], 1024)
    return rounded(H.collision_report(known), ["shared_rows"], 9)

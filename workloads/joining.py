"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.operators import joins as J
from workloads.registry import query, table

# Both sides carry null keys and keys without a partner.
LEFT = """SELECT o_orderkey, o_totalprice AS amount,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN -o_custkey - 1 ELSE o_custkey END AS custkey FROM {orders}"""
RIGHT = """SELECT CASE WHEN c_custkey = 9 THEN NULL WHEN c_acctbal <= 0 THEN c_custkey + 1000000000000 ELSE c_custkey END AS custkey,
    c_mktsegment AS segment, c_acctbal AS amount FROM {customer}"""
DUCK_LEFT, DUCK_RIGHT = LEFT.replace("{orders}", "orders"), RIGHT.replace("{customer}", "customer")


def _sides(spark, d):
    return (
        spark.sql(LEFT, orders=table(spark, d, "orders")),
        spark.sql(RIGHT, customer=table(spark, d, "customer")),
    )


def _sql(how, key):
    return f"""SELECT l.o_orderkey, l.amount, {key} AS custkey, r.segment, r.amount AS amount_r
        FROM ({DUCK_LEFT}) l {how} JOIN ({DUCK_RIGHT}) r ON l.custkey IS NOT DISTINCT FROM r.custkey"""


@query("join_left", _sql("LEFT", "l.custkey"))
def join_left(spark, d):
    left, right = _sides(spark, d)
    return J.join(left, right, "custkey")


@query("join_inner", _sql("INNER", "l.custkey"))
def join_inner(spark, d):
    left, right = _sides(spark, d)
    return J.join(left, right, "custkey", "inner")


@query("join_outer", _sql("FULL OUTER", "coalesce(l.custkey, r.custkey)"))
def join_outer(spark, d):
    left, right = _sides(spark, d)
    return J.join(left, right, "custkey", "outer")


@query("join_right", _sql("RIGHT", "r.custkey"))
def join_right(spark, d):
    left, right = _sides(spark, d)
    return J.join(left, right, "custkey", "right")


@query(
    "join_suffix",
    f"""SELECT l.o_orderkey, l.amount, l.custkey, r.segment, r.amount AS amount_cust
        FROM ({DUCK_LEFT}) l LEFT JOIN ({DUCK_RIGHT}) r ON l.custkey IS NOT DISTINCT FROM r.custkey""",
)
def join_suffix(spark, d):
    left, right = _sides(spark, d)
    return J.join(left, right, ["custkey"], suffix_right="_cust")


@query(
    "join_left_on_right_on",
    """SELECT s.s_suppkey, s.s_name, s.s_nationkey, n.n_nationkey, n.n_name
       FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
)
def join_named_keys(spark, d):
    suppliers = table(spark, d, "supplier").drop("s_acctbal")
    return J.join(
        suppliers, table(spark, d, "nation"), left_on="s_nationkey", right_on="n_nationkey", select=["n_name"]
    )


@query(
    "join_select",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand
       FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
)
def join_select(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, d, "part").withColumnRenamed("p_partkey", "l_partkey")
    return J.join(lines, parts, "l_partkey", select=["p_brand", "no_such_column"])


@query(
    "join_composite",
    """WITH pairs AS (SELECT l_partkey, l_suppkey, count(*) AS n_lines FROM lineitem GROUP BY ALL)
       SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, p.n_lines
       FROM lineitem l LEFT JOIN pairs p USING (l_partkey, l_suppkey)""",
)
def join_composite(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    pairs = lines.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return J.join(lines, pairs, ["l_partkey", "l_suppkey"])


@query(
    "join_validate",
    "SELECT o.*, c.c_mktsegment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey",
)
def join_validated(spark, d):
    customers = table(spark, d, "customer").selectExpr("c_custkey AS o_custkey", "c_mktsegment")
    return J.join(table(spark, d, "orders"), customers, "o_custkey", validate="m:1")


@query(
    "repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def repeated(spark, d):
    return J.repeated_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "lookup_broadcast",
    """SELECT c.c_custkey, c.c_name, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def lookup(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    names = table(spark, d, "nation").select("n_nationkey", "n_name")
    return J.lookup(customers, names, "c_nationkey", "n_nationkey")


@query(
    "semi_join",
    "SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def semi_join(spark, d):
    returned = table(spark, d, "lineitem").filter("l_returnflag = 'R'").selectExpr("l_orderkey AS o_orderkey")
    return J.keep_matching(table(spark, d, "orders"), returned, "o_orderkey")

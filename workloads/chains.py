"""Whole step lists and multi-table runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsekit.operators.joins import join
from lapsekit.plans.runner import run_datasets
from lapsekit.plans.steps import apply_steps
from lapsekit.session import shared_folder
from workloads.labelling import label_sql
from workloads.registry import query, rounded, table

ORDER_STEPS = [
    {"op": "drop_duplicates", "subset": "all", "keep": "first"},
    {"op": "lowercase_categoricals", "cat_cols": ["o_orderpriority", "o_orderstatus"]},
    {"op": "dropna_rows", "subset": ["o_custkey"], "how": "any"},
    {"op": "rename_columns", "mapping": {"o_totalprice": "price"}},
    {"op": "group_by_features", "group_mapping": {"worth": ["price", "o_custkey"]}, "agg_funcs": "sum", "keep_original": True},
    {
        "op": "make_label",
        "customer_col": "o_custkey",
        "purchase_ts_col": "o_orderdate",
        "filter_status_col": "o_orderstatus",
        "keep_statuses": "f",
    },
    {"op": "drop_columns", "cols": ["o_orderdate"]},
    {"op": "select_columns", "exclude": ["o_orderstatus"]},
]


@query(
    "steps_orders",
    f"""SELECT o.o_orderkey, o.o_custkey, o.o_totalprice AS price, replace(lower(o.o_orderpriority), ' ', '_') AS o_orderpriority,
               round(o.o_totalprice + o.o_custkey, 6) AS worth, l.churned
        FROM orders o JOIN ({label_sql("o_orderstatus = 'F'")}) l ON o.o_orderkey = l.o_orderkey""",
)
def steps_orders(spark, d):
    return rounded(apply_steps(table(spark, d, "orders"), ORDER_STEPS), ["worth"])


# The raw tables of the multi-table run: the same expressions in both engines.
RAW = {
    "facts": """SELECT o_orderkey AS order_id, upper(o_orderstatus) AS order_status, l_extendedprice AS order_products_value,
        l_quantity AS order_items_qty, l_linenumber AS line, l_discount AS product_name_lenght, l_shipdate AS review_creation_date,
        l_returnflag AS review_comment_title,
        CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_custkey END AS customer_id, l_partkey AS product_id,
        o_orderpriority AS product_category_name, o_orderdate AS order_purchase_timestamp,
        CASE WHEN o_orderkey % 3 = 0 THEN 'Porto Alegre' WHEN o_orderkey % 3 = 1 THEN 'Santos' ELSE 'Natal' END AS customer_city,
        CASE WHEN o_orderkey % 6 = 3 THEN 'RS' WHEN o_orderkey % 6 = 0 THEN 'PA' ELSE 'SP' END AS customer_state
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "payments": """SELECT l_orderkey AS order_id, l_linenumber AS sequential, l_quantity AS installments,
        l_returnflag AS payment_type, l_extendedprice AS value FROM {lineitem}""",
    "measures": "SELECT p_partkey AS product_id, p_size AS product_weight_g, p_retailprice AS product_length_cm FROM {part}",
    "customers": "SELECT c_custkey AS customer_id, c_name AS customer_unique_id FROM {customer}",
    "sellers": """SELECT l_orderkey AS order_id, l_partkey AS product_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE s_name END AS seller_id,
        n_name AS seller_city, r_name AS seller_state
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
        JOIN {region} ON n_regionkey = r_regionkey""",
    "translation": """SELECT o_orderpriority AS product_category_name,
        substring(o_orderpriority, 3) AS product_category_name_english FROM {orders}""",
}
_NAMES = ["orders", "lineitem", "part", "customer", "supplier", "nation", "region"]
DUCK_RAW = {k: v.format(**{n: n for n in _NAMES}) for k, v in RAW.items()}


def raw_tables(spark, d):
    sources = {n: table(spark, d, n) for n in _NAMES}
    return {k: spark.sql(v, **{n: df for n, df in sources.items() if "{" + n + "}" in v}) for k, v in RAW.items()}


DATASETS = [
    {
        "name": "payments_basic",
        "input": "payments",
        "steps": [
            {"op": "lowercase_categoricals", "cat_cols": ["payment_type"]},
            {"op": "dropna_rows", "subset": ["order_id", "payment_type"], "how": "any"},
            {"op": "rename_columns", "mapping": {"value": "summary_payments_value"}},
            {"op": "drop_duplicates", "subset": "all", "keep": "first", "ignore_index": True},
            {
                "op": "groupby_aggregate",
                "by": "order_id",
                "sum_cols": ["sequential", "summary_payments_value"],
                "mean_cols": ["installments"],
                "order_by": ["payment_type"],
            },
        ],
    },
    {
        "name": "measures_basic",
        "input": "measures",
        "steps": [
            {"op": "dropna_rows", "subset": ["product_id", "product_weight_g"], "how": "any"},
            {"op": "drop_duplicates", "subset": "all"},
        ],
    },
    {
        "name": "customers_basic",
        "input": "customers",
        "steps": [{"op": "dropna_rows", "how": "any"}, {"op": "drop_duplicates", "subset": "all"}],
    },
    {
        "name": "facts_basic",
        "input": "facts",
        "steps": [
            {"op": "drop_duplicates", "subset": "all"},
            {"op": "dropna_rows", "subset": ["order_id", "order_status", "customer_id"], "how": "any"},
            {"op": "lowercase_categoricals", "cat_cols": ["order_status", "customer_city", "customer_state", "product_category_name"]},
            {"op": "disambiguate_city_state", "city_col": "customer_city", "state_col": "customer_state"},
            {"op": "rename_columns", "mapping": {"product_name_lenght": "product_name_length"}},
            {
                "op": "groupby_aggregate",
                "by": "order_id",
                "sum_cols": ["order_products_value", "order_items_qty"],
                "mean_cols": ["product_name_length"],
                "min_cols": ["review_creation_date"],
                "first_for_rest": True,
                "order_by": ["line", "product_id", "order_products_value"],
            },
        ],
    },
    {
        "name": "sellers_basic",
        "input": "sellers",
        "steps": [
            {"op": "dropna_rows", "subset": ["order_id", "product_id", "seller_id"], "how": "any"},
            {"op": "drop_duplicates", "subset": "all", "keep": "first", "ignore_index": True},
            {"op": "lowercase_categoricals", "cat_cols": ["seller_city", "seller_state"]},
            {"op": "disambiguate_city_state", "city_col": "seller_city", "state_col": "seller_state"},
        ],
    },
    {
        "name": "translation_basic",
        "input": "translation",
        "steps": [
            {"op": "lowercase_categoricals"},
            {"op": "dropna_rows", "subset": ["product_category_name", "product_category_name_english"], "how": "any"},
            {"op": "drop_duplicates", "subset": "all"},
        ],
    },
    {
        "name": "master_basic",
        "input": "facts_basic",
        "steps": [
            {"op": "join", "right": "payments_basic", "on": ["order_id"], "suffix_right": "_pay"},
            {"op": "join", "right": "measures_basic", "on": ["product_id"], "suffix_right": "_prod"},
            {"op": "join", "right": "customers_basic", "on": ["customer_id"], "suffix_right": "_cust"},
            {"op": "join", "right": "sellers_basic", "on": ["order_id", "product_id"], "suffix_right": "_sel"},
            {"op": "join", "right": "translation_basic", "on": ["product_category_name"], "suffix_right": "_tr"},
        ],
    },
    {
        "name": "master_clean",
        "input": "master_basic",
        "steps": [
            {"op": "drop_duplicates", "subset": "all"},
            {"op": "drop_columns", "cols": ["review_comment_title"]},
            {"op": "dropna_rows", "how": "any"},
        ],
    },
    {
        "name": "master_labelled",
        "input": "master_clean",
        "steps": [
            {
                "op": "make_label",
                "customer_col": "customer_unique_id",
                "purchase_ts_col": "order_purchase_timestamp",
                "horizon_days": 120,
                "reference_date": "max",
                "filter_status_col": "order_status",
                "keep_statuses": ["f", "o"],
            }
        ],
    },
    {
        "name": "baseline_dataset",
        "input": "master_labelled",
        "steps": [
            {
                "op": "select_columns",
                "include": [
                    "order_id", "customer_state", "customer_city", "seller_id", "seller_city", "seller_state",
                    "order_products_value", "summary_payments_value", "installments", "sequential", "payment_type",
                    "product_weight_g", "product_length_cm", "product_category_name_english", "churned",
                ],
            }
        ],
    },
]

_MASTER = f"""
WITH payments AS (SELECT order_id, sum(sequential)::BIGINT AS sequential, round(sum(value), 2) AS summary_payments_value,
        round(avg(installments), 6) AS installments, min(lower(payment_type)) AS payment_type
      FROM (SELECT DISTINCT * FROM ({DUCK_RAW["payments"]})) GROUP BY order_id),
  facts0 AS (SELECT DISTINCT * FROM ({DUCK_RAW["facts"]}) WHERE customer_id IS NOT NULL),
  facts1 AS (SELECT * REPLACE (lower(order_status) AS order_status, replace(lower(product_category_name), ' ', '_') AS product_category_name,
        replace(lower(customer_city), ' ', '_') || CASE WHEN customer_city IN (SELECT customer_city FROM facts0 GROUP BY 1
          HAVING count(DISTINCT customer_state) > 1) THEN '_' || lower(customer_state) ELSE '' END AS customer_city,
        lower(customer_state) AS customer_state) FROM facts0),
  facts AS (SELECT * EXCLUDE (order_products_value, order_items_qty, product_name_lenght, review_creation_date, place),
        total AS order_products_value, items AS order_items_qty FROM (SELECT *,
        round(sum(order_products_value) OVER w, 2) AS total, sum(order_items_qty) OVER w AS items,
        row_number() OVER (PARTITION BY order_id ORDER BY line, product_id, order_products_value) AS place
        FROM facts1 WINDOW w AS (PARTITION BY order_id)) WHERE place = 1),
  sellers0 AS (SELECT DISTINCT * FROM ({DUCK_RAW["sellers"]}) WHERE seller_id IS NOT NULL),
  sellers AS (SELECT order_id, product_id, seller_id, replace(lower(seller_city), ' ', '_') || CASE WHEN seller_city IN
        (SELECT seller_city FROM sellers0 GROUP BY 1 HAVING count(DISTINCT seller_state) > 1)
        THEN '_' || replace(lower(seller_state), ' ', '_') ELSE '' END AS seller_city,
        replace(lower(seller_state), ' ', '_') AS seller_state FROM sellers0),
  translation AS (SELECT DISTINCT replace(lower(product_category_name), ' ', '_') AS product_category_name,
        replace(lower(product_category_name_english), ' ', '_') AS product_category_name_english
        FROM ({DUCK_RAW["translation"]})),
  master AS (SELECT DISTINCT f.*, p.* EXCLUDE (order_id), m.* EXCLUDE (product_id), c.customer_unique_id,
        s.* EXCLUDE (order_id, product_id), t.product_category_name_english
      FROM facts f LEFT JOIN payments p USING (order_id) LEFT JOIN ({DUCK_RAW["measures"]}) m USING (product_id)
        LEFT JOIN ({DUCK_RAW["customers"]}) c USING (customer_id) LEFT JOIN sellers s USING (order_id, product_id)
        LEFT JOIN translation t USING (product_category_name)),
  clean AS (SELECT * FROM master WHERE sequential IS NOT NULL AND summary_payments_value IS NOT NULL AND installments IS NOT NULL
        AND payment_type IS NOT NULL AND product_weight_g IS NOT NULL AND product_length_cm IS NOT NULL
        AND customer_unique_id IS NOT NULL AND seller_id IS NOT NULL AND product_category_name_english IS NOT NULL),
  last AS (SELECT customer_unique_id, max(order_purchase_timestamp) AS lp FROM clean WHERE order_status IN ('f', 'o') GROUP BY 1),
  label AS (SELECT customer_unique_id,
        (floor((epoch_us((SELECT max(lp) FROM last)) - epoch_us(lp)) / 86400000000) > 120)::INT AS churned FROM last)
"""


def _run(spark, d):
    """Lazy up to the cleaned master table, which is written because labelling reads it twice."""
    place = shared_folder(spark, "run")
    datasets = [
        {**spec, "output": f"{place}/master_clean.parquet"} if spec["name"] == "master_clean" else spec
        for spec in DATASETS
    ]
    return run_datasets(spark, datasets, tables=raw_tables(spark, d)).frames


@query(
    "steps_master",
    _MASTER
    + """SELECT order_id, customer_state, customer_city, seller_id, seller_city, seller_state, order_products_value,
           summary_payments_value, installments, sequential, payment_type, product_weight_g, product_length_cm,
           product_category_name_english, churned FROM clean LEFT JOIN label USING (customer_unique_id)""",
)
def steps_master(spark, d):
    found = _run(spark, d)["baseline_dataset"]
    return rounded(rounded(found, ["summary_payments_value", "order_products_value"], 2), ["installments"])


@query(
    "master_table",
    """SELECT o.o_orderkey, o.o_custkey, p.n_lines, p.paid, c.c_mktsegment, n.n_name
       FROM orders o
       LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS paid FROM lineitem GROUP BY 1) p
         ON o.o_orderkey = p.l_orderkey
       LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def master_table(spark, d):
    """A chain of left joins: one shuffle by order, small sides broadcast."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("paid")
    )
    customers = table(spark, d, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS nation", "c_mktsegment")
    nations = table(spark, d, "nation").selectExpr("n_nationkey AS nation", "n_name")
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return join(join(join(df, lines, "o_orderkey"), customers, "o_custkey"), nations, "nation").drop("nation")

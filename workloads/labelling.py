"""Churn and inactivity labels."""

from __future__ import annotations

from lapsekit.operators.labels import churn_balance, create_churn_label, inactivity_label
from workloads.registry import query, table


def label_sql(where: str, reference: str = "(SELECT max(lp) FROM l)", horizon: int = 120) -> str:
    return f"""WITH l AS (SELECT o_custkey AS k, max(o_orderdate) AS lp FROM orders WHERE {where} GROUP BY 1),
        c AS (SELECT k, coalesce(floor((epoch_us({reference}) - epoch_us(lp)) / 86400000000) > {horizon}, false)::INT AS churned
              FROM l)
        SELECT o.o_orderkey, o.o_custkey, c.churned FROM orders o LEFT JOIN c ON o.o_custkey = c.k"""


def labelled(spark, d, **options):
    options = {"filter_status_col": "o_orderstatus", "keep_statuses": ("F",), **options}
    out = create_churn_label(table(spark, d, "orders"), "o_custkey", "o_orderdate", **options)
    return out.select("o_orderkey", "o_custkey", "churned")


@query("churn_label", label_sql("o_orderstatus = 'F'"))
def churn_label(spark, d):
    return labelled(spark, d)


@query("churn_label_fixed_date", label_sql("o_orderstatus = 'F'", "TIMESTAMP '1999-06-30'", 30))
def churn_label_fixed_date(spark, d):
    return labelled(spark, d, reference_date="1999-06-30", horizon_days=30)


@query("churn_label_nostatus", label_sql("true"))
def churn_label_nostatus(spark, d):
    return labelled(spark, d, filter_status_col=None)


@query(
    "churn_balance",
    f"""SELECT churned, count(*) AS count FROM ({label_sql("o_orderstatus = 'F'")})
        WHERE churned IS NOT NULL GROUP BY churned""",
)
def balance(spark, d):
    return churn_balance(labelled(spark, d))


_WINDOW = """SELECT user_id, e AS window_end, count(*) FILTER (ts < e) AS n_before,
        (count(*) FILTER (ts >= e) = 0)::INT AS inactive
    FROM ({source}) JOIN (SELECT unnest(generate_series(date_trunc('day', min(ts)) + INTERVAL 7 DAY, max(ts), INTERVAL 7 DAY)) AS e FROM ({source})) ON ts >= e - INTERVAL 7 DAY AND ts < e + INTERVAL {n} DAY
    WHERE e + INTERVAL {n} DAY <= (SELECT max(ts) FROM ({source}))
    GROUP BY ALL HAVING count(*) FILTER (ts < e) > 0"""


def _window_sql(source: str, n: int) -> str:
    return _WINDOW.format(source=source, n=n)


@query("inactivity_label", _window_sql("SELECT * FROM events WHERE event_type = 'purchase'", 3))
def inactivity(spark, d):
    purchases = table(spark, d, "events").filter("event_type = 'purchase'")
    return inactivity_label(purchases, "user_id", "ts", None, 7, 3)


@query("inactivity_label_all", _window_sql("SELECT * FROM events", 7))
def inactivity_all(spark, d):
    return inactivity_label(table(spark, d, "events"), "user_id", "ts", None, 7, 7)

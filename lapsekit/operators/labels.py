"""Churn labels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lapsekit.functions.timing import any_moment, days_between
from lapsekit.operators.columns import as_list, is_datetime


def _moment(field: T.StructField) -> Column:
    """The column as a zone-less timestamp; text that is not a date becomes null."""
    if is_datetime(field):
        return F.col(field.name).cast("timestamp_ntz")
    return any_moment(F.col(field.name))


def create_churn_label(
    df: DataFrame,
    customer_col: str,
    purchase_ts_col: str,
    target_col: str = "churned",
    horizon_days: int = 120,
    reference_date: str | dt.date | dt.datetime | None = "max",
    filter_status_col: str | None = "order_status",
    keep_statuses: Iterable[str] | None = ("delivered",),
    force: bool = False,
) -> DataFrame:
    """Label every row with whether its customer had lapsed at the reference date.

    A customer is 1 when more than ``horizon_days`` whole days passed since their
    last purchase in a kept status, else 0 (also when no purchase date is
    readable). Customers without a kept purchase, and null customers, get null.
    ``reference_date`` is a date, or ``"max"``/``None`` for the latest kept purchase.

    An existing target is returned as it is unless ``force``, which replaces it.
    A requested status column that is missing is an error.

    The plan is one partial aggregate per customer, a scalar subquery for the
    date and one left join back; rows of a hot customer are merged map-side and
    split by the adaptive join.
    """
    if target_col in df.columns:
        if not force:
            return df
        df = df.drop(target_col)
    for name in (customer_col, purchase_ts_col):
        if name not in df.columns:
            raise ValueError(f"column {name!r} is missing")
    kept = df
    if filter_status_col and keep_statuses is not None:
        if filter_status_col not in df.columns:
            raise ValueError(f"status column {filter_status_col!r} is missing; pass None to skip the filter")
        kept = df.filter(F.col(filter_status_col).isin(as_list(keep_statuses)))
    dated = kept.select(F.col(customer_col).alias("__customer"), _moment(df.schema[purchase_ts_col]).alias("__ts"))

    last = dated.groupBy("__customer").agg(F.max("__ts").alias("__last"))
    if reference_date is None or (isinstance(reference_date, str) and reference_date == "max"):
        # One number over the kept rows: a partial maximum per task, no shuffle of rows.
        reference = dated.agg(F.max("__ts")).scalar()
    else:
        reference = F.lit(str(reference_date)).cast("timestamp_ntz")
    overdue = F.coalesce(days_between(F.col("__last"), reference) > horizon_days, F.lit(False))
    labels = last.select("__customer", overdue.cast("int").alias(target_col))
    return df.join(labels, F.col(customer_col) == F.col("__customer"), "left").drop("__customer")


def churn_balance(df: DataFrame, target_col: str = "churned") -> DataFrame:
    """Rows per label value: ``<target>``, ``count``."""
    return df.filter(F.col(target_col).isNotNull()).groupBy(target_col).agg(F.count(F.lit(1)).alias("count"))


def inactivity_label(
    events: DataFrame,
    user_col: str,
    ts_col: str,
    window_ends: Iterable[str | dt.date | dt.datetime] | None = None,
    window_days: int = 7,
    horizon_days: int = 7,
    target_col: str = "inactive",
) -> DataFrame:
    """Per user and window end: were there no actions in the days after the window?

    A user counts for a window end ``t`` when active in ``[t - window_days, t)``
    and is inactive (1) when nothing follows in ``[t, t + horizon_days)``. Window
    ends whose horizon reaches past the last event are left out.

    Without ``window_ends`` the windows follow each other from the day of the first
    event to the last one.

    Each event is copied only to the windows it falls in, and the copies are
    merged map-side per (user, window end) before the single shuffle.
    """
    ts = F.col(ts_col).cast("timestamp_ntz")
    day = F.expr("interval 1 day")
    # One scan for both ends of the table.
    span = events.agg(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi")).alias("s")).scalar()
    if window_ends is None:
        first = F.date_trunc("day", span["lo"]).cast("timestamp_ntz") + day * window_days
        ends = F.sequence(first, F.greatest(first, span["hi"]), day * window_days)
    else:
        ends = F.array(*[F.lit(str(e)).cast("timestamp_ntz") for e in window_ends])
    touched = F.filter("__ends", lambda e: (ts >= e - day * window_days) & (ts < e + day * horizon_days))
    seen = (
        events.filter(F.col(user_col).isNotNull())
        .select(F.col(user_col), ts.alias(ts_col), ends.alias("__ends"))
        .select(F.col(user_col), ts.alias("__ts"), F.explode(touched).alias("window_end"))
        .filter(F.col("window_end") + day * horizon_days <= span["hi"])
    )
    return (
        seen.groupBy(user_col, "window_end")
        .agg(
            F.count_if(F.col("__ts") < F.col("window_end")).alias("n_before"),
            F.count_if(F.col("__ts") >= F.col("window_end")).alias("n_after"),
        )
        .filter("n_before > 0")
        .select(user_col, "window_end", "n_before", (F.col("n_after") == 0).cast("int").alias(target_col))
    )

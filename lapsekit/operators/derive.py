"""New columns from the columns of the same row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lapsekit.functions.rowwise import ROW_AGGREGATES
from lapsekit.functions.text import snake_lower
from lapsekit.functions.timing import hours_between
from lapsekit.operators.columns import as_list, is_numeric, text_columns

RowFunction = str | Callable[..., Column]
_ANY_TYPE = {"count", "nunique", "any", "all"}


def lowercase_categoricals(df: DataFrame, cat_cols: Iterable[str] | None = None) -> DataFrame:
    """Lower-case text columns and replace whitespace runs by ``_``.

    Without names all text columns are taken; absent and non-text names are skipped.
    """
    text = text_columns(df)
    names = text if cat_cols is None else [c for c in as_list(cat_cols) if c in text]
    return df.withColumns({c: snake_lower(F.col(c)) for c in names}) if names else df


def _functions_by_feature(
    features: Sequence[str],
    agg_funcs: RowFunction | Sequence[RowFunction] | Mapping[str, RowFunction],
) -> dict[str, RowFunction]:
    if isinstance(agg_funcs, Mapping):
        uncovered = [f for f in features if f not in agg_funcs]
        if uncovered:
            raise ValueError(f"no aggregate given for {uncovered}")
        return {f: agg_funcs[f] for f in features}
    if isinstance(agg_funcs, str) or callable(agg_funcs):
        return dict.fromkeys(features, agg_funcs)
    if isinstance(agg_funcs, (list, tuple)):
        if len(agg_funcs) != len(features):
            raise ValueError(f"{len(agg_funcs)} aggregates given for {len(features)} features")
        return dict(zip(features, agg_funcs))
    raise TypeError("agg_funcs must be a name, a function, a list or a mapping")


def group_by_features(
    df: DataFrame,
    group_mapping: Mapping[str, str | Sequence[str]],
    agg_funcs: RowFunction | Sequence[RowFunction] | Mapping[str, RowFunction] = "sum",
    keep_original: bool = False,
    prefix: str | None = None,
) -> DataFrame:
    """Row-wise aggregates over lists of columns, named ``[prefix_]feature``.

    A function is a name from :data:`ROW_AGGREGATES` or a callable that takes the
    columns and returns a ``Column`` (a pandas UDF qualifies). Unless
    ``keep_original``, the columns that were aggregated are dropped.
    """
    chosen = _functions_by_feature(list(group_mapping), agg_funcs)
    made: dict[str, Column] = {}
    for feature, source in group_mapping.items():
        names, func = as_list(source), chosen[feature]
        if not names:
            raise ValueError(f"feature {feature!r} has no columns")
        cols = [F.col(c) for c in names]
        if callable(func):
            value = func(*cols)
        elif func not in ROW_AGGREGATES:
            raise ValueError(f"unknown aggregate {func!r}; known: {sorted(ROW_AGGREGATES)}")
        else:
            wrong = [c for c in names if func not in _ANY_TYPE and not is_numeric(df.schema[c])]
            if wrong:
                raise ValueError(f"aggregate {func!r} needs numeric columns, not {wrong}")
            value = ROW_AGGREGATES[func](cols)
        made[f"{prefix}_{feature}" if prefix else feature] = value
    result = df.withColumns(made)
    if keep_original:
        return result
    used = {c for source in group_mapping.values() for c in as_list(source)}
    return result.drop(*[c for c in used if c not in made])


def add_hours_between(df: DataFrame, start_col: str, end_col: str, new_col: str) -> DataFrame:
    """Add the whole hours from one timestamp to another, floored; null stays null."""
    return df.withColumn(new_col, hours_between(F.col(start_col), F.col(end_col)))


def add_order_lags(df: DataFrame, lags: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Several hour gaps at once: ``{new column: (start, end)}``, by default :data:`ORDER_LAGS`."""
    lags = ORDER_LAGS if lags is None else lags
    return df.withColumns({name: hours_between(F.col(a), F.col(b)) for name, (a, b) in lags.items()})


# Hour gaps of an order's life: new column -> (start, end). Fixed values.
ORDER_LAGS = {
    "payment_lag_hours": ("order_purchase_timestamp", "order_aproved_at"),
    "estimated_shipping_lag_hours": ("order_aproved_at", "order_estimated_delivery_date"),
    "actual_and_estimated_shipping_lag_hours": ("order_estimated_delivery_date", "order_delivered_customer_date"),
    "customer_review_response_lag_hours": ("review_creation_date", "review_answer_timestamp"),
    "approval_and_arrival_lag_hours": ("order_aproved_at", "order_delivered_customer_date"),
}

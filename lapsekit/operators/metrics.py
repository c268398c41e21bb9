"""Classification metrics, exact, as small frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from lapsekit.operators.ranks import running_before
from lapsekit.plans.sizing import SINGLE_TASK_BYTES


def _ratio(a: Column, b: Column) -> Column:
    """a / b as a double, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def per_class_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``class``, ``tp``, ``support``, ``predicted`` for every class seen on either side.

    The data is reduced to one row per (label, prediction) pair first.
    """
    pairs = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    as_label = F.struct(
        F.col("l").cast("string").alias("class"),
        F.when(F.col("l").cast("string") == F.col("p").cast("string"), F.col("n")).otherwise(zero).alias("tp"),
        F.col("n").alias("support"),
        zero.alias("predicted"),
    )
    as_prediction = F.struct(
        F.col("p").cast("string").alias("class"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")
    )
    sides = pairs.select(F.explode(F.array(as_label, as_prediction)).alias("s")).select("s.*")
    return sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])


def _with_scores(counts: DataFrame) -> DataFrame:
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return counts.withColumns(
        {
            "precision": _ratio(tp, predicted),
            "recall": _ratio(tp, support),
            "f1": _ratio(2 * tp, support + predicted),
        }
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: ``accuracy`` and macro-averaged ``f1``, ``precision``, ``recall``; 0/0 counts as 0."""
    return _with_scores(per_class_counts(df, label, prediction)).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
    )


def binary_metrics(df: DataFrame, label: str, prediction: str, positive: Any = 1) -> DataFrame:
    """One row: ``precision``, ``recall``, ``f1`` of the positive class."""
    is_label = F.coalesce(F.col(label) == F.lit(positive), F.lit(False))
    is_prediction = F.coalesce(F.col(prediction) == F.lit(positive), F.lit(False))
    counts = df.agg(
        F.count_if(is_label & is_prediction).alias("tp"),
        F.count_if(is_label).alias("support"),
        F.count_if(is_prediction).alias("predicted"),
    )
    return _with_scores(counts).select("precision", "recall", "f1")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class, then ``accuracy``, ``macro avg`` and ``weighted avg``.

    ``class``, ``precision``, ``recall``, ``f1``, ``support``. The averages are
    the total row of a rollup over the classes, so the data is read once.
    """
    scored = _with_scores(per_class_counts(df, label, prediction)).withColumn(
        "class", F.coalesce("class", F.lit("null"))
    )
    weigh = {m: F.sum(F.col(m) * F.col("support")) / F.sum("support") for m in ("precision", "recall", "f1")}
    rolled = scored.rollup("class").agg(
        *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
        *[value.alias(f"w_{m}") for m, value in weigh.items()],
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.sum("support").alias("support"),
    )

    def line(name: Column, precision: str, recall: str, f1: str) -> Column:
        return F.struct(
            name.alias("class"),
            F.col(precision).alias("precision"),
            F.col(recall).alias("recall"),
            F.col(f1).alias("f1"),
            F.col("support"),
        )

    totals = F.array(
        line(F.lit("accuracy"), "accuracy", "accuracy", "accuracy"),
        line(F.lit("macro avg"), "precision", "recall", "f1"),
        line(F.lit("weighted avg"), "w_precision", "w_recall", "w_f1"),
    )
    lines = F.when(F.col("class").isNull(), totals).otherwise(
        F.array(line(F.col("class"), "precision", "recall", "f1"))
    )
    return rolled.select(F.explode(lines).alias("r")).select("r.*")


def confusion_matrix(df: DataFrame, label: str, prediction: str, values: Sequence[Any]) -> DataFrame:
    """One row per label and one ``predicted_<value>`` column per listed prediction."""
    cells = [F.count_if(F.col(prediction).eqNullSafe(F.lit(v))).alias(f"predicted_{v}") for v in values]
    return df.groupBy(label).agg(*cells)


def _auc_per_class(scored: DataFrame, single_task_bytes: int) -> DataFrame:
    """AUC per ``class`` from (class, score, positive) rows; tied scores count half.

    A missing score is an error: leaving the row out would flatter the score.

    Rows are reduced to distinct scores. On large tables the number of negatives
    below each score comes from ranges of scores, never from one sorted task.
    """
    counted = (
        scored.withColumn("score", F.coalesce("score", F.raise_error(F.lit("a labelled row has no score")).cast("double")))
        .groupBy("class", "score")
        .agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    )
    below = running_before(counted, ["class"], "score", ["neg"], single_task_bytes=single_task_bytes)
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2)
    return below.groupBy("class").agg(
        F.try_divide(
            F.sum(won), F.sum("pos").cast("double") * F.sum("neg").cast("double")
        ).alias("auc"),
        F.sum("pos").alias("support"),
    )


def roc_auc(
    df: DataFrame, label: str, score: str | Column, positive: Any = 1, single_task_bytes: int = SINGLE_TASK_BYTES
) -> DataFrame:
    """One row: ``roc_auc`` of the score for the positive class; null without both classes.

    Rows without a label are no evidence and left out; a labelled row without a score is an error.
    """
    scored = df.filter(F.col(label).isNotNull()).select(
        F.lit("1").alias("class"),
        (score if isinstance(score, Column) else F.col(score)).cast("double").alias("score"),
        (F.col(label) == F.lit(positive)).alias("positive"),
    )
    return _auc_per_class(scored, single_task_bytes).select(F.col("auc").alias("roc_auc"))


def roc_auc_ovr(
    df: DataFrame,
    label: str,
    scores: Mapping[Any, str | Column],
    single_task_bytes: int = SINGLE_TASK_BYTES,
) -> DataFrame:
    """One row: one-versus-rest AUC averaged with the class supports as weights.

    ``scores`` maps each class to the column holding its score.
    """
    text = F.col(label).cast("string")
    sides = [
        F.struct(
            F.lit(str(c)).alias("class"),
            (F.col(s) if isinstance(s, str) else s).cast("double").alias("score"),
            (text == str(c)).alias("positive"),
        )
        for c, s in scores.items()
    ]
    scored = df.filter(F.col(label).isNotNull()).select(F.explode(F.array(*sides)).alias("s")).select("s.*")
    weighted = F.sum(F.col("auc") * F.col("support")) / F.sum("support")
    return _auc_per_class(scored, single_task_bytes).agg(weighted.alias("roc_auc_ovr_weighted"))


def scoring_names(n_classes: int) -> list[str]:
    """Metrics used for a target with that many classes (fixed values)."""
    if n_classes <= 2:
        return ["f1", "precision", "recall", "roc_auc"]
    return ["f1_macro", "precision_macro", "recall_macro", "roc_auc_ovr_weighted"]

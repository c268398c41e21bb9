"""Reproducible, exactly stratified splits.

Rows are ordered by a hash of their identity, so a split depends on the data and
the seed and not on the partitioning. The rank of a row within its class is
found without one task per class: hash ranges are counted, the range totals are
accumulated, and rows are numbered inside a range. The numbering and the join
with the totals use the same keys, so the rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from lapsekit.operators.columns import as_list
from lapsekit.operators.ranks import text_running_before
from lapsekit.plans.sizing import SINGLE_TASK_BYTES, fits

# Hash ranges per class, as a power of two. The split itself does not depend on it.
RANGE_BITS = 12
LARGE_RANGE_BITS = 18
_LARGE_BYTES = 1 << 40
_BY_RANGE = ["__class", "__range"]


def range_bits_for(df: DataFrame) -> int:
    """More and smaller ranges for tables that are large, or of unknown size."""
    return RANGE_BITS if fits(df, _LARGE_BYTES) else LARGE_RANGE_BITS


def _keyed(df: DataFrame, label: str | None, ids: list[str], seed: int, range_bits: int) -> DataFrame:
    """Add the class as non-null text, the hash that orders rows, and the hash's range."""
    hashed = F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in ids], F.lit(seed)), 1)
    klass = F.coalesce(F.col(label).cast("string"), F.lit("(null)")) if label else F.lit("")
    return df.withColumns({"__class": klass, "__hash": hashed}).withColumn(
        "__range", F.shiftright("__hash", 63 - range_bits)
    )


def _offsets(keyed: DataFrame, label: str | None, few: bool) -> DataFrame:
    """Per class and range: rows of earlier ranges in the class, rows of earlier classes, class size.

    Ranges are accumulated inside their class. The totals of whole classes are accumulated over all
    classes: in one task where the whole table would fit one (``few``), else by ranges of class names.
    """
    sizes = keyed.groupBy(*_BY_RANGE).agg(F.count(F.lit(1)).alias("n"))
    before = (Window.unboundedPreceding, -1)
    in_class = Window.partitionBy("__class")
    offset = F.coalesce(F.sum("n").over(in_class.orderBy("__range").rowsBetween(*before)), F.lit(0)).alias("__offset")
    if label is None:
        # A single class: one row per range.
        return sizes.select(*_BY_RANGE, offset, F.lit(0).alias("__before"), F.sum("n").over(in_class).alias("__size"))
    totals = sizes.groupBy("__class").agg(F.sum("n").alias("__size"))
    totals = text_running_before(totals, "__class", ["__size"], one_task=few).withColumnRenamed("__size_before", "__before")
    return sizes.select(*_BY_RANGE, offset).join(totals, "__class").select(*_BY_RANGE, "__offset", "__before", "__size")


def _ranked(keyed: DataFrame, offsets: DataFrame, ids: list[str]) -> DataFrame:
    """Add ``__rank``, 1-based within the class, and the columns of ``offsets``."""
    numbered = Window.partitionBy(*_BY_RANGE).orderBy("__hash", *ids)
    return (
        keyed.join(offsets, _BY_RANGE)
        .withColumn("__number", F.row_number().over(numbered))
        .withColumn("__rank", F.col("__offset") + F.col("__number"))
    )


def _shares(totals: DataFrame, total: Column, test_size: float) -> DataFrame:
    """Add each class's share of the test rows, its whole part and the remainder.

    The share is ``test_size`` of the class, in exact decimals, so no class is a whole row or more off it;
    the spare rows that ``ceil`` adds go to the largest remainders.
    """
    size = F.lit(Decimal(repr(float(test_size))))
    shared = totals.withColumn("total", total).withColumn("wanted", F.ceil(F.col("total") * size)).withColumn("share", F.col("n") * size)
    return shared.withColumn("base", F.floor("share")).withColumn("rest", F.col("share") - F.col("base"))


def _quotas_in_one_task(totals: DataFrame, test_size: float) -> DataFrame:
    """``__class, __quota`` by largest remainder, equal remainders by name; windows over one row per class."""
    everything = Window.partitionBy(F.lit(0))
    shares = _shares(totals, F.sum("n").over(everything), test_size)
    order = F.row_number().over(everything.orderBy(F.desc("rest"), "__class"))
    spare = F.col("wanted") - F.sum("base").over(everything)
    return shares.withColumns({"order": order, "spare": spare}).select(
        "__class", (F.col("base") + (F.col("order") <= F.col("spare")).cast("int")).alias("__quota")
    )


def _quotas(totals: DataFrame, test_size: float) -> DataFrame:
    """The same for any number of classes.

    A remainder depends on the class's size alone, so the spare rows are first dealt over distinct
    remainders, of which there are at most as many as sizes. Only classes at the one remainder where
    they run out are put in order of name, by ranges.
    """
    shares = _shares(totals, totals.agg(F.sum("n")).scalar(), test_size)
    spare = shares.agg(F.max("wanted") - F.sum("base")).scalar()
    rests = shares.groupBy("rest").agg(F.count(F.lit(1)).alias("m"))
    larger = Window.partitionBy(F.lit(0)).orderBy(F.desc("rest")).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.least(F.greatest(spare - F.coalesce(F.sum("m").over(larger), F.lit(0)), F.lit(0)), F.col("m"))
    dealt = shares.select("__class", "base", "rest").join(rests.select("rest", "m", taken.alias("taken")), "rest")
    edge = dealt.where("taken > 0 and taken < m").select("__class", "taken", F.lit(1).alias("one"))
    first = text_running_before(edge, "__class", ["one"]).where("one_before < taken").select("__class", F.lit(1).alias("__first"))
    more = F.when(F.col("taken") == F.col("m"), 1).otherwise(F.coalesce("__first", F.lit(0)))
    return dealt.join(first, "__class", "left").select("__class", (F.col("base") + more).alias("__quota"))


def kfold_assign(
    df: DataFrame,
    label: str | None,
    id_cols: str | Iterable[str] | None = None,
    n_splits: int = 5,
    seed: int = 42,
    fold_col: str = "fold",
    range_bits: int | None = None,
    few_classes: bool | None = None,
) -> DataFrame:
    """Add a fold number from 0; per class, and overall, fold sizes differ by at most one.

    ``id_cols`` must identify a row; without them the whole row is hashed. The label may have as many
    classes as rows: unless the table is small (or ``few_classes`` says so), no task holds a row for every class.
    """
    ids = as_list(id_cols) or df.columns
    few = fits(df, SINGLE_TASK_BYTES) if few_classes is None else few_classes
    keyed = _keyed(df, label, ids, seed, range_bits or range_bits_for(df))
    place = F.col("__before") + F.col("__rank") - 1
    ranked = _ranked(keyed, _offsets(keyed, label, few), ids)
    return ranked.select(*df.columns, F.pmod(place, F.lit(n_splits)).cast("int").alias(fold_col))


def holdout_split(
    df: DataFrame,
    label: str | None,
    id_cols: str | Iterable[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    test_col: str = "is_test",
    range_bits: int | None = None,
    few_classes: bool | None = None,
) -> DataFrame:
    """Add a test flag on exactly ``ceil(test_size * n)`` rows.

    Each class gives its proportional share, rounded by largest remainder. With
    ``label=None`` the split is plain random. ``id_cols`` must identify a row;
    without them the whole row is hashed. ``few_classes`` as in :func:`kfold_assign`.
    """
    ids = as_list(id_cols) or df.columns
    few = fits(df, SINGLE_TASK_BYTES) if few_classes is None else few_classes
    keyed = _keyed(df, label, ids, seed, range_bits or range_bits_for(df))
    offsets = _offsets(keyed, label, few)
    if label is None:
        rows_wanted = F.ceil(F.round(F.sum("n") * float(test_size), 9))
        quota = keyed.groupBy(*_BY_RANGE).agg(F.count(F.lit(1)).alias("n")).agg(rows_wanted).scalar()
        return _ranked(keyed, offsets, ids).select(*df.columns, (F.col("__rank") <= quota).alias(test_col))
    totals = offsets.groupBy("__class").agg(F.max("__size").alias("n"))
    quotas = (_quotas_in_one_task if few else _quotas)(totals, test_size)
    ranked = _ranked(keyed, offsets.join(quotas, "__class"), ids)
    return ranked.select(*df.columns, (F.col("__rank") <= F.col("__quota")).alias(test_col))

"""Row samples."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from lapsekit.operators.columns import as_list

_HASHES = 1 << 63


def sample_fraction(
    df: DataFrame, fraction: float | None, seed: int = 42, keys: str | Iterable[str] | None = None
) -> DataFrame:
    """A Bernoulli sample of rows; a fraction of ``None`` or 0 returns everything.

    With ``keys`` the choice is a hash of the key values: the same rows on every
    partitioning and every run.
    """
    if not fraction:
        return df
    names = as_list(keys)
    if not names:
        return df.sample(withReplacement=False, fraction=float(fraction), seed=seed)
    place = F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in names], F.lit(seed)), 1)
    return df.filter(place <= min(int(float(fraction) * _HASHES), _HASHES - 1))

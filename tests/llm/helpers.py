"""Small frames with the awkward rows every operator must take."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def docs(spark, rows):
    """``rows`` of (doc_id, text), with the other columns of documents."""
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in rows], DOC_SCHEMA)


def awkward() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    long_ = prose(rng, 30_000)
    same = prose(rng, 80)
    return [
        (1, None), (2, ""), (3, "   \t\n"), (4, "word"), (5, same), (6, same), (7, same.upper()), (8, long_), (9, long_ + " end"),
        (10, "éÀß 日本 🎉 ▁ \\ </turn>"), (11, "x" * 1000), (None, same), (None, None), (5, same), (12, prose(rng, 60)), (13, "..."),
    ]


def clashing(df):
    """Extra columns named like what operators make."""
    from pyspark.sql import functions as F

    names = ["id", "h", "key", "n", "n_shingles", "component_id", "kept", "score", "held_out", "value", "ids", "k1", "begin", "best", "path", "size", "row"]
    return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

"""Full-text matching and ranking over a text column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from skein.sources.shared import written


#: What lies between words: all but ASCII letters and digits, or all but those of any script.
ASCII, ANY_SCRIPT = "[^a-z0-9]+", r"[^\p{L}\p{N}]+"


def terms(text: Column, separators: str = ASCII) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), separators), lambda w: w != "")


def matches(words: Column, all_of: tuple[str, ...] = (), any_of: tuple[str, ...] = (), none_of: tuple[str, ...] = ()) -> Column:
    """Whether an array of terms has all, one, and none of the given ones."""
    out = F.lit(True)
    for w in all_of:
        out = out & F.array_contains(words, w)
    if any_of:
        out = out & F.arrays_overlap(words, F.array(*map(F.lit, any_of)))
    return out & ~F.arrays_overlap(words, F.array(*map(F.lit, none_of))) if none_of else out


def bm25(docs: DataFrame, key: str, query: list[str], text: str = "text", k1: float = 1.2, b: float = 0.75, separators: str = ASCII) -> DataFrame:
    """key and score of every document with a term of query. Texts are read once; their counts are written, not their words."""
    words = docs.select(key, terms(F.col(text), separators).alias("w"))
    count = lambda q: F.size(F.filter("w", lambda x: x == q))
    tf = written(words.select(key, F.size("w").alias("n"), *(count(q).alias(f"t{i}") for i, q in enumerate(query))), "counts")
    docs_n, mean, *with_term = tf.agg(F.count(F.lit(1)), F.avg("n"), *(F.count_if(F.col(f"t{i}") > 0) for i in range(len(query)))).first()  # one row
    scored = tf.where(" OR ".join(f"t{i} > 0" for i in range(len(query))))
    score = F.lit(0.0)
    for i, d in enumerate(with_term):
        t = F.col(f"t{i}")
        score = score + math.log(1 + (docs_n - d + 0.5) / (d + 0.5)) * t * (k1 + 1) / (t + k1 * (1 - b + b * F.col("n") / F.lit(mean)))
    return scored.select(key, score.alias("score"))

"""Quality rules with host-level verdicts (operator 10), in DataFrame functions only.

Every text gets its rule figures in one pass without a shuffle. Failures are then counted by host;
a beta prior is fitted to the hosts' failure rates by moments (each host weighted by its documents),
and each host's rate is shrunk towards it. The host's verdict is how strict its documents are judged:
a document's margin is the share of the allowed repetition that it leaves unused, and it is kept if it
passes its own rules, its margin reaches its host's shrunk rate, and that is at most max_host_rate.
So a document without repeats stays on any host but the worst, and one that just passes stays on a
host that seldom fails and goes on one that often does.

Null texts have no words and fail (too few words). A null host is a host of its own. Repeated rows
count as often as they appear. An empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, saved

SYMBOLS = "#*$%&|<>"
#: Percent of a text's words that may stand in repeated windows.
ALLOWED = 20


def repeated_window_words(words: Column, size: int = 5) -> Column:
    """Words that stand in a window of size words that occurs at least twice in the text.

    Each word is hashed once, and windows from their words' hashes. Where windows repeat, they are sorted with
    their positions; neighbours in that order that are equal are repeats, and the sorted positions of all repeats
    are covered once each: n log n, no shuffle.
    """

    def let(value: Column, body) -> Column:
        """body(value), computing value once."""
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def windows(h: Column) -> Column:
        starts = F.when(F.size(h) >= size, F.sequence(F.lit(0), F.size(h) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(size))))

    def repeats(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size)))), F.lit(0), lambda a, x: a + x)

    def counted(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(placed, lambda s: let(repeats(s), covered)))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), counted))


def rule_figures(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    blank = F.translate(text, SPACE, "")
    d = docs.withColumn("__skein_words", F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    d = d.withColumn("__skein_lines", F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    d = d.withColumns({
        "n_words": F.size("__skein_words").cast("long"),
        "word_chars": F.length(blank).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("__skein_lines") - F.size(F.array_distinct("__skein_lines"))).cast("long"),
        "n_repeat_words": repeated_window_words(F.col("__skein_words")).cast("long"),
    })
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > ALLOWED * F.col("n_words"))).drop("__skein_words", "__skein_lines")


def host_rates(figures: DataFrame, host: str) -> DataFrame:
    """host, n, failed, rate (shrunk). With one host, or hosts that differ no more than by chance, all shrink to the mean."""
    by = figures.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    by = by.withColumn("p", F.col("failed") / F.col("n"))
    total = by.agg(F.sum("n"), F.sum("failed"), F.count(F.lit(1)), F.sum(F.col("n") * F.col("p") * F.col("p"))).first()  # one row
    n, failed, hosts, squares = (float(x or 0) for x in total)
    mean = failed / n if n else 0.0
    within = mean * (1 - mean)
    strength = 1e9
    if n > hosts:
        # the rates' weighted variance is v + (within - v) * hosts / n for a beta prior of variance v
        v = (squares / n - mean * mean - within * hosts / n) / (1 - hosts / n)
        if 0 < v < within:
            strength = within / v - 1
    return by.select("host", "n", "failed", ((F.col("failed") + mean * strength) / (F.col("n") + strength)).alias("rate"))


def margin() -> Column:
    """The share of the allowed repetition that a document leaves unused: 1 without repeats, 0 at the limit."""
    return 1.0 - 100 * F.col("n_repeat_words") / (ALLOWED * F.col("n_words"))


def quality(docs: DataFrame, host: str = "source", max_host_rate: float = 0.5, keep_text: bool = False) -> DataFrame:
    """docs (without text, unless keep_text) with the rule figures, base_failed, host_rate and kept."""
    figures = rule_figures(docs.drop("host_rate"))
    figures = saved(figures if keep_text else figures.drop("text"), "figures")
    # both sides of the join are written tables: Spark broadcasts few hosts and splits a hot one
    rates = saved(host_rates(figures, host).select(F.col("host").alias("__skein_host"), F.col("rate").alias("host_rate")), "rates")
    out = figures.join(rates, F.col(host).eqNullSafe(F.col("__skein_host"))).drop("__skein_host")
    return out.withColumn("kept", ~F.col("base_failed") & (margin() >= F.col("host_rate")) & (F.col("host_rate") <= max_host_rate))

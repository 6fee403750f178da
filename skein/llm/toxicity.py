"""Toxicity by a classifier chain (operator 8).

Categories are the labels' own columns, predicted one after another by logistic models over the
presence of words; each later model also reads the earlier categories' probabilities. For training,
those come from models that have not seen the row (out of fold), so that later models learn from
what they will meet. Words are chosen by how far their rates in the category and outside it lie
apart, in standard errors.

Training takes at most max_rows labelled documents, those with the smallest hash of their doc_id
(a documented bound). Their words are counted by fold and category on the executors; the driver
gets the chosen words, at most most for each model, and which row holds which of them. Scoring reads
every whole text. Labels that are null are ignored; a doc_id labelled twice takes the larger value;
of documents that repeat a labelled doc_id one is learnt from. Null and empty texts get the bias
only. Without labelled rows, or if a category has one value only, its model is the constant rate.
Repeated rows are scored alike; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F, Window

from .common import Table, text_chunks, word_bytes_table, word_hashes

FOLDS = 5
#: Words chosen for a model at most, and the standard errors by which their rates must differ at least.
MOST, LEAST_Z = 240, 5.5
#: Documents that a chosen word must stand in.
LEAST_DOCS = 5
#: A cut of which fewer rejections are right is not taken; without any such cut the threshold is one half.
LEAST_PRECISION = 0.9


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def distinct_words(column: pa.Array):
    """(first row, rows, hash and row of every distinct word) by slices of the column."""
    inside, value = word_bytes_table(alnum=True)
    for i, n, data, ends in text_chunks(column):
        h, bounds, _, _ = word_hashes(data, ends, inside, value)
        yield i, n, h, np.repeat(np.arange(n), np.diff(bounds))


def word_sets(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns keep and words, the distinct word hashes of text."""

    @F.arrow_udf("array<long>")
    def words(column: pa.Array) -> pa.Array:
        out = []
        for _, n, h, row in distinct_words(column):
            at = np.searchsorted(row, np.arange(n + 1))
            out += [np.unique(h[a:b]).view(np.int64) for a, b in zip(at[:-1], at[1:])]
        return pa.array(out, pa.list_(pa.int64()))

    return docs.select(*keep, words(F.col("text").cast("string")).alias("words"))


@dataclass
class Model:
    """A logistic model over chosen words (sorted hashes) and the probabilities of earlier categories."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray, chain: np.ndarray) -> np.ndarray:
        return np.hstack([x, chain]) @ self.weights + self.bias


def fit(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge-penalised logistic regression, by Newton's method."""
    n, k = x.shape
    rate = (y.sum() + 0.5) / (n + 1)
    w = np.zeros(k + 1)
    w[k] = np.log(rate / (1 - rate))
    if y.min(initial=1) == y.max(initial=0) or n == 0:
        return w[:k], float(w[k])
    ridge = np.append(np.full(k, l2), 1e-6)
    for _ in range(steps):
        curve, slope = np.diag(ridge), -ridge * w
        for i in range(0, n, 1000):  # in blocks of rows, for the driver's memory
            z = np.hstack([x[i : i + 1000], np.ones((len(x[i : i + 1000]), 1))])
            p = _sigmoid(z @ w)
            curve = curve + (z * (p * (1 - p))[:, None]).T @ z
            slope = slope + z.T @ (y[i : i + 1000] - p)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:k], float(w[k])


def chosen_words(sample: DataFrame, names: list[str], most: int, least_z: float) -> dict[tuple[str, int], np.ndarray]:
    """(category, fold left out, or -1 for none): the hashes of the words whose rates in the category and
    outside it differ most, by at least least_z standard errors. sample: fold, words and the categories as 0 or 1."""
    sides = [(c, f) for c in [None, *names] for f in range(FOLDS)]
    here = {k: F.when((F.col("fold") == k[1]) & (F.lit(True) if k[0] is None else F.col(k[0]) == 1), 1).otherwise(0) for k in sides}
    sums = [F.sum(v).alias(f"n{i}") for i, v in enumerate(here.values())]
    rows = sample.agg(*sums).first()  # one row: documents by fold and category
    known = {k: int(rows[i] or 0) for i, k in enumerate(sides)}
    counts = sample.select(F.explode("words").alias("word"), "fold", *names).groupBy("word").agg(*sums)
    at = {k: f"n{i}" for i, k in enumerate(sides)}

    def total(c: str | None, out: int) -> tuple[Column, float]:
        own = [(c, f) for f in range(FOLDS) if f != out]
        return sum((F.col(at[k]) for k in own), F.lit(0)).cast("double"), float(sum(known[k] for k in own))

    scores = []
    for c in names:
        for out in range(-1, FOLDS):
            (both, n), (yes, n1) = total(None, out), total(c, out)
            n0 = n - n1
            if n1 and n0:
                z = F.abs(yes / n1 - (both - yes) / n0) / F.sqrt(both / n * (1 - both / n) * (1 / n1 + 1 / n0) + 1e-12)
                scores.append(F.struct(F.lit(f"{c}/{out}").alias("model"), F.when(both >= LEAST_DOCS, z).otherwise(0.0).alias("z")))
    if not scores:
        return {(c, f): np.zeros(0, np.uint64) for c in names for f in range(-1, FOLDS)}
    best = Window.partitionBy("model").orderBy(F.col("z").desc(), "word")
    top = counts.select("word", F.explode(F.array(*scores)).alias("_")).select("word", "_.*").where(F.col("z") >= least_z)
    top = top.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most).select("model", "word").collect()  # at most most for each model
    by: dict[str, list[int]] = {}
    for r in top:
        by.setdefault(r.model, []).append(r.word)
    return {(c, f): np.sort(np.array(by.get(f"{c}/{f}", []), np.int64).view(np.uint64)) for c in names for f in range(-1, FOLDS)}


def presence(flat: np.ndarray, row: np.ndarray, n: int, words: np.ndarray) -> np.ndarray:
    x = np.zeros((n, len(words)), np.float32)
    if len(words) and len(flat):
        at = np.minimum(np.searchsorted(words, flat), len(words) - 1)
        hit = words[at] == flat
        x[row[hit], at[hit]] = 1
    return x


@dataclass
class Chain:
    names: list[str]
    models: list[Model]
    threshold: float

    def logits(self, flat: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, 0))
        for m in self.models:
            out = np.hstack([out, m.logit(presence(flat, row, n, m.words), _sigmoid(out))[:, None]])
        return out


def train_chain(flat: np.ndarray, sizes: np.ndarray, fold: np.ndarray, labels: dict[str, np.ndarray], words: dict[tuple[str, int], np.ndarray]) -> Chain:
    """The chain over the categories in their order; the last one's threshold is the best F1 out of fold.

    flat: the rows' distinct word hashes behind one another, sizes of them each; words: see chosen_words.
    """
    n = len(sizes)
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    unseen, models = np.zeros((n, 0)), []
    for name, y in labels.items():
        y = y.astype(float)
        out = np.zeros(n)
        for f in range(FOLDS):
            test = fold == f
            x = presence(flat, row, n, words[name, f])
            w, b = fit(np.hstack([x, unseen])[~test], y[~test])
            out[test] = Model(words[name, f], w, b).logit(x[test], unseen[test])
        models.append(Model(words[name, -1], *fit(np.hstack([presence(flat, row, n, words[name, -1]), unseen]), y)))
        unseen = np.hstack([unseen, _sigmoid(out)[:, None]])
    threshold = 0.5
    if n and 0 < y.sum() < n:
        order = np.argsort(-out, kind="stable")
        hit = np.cumsum(y[order])
        f1 = 2 * hit / (np.arange(1, n + 1) + y.sum())
        f1[:-1][out[order][:-1] == out[order][1:]] = -1  # equal scores are not cut apart
        f1[:-1][out[order][1:] > 0] = -1  # never above one half
        f1[hit < LEAST_PRECISION * np.arange(1, n + 1)] = -1
        k = int(f1.argmax())
        if f1[k] > 0:
            below = out[order[k + 1]] if k + 1 < n else out[order[k]] - 1
            threshold = float(_sigmoid(np.array([(out[order[k]] + below) / 2]))[0])
    return Chain(list(labels), models, threshold)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], max_rows: int = 12_000, most: int = MOST, least_z: float = LEAST_Z) -> Chain:
    """A chain for categories (name: a boolean over text and the labels' columns), in their order.

    docs: doc_id, text; labels: doc_id and the label columns. At most max_rows labelled documents are used.
    """
    names = [c for c in labels.columns if c != "doc_id"]
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*(F.max(c).alias(c) for c in names)).dropna(subset=names)
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # at most max_rows ids and labels
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    rows = rows.groupBy("doc_id", *names).agg(F.min("text").alias("text"))
    rows = rows.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"), *(F.coalesce(c, F.lit(False)).cast("int").alias(k) for k, c in categories.items()))
    sample = Table(word_sets(rows, ["doc_id", "fold", *categories]), "labelled")
    words = chosen_words(sample.df, list(categories), most, least_z)
    used = np.unique(np.concatenate(list(words.values()))) if words else np.zeros(0, np.uint64)

    @F.arrow_udf("array<long>")
    def held(column: pa.Array) -> pa.Array:
        flat, sizes = _lists(column)
        hit = np.isin(flat, used)
        at = np.concatenate(([0], np.cumsum(np.bincount(np.repeat(np.arange(len(sizes)), sizes)[hit], minlength=len(sizes))))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(flat[hit].view(np.int64)))

    # at most max_rows rows, with the chosen words alone
    got = sample.df.select("doc_id", "fold", *categories, held("words").alias("words")).toArrow().sort_by("doc_id")
    sample.drop()
    flat, sizes = _lists(got["words"].combine_chunks())
    return train_chain(flat, sizes, got["fold"].to_numpy(), {k: got[k].to_numpy() for k in categories}, words)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists behind one another, and each list's size."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64), sizes


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """docs with p_<category> for each category, and rejected: the last category's probability reaches the threshold."""
    names, logit = chain.names, float(np.log(chain.threshold / (1 - chain.threshold)))

    @F.arrow_udf(f"struct<{','.join(f'{n}:double' for n in names)},rejected:boolean>")
    def predict(column: pa.Array) -> pa.Array:
        # most words are in no model: they are dropped before anything else
        used = np.unique(np.concatenate([m.words for m in chain.models]))
        parts = [np.zeros((0, len(names)))]
        for _, n, h, row in distinct_words(column):
            if len(used):
                hit = used[np.minimum(np.searchsorted(used, h), len(used) - 1)] == h
                h, row = h[hit], row[hit]
            parts.append(chain.logits(h, row, n))
        out = np.vstack(parts)
        return pa.StructArray.from_arrays([*(pa.array(_sigmoid(c)) for c in out.T), pa.array(out[:, -1] >= logit)], [*names, "rejected"])

    kept = [c for c in docs.columns if c != "rejected" and c not in {f"p_{n}" for n in names}]
    out = docs.select(*kept, predict(F.col(text).cast("string")).alias("__skein_p"))
    return out.select(*kept, *(F.col(f"__skein_p.{n}").alias(f"p_{n}") for n in names), F.col("__skein_p.rejected").alias("rejected"))


def default_categories() -> dict[str, Column]:
    """poor (labelled as of low quality) before toxic: the labels' own columns."""
    return {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}

"""MinHash near-dedup with odd sketches (operator 3).

1. One Arrow pass over the texts hashes every word and shingle, takes 256 MinHash samples, folds
   them into a 512-bit odd sketch (each sample flips one bit) and hashes bands of them, as long as
   the threshold allows: at 0.85 32 bands of 8 samples, of which a pair at the threshold shares none
   with a chance of 3.8e-5, at 0.80 42 bands of 6 with 2.9e-6.
2. Equal shingle sets collapse into one representative, by a combinable aggregate.
3. Band groups are dealt out by (band key, chunk), a chunk holding about CHUNK representatives, so
   that a hot band is spread over many tasks. In a chunk, sketches are XORed in blocks; the
   population counts estimate similarities, and each member's closest partner becomes a candidate.
4. Candidates are confirmed on full shingle sets, and components are taken.
5. Members outside a band's dominant component meet, in blocks, all chunks of that band; finer sketches
   (2048 samples in 4096 bits) keep the candidates near the threshold few. A block with very many
   candidates all the same lists none of them, but has its members' full sets brought along and confirms
   in place, where one link joins two components and ends all other pairs between them. Pairs inside a
   component are never listed, so a hot group of near copies costs little.

Rows with a null doc_id count as one document id of their own (null stays null in the result).
Null or blank texts have an empty set and are linked with nothing. Rows that repeat a doc_id each
get a result row; if their texts differ, each is linked for itself, and all of them are one node.
An empty table gives an empty result. Other columns are ignored here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, components, mix, saved, text_chunks, word_bytes_table, word_hashes

SAMPLES, BITS, CHUNK = 256, 512, 1024
#: A block with more candidates for each of its rows confirms them in place.
DENSE = 16
#: A pair at the threshold shares no band with a smaller chance than this.
MISSED = 1e-4
#: Pairs whose estimate is lower are not confirmed: over four standard errors below 0.85; at other thresholds as many (see slack).
SLACK = 0.10
#: The same for the finer sketches of what is left at last.
FINE_SAMPLES, FINE_BITS, FINE_SLACK = 2048, 4096, 0.04


def _constants(samples: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(1, samples + 1, dtype=np.uint64)
    return (mix(i) >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (mix(i + np.uint64(1 << 40)) >> np.uint64(32)).astype(np.uint32)


def band_rows(percent: int, samples: int = SAMPLES) -> int:
    """Samples in a band: the most with which a pair at percent is missed with a chance below MISSED (1 if none is enough)."""
    return max((r for r in range(1, samples + 1) if (1 - (percent / 100) ** r) ** (samples // r) < MISSED), default=1)


def standard_error(s: float, samples: int = SAMPLES, bits: int = BITS) -> float:
    """Of the estimate at a similarity of s: the samples' and the sketch's, whose bits are flipped at random."""
    flips = 2 * samples * (1 - s)
    left = np.exp(-2 * flips / bits)
    return float(np.sqrt(s * (1 - s) / samples + (bits / 4 * (1 - left**2) - flips * left**2) / (2 * samples * left) ** 2))


def slack(percent: int, at_85: float) -> float:
    """As many standard errors below percent as at_85 is below 0.85."""
    return at_85 * standard_error(percent / 100) / standard_error(0.85)


def shingle_sets(data: np.ndarray, ends: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes of its shingles; a text of fewer words is one shingle."""
    inside, value = word_bytes_table()
    h, bounds, _, _ = word_hashes(data, ends, inside, value)
    n = len(h)
    rolled = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(3) + h[k : k + len(rolled)])
    for i in range(len(ends)):
        a, b = int(bounds[i]), int(bounds[i + 1])
        if a == b:
            yield np.zeros(0, np.uint64)
        elif b - a < size:
            one = np.zeros(1, np.uint64)
            for k in range(a, b):
                one = mix(one * np.uint64(3) + h[k])
            yield one ^ np.uint64(b - a)
        else:
            yield np.unique(rolled[a : b - size + 1])


def min_samples(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 2048) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), block):
        t = a[:, None] * x[None, k : k + block]
        t += b[:, None]
        np.minimum(out, t.min(axis=1), out=out)
    return out


def odd_sketch(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parity bitmap of the samples: sample i with value v flips the bit that (i, v) hashes to."""
    where = mix(samples.astype(np.uint64) << np.uint64(16) | np.arange(len(samples), dtype=np.uint64)) % np.uint64(bits)
    return np.packbits((np.bincount(where.astype(np.int64), minlength=bits) & 1).astype(np.uint8))


def similarity(xor_bits: np.ndarray, samples: int = SAMPLES, bits: int = BITS) -> np.ndarray:
    """The similarity that a number of differing sketch bits stands for."""
    return 1 + bits / (4 * samples) * np.log(np.maximum(1 - 2 * xor_bits / bits, 1e-9))


FEATURES = "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, sketch binary, bands array<long>"


def text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def features(docs: DataFrame, shingle: int, rows: int, samples: int = SAMPLES) -> DataFrame:
    """doc_id, hash of the text, set size, 128-bit hash of the set, odd sketch and band hashes of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _constants(samples)
        spread = mix(np.arange(1, samples + 1, dtype=np.uint64) << np.uint64(8))
        for batch in batches:
            for i, n, data, ends in text_chunks(batch.column(2)):
                sizes, h, sketches, bands = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64), [], []
                for k, s in enumerate(shingle_sets(data, ends, shingle)):
                    sizes[k] = len(s)
                    if len(s) == 0:
                        sketches.append(None)
                        bands.append(np.zeros(0, np.int64))
                        continue
                    h[k] = np.add.reduce(mix(s)), np.bitwise_xor.reduce(mix(s * np.uint64(5) + np.uint64(7)))
                    m = min_samples(s, a, b)
                    sketches.append(odd_sketch(m).tobytes())
                    keys = np.add.reduce(mix(m + spread)[: samples // rows * rows].reshape(-1, rows), axis=1)
                    bands.append(mix(keys).view(np.int64))
                lengths = np.concatenate(([0], np.cumsum([len(x) for x in bands]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), batch.column(1).slice(i, n), pa.array(sizes), pa.array(h[:, 0].view(np.int64)), pa.array(h[:, 1].view(np.int64)), pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(bands)))],
                    ["doc_id", "text_hash", "n_shingles", "h1", "h2", "sketch", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), F.col("text").cast("string")).mapInArrow(run, FEATURES)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of whole groups, of sorted rows whose first columns are the keys; only the last group of a batch is carried over."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        if len(t) == 0:
            continue
        k = [np.asarray(t.column(i)) for i in range(keys)]
        last = np.logical_and.reduce([x == x[-1] for x in k])
        cut = int(np.argmax(last))
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut)
    if rest is not None and len(rest):
        yield rest


def _bounds(t: pa.Table, keys: int) -> np.ndarray:
    new = np.ones(len(t), bool)
    new[1:] = np.logical_or.reduce([(x := np.asarray(t.column(i)))[1:] != x[:-1] for i in range(keys)])
    return np.append(np.flatnonzero(new), len(t))


def _sketches(t: pa.Table, bits: int = BITS) -> np.ndarray:
    raw = t.column("sketch").combine_chunks()
    raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
    at = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset]
    return np.frombuffer(raw.buffers()[2], np.uint8, len(t) * bits // 8, at).view(np.uint64).reshape(len(t), -1)


def _estimates(x: np.ndarray, y: np.ndarray, samples: int = SAMPLES, bits: int = BITS) -> np.ndarray:
    return similarity(np.bitwise_count(x[:, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64), samples, bits)


def fine_sketches(texts: DataFrame, shingle: int) -> DataFrame:
    """rep and sketch, from more samples and bits, for texts (rep, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _constants(FINE_SAMPLES)
        for batch in batches:
            for i, n, data, ends in text_chunks(batch.column(1)):
                sketches = [odd_sketch(min_samples(s, a, b, 256), FINE_BITS).tobytes() for s in shingle_sets(data, ends, shingle)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), pa.array(sketches, pa.binary())], ["rep", "sketch"])

    return texts.select("rep", "text").mapInArrow(run, "rep long, sketch binary")


def full_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """rep and shingles, the whole set of sorted hashes in bytes, for texts (rep, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n, data, ends in text_chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), pa.array([s.tobytes() for s in shingle_sets(data, ends, shingle)], pa.binary())], ["rep", "shingles"])

    return texts.select("rep", "text").mapInArrow(run, "rep long, shingles binary")


PAIRS = "a long, b long"


def _pairs(rep: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = rep[i], rep[j]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def closest(groups: DataFrame, least: float) -> DataFrame:
    """For each member of each (key, chunk), the partner with the highest estimate, if that is at least least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 2):
            at, rep, sk = _bounds(t, 2), np.asarray(t.column("rep")), _sketches(t)
            n = np.diff(at)
            two = at[:-1][n == 2]
            est = similarity(np.bitwise_count(sk[two] ^ sk[two + 1]).sum(axis=1, dtype=np.int64))
            found = [(two[est >= least], two[est >= least] + 1)]
            for s, k in zip(at[:-1][n > 2], n[n > 2]):
                for lo in range(s, s + k, 128):
                    hi = min(lo + 128, s + k)
                    e = _estimates(sk[lo:hi], sk[s : s + k])
                    e[np.arange(hi - lo), np.arange(lo - s, hi - s)] = -1
                    best = e.argmax(axis=1)
                    ok = e[np.arange(hi - lo), best] >= least
                    found.append((np.arange(lo, hi)[ok], s + best[ok]))
            yield _pairs(rep, np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))

    return groups.mapInArrow(run, PAIRS).distinct()


def _candidates(t: pa.Table, s: int, e: int, least: float, samples: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the rows s to e of one block: strangers, the columns that they meet, and the estimates of pairs between components.

    A pair meets in every band it shares; only the first of them takes it: elsewhere, and below least, the estimate is -1.
    """
    t = t.slice(s, e - s)
    comp, sk, side = np.asarray(t.column("comp")), _sketches(t, bits), np.asarray(t.column("stranger"))
    key, bands = t.column("key")[0].as_py(), np.array(t.column("bands").to_pylist(), np.int64).reshape(len(t), -1)
    rows, cols = np.flatnonzero(side), np.flatnonzero(~side)
    for k in range(0, len(rows), 32):
        r = rows[k : k + 32]
        est = _estimates(sk[r], sk[cols], samples, bits)
        est[(comp[r][:, None] == comp[cols][None, :]) | (est < least)] = -1
        x, y = np.nonzero(est >= least)
        shared = bands[r[x]] == bands[cols[y]]
        later = bands[r[x], shared.argmax(axis=1)] != key
        est[x[later], y[later]] = -1
        yield s + r, s + cols, est


BLOCKS = "a long, b long, chunk int, block int"


def all_across(groups: DataFrame, least: float) -> DataFrame:
    """All candidates between components by finer sketches: (a, b), or (key, null, chunk, block) for a block that is dense."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            at, rep = _bounds(t, 3), np.asarray(t.column("rep"))
            key, chunk, block = (np.asarray(t.column(c)) for c in ("key", "chunk", "block"))
            found, dense = [], []
            for s, e in zip(at[:-1], at[1:]):
                own, n = [], 0
                for rows, cols, est in _candidates(t, s, e, least, FINE_SAMPLES, FINE_BITS):
                    x, y = np.nonzero(est >= least)
                    own.append((rows[x], cols[y]))
                    n += len(x)
                    if n > DENSE * (e - s):
                        break
                if n > DENSE * (e - s):
                    dense.append(s)
                else:
                    found += own
            if found:
                p = _pairs(rep, np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))
                yield pa.RecordBatch.from_arrays([*p.columns, pa.nulls(len(p), pa.int32()), pa.nulls(len(p), pa.int32())], ["a", "b", "chunk", "block"])
            if dense:
                yield pa.RecordBatch.from_arrays([pa.array(key[dense]), pa.nulls(len(dense), pa.int64()), pa.array(chunk[dense]), pa.array(block[dense])], ["a", "b", "chunk", "block"])

    return groups.mapInArrow(run, BLOCKS).distinct()


def confirmed_in_place(groups: DataFrame, least: float, percent: int) -> DataFrame:
    """Links between components in dense blocks, whose rows bring their full sets along; what earlier links of the block join is not tried again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            at, rep, comp, got_i, got_j = _bounds(t, 3), np.asarray(t.column("rep")), np.asarray(t.column("comp")), [], []
            sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
            for s, e in zip(at[:-1], at[1:]):
                names, label = np.unique(comp[s:e], return_inverse=True)
                for rows, cols, est in _candidates(t, s, e, least, FINE_SAMPLES, FINE_BITS):
                    for r, row in zip(rows, est):
                        js = cols[row >= least]
                        js = js[label[js - s] != label[r - s]]
                        if len(js) == 0:
                            continue
                        size = np.array([len(sets[j]) for j in js])
                        hit = np.isin(np.concatenate([sets[j] for j in js]), sets[r])
                        both = np.add.reduceat(hit, np.concatenate(([0], np.cumsum(size)[:-1])))
                        for j in js[100 * both >= percent * (len(sets[r]) + size - both)]:
                            if label[j - s] != label[r - s]:
                                label[label == label[j - s]] = label[r - s]
                                got_i.append(r)
                                got_j.append(j)
            if got_i:
                yield _pairs(rep, np.array(got_i), np.array(got_j))

    return groups.mapInArrow(run, PAIRS).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets satisfy 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(len(batch), bool)
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                x, y = ([s for _, _, d, e in text_chunks(part.column(c)) for s in shingle_sets(d, e, shingle)] for c in (2, 3))
                for k, (p, q) in enumerate(zip(x, y)):
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    ok[i + k] = 100 * both >= percent * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], ["a", "b"])

    first, second = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "ta", "tb").mapInArrow(run, PAIRS)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text, ...).

    Documents are linked whose sets of shingle-word shingles satisfy 100 * intersection >= percent *
    union; component_id is the smallest doc_id reachable by links, kept says that it is the row's own.
    """
    with Scratch() as scratch:
        part = scratch.saved(features(docs, shingle, band_rows(percent)), "features")
        own = part.where("n_shingles > 0 and doc_id is not null")
        # rep numbers the classes of equal sets, as the table is written; a class is confirmed by the text of one of its rows
        classes = own.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.min_by("text_hash", "doc_id").alias("text_hash"))
        classes = scratch.saved(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
        numbered = saved(part.select("doc_id", "n_shingles", "h1", "h2").join(classes.select("h1", "h2", F.col("rep").alias("class")), ["h1", "h2"], "left").select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("class")).alias("rep")), "numbered")
        links = set_links(docs, part, classes, shingle, percent, scratch)
        # the classes of one doc_id are one node
        ids = scratch.saved(numbered.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b"), "repeated")
        if not ids.isEmpty():
            links = links.union(numbered.join(ids.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).where("a < b").distinct())
        comp = scratch.saved(components(links), "components")
        named = scratch.saved(classes.select("rep", "doc_id").join(comp, F.col("rep") == F.col("node"), "left").select("rep", "doc_id", F.coalesce("component", "rep").alias("component")), "named")
        first = scratch.saved(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "first")
        named = saved(named.join(first, "component").select("rep", "component_id"), "named")
    out = numbered.join(named, "rep", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("component_id") == F.col("doc_id")).alias("kept"))


def set_links(docs: DataFrame, part: DataFrame, classes: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) of classes whose components are those of all links: bands, candidates, confirmation on full sets."""
    saved = scratch.saved
    least, fine_least = percent / 100 - slack(percent, SLACK), percent / 100 - slack(percent, FINE_SLACK)
    node = ["h1", "h2", "doc_id", "text_hash"]
    reps = saved(part.select(*node, "sketch", "bands").join(classes, node).dropDuplicates(node).select("rep", "sketch", "bands"), "reps")
    keyed = reps.select("rep", F.explode("bands").alias("key"))
    sizes = saved(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    # a hot band is dealt out over chunks by a hash of the member
    chunk = F.pmod(F.xxhash64("rep", "key"), F.ceil(F.col("size") / CHUNK)).cast("int")
    groups = saved(keyed.join(sizes, "key").withColumn("chunk", chunk).join(reps, "rep"), "bands")

    pairs = saved(closest(groups.select("key", "chunk", "rep", "sketch").repartition("key", "chunk").sortWithinPartitions("key", "chunk", "rep"), least), "pairs")
    wanted = pairs.select("a").union(pairs.select("b")).union(groups.where(f"size > {CHUNK}").select("rep")).toDF("rep").distinct()
    wanted = classes.select("rep", "doc_id", "text_hash").join(wanted, "rep")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), F.col("text").cast("string").alias("text"))
    texts = saved(texts.join(wanted.hint("merge"), ["doc_id", "text_hash"]).groupBy("rep").agg(F.min("text").alias("text")), "texts")
    links = saved(confirmed(pairs, texts, shingle, percent), "confirmed")

    # rows of bands that hold several components; strangers belong to another than the band's main one
    comp = saved(components(links), "components")
    g = groups.join(comp, F.col("rep") == F.col("node"), "left").select("key", "chunk", "rep", "bands", "size", F.coalesce("component", "rep").alias("comp"))
    counts = g.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.max_by("comp", F.struct("n", "comp")).alias("main"), (F.sum("n") - F.max("n")).alias("strangers")).where("comps > 1")
    mixed = saved(mixed.select("key", "main", "strangers"), "mixed")
    g = g.join(mixed, "key").withColumn("parts", F.ceil(F.col("strangers") / CHUNK).cast("int"))
    # a stranger goes, with its block, to all chunks; a member, in its chunk, meets all blocks of strangers (but for itself)
    # by a hash that doesn't follow the chunk's
    own = F.pmod(F.xxhash64("key", "rep", F.lit(1)), F.col("parts")).cast("int")
    place = lambda chunk, block, stranger: F.struct(chunk.alias("chunk"), block.alias("block"), F.lit(stranger).alias("stranger"))
    here = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: place(F.col("chunk"), k, False))
    there = F.transform(F.sequence(F.lit(0), F.ceil(F.col("size") / CHUNK).cast("int") - 1), lambda k: place(k, own, True))
    g = g.withColumn("at", F.explode(F.when(F.col("comp") != F.col("main"), F.concat(here, there)).otherwise(here)))
    g = g.select("key", "at.*", "rep", "bands", "comp")

    def dealt(g: DataFrame) -> DataFrame:
        first = ["key", "chunk", "block"]
        return g.select(*first, *(c for c in g.columns if c not in first)).repartition(*first).sortWithinPartitions(*first, "stranger", "rep")

    # whatever has no text has no candidate
    far = saved(g.join(saved(fine_sketches(texts, shingle), "fine"), "rep"), "blocks")
    found = saved(all_across(dealt(far), fine_least), "found")
    new = found.where("b is not null").select("a", "b").join(pairs, ["a", "b"], "left_anti")
    links = links.union(saved(confirmed(new, texts, shingle, percent), "confirmed"))
    dense = found.where("b is null").select(F.col("a").alias("key"), "chunk", "block")
    if not dense.isEmpty():
        dense = saved(far.join(dense, ["key", "chunk", "block"], "left_semi"), "dense")
        sets = saved(full_sets(texts.join(dense.select("rep").distinct(), "rep", "left_semi"), shingle), "sets")
        links = links.union(saved(confirmed_in_place(dealt(dense.join(sets, "rep")), fine_least, percent), "confirmed"))
    return links

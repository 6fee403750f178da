"""Embedding near-dedup over a pivot-permutation index (operator 7).

Vectors of one length form an index of their own. Its pivots come from a bounded sample of the distinct
vectors, in order of their hashes; their number grows with the square root of the vectors', so that
lists keep their length. No pivot has a cosine of HOME or more with an earlier one; what the sample
lacks is filled up with fixed directions. A pivot that kept another vector of the sample out is dense.
A vector whose cosine with a dense pivot is HOME or more has the nearest such pivot as its home: it
enters that pivot's own list, and so does every vector whose angle with the pivot lets it have a link
to one at home there. Links of vectors at home are thus all found, however large the group of near
copies is.

Each other vector is described by its NEAREST pivots in order of their cosine, and is entered into the
inverted list of every pair of them whose places in that order add up to PREFIX at most: two vectors
meet if they share two pivots near the head of both orders, and in as many lists as such pairs. Only the
first of these lists keeps the pair. Pairs are verified by their cosine in double precision.

Equal vectors collapse into one representative with a count. Lists longer than BLOCK are cut into
blocks, each pair of which is one group, so no task holds more than two blocks. Tasks give back, per
vector, the number of its links and a forest of them instead of all pairs.

Rows without a vec_id have no links, nor have vectors that are null, empty, zero, or hold null or non-finite components; neither have
vectors of different lengths with one another. The LENGTHS most frequent lengths get pivots from a
sample, all others fixed directions alone. Rows that repeat a vec_id count each; if their vectors
differ, the vec_id is one node, whose links are summed. Without rows the result is empty; other columns
are ignored. Recall is that of the index for vectors without a home (figures in the README); no pair
below the threshold is ever linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F, types as T

from .common import Scratch, components, saved
from .minhash_dedup import _bounds, _groups

#: Pivots of a length at least and at most, and in between so many times the root of its vectors' number.
PIVOTS, MOST_PIVOTS, PIVOTS_PER_ROOT = 256, 2048, 2
NEAREST, PREFIX, BLOCK, LENGTHS = 8, 6, 1024, 16
#: Vectors sampled for each pivot, and bytes of them for a length at most.
SAMPLED, SAMPLE_BYTES = 4, 32 << 20
HOME = 0.85

#: Pivots (unit vectors), which of them are dense.
Pivots = tuple[np.ndarray, np.ndarray]


def unit_rows(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vectors(rows: DataFrame, ids: str, embedding: str, kind: str) -> DataFrame:
    """vec_id and v, the components in bytes; null where the vector has no links."""

    @F.arrow_udf("binary")
    def packed(column: pa.Array) -> pa.Array:
        size = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten()
        x = pa.compute.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)  # no negative zeros
        at = np.concatenate(([0], np.cumsum(size)))
        odd, some = (np.concatenate(([0], np.cumsum(c)))[at] for c in (~np.isfinite(x), x != 0))
        ok, raw, at = (np.diff(odd) == 0) & (np.diff(some) > 0), x.tobytes(), at * x.itemsize
        return pa.array([raw[a:b] if k else None for a, b, k in zip(at[:-1].tolist(), at[1:].tolist(), ok.tolist())], pa.binary())

    return rows.select(F.col(ids).cast("long").alias("vec_id"), packed(F.col(embedding).cast("array<float>" if kind == "<f4" else "array<double>")).alias("v"))


def directions(width: int, n: int, seed: int = 7) -> np.ndarray:
    x = np.random.default_rng(seed).standard_normal((n, width))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def thinned(some: list[bytes], kind: str, pivots: int) -> Pivots:
    x = unit_rows(some, kind)
    chosen, dense, free = [], [], np.ones(len(x), bool)
    while free.any() and len(chosen) < pivots:
        chosen.append(int(free.argmax()))
        free[chosen[-1]] = False
        close = x @ x[chosen[-1]] >= HOME
        close[chosen] = False
        dense.append(bool(close.any()))
        free &= ~close
    more = directions(x.shape[1], pivots - len(chosen))
    return np.concatenate([x[chosen], more]), np.array(dense + [False] * len(more))


def sample_pivots(classes: DataFrame, kind: str, pivots: int | None) -> dict[int, Pivots]:
    """Pivots for each of the most frequent lengths (in bytes), from bounded samples."""
    out = {}
    sizes = classes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(LENGTHS).collect()  # at most LENGTHS rows
    for size, n in sizes:
        p = pivots or min(MOST_PIVOTS, max(PIVOTS, PIVOTS_PER_ROOT * int(np.ceil(np.sqrt(n)))), max(8, SAMPLE_BYTES // size // SAMPLED))
        own = classes.where(F.col("size") == size).select("v", F.xxhash64("v").alias("h"))
        # few more than are wanted get as far as the sort
        own = own.where(F.shiftrightunsigned("h", 11) <= min(1.0, (2 * SAMPLED * p + 100) / n) * (1 << 53))
        out[size] = thinned([bytes(r.v) for r in own.orderBy("h", "v").limit(SAMPLED * p).collect()], kind, p)  # at most SAMPLE_BYTES
    return out


def postings(classes: DataFrame, kind: str, index: dict[int, Pivots], pivots: int | None, nearest: int, prefix: int, least: float) -> DataFrame:
    """rep, n, v, home (a dense pivot, or -1), keys (the vector's lists by pairs, ascending) and key.

    A key is the vector's length, then two pivots; a row for each of keys if there is no home, and for each
    dense pivot (twice in the key) whose list the vector enters.
    """
    fallback = pivots or PIVOTS
    # a link reaches no further than this from a vector at home
    reach = np.cos(min(np.pi, np.arccos(HOME) + np.arccos(np.clip(least, -1, 1)))) - 1e-9

    def entries(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, key) of every posting, and home and keys of every row, for vectors of one length."""
        size = len(raw[0])
        if size not in index:
            index[size] = directions(size // np.dtype(kind).itemsize, fallback), np.zeros(fallback, bool)
        points, dense = index[size]
        cos = unit_rows(raw, kind) @ points.T
        m = min(nearest, len(points))
        near = np.argpartition(-cos, m - 1, axis=1)[:, :m]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(cos, near, axis=1), axis=1, kind="stable"), axis=1)
        i, j = np.triu_indices(m, 1)
        i, j = i[i + j <= prefix], j[i + j <= prefix]
        home, centres = np.full(len(raw), -1, np.int32), np.flatnonzero(dense)
        if len(centres):
            best = centres[cos[:, centres].argmax(axis=1)]
            home = np.where(cos[np.arange(len(raw)), best] >= HOME, best, -1).astype(np.int32)
        a, b = near[:, i], near[:, j]
        keys = np.sort(size << 32 | np.minimum(a, b) << 16 | np.maximum(a, b), axis=1)
        away = np.flatnonzero(home < 0)
        at, c = np.nonzero(cos[:, centres] >= reach)
        c = centres[c]
        return np.concatenate([np.repeat(away, len(i)), at]), np.concatenate([keys[away].ravel(), size << 32 | c << 16 | c]), home, keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 2000):
                part = batch.slice(k, 2000)
                raw = part.column(2).to_pylist()
                sizes = np.array(list(map(len, raw)))
                for size in np.unique(sizes):
                    own = np.flatnonzero(sizes == size)
                    at, key, home, keys = entries([raw[x] for x in own])
                    rows = part.take(pa.array(own[at]))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(at) + 1) * keys.shape[1], keys.shape[1], dtype=np.int32)), pa.array(keys[at].ravel()))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(home[at]), lists, pa.array(key)], ["rep", "n", "v", "home", "keys", "key"])

    return classes.select("rep", "n", "v").mapInArrow(run, "rep long, n long, v binary, home int, keys array<long>, key long")


def matched(groups: DataFrame, least: float, kind: str) -> DataFrame:
    """Rows (rep, n, other): n more links of rep, and in other a linked vector of the groups' forests (or null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            at, key = _bounds(t, 3), np.asarray(t.column("key"))
            side, rep, n = (np.asarray(t.column(c)) for c in ("side", "rep", "n"))
            home = np.asarray(t.column("home"))
            keys = [k.values.to_numpy() for k in t.column("keys").chunks]
            offsets = [k.offsets.to_numpy() for k in t.column("keys").chunks]
            own_keys = [k[o[i] : o[i + 1]] for k, o in zip(keys, offsets) for i in range(len(o) - 1)]
            raw = t.column("v").to_pylist()
            got_i, got_j = [], []
            for s, e in zip(at[:-1], at[1:]):
                if e - s < 2:
                    continue
                x, cross = unit_rows(raw[s:e], kind), side[s] != side[e - 1]
                mid = s + int(np.searchsorted(side[s:e], 1)) if cross else s
                lo, hi = (s, mid) if cross else (s, e)
                for k in range(lo, hi, 512):
                    q = min(k + 512, hi)
                    i, j = np.nonzero(x[k - s : q - s] @ x[mid - s :].T >= least)
                    i, j = i + k, j + mid
                    own = np.ones(len(i), bool) if cross else i < j
                    i, j = i[own], j[own]
                    low, high = key[s] >> 16 & 0xFFFF, key[s] & 0xFFFF
                    if low == high:  # the list of a home keeps the pair, the smaller one if there are two
                        p, q = home[i], home[j]
                        first = ((p == low) & ((q < 0) | (q >= low))) | ((q == low) & ((p < 0) | (p >= low)))
                        got_i.append(i[first])
                        got_j.append(j[first])
                        continue
                    # the first of the lists that both are in keeps the pair
                    x_keys, y_keys = np.array([own_keys[x] for x in i]), np.array([own_keys[y] for y in j])
                    if len(i) == 0:
                        continue
                    both = (x_keys[:, :, None] == y_keys[:, None, :]).any(axis=2)
                    first = x_keys[np.arange(len(i)), both.argmax(axis=1)] == key[s]
                    got_i.append(i[first])
                    got_j.append(j[first])
            if not got_i:
                continue
            i, j = np.concatenate(got_i), np.concatenate(got_j)
            links = np.bincount(i, n[j], len(t)) + np.bincount(j, n[i], len(t))
            parent = np.arange(len(t))

            def root(k: int) -> int:
                while parent[k] != k:
                    parent[k] = parent[parent[k]]
                    k = parent[k]
                return k

            tree_i, tree_j = [], []
            for a, b in zip(i.tolist(), j.tolist()):
                p, q = root(a), root(b)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    tree_i.append(a)
                    tree_j.append(b)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([rep[some], rep[tree_i].astype(np.int64)])), pa.array(np.concatenate([links[some].astype(np.int64), np.zeros(len(tree_i), np.int64)])), pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(rep[tree_j].astype(np.int64))])],
                ["rep", "n", "other"],
            )

    return groups.mapInArrow(run, "rep long, n long, other long")


def embedding_duplicates(rows: DataFrame, least: float = 0.95, ids: str = "vec_id", embedding: str = "embedding", pivots: int | None = None, nearest: int = NEAREST, prefix: int = PREFIX) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    kind = "<f4" if rows.schema[embedding].dataType == T.ArrayType(T.FloatType(), rows.schema[embedding].dataType.containsNull) else "<f8"
    all_rows = saved(vectors(rows, ids, embedding, kind).withColumn("v", F.when(F.col("vec_id").isNotNull(), F.col("v"))), "vectors")
    classes = saved(all_rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).withColumn("size", F.octet_length("v")), "classes")
    with Scratch() as scratch:
        post = scratch.saved(postings(classes, kind, sample_pivots(classes, kind, pivots), pivots, nearest, prefix, least), "postings")
        lists = scratch.saved(post.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "lists")
        g = post.join(lists, "key").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
        g = g.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        g = g.select("key", F.least("own", "with").alias("x"), F.greatest("own", "with").alias("y"), (F.col("own") > F.col("with")).cast("int").alias("side"), "rep", "n", "v", "home", "keys")
        g = g.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "side", "rep")
        found = scratch.saved(matched(g, least, kind), "links")
        links = saved(found.groupBy("rep").agg(F.sum("n").alias("others")), "counts")
        comp = saved(components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))), "components")
    named = classes.join(links, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left").select("v", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = all_rows.join(named, "v", "left")
    comp_id = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), comp_id.alias("component_id"), (comp_id == F.col("vec_id")).alias("kept"))

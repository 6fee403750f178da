"""Best-two-fit packing of tokenized documents into sequences (operator 6).

Documents are tokenized in Arrow batches (each distinct piece of a text once per worker, as the
tokenizer never looks across their ends), cut only if longer than a sequence, and dealt out over groups by a hash. The
number of groups follows the corpus, so a group has about GROUP sequences' tokens at every size;
each wastes less than one sequence more than a single group would.

In a group, a bin takes the longest piece that fits until none does. Then its smallest piece goes
back if two unpacked pieces fill the room it leaves, gap included, more tightly; the best such pair
takes its place, again and again until nothing is gained. A group that best-fit decreasing packs into
fewer bins takes those.

Null texts are empty and have the closing id only. Rows that repeat a doc_id give pieces each; these,
and those without a doc_id, are dealt out like others, by their places in the table. Ties in a group are
broken by doc_id and piece. An empty table gives no piece.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Memory

GROUP = 4096
#: Pieces in a group, about, at most.
GROUP_ROWS = 500_000
#: Words that a worker remembers (see Memory).
REMEMBERED = 400_000
_SEEN: dict[str, tuple] = {}


#: Pieces that may be encoded by themselves: runs of Latin-1 letters and runs of other Latin-1 characters,
#: unless an apostrophe (which may open a contraction) or a further character follows; then all up to the next space.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_RUNS = re.compile(rf"[{_LETTER}]++(?!['\u0100-\U0010ffff])|[^ \t\n\r'{_LETTER}\u0100-\U0010ffff]++(?!['\u0100-\U0010ffff])|[^ \t\n\r]+")
_WHOLE = re.compile(r"[^ \t\n\r]+")


def _tokenizer(path: str):
    if path not in _SEEN:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        vocab = tokenizer.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        _SEEN[path] = (tokenizer, ends, Memory(REMEMBERED))
    return _SEEN[path]


def _pieces(text: str) -> list[str]:
    """Pieces of a text across whose ends the tokenizer never looks."""
    if "<|" in text:  # perhaps a special token, which counts as it is spelt
        return _WHOLE.findall(text)
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:  # lower case and composition may depend on one another
        return _RUNS.findall(text)
    return _RUNS.findall(text.lower())


def encode_words(texts: list[str], path: str) -> Iterator[bytes]:
    """Each text's ids (little-endian uint32), for a tokenizer that drops white space and never looks across it."""
    tokenizer, ends, memory = _tokenizer(path)

    def learn(new: list[str]) -> Iterator[tuple[str, bytes]]:
        letters, mixed = [w for w in new if w.isalpha()], [w for w in new if not w.isalpha()]
        for i in range(0, len(letters), 2048):
            part = letters[i : i + 2048]
            ids = np.array(tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            at = np.flatnonzero(ends[ids]) + 1
            if len(at) == len(part):  # each is one word of the tokenizer's, too
                raw, at = ids.tobytes(), (4 * at).tolist()
                yield from zip(part, (raw[s:e] for s, e in zip([0, *at], at)))
            else:
                mixed += part
        for i in range(0, len(mixed), 4096):
            part = mixed[i : i + 4096]
            yield from zip(part, (np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(part, add_special_tokens=False)))

    for ids in memory.lists([_pieces(t) for t in texts], learn):
        yield b"".join(ids)


PIECES = "doc_id long, piece int, start long, length long, ids binary"


def tokenized(docs: DataFrame, path: str, size: int = 2048, closing: int = 0) -> DataFrame:
    """The documents' pieces of at most size ids: doc_id, piece, start, length, ids (little-endian uint32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([closing], "<u4").tobytes()
        for batch in batches:
            for i in range(0, len(batch), 500):
                part = batch.slice(i, 500)
                rows = ([], [], [], [], [])
                for doc_id, ids in zip(part.column(0).to_pylist(), encode_words([t or "" for t in part.column(1).to_pylist()], path)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * size)):
                        one = ids[at : at + 4 * size]
                        for column, v in zip(rows, (doc_id, k, at // 4, len(one) // 4, one)):
                            column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def best_two_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of indices into lengths (1 to size each)."""
    stacks: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        stacks.setdefault(int(lengths[i]), []).append(i)
    mask = sum(1 << n for n in stacks)

    def longest(room: int) -> int:
        return (mask & ((2 << room) - 1)).bit_length() - 1 if room > 0 else -1

    def take(n: int) -> int:
        nonlocal mask
        i = stacks[n].pop()
        if not stacks[n]:
            mask ^= 1 << n
        return i

    def best_pair(room: int, more_than: int) -> tuple[int, int] | None:
        best, pair = more_than, None
        a = longest(room - 1)
        while a > 0 and 2 * a > best:
            b = longest(min(a, room - a))
            if b == a and len(stacks[a]) < 2:
                b = longest(a - 1)
            if b > 0 and a + b > best:
                best, pair = a + b, (a, b)
                if best == room:
                    break
            a = longest(a - 1)
        return pair

    bins = []
    while mask:
        own, gap = [], size
        while (n := longest(gap)) > 0:
            own.append(take(n))
            gap -= n
        while gap and mask:
            small = min(own, key=lambda i: lengths[i])
            n = int(lengths[small])
            if (pair := best_pair(gap + n, n)) is None:
                break
            own.remove(small)
            own += [take(pair[0]), take(pair[1])]
            gap += n - sum(pair)
            stacks.setdefault(n, []).append(small)
            mask |= 1 << n
        bins.append(own)
    return bins


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of indices: the longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    mask = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = mask >> lengths[i]
        if fits:
            room = lengths[i] + (fits & -fits).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, k = size, len(bins)
            bins.append([])
        bins[k].append(i)
        if room := room - lengths[i]:
            by_room.setdefault(room, []).append(k)
            mask |= 1 << room
    return bins


def packed(pieces: DataFrame, size: int = 2048, group: int = GROUP) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset; length is 1 to size. pieces should be a written table."""
    tokens, rows = pieces.agg(F.sum("length"), F.count(F.lit(1))).first()  # one row
    groups = max(1, round((tokens or 0) / size / group), -(-rows // GROUP_ROWS))
    dealt = pieces.withColumn("__skein_group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)))
    schema = dealt.drop("__skein_group").schema.add("sequence_id", "long").add("offset", "long")

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "length"], kind="stable", ignore_index=True).drop(columns="__skein_group")
        lengths = rows["length"].to_numpy()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        each = lengths.tolist()
        for k, own in enumerate(min(best_two_fit(each, size), best_fit_decreasing(each, size), key=len)):
            sequence[own] = (int(key[0]) << 32) + k
            offset[own] = np.concatenate(([0], np.cumsum(lengths[own])[:-1]))
        return rows.assign(sequence_id=sequence, offset=offset)

    return dealt.groupBy("__skein_group").applyInPandas(fill, schema)

"""Token counts by rank-synchronous merging of a byte-level BPE (operator 9).

A batch's distinct pre-tokens lie behind one another in one array of symbols, with the sequences'
bounds beside it. In each round every sequence finds its lowest-ranked adjacent pair, and all of
them merge theirs at once (from the left, where occurrences overlap); the rounds end when no
sequence has a mergeable pair. The surviving symbols are counted. A worker remembers the counts of
pieces it has met.

Whole texts are counted; null texts are empty and have no tokens. A special token's string inside
a text is one token, as the library treats it by default. Rows do not depend on one another.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import Memory

#: Fixed value: the public byte-level pattern that splits texts into pre-tokens.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
REMEMBERED = 500_000
_LOADED: dict[str, "Merger"] = {}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Merger:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.splitter = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.first = np.array([vocab[c] for c in byte_characters()], np.int64)
        self.width = max(vocab.values()) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        key = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(key)
        self.key, self.rank = key[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.known = Memory(REMEMBERED)

    def count_all(self, words: list[str]) -> np.ndarray:
        """Symbols that survive in each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        length = np.array([len(x) for x in raw], np.int64)
        symbols = self.first[np.frombuffer(b"".join(raw), np.uint8)]
        owner = np.repeat(np.arange(len(words)), length)
        count = np.zeros(len(words), np.int64)
        never = len(self.rank)
        while len(symbols):
            pair = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.key, pair), never - 1)
            rank = np.where((self.key[at] == pair) & (owner[:-1] == owner[1:]), self.rank[at], never)
            rank = np.append(rank, never)
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            low = np.minimum.reduceat(rank, start)
            size = np.diff(np.append(start, len(symbols)))
            # finished sequences leave the arrays
            count[owner[start[low == never]]] = size[low == never]
            alive = np.repeat(low < never, size)
            if not alive.any():
                break
            hit = (rank == np.repeat(low, size)) & alive
            symbols, owner, rank, hit = symbols[alive], owner[alive], rank[alive], hit[alive]
            # in a run of overlapping occurrences every other one merges, from the left
            place = np.arange(len(hit))
            begin = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, -1))
            hit &= (place - begin) % 2 == 0
            symbols = np.where(hit, self.made[np.minimum(rank, never - 1)], symbols)
            stay = ~np.append(False, hit[:-1])
            symbols, owner = symbols[stay], owner[stay]
        return count

    def learn(self, pieces: list[str]) -> dict[str, int]:
        words = [PATTERN.findall(p) for p in pieces]
        distinct = list(set().union(*words)) if words else []
        counts: dict[str, int] = {}
        for i in range(0, len(distinct), 50_000):
            part = distinct[i : i + 50_000]
            counts.update(zip(part, self.count_all(part).tolist()))
        return {p: sum(map(counts.__getitem__, w)) for p, w in zip(pieces, words)}

    def counts(self, texts: list[str]) -> list[int]:
        out, pieces = [], []
        for text in texts:
            parts = self.splitter.split(text) if self.splitter else [text]
            out.append(len(parts) - 1)
            own = []
            for part in parts:
                if "  " in part:  # runs of spaces are not cut apart
                    own += PATTERN.findall(part)
                elif part:
                    head, *rest = part.split(" ")
                    own += [head] if head else []
                    own += [" " + p for p in rest]
            pieces.append(own)
        known = self.known.of(set().union(*pieces), lambda new: self.learn(new).items())
        return [n + sum(map(known.__getitem__, p)) for n, p in zip(out, pieces)]


def merger(path: str) -> Merger:
    if path not in _LOADED:
        _LOADED[path] = Merger(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with n_tokens: tokens of each whole text for the tokenizers file at path (the same place on every executor)."""

    @F.arrow_udf("long")
    def tokens(column: pa.Array) -> pa.Array:
        m, out = merger(path), []
        for i in range(0, len(column), 500):
            out += m.counts([t or "" for t in column.slice(i, 500).to_pylist()])
        return pa.array(out, pa.int64())

    return docs.withColumn("n_tokens", tokens(F.col(text).cast("string")))

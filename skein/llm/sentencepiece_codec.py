"""SentencePiece encoding and decoding by suffix-array matching (operator 1).

The distinct words of a batch that a worker has not met are laid behind one another and indexed by
a suffix array. Every piece is binary-searched for its range of occurrences; these edges (start,
end, piece) are sorted by their end and relaxed from left to right, for all words at once.

The public model is a BPE model, for which the best path by summed scores is not the library's
answer. So an edge is relaxed only if the last piece before it and its own piece stay apart when
merged as a pair; for merges in a fixed order exactly one edge into each position qualifies, and
the path is the library's encoding. Runs of several spaces, whose pieces have equal scores, are
merged step by step instead. Characters outside the vocabulary become byte pieces.

Whole texts are encoded; null texts are null, empty texts have no pieces. Rows do not depend on one
another, so ties, repeats and skew need no care; other columns pass through.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Memory, mix

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
BATCH_BYTES, REMEMBERED, SLOTS = 400_000, 300_000, 1 << 21
#: Words of more characters are relaxed edge by edge, as few words have an edge at their later offsets.
LONG, PAIRS_KEPT = 200, 500_000
_LOADED: dict[str, "Codec"] = {}


def holds_zero(eight: np.ndarray) -> np.ndarray:
    """Whether one of the eight bytes of each number (uint64) is zero."""
    return ((eight - np.uint64(0x0101010101010101)) & ~eight & np.uint64(0x8080808080808080)) != 0


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions of data (uint8) ordered by the depth bytes (or more) that follow, as far as the first zero, by doubling from eight bytes on."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + n]
    order, k, rank = np.argsort(key), 8, np.zeros(n, np.int64)
    ended = np.append(holds_zero(key), True)
    s = key[order]
    new = np.append(True, s[1:] != s[:-1])
    group = np.cumsum(new) - 1
    # a rank is the first place of a group in the order, from 1
    rank[order] = np.flatnonzero(new)[group] + 1
    # the places in the order that are still to be told apart: their groups are larger than one, and no zero has come yet
    open_ = np.flatnonzero((np.bincount(group)[group] > 1) & ~ended[order])
    while k < depth and len(open_):
        at = order[open_]
        following = np.minimum(at + k, n)
        second = np.append(rank, 0)[following]
        by = np.argsort(rank[at] * np.int64(n + 2) + second)
        at, second, first = at[by], second[by], rank[at[by]]
        order[open_] = at
        new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        part = np.cumsum(new) - 1
        rank[at] = open_[np.flatnonzero(new)][part] + 1
        open_ = open_[(np.bincount(part)[part] > 1) & ~ended[np.minimum(at + k, n)]]
        k *= 2
    return order


class Codec:
    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = self.size = sp.vocab_size()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.score = [sp.get_score(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_ids = np.array(self.byte, np.int64)
        self.ids = {self.piece[i]: i for i in plain}
        #: what each id decodes to
        self.raw = [b""] * n
        for i in plain:
            self.raw[i] = self.piece[i].replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte):
            self.raw[i] = bytes([b])
        self.raw[sp.unk_id()] = " ⁇ ".encode()
        self.raw_array = np.array(self.raw, object)
        self.known = Memory(REMEMBERED)
        # pieces that merging can reach, apart from runs of spaces
        reach = [i for i in plain if self.piece[i].strip(SPACE) == "" and len(self.piece[i]) == 1 or self.piece[i].strip(SPACE) and self.merge(self.piece[i]) == [i]]
        reach.sort(key=lambda i: self.piece[i].encode())
        self.reach = np.array(reach, np.int64)
        text = [self.piece[i].encode() for i in reach]
        self.lengths = np.array([len(t) for t in text])
        self.depth = int(self.lengths.max())
        self.low = np.array(text, f"S{self.depth}")
        self.high = np.array([t.ljust(self.depth, b"\xff") for t in text], f"S{self.depth}")
        self.bytes = self.low.view(np.uint8).reshape(len(text), self.depth)
        self.masked = np.arange(self.depth)[None, :] >= self.lengths[:, None]
        self._index_merges(plain)
        # a direct-mapped memory of pairs: a later pair takes an earlier one's slot
        self.slot_key, self.slot_apart = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    def _index_merges(self, plain: list[int]) -> None:
        """Ranks (characters first, then by score), each piece's last merge, and all pairs that can merge."""
        reach = [i for i in self.reach.tolist() if len(self.piece[i]) > 1]
        chars = [i for i in plain if len(self.piece[i]) == 1]
        order = chars + sorted(reach, key=lambda i: -self.score[i])
        self.rank = np.full(self.size, len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.left, self.right = np.arange(len(order)), np.arange(len(order))
        pairs = {}
        for i in reach:
            text = self.piece[i]
            for k in range(1, len(text)):
                a, b = self.ids.get(text[:k]), self.ids.get(text[k:])
                if a is not None and b is not None and self.rank[a] < len(order) and self.rank[b] < len(order):
                    pairs[int(self.rank[a]) * len(order) + int(self.rank[b])] = int(self.rank[i])
            a, b = self.last_merge(text)
            self.left[self.rank[i]], self.right[self.rank[i]] = self.rank[a], self.rank[b]
        self.pairs, self.apart = pairs, {}
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_key.tolist()], np.int64)

    def last_merge(self, text: str) -> tuple[int, int]:
        """The two pieces whose merge completes a piece."""
        steps: list[tuple[str, str]] = []
        self.merge(text, steps)
        return self.ids[steps[-1][0]], self.ids[steps[-1][1]]

    def merge(self, text: str, steps: list[tuple[str, str]] | None = None) -> list[int]:
        """The encoding of text by merging, best score first, then leftmost; steps gets the pairs merged."""
        part, after, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(part) and (k := self.ids.get(both := part[i] + part[j])) is not None:
                heapq.heappush(heap, (-self.score[k], i, both))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if part[i] and j < len(part) and part[i] + part[j] == both:
                if steps is not None:
                    steps.append((part[i], part[j]))
                part[i], part[j], after[i] = both, "", after[j]
                if after[i] < len(part):
                    before[after[i]] = i
                offer(before[i], i)
                offer(i, after[i])
        out: list[int] = []
        for p in part:
            if p:
                out += [self.ids[p]] if p in self.ids else [self.byte[b] for b in p.encode()]
        return out

    def unmerged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two pieces stay apart: their merges are taken back, the latest first, and at no
        stage may the parts that touch have a merge that would have come before the one taken back."""
        n = len(self.left)
        x, y, out, at = self.rank[left], self.rank[right], np.ones(len(left), bool), np.arange(len(left))
        limit = np.full(len(left), n, np.int64)
        while len(at):
            key = x * n + y
            k = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            bad = (self.pair_key[k] == key) & (self.pair_rank[k] < limit)
            out[at[bad]] = False
            # of two equal ranks the left one was merged first; characters are not taken apart
            can_x, can_y = self.right[x] != x, self.left[y] != y
            from_x = can_x & (~can_y | (x > y))
            from_y = can_y & ~from_x
            limit = np.where(from_x, x, np.where(from_y, y + 1, limit))
            x, y = np.where(from_x, self.right[x], x), np.where(from_y, self.left[y], y)
            on = (from_x | from_y) & ~bad
            x, y, limit, at = x[on], y[on], limit[on], at[on]
        return out

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces, merged as a text, stays as it is. Ids of size or more stand for boundaries."""
        key = left * self.size + right
        slot = (mix(key.view(np.uint64)) & np.uint64(SLOTS - 1)).view(np.int64)
        out, inner = self.slot_apart[slot], (left < self.size) & (right < self.size)
        new = np.flatnonzero(inner & (self.slot_key[slot] != key))
        out[new] = self.slot_apart[slot[new]] = self.unmerged(left[new], right[new])
        self.slot_key[slot[new]] = key[new]
        # pairs that met in one slot here: the last one written holds it, in both arrays
        self.slot_apart[slot[new]] = out[new]
        return out | ~inner

    def edges(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every occurrence of every piece in data."""
        order = suffix_array(data, self.depth)
        padded = np.concatenate([data, np.zeros(self.depth, np.uint8)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.depth)

        def bound(pieces: np.ndarray) -> np.ndarray:
            lo, hi = np.zeros(len(pieces), np.int64), np.full(len(pieces), len(data), np.int64)
            while (open_ := lo < hi).any():
                mid = (lo + hi) // 2
                less = windows[order[np.minimum(mid, len(data) - 1)]].view(pieces.dtype).ravel() < pieces
                lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
            return lo

        first = bound(self.low)
        there = ((windows[order[np.minimum(first, len(data) - 1)]] == self.bytes) | self.masked).all(axis=1) & (first < len(data))
        piece, first = np.flatnonzero(there), first[there]
        n = bound(self.high[piece]) - first
        start = order[np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
        which = np.repeat(piece, n)
        return start, start + self.lengths[which], self.reach[which]

    def relax(self, words: list[str]) -> list[bytes]:
        """The encodings of words, each behind a space, that hold no run of spaces, as int32 ids."""
        space = SPACE.encode()
        raw = [space + w.encode("utf-8", "surrogatepass") for w in words]
        data = np.frombuffer(b"\x00".join(raw) + b"\x00", np.uint8)
        length = np.array([len(r) for r in raw])
        begin = np.concatenate(([0], np.cumsum(length + 1)[:-1]))
        start, end, piece = self.edges(data)
        # characters that are no piece: an edge that stands for their bytes
        head = np.flatnonzero((data & 0xC0) != 0x80)
        head_end = np.append(head[1:], len(data))
        following = np.zeros(len(data), np.int64)
        following[head] = head_end
        single = np.zeros(len(data), bool)
        single[start[end == following[start]]] = True
        single[begin + length] = True  # the zeros between words
        lost = ~single[head]
        start, end, piece = np.concatenate([start, head[lost]]), np.concatenate([end, head_end[lost]]), np.concatenate([piece, np.full(lost.sum(), self.size)])
        offset = end - np.repeat(begin, length + 1)[start]
        order = np.argsort(offset.astype(np.int16) if offset.max(initial=0) < 32767 else offset, kind="stable")
        start, end, piece, offset = start[order], end[order], piece[order], offset[order]
        last, back = np.full(len(data) + 1, -1, np.int64), np.zeros(len(data) + 1, np.int64)
        last[begin] = self.size + 1
        cuts = np.flatnonzero(np.append(True, offset[1:] != offset[:-1])) if len(offset) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(offset))):
            s, p = start[a:b], piece[a:b]
            reached = last[s] >= 0
            s, p, e = s[reached], p[reached], end[a:b][reached]
            ok = self.stay_apart(last[s], p)
            last[e[ok]], back[e[ok]] = p[ok], s[ok]
        # all words' paths are walked back in step
        word, at, walked = np.arange(len(words)), begin + length, []
        word, at = word[length > 0], at[length > 0]
        while len(word):
            walked.append((word, last[at], back[at], at))
            at = back[at]
            on = at > begin[word]
            word, at = word[on], at[on]
        if not walked:
            return [b""] * len(words)
        word, piece, start, end = (np.concatenate(c) for c in zip(*walked))
        order = np.argsort(start)
        word, piece, start, end = word[order], piece[order], start[order], end[order]
        n = np.where(piece < self.size, 1, end - start)
        place = np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        ids = np.repeat(piece, n)
        ids = np.where(ids < self.size, ids, self.byte_ids[data[np.minimum(place, len(data) - 1)]]).astype("<i4").tobytes()
        cut = np.concatenate(([0], np.cumsum(np.bincount(word, n, len(words))))).astype(np.int64) * 4
        return [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def stays_apart(self, left: int, right: int) -> bool:
        """unmerged for one pair, remembered."""
        if len(self.apart) > PAIRS_KEPT:
            self.apart.clear()
        key = left * self.size + right
        out = self.apart.get(key)
        if out is None:
            n = limit = len(self.left)
            x, y, out = int(self.rank[left]), int(self.rank[right]), True
            while True:
                if self.pairs.get(x * n + y, limit) < limit:
                    out = False
                    break
                in_x, in_y = int(self.right[x]), int(self.left[y])
                if in_x != x and (in_y == y or x > y):
                    x, limit = in_x, x
                elif in_y != y:
                    y, limit = in_y, y + 1
                else:
                    break
            self.apart[key] = out
        return out

    def relax_long(self, word: str) -> bytes:
        """The encoding of one long word behind a space: edges by slices of the text, relaxed one after another by their start."""
        data = np.frombuffer((SPACE + word).encode("utf-8", "surrogatepass"), np.uint8)
        last, back, size = [-1] * (len(data) + 1), [0] * (len(data) + 1), self.size
        last[0] = size + 1
        head = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        for at in range(0, len(data), BATCH_BYTES):
            start, end, piece = self.edges(data[at : at + BATCH_BYTES + self.depth])
            start, end = start + at, end + at
            own = head[:-1][(head[:-1] >= at) & (head[:-1] < at + BATCH_BYTES)]
            own_end = head[np.searchsorted(head, own) + 1]
            # characters that are no piece: an edge that stands for their bytes
            lost = ~np.isin(own << 8 | own_end - own, start << 8 | end - start)
            start, end, piece = np.concatenate([start, own[lost]]), np.concatenate([end, own_end[lost]]), np.concatenate([piece, np.full(lost.sum(), size)])
            here = start < at + BATCH_BYTES
            start, end, piece = start[here], end[here], piece[here]
            order = np.argsort(start, kind="stable")
            for s, e, p in zip(start[order].tolist(), end[order].tolist(), piece[order].tolist()):
                before = last[s]
                if before >= 0 and (p >= size or before >= size or self.stays_apart(before, p)):
                    last[e], back[e] = p, s
        ids, at = [], len(data)
        while at > 0:
            ids.append([last[at]] if last[at] < size else self.byte_ids[data[back[at] : at]].tolist())
            at = back[at]
        return np.array([i for own in reversed(ids) for i in own], "<i4").tobytes()

    def learn(self, words: list[str]) -> list[tuple[str, bytes]]:
        """(word, ids) of words that each stand behind a space."""
        out, short = [], []
        for w in words:
            if len(w) > LONG or SPACE in w:
                out.append((w, np.array(self.merge(SPACE + w), "<i4").tobytes() if SPACE in w else self.relax_long(w)))
            else:
                short.append(w)
        size = np.cumsum(np.fromiter(map(len, short), np.int64, len(short)) + 4)
        cuts = (np.flatnonzero(np.diff(size // BATCH_BYTES)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(short)]):
            if b > a:
                out += zip(short[a:b], self.relax(short[a:b]))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        # words without the space before them; of a run of spaces all but the first stay
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif SPACE in t or "  " in t or t[0] == " " or t[-1] == " ":
                split.append([w[1:] for w in WORD.findall(SPACE + t.replace(" ", SPACE))])
            else:
                split.append(t.split(" "))
        known = self.known.of(set().union(*split), self.learn)
        return [None if t is None else b"".join(map(known.__getitem__, w)) for t, w in zip(texts, split)]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        out = b"".join(self.raw_array[ids].tolist() if isinstance(ids, np.ndarray) else map(self.raw.__getitem__, ids))
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """docs with the ids of each whole text, for the model file at path (the same place on every executor)."""

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        c, parts = codec(path), []
        for i in range(0, len(column), 1000):
            got = c.encode(column.slice(i, 1000).to_pylist())
            at = np.concatenate(([0], np.cumsum([len(x or b"") // 4 for x in got]))).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(x or b"" for x in got), "<i4"))
            parts.append(pa.ListArray.from_arrays(pa.array(at), flat, mask=pa.array([x is None for x in got])))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return docs.withColumn(into, ids(F.col(text).cast("string")))


def decode(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """docs with the text that each array of ids stands for; null for null."""

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        c, out = codec(path), []
        for i in range(0, len(column), 1000):
            own = column.slice(i, 1000)
            flat, at = own.values.to_numpy(zero_copy_only=False), own.offsets.to_numpy()
            out += [c.decode(flat[a:b]) if there else None for a, b, there in zip(at[:-1].tolist(), at[1:].tolist(), own.is_valid().to_pylist())]
        return pa.array(out, pa.string())

    return docs.withColumn(into, text(ids))

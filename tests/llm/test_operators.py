"""The operators against brute force, libraries and held-out labels, on small tables and on odd rows."""

import collections
import hashlib
import math
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F, types as T

from skein.llm import embedding_dedup, queries as Q
from skein.llm.chat import escaped, format_trees, unescaped
from skein.llm.common import LOWER, SPACE, UPPER, components, shared_dir
from skein.llm.embedding_dedup import embedding_duplicates
from skein.llm.line_dedup import dedup_lines
from skein.llm.minhash_dedup import near_duplicates, odd_sketch, similarity
from skein.llm.packing import best_fit_decreasing, best_two_fit, packed, tokenized
from skein.llm.quality_rules import quality
from skein.llm.secret_scan import ALLOWED, CLASSES, KINDS, RUN, find_secrets, redact, scan, window_entropies
from skein.llm.sentencepiece_codec import Codec, decode, encode
from skein.llm.token_counts import count_tokens
from skein.llm.toxicity import Chain, default_categories, score, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(UPPER, LOWER)
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
#: Columns whose names the operators use themselves.
CLASHES = ["spans", "kept", "rep", "key", "component", "words", "n", "v", "a", "b", "h1", "rejected", "host_rate", "size", "node", "n_lines"]
ODD = ["", " ", "\n", "\n\n \n", "a", "a b", "<|endoftext|> <|endoftext|>x", "a\x00b \x00", "日本語 \U0001f642\U0001f642 é é", "a  b   c\t\t d \n e ", "it's don't I'LL 12345 ---- !!!", "x" * 3000, "word " * 4000, "▁▁ x", "<s> [INST] ~1 ~ </s>", " x y"]


@pytest.fixture(scope="module")
def odd(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), *(T.StructField(c, T.StringType()) for c in CLASHES)])
    rows = [(i, t, "s", *["?"] * len(CLASHES)) for i, t in enumerate(ODD)]
    rows += [(100, None, None, *[None] * len(CLASHES)), (None, "no id here", "s", *["?"] * len(CLASHES)), rows[12], rows[12]]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def test_sentencepiece_equals_the_library(spark, docs, odd):
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=PIECES)
    for d in (docs, odd):
        rows = decode(encode(d, PIECES), PIECES).select("text", "ids", "decoded").collect()
        assert len(rows) == d.count()
        for r in rows:
            assert r.ids == (None if r.text is None else lib.encode(r.text))
            assert r.decoded == (None if r.text is None else r.text.replace("▁", " "))
    c = Codec(PIECES)
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcdeth in,.\nó▁0"), 30)) for _ in range(3000)]
    assert [np.frombuffer(x, "<i4").tolist() for x in c.encode(texts)] == lib.encode(texts)


def test_chat_reads_back(spark, sf):
    got = {r.conv_id: r for r in Q.op2_chat(spark, sf).collect()}
    rows = collections.defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        rows[r.conv_id].append((r.turn, r.role, r.text or ""))
    one = "</s>[INST] ok [/INST]"
    rows[-7] = [(0, "user", one), (1, "assistant", one)]
    assert got.keys() == rows.keys()
    for k, v in rows.items():
        v.sort()
        loss = "".join(t for _, r, t in v if r == "assistant")
        assert (got[k].n_turns, got[k].turns_sha256) == (len(v), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in v).encode()).hexdigest())
        assert (got[k].loss_chars, got[k].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_trees(spark):
    schema = "tree long, node long, parent long, role string, text string, score double"
    nodes = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "bad", 1.0), (1, 2, 0, "assistant", "good", 2.0), (1, 3, 2, "user", None, 0.5), (1, 4, 1, "user", "more", 3.0), (1, 4, 1, "user", "more", 3.0),
             (2, 5, 99, "assistant", "orphan", None), (3, 6, 7, "user", "loop", 0.0), (3, 7, 6, "user", "loop", 0.0), (4, 1, None, "user", "x", 0.0), (4, 2, 1, "assistant", "tie", 1.0), (4, 3, 1, "assistant", "tie2", 1.0)]
    nodes += [(5, k, k - 1 if k else None, "user", str(k), 0.0) for k in range(70)]
    out = {(r.tree, r["rank"]): r for r in format_trees(spark.createDataFrame(nodes, schema), paths=2).collect()}
    assert out.keys() == {(1, 1), (1, 2), (2, 1), (4, 1), (4, 2), (5, 1)}
    assert out[1, 1].leaf == 4 and out[1, 2].leaf == 3 and out[4, 1].leaf == 2 and out[5, 1].n_turns == 70
    assert out[1, 2].formatted == "<s>[INST]user[/INST]\nq</s>\n<s>[INST]assistant[/INST]\ngood</s>\n<s>[INST]user[/INST]\n</s>\n"
    assert [out[1, 2].formatted[r.start : r.end] for r in out[1, 2].loss] == ["good"] and [out[1, 1].formatted[r.start : r.end] for r in out[1, 1].loss] == ["bad"]
    assert format_trees(spark.createDataFrame([], schema)).count() == 0


def test_chat_odd_rows(spark, tmp_path):
    """Null texts, roles, turns and ids, repeated rows and columns with clashing names."""
    rows = [(1, 0, "user", None), (1, 1, "assistant", "</s> ok ~"), (1, 1, "assistant", "</s> ok ~"), (1, None, None, "x"), (None, 0, "assistant", "a"), (None, None, "user", ""), (2, 0, "assistant", "")]
    spark.createDataFrame([(*r, "?", "?") for r in rows], "conv_id long, turn long, role string, text string, loss string, node string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in Q.op2_chat(spark, str(tmp_path)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in got.items()} == {1: (4, 18), None: (2, 1), 2: (1, 0), -7: (2, 21)}
    assert got[1].loss_sha256 == hashlib.sha256("</s> ok ~</s> ok ~".encode()).hexdigest()
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert [r.conv_id for r in Q.op2_chat(spark, f"{tmp_path}/none").collect()] == [-7]


def test_chat_escapes_are_reversible(spark):
    texts = ODD + ["~0~1~", "<s><s>[INST][/INST]</s>", "[/[INST]INST]", "~<s>~~</s>"]
    r = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect()
    assert all(x.t == x.u and not re.search(r"<s>|</s>|\[INST\]|\[/INST\]", x.e) for x in r)


def brute_components(sets, percent):
    ids, up = sorted(k for k in sets if sets[k]), {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_minhash_components(spark, docs, size, percent):
    base = [r.text for r in docs.select("text").limit(12).collect()]
    rng, texts = np.random.default_rng(size), {r.doc_id: r.text for r in docs.collect()}
    for k, t in enumerate(base):  # chains of copies, each a little further off
        w = t.split(" ")
        for m in range(12):
            w[int(rng.integers(len(w)))] = f"w{m}"
            texts[10_000 + 100 * k + m] = " ".join(w)
    sets = {}
    for k, t in texts.items():
        w = WORD.findall(t.translate(LOW))
        sets[k] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), size, percent).collect()}
    want = brute_components(sets, percent)
    assert {k: r.component_id for k, r in got.items()} == want
    assert all(r.n_shingles == len(sets[k]) and r.kept == (want[k] == k) for k, r in got.items())


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 95])
def test_minhash_settings_follow_the_threshold(spark, percent):
    """A pair at the threshold shares a band but for a chance of 1e-4, and its estimate is over four standard errors inside the slack."""
    from skein.llm import minhash_dedup as M

    rows = M.band_rows(percent)
    bands = len(M.features(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), 3, rows).first().bands)
    assert bands * rows <= M.SAMPLES and (1 - (percent / 100) ** rows) ** bands < 1e-4
    rng, s, est = np.random.default_rng(percent), percent / 100, []
    a = rng.integers(0, 2**32, (1000, M.SAMPLES)).astype(np.uint32)
    b = np.where(rng.random(a.shape) < s, a, rng.integers(0, 2**32, a.shape).astype(np.uint32))
    for x, y in zip(a, b):
        est.append(similarity(np.array([np.unpackbits(np.frombuffer(odd_sketch(x), np.uint8) ^ np.frombuffer(odd_sketch(y), np.uint8)).sum()]))[0])
    assert 0.9 < np.std(est) / M.standard_error(s) < 1.15 and M.slack(percent, M.SLACK) > 4 * M.standard_error(s)
    assert (rows, bands) == (8, 32) and M.slack(85, M.SLACK) == M.SLACK if percent == 85 else True


def test_minhash_hot_bands(spark, monkeypatch):
    """Chunks far smaller than a group of near copies lose no link."""
    from skein.llm import minhash_dedup

    monkeypatch.setattr(minhash_dedup, "CHUNK", 8)
    rng, base = np.random.default_rng(5), [f"w{i}" for i in range(60)]
    texts = {}
    for k in range(120):
        w = list(base)
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(60))] = f"x{int(rng.integers(40))}"
        texts[k] = " ".join(w)
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(58)} for k, t in texts.items()}
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 85).collect()}
    assert got == brute_components(sets, 85)


def test_minhash_below_the_threshold(spark, monkeypatch):
    """Blocks full of pairs just below the threshold are confirmed in place, and links among them are found."""
    from skein.llm import minhash_dedup

    monkeypatch.setattr(minhash_dedup, "CHUNK", 16)
    monkeypatch.setattr(minhash_dedup, "DENSE", 1)
    rng, texts = np.random.default_rng(6), {}
    base = [f"w{i}" for i in range(120)]
    for k in range(150):
        w = list(base)
        for i in rng.choice(120, 3 if k % 10 else 1, replace=False):
            w[int(i)] = f"x{k}y{int(i)}"
        texts[k] = " ".join(w)
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(118)} for k, t in texts.items()}
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 88).collect()}
    assert got == brute_components(sets, 88) and len(set(got.values())) > 30


def test_minhash_texts_of_one_doc_id(spark):
    """Every text of a repeated doc_id is linked for itself; the doc_id is one node."""
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(5, words(1)), (5, words(2)), (5, words(3)), (9, words(3) + " more"), (3, words(2)), (8, words(4)), (8, words(4)), (None, words(1))]
    got = sorted((r.doc_id or 0, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect() if r.doc_id)
    assert got == [(3, 3), (5, 3), (5, 3), (5, 3), (8, 8), (8, 8), (9, 3)]


def test_minhash_odd_rows(spark, odd):
    got = near_duplicates(odd, 3, 85).collect()
    assert len(got) == odd.count()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [(r.component_id, r.kept) for r in by[12]] == [(12, True)] * 3 and by[100][0].n_shingles == 0 and by[0][0].component_id == 0
    assert by[None][0].component_id is None
    assert near_duplicates(odd.limit(0), 3, 85).count() == 0


def test_odd_sketch_estimates():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**32, 256).astype(np.uint32)
    b = a.copy()
    b[:26] = rng.integers(0, 2**32, 26)
    x = np.unpackbits(np.frombuffer(odd_sketch(a), np.uint8) ^ np.frombuffer(odd_sketch(b), np.uint8)).sum()
    assert abs(similarity(np.array([x]))[0] - 230 / 256) < 0.04


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 7), *((i, i + 1) for i in range(100, 140)), (3, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, **{i: 100 for i in range(100, 141)}}


def brute_lines(rows, least_docs=5):
    key = lambda x: x.strip(SPACE).translate(LOW)
    held = collections.defaultdict(set)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                held[k].add(-(1 << 63) if i is None else i)
    common = {k: max(v) for k, v in held.items() if len(v) >= least_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in common or common[key(x)] == (-(1 << 63) if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(spark, docs, odd):
    lines = ["A line that is long enough to count, ÉCOLE " + str(i) for i in range(9)]
    more = [(1000 + k, "\n".join(["  " + lines[j].upper() + "\t" if k % 2 else lines[j].replace("É", "é") for j in range(9) if (k + j) % 3] + ["x"])) for k in range(14)]
    once = [(3000, "a line that only one doc_id holds, though in six rows")] * 6 + [(3001, "a line that only one doc_id holds, though in six rows")]
    extra = spark.createDataFrame([*more, (None, lines[1]), more[3], more[3], (2000, None), *once], "doc_id long, text string")
    for d in (docs.select("doc_id", "text"), docs.select("doc_id", "text").union(extra), odd.select("doc_id", "text"), docs.select("doc_id", "text").limit(0)):
        got = dedup_lines(d).collect()
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got), key=str) == brute_lines([(r.doc_id, r.text) for r in d.collect()])
    assert set(odd.columns) <= set(dedup_lines(odd).columns)


def brute_base(text):
    out = []
    for k, p, ok in (
        ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ):
        out += [(m.start(), KINDS.index(k), k, m.end()) for m in re.finditer(p, text) if ok(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def test_secrets_base(spark, sf, docs):
    got = {r.doc_id: r for r in Q.op5_secrets(spark, sf).collect()}
    for r in docs.collect():
        base = brute_base(r.text or "")
        assert got[r.doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert got[r.doc_id].n_hex == base.count("hex:") and got[r.doc_id].n_access == base.count("access:")
        assert ",".join(x for x in got[r.doc_id].spans.split(",") if "entropy" not in x) == base
    rng = np.random.default_rng(2)
    alphabet = ["token", "Secret", "api_key", "PASSWORD", "=", ":", " ", '"', "abc123", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", ".", "ſecret", "\n", "_", "zz"]
    for _ in range(3000):
        t = "".join(rng.choice(alphabet, 9))
        assert ",".join(f"{k}:{s}:{e}" for k, s, e in find_secrets(t) if "entropy" not in k) == brute_base(t)


def test_secrets_entropy(spark, odd):
    run = "aZ3kQ9xT7bLm2WcV5nRf8Yp4"
    direct = [-sum(c / 20 * math.log2(c / 20) for c in collections.Counter(run[i : i + 20]).values()) for i in range(len(run) - 19)]
    assert np.allclose(window_entropies(run, 20), direct)
    assert find_secrets(f"see {run} here") == [("mixed_entropy", 4, 4 + len(run))]
    assert find_secrets("see EXAMPLEaZ3kQ9xT7bLm2WcV here") == [] and find_secrets("internationalizationcounterrevolutionary") == []
    assert find_secrets(f"{run}sample{run}") == [("mixed_entropy", 0, 24), ("mixed_entropy", 30, 54)]
    assert find_secrets("q7x2m9c4v8b1n5z3l6w0p") == [("lower_entropy", 0, 21)] and find_secrets("Q7X2M9C4V8B1N5Z3L6W0P") == [("upper_entropy", 0, 21)]
    assert find_secrets("Donaudampfschifffahrtsgesellschaft getUserAccountInformationService") == []
    got = {r.doc_id: r for r in redact(scan(odd)).collect()}
    assert got[100].spans == [] and got[100].text is None and got[4].text == "a" and got[4].rep == "?"
    one = spark.createDataFrame([(1, "x password=abcdef12 y")], "doc_id long, text string")
    assert redact(one).first().text == "x [assign] y"


def brute_entropy(text):
    """All spans, window by window from scratch, and every span against every other."""
    out = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in brute_base(text).split(",") if x)]
    for kind, (chars, needs, bits) in CLASSES.items():
        good = set()
        for run in RUN.finditer(text):
            places = [m.span() for a in ALLOWED for m in re.finditer(f"(?=({re.escape(a)}))", run[0].lower()) for m in [re.compile(re.escape(a)).match(run[0].lower(), m.start())]]
            for m in chars.finditer(run[0]):
                for i in range(m.start(), m.end() - 19):
                    w = run[0][i : i + 20]
                    h = -sum(c / 20 * math.log2(c / 20) for c in collections.Counter(w).values())
                    if h >= bits - 1e-9 and all(set(w) & set(n) for n in needs) and not any(a < i + 20 and i < b for a, b in places):
                        good.add((run.start() + i, m.start() + run.start()))
        spans = []
        for i, origin in sorted(good):
            if spans and spans[-1][2] == origin and i <= spans[-1][1]:
                spans[-1][1] = i + 20
            else:
                spans.append([i, i + 20, origin])
        out += [(kind, a, b) for a, b, _ in spans if not any(x <= a and b <= y for _, x, y in out)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def test_secrets_against_a_plain_rescan(docs):
    rng = np.random.default_rng(12)
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", UPPER + LOWER, UPPER + LOWER + "0123456789+/=_-"]
    texts = [r.text or "" for r in docs.collect()]
    for _ in range(300):
        parts = ["".join(rng.choice(list(alphabets[int(rng.integers(6))]), int(rng.integers(5, 60)))) for _ in range(3)]
        texts.append(str(rng.choice(["", "x ", "example", "_"])) + str(rng.choice(["sample", " ", "=", "-", "1234567890"])).join(parts))
    for t in texts:
        assert find_secrets(t) == brute_entropy(t), t


def test_secrets_are_linear_in_their_number():
    rng, took = np.random.default_rng(13), []
    for n in (2000, 8000):
        t = " ".join("".join(rng.choice(list(UPPER + LOWER + "0123456789"), 24)) for _ in range(n))
        began = time.process_time()
        assert len(find_secrets(t)) >= 0.9 * n
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0]


def check_bins(lengths, size=2048):
    bins = best_two_fit(lengths, size)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= size for b in bins)
    return len(bins)


def test_best_two_fit():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.minimum(2048, rng.lognormal(6, 1, 700).astype(int) + 1).tolist()
        assert check_bins(lengths) <= -(-sum(lengths) // 2048) * 1.02 + 1
    # the smallest piece, 3, makes way for 2 and 2
    assert [sorted(b) for b in best_two_fit([6, 3, 2, 2], 10)] == [[0, 2, 3], [1]]
    assert check_bins([]) == 0 and check_bins([2048] * 3) == 3
    for _ in range(50):
        lengths = rng.integers(1, 2049, int(rng.integers(0, 60))).tolist()
        bins, room = best_fit_decreasing(lengths, 2048), []
        for n in sorted(lengths, reverse=True):  # the same bin by bin
            fits = [k for k, r in enumerate(room) if r >= n]
            if fits:
                room[min(fits, key=lambda k: room[k])] -= n
            else:
                room.append(2048 - n)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and sorted(2048 - sum(lengths[i] for i in b) for b in bins) == sorted(room)


def test_packing_deals_rows_without_an_id(spark, monkeypatch):
    from skein.llm import packing

    monkeypatch.setattr(packing, "GROUP_ROWS", 500)
    rows = spark.createDataFrame([(None, 0, 0, 700)] * 4000, "doc_id long, piece int, start long, length long")
    rows.write.parquet(path := f"{shared_dir(spark)}/nameless")
    got = packed(spark.read.parquet(path)).groupBy(F.shiftright("sequence_id", 32).alias("g")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("sequence_id").alias("s")).collect()
    assert len(got) == 8 and sum(r.n for r in got) == 4000 and max(r.n for r in got) < 650 and all(r.s == -(-r.n // 2) for r in got)


def test_packing(spark, sf, docs, odd):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORDS)
    for d in (docs, odd):
        texts = collections.defaultdict(list)
        for r in d.collect():
            texts[r.doc_id].append([*lib.encode(r.text or "", add_special_tokens=False).ids, 0])
        rows = packed(tokenized(d, WORDS)).collect()
        seen, used = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            ids = texts[r.doc_id][0][r.start : r.start + r.length]
            assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.start == 2048 * r.piece
            seen[r.doc_id].append(r.length)
            used[r.sequence_id].append((r.offset, r.length))
        assert {k: sum(v) for k, v in seen.items()} == {k: sum(map(len, v)) for k, v in texts.items()}
        for v in used.values():
            v.sort()
            assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:])) and sum(v[-1]) <= 2048
    r = Q.op6_packing(spark, sf).first()
    want = [*lib.encode(docs.where(F.col("doc_id") == r.doc_id).first().text, add_special_tokens=False).ids, 0][r.start : r.start + r.length]
    assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    assert packed(tokenized(odd.limit(0), WORDS)).count() == 0


def test_embeddings(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in d.collect()]
    rows += [(9000, rows[3][1]), (9001, rows[3][1]), (9002, None), (9003, [0.0] * 64), (9004, [float("nan")] * 64), (9005, [1.0, None] + [0.0] * 62), (9006, [2 * x for x in rows[5][1]]), (9007, [])]
    got = {r.vec_id: r for r in embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    good = {k: np.array(v, np.float64) for k, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = sorted(good)
    x = np.array([np.float32(good[k]).astype(np.float64) for k in ids])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = dict(zip(ids, near.sum(1)))
    found = sum(got[k].n_links for k in ids)
    assert all(got[k].n_links <= want[k] for k in ids) and found >= 0.98 * near.sum()
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in (9002, 9003, 9004, 9005, 9007))
    assert got[9000].component_id == got[9001].component_id == got[rows[3][0]].component_id and not got[9006].kept
    few = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])]
    assert [r.n_links for r in embedding_duplicates(spark.createDataFrame(few, "vec_id long, embedding array<double>")).orderBy("vec_id").collect()] == [1, 1, 0]
    assert embedding_duplicates(d.limit(0)).count() == 0


def test_embeddings_of_mixed_lengths(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [3.0, 0.1, 0.0]), (5, [0.0, 1.0, 0.0]), (6, None), (None, [1.0, 0.0]), (7, [1.0] * 40), (8, [2.0] * 40), (8, [2.0] * 40)]
    rows += [(100 + k, [float(k % 7), 1.0, float(k % 3), float(k)]) for k in range(50)] + [(1000 + k, [1.0] + [0.0] * k) for k in range(5, 30)]
    d = spark.createDataFrame([(*r, "?", "?", "?") for r in rows], "vec_id long, embedding array<double>, v string, component_id string, rep string")
    for lengths in (16, 2):  # with and without a sample for each length
        embedding_dedup.LENGTHS, before = lengths, embedding_dedup.LENGTHS
        got = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in embedding_duplicates(d).collect())
        embedding_dedup.LENGTHS = before
        good = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if v and i is not None]
        want = [(i or 0, 0 if i is None or not v else sum(len(w) == len(v) and np.dot(np.array(v) / np.linalg.norm(v), w) >= 0.95 for _, w in good) - 1) for i, v in rows]
        assert [(i, n) for i, n, _ in got] == sorted(want)
        assert {i: c for i, _, c in got if i in (1, 2, 3, 4, 5, 6, 7, 8)} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 7}


def link_recall(spark, planted):
    """The share of all links that are found, in the vectors of sf0.1 and the planted ones; each vec_id has no link too many."""
    d = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.array([r.embedding for r in d.orderBy("vec_id").collect()], np.float32)
    x = np.concatenate([x, planted(x, np.random.default_rng(11)).astype(np.float32)])
    assert len(np.unique(x, axis=0)) == len(x)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    x = x.astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    assert all(got[k] <= n for k, n in enumerate(near.sum(1)))
    return sum(got.values()) / near.sum()


def near_copies(x, cosines, rng):
    """A copy of each row of x, at the given cosine with it."""
    x = x / np.linalg.norm(x, axis=1)[:, None]
    u = rng.standard_normal(x.shape)
    u -= (u * x).sum(1)[:, None] * x
    u /= np.linalg.norm(u, axis=1)[:, None]
    return cosines[:, None] * x + np.sqrt(1 - cosines**2)[:, None] * u


@pytest.mark.parametrize("copies", [200, 1000, 2500])
def test_embeddings_in_a_hot_group(spark, copies):
    found = link_recall(spark, lambda x, rng: near_copies(np.repeat(x[:1], copies, axis=0), rng.uniform(0.97, 0.99, copies), rng))
    print(f"recall in a group of {copies}: {found:.4f}")
    assert found >= 0.99


def test_embeddings_recall(spark):
    """Distinct copies at 0.95 to 0.99: pairs among thousands of other vectors, alone and beside a group of a third of the rows."""
    def pairs(x, rng):
        return near_copies(x[1:1001], rng.uniform(0.951, 0.99, 1000), rng)

    def both(x, rng):
        return np.concatenate([pairs(x, rng), near_copies(np.repeat(x[:1], 1500, axis=0), rng.uniform(0.95, 0.99, 1500), rng)])

    alone, beside = link_recall(spark, pairs), link_recall(spark, both)
    print(f"recall of pairs: {alone:.4f}, beside a group: {beside:.4f}")
    assert alone >= 0.9 and beside >= 0.9


def test_toxicity(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality", "toxic")
    chain = train(docs, labels.where("doc_id % 3 <> 0"), default_categories())
    held = score(docs, chain).join(labels.where("doc_id % 3 = 0"), "doc_id").groupBy(F.col("toxic") == 1, "rejected").count().collect()
    n = {(r[0], r[1]): r[2] for r in held}
    hit, miss, wrong = n.get((True, True), 0), n.get((True, False), 0), n.get((False, True), 0)
    # few labelled rows of some languages here; with ten times as many both are above 0.99
    assert hit / (hit + miss) > 0.75 and hit / (hit + wrong) > 0.9
    out = score(odd, chain)
    assert out.count() == odd.count() and out.where("rejected is null or p_toxic is null or rejected").count() == 0 and "rep" in out.columns
    assert score(odd.limit(0), chain).count() == 0
    twice = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, None, 0), (2, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert train(odd.select("doc_id", "text"), twice, default_categories()).names == ["poor", "toxic"]
    none = train(odd.select("doc_id", "text"), labels.limit(0), default_categories())
    assert score(odd, none).where("rejected").count() in (0, odd.count())


def test_token_counts(spark, docs, odd):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(BYTES)
    rng = np.random.default_rng(4)
    noise = ["".join(rng.choice(list("ab c\n\té'st 12.▁<|>"), 40)) for _ in range(2000)]
    noise = spark.createDataFrame([(i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    for d in (docs, odd, noise):
        rows = count_tokens(d, BYTES).collect()
        assert len(rows) == d.count()
        for r in rows:
            assert r.n_tokens == len(lib.encode(r.text or "", add_special_tokens=False).ids), r.text


def test_quality_odd_rows(spark, odd):
    rows = quality(odd, keep_text=True).collect()
    assert len(rows) == odd.count()
    for r in rows:
        w = WORD.findall(r.text or "")
        win = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if win[tuple(w[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), len("".join(w)), len(covered), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
    assert quality(odd.limit(0)).count() == 0


def test_host_verdicts_decide(spark):
    """Documents that just pass their own rules stay on a host that seldom fails and go on one that often does."""
    clean, bad = " ".join(f"w{i}" for i in range(100)), "too few"
    close = " ".join([f"w{i}" for i in range(91)] + [f"w{i}" for i in range(9)])  # 18 of 100 words repeat: a margin of 0.1
    rows = [(i, clean, "good") for i in range(400)] + [(1000 + i, bad if i % 3 == 0 else clean, "poor") for i in range(400)] + [(5000, close, "good"), (5001, close, "poor")]
    got = {r.doc_id: r for r in quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[5000].kept and not got[5001].kept and not got[5001].base_failed and got[1001].kept and got[0].kept
    assert {k for k, r in got.items() if not r.kept and not r.base_failed} == {5001}


def test_host_verdicts(spark):
    good, bad = " ".join(f"w{i}" for i in range(20)), "too few"
    rows = [(i, good, "clean") for i in range(300)] + [(1000 + i, bad if i % 10 else good, "junk") for i in range(300)] + [(2000, bad, "small"), (2001, good, "small")]
    got = {r.doc_id: r for r in quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].kept and not got[1000].base_failed and not got[1000].kept and got[2001].host_rate > 0


def test_pipeline(spark, sf):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, out, sf)
        assert out.columns == docs.columns, name
    pieces = P.run(spark, sf)
    assert pieces.select("doc_id").distinct().count() == out.count() and out.count() > 0.7 * docs.count()


def brute_redact(text):
    """Overlapping spans are one, named by the first of them."""
    out, spans = "", []
    for kind, a, b in sorted(find_secrets(text), key=lambda s: s[1]):
        if spans and a < spans[-1][2]:
            spans[-1][2] = max(b, spans[-1][2])
        else:
            spans.append([kind, a, b])
    at = 0
    for kind, a, b in spans:
        out += text[at:a] + f"[{kind}]"
        at = b
    return out + text[at:]


def test_pipeline_against_brute_force(spark, sf, tmp_path):
    """run(), ids included: toxicity's verdicts are its own, every later stage is done over in Python."""
    import corpus_pipeline as P
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORDS)
    line = "A line that stands in six documents and is long enough to count"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    first = docs.first()
    more = [first.asDict() | {"doc_id": 10**6 + k, "text": t} for k, t in enumerate([first.text, first.text + " more", "x password=abcdef12 y", "word " * 5000, "", *(f"{line}\n{k} and its own words, number {k}" for k in range(6))])]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in P.toxicity(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()]
    texts = {i: t for i, _, _, t in brute_lines(rows)}
    sets = {}
    for k, t in texts.items():
        w = WORD.findall(t.translate(LOW))
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    kept = [k for k, c in brute_components(sets, 80).items() if k == c]
    assert len(kept) < len(rows) == len(texts)
    want = {k: np.array([*lib.encode(brute_redact(texts[k]), add_special_tokens=False).ids, 0], "<u4").tobytes() for k in kept}
    got, used = collections.defaultdict(list), collections.defaultdict(list)
    for r in P.run(spark, str(tmp_path)).collect():
        assert len(r.ids) == 4 * r.length and r.start == 2048 * r.piece
        got[r.doc_id].append((r.start, bytes(r.ids)))
        used[r.sequence_id].append((r.offset, r.length))
    assert {k: b"".join(x for _, x in sorted(v)) for k, v in got.items()} == want
    for v in used.values():
        v.sort()
        assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:])) and sum(v[-1]) <= 2048


def test_pipeline_keeps_rows_that_share_a_doc_id(spark):
    import corpus_pipeline as P

    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(-1, words(k)) for k in range(30)] + [(-1, words(3)), (7, words(4) + " more"), (-5, words(5) + " more"), (8, words(50)), (None, words(6)), (9, ""), (9, words(51))]
    out = [tuple(r) for r in P.minhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    want = [(-1, words(k)) for k in range(30) if k != 5] + [(-5, words(5) + " more"), (8, words(50)), (None, words(6)), (9, ""), (9, words(51))]
    assert sorted(out, key=str) == sorted(want, key=str)


def test_sql_agrees(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in Q.oracle_sql().items():
        got, want = Q.queries()[name](spark, sf), con.execute(sql)
        names = [c[0] for c in want.description]
        assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(map(tuple, want.fetchall()), key=str), name


def test_pipeline_stages_on_odd_rows(spark, sf, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, clashing columns and an empty table, through each stage."""
    import corpus_pipeline as P

    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHES)])
    more = ["?"] * len(CLASHES)
    rows = [(i, t, None, None, len(t), *more) for i, t in enumerate(ODD)] + [(100, None, None, None, None, *[None] * len(CLASHES)), (None, "no id here", "en", "s", 10, *more), (None, None, None, None, None, *more), (7, "another text of a known id", "en", "s", 26, *more)]
    rows += [rows[12], rows[12]]
    odd = spark.createDataFrame(rows, schema)
    kept = {"toxicity": len(rows), "line_dedup": len(rows), "minhash_dedup": len(rows) - 2, "secret_scan": len(rows)}
    for d, n in ((odd, kept), (odd.limit(0), dict.fromkeys(kept, 0))):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, d, str(tmp_path))
            assert out.columns == d.columns and out.count() == n[name], name
        pieces = P.packing(spark, d, str(tmp_path))
        assert pieces.where("start = 0").count() == d.count() and pieces.where("offset + length > 2048").count() == 0

"""The operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .chat import chain_nodes, format_trees, masked, parsed
from .embedding_dedup import embedding_duplicates
from .line_dedup import LOWEST, dedup_lines
from .minhash_dedup import near_duplicates
from .packing import packed, tokenized
from .common import saved
from .quality_rules import quality
from .secret_scan import scan
from .sentencepiece_codec import decode, encode
from .token_counts import count_tokens
from .toxicity import default_categories, score, train


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids in decimal, one space between), round_trip: decoding gives the text again."""
    path = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = decode(encode(docs, path), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.crc32(F.array_join("ids", " ")).alias("ids_crc32"), (F.col("decoded") == F.col("text")).alias("round_trip"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{one}'), (-7L, 1L, 'assistant', '{one}') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    rows = rows.withColumn("conv_id", F.coalesce("conv_id", F.lit(LOWEST)))
    out = format_trees(chain_nodes(rows))
    turns = parsed(F.col("formatted"))
    whole = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = out.withColumn("_loss", masked(F.col("formatted"), F.col("loss")))
    return out.select(
        F.nullif("tree", F.lit(LOWEST)).alias("conv_id"), F.size(turns).cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", number("assign"), number("access"), number("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenized(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    slim = saved(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return packed(slim).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), default_categories())
    return score(docs, chain).drop("text")


def op9_token_counts(spark: SparkSession, sf_dir: str, limit: int = 512) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = count_tokens(docs, tokenizer_path("byte_bpe_50k.json"))
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_SPACE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP2_SQL = """
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), e AS (
  SELECT *, replace(replace(replace(replace(replace(text, '~', '~0'), '<s>', '~1'), '</s>', '~2'), '[INST]', '~3'), '[/INST]', '~4') AS t,
    replace(replace(replace(replace(replace(role, '~', '~0'), '<s>', '~1'), '</s>', '~2'), '[INST]', '~3'), '[/INST]', '~4') AS r FROM rows_
), f AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<s>[INST]' || r || '[/INST]' || chr(10) || t || '</s>' || chr(10))) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM f
"""

OP3_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_A}', '{_Z}')")} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i+2], ' ') FOR i IN range(1, len(ws) - 1)] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP4_SQL = f"""
WITH a AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM a),
k AS (SELECT *, translate(trim(line, {_SPACE}), '{_A}', '{_Z}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.holder AS gone FROM k LEFT JOIN c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""

OP10_SQL = f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, i + unnest(range(5)) AS p FROM dup) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: trim(x, {_SPACE}) <> '')) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: trim(x, {_SPACE}) <> ''))) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (base_failed))::DOUBLE AS failed FROM b GROUP BY source),
t AS (SELECT sum(n) AS n, sum(failed) / sum(n) AS mean, count(*)::DOUBLE AS hosts, sum(failed * failed / n) AS squares FROM h),
v AS (SELECT *, mean * (1 - mean) AS within, (squares / n - mean * mean - mean * (1 - mean) * hosts / n) / (1 - hosts / n) AS v FROM t),
p AS (SELECT mean, CASE WHEN n > hosts AND v > 0 AND v < within THEN within / v - 1 ELSE 1e9 END AS strength FROM v),
r AS (SELECT source, (failed + mean * strength) / (n + strength) AS rate FROM h, p)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND 1.0::DOUBLE - (100 * n_repeat_words)::DOUBLE / (20 * n_words)::DOUBLE >= rate AND rate <= 0.5 AS kept FROM b JOIN r ON r.source IS NOT DISTINCT FROM b.source
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_sentencepiece, op2_chat, op3_minhash, op4_line_dedup, op5_secrets, op6_packing, op7_embeddings, op8_toxicity, op9_token_counts, op10_quality, pipeline)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": OP2_SQL, "op3_minhash": OP3_SQL, "op4_line_dedup": OP4_SQL, "op10_quality": OP10_SQL}

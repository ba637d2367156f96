"""Registered queries of the training-data operators.

Each query applies its operator, with production parameters, to its whole
table.  ``ORACLES`` has DuckDB SQL where SQL can express the result.
"""
from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import alignment, bpe, bwtmerge, chat, imatch, langid, pfair, probminhash, quality, secrets, toxicity, variants, warc
from .common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls (derived from every turn of the conversations) linked, ordered and validated."""
    return chat.link_calls(chat.with_tools(table(spark, sf_dir, "conversations")))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; the text model is learned from the documents' languages."""
    return langid.identify(table(spark, sf_dir, "pages"), langid.fit(table(spark, sf_dir, "documents")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    rows = bpe.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and a digest of the rules' spans, and all spans."""
    docs = table(spark, sf_dir, "documents")
    spans = F.col("spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    def joined(found):
        return F.array_join(F.transform(found, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return secrets.scan(docs, secrets.fit(docs)).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
        joined(spans).alias("spans"), count("markov").alias("n_markov"))


def op6_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document when sources are mixed to their target weights."""
    return pfair.schedule(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "chars", "block", "phase", "slot", "release", "deadline")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: counts, the plain rules' verdict, and the posterior's."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"), "quality")


def op8_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return probminhash.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archive."""
    path = f"{shared_dir(spark, 'llm')}/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_to")


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    made = imatch.fingerprints(table(spark, sf_dir, "documents"))
    return made.withColumns({c: F.array_join(c, ":") for c in ("fingerprint", "edited_fingerprint")})


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that documents with smaller ids have."""
    def total(c: str):
        return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)

    return bwtmerge.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (total("ends") - total("starts")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers linked by the bytes they share, for every document."""
    return alignment.align(table(spark, sf_dir, "documents"), VOCABULARY, PIECES).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words' number, most frequent form and root."""
    return variants.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat": op1_chat,
    "op5_language": op5_language,
    "op3_toxicity": op3_toxicity,
    "op4_secrets": op4_secrets,
    "op6_pfair": op6_pfair,
    "op7_quality": op7_quality,
    "op8_probminhash": op8_probminhash,
    "op9_warc": op9_warc,
    "op10_imatch": op10_imatch,
    "op2_bpe": op2_bpe,
    "op11_suffixes": op11_suffixes,
    "op12_alignment": op12_alignment,
    "op13_variants": op13_variants,
}

OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
                  sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS r FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1) for i in generate_series(0, 31)], '')
    AS payload_digest,
  CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = r THEN NULL ELSE r END AS refers_to
FROM p
"""

OP11_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
e AS (SELECT w.doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY w.doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new
      FROM w JOIN f USING (s) WHERE m < w.doc_id),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e),
r AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, k),
c AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends
      FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  CASE WHEN n IS NULL THEN sha256(unhex(h)) ELSE sha256(unhex(array_to_string([
    substr(h, 2 * (CASE WHEN j = 1 THEN 0 ELSE ends[j - 1] END) + 1,
           2 * ((CASE WHEN j = n + 1 THEN length(h) // 2 ELSE starts[j] END) - (CASE WHEN j = 1 THEN 0 ELSE ends[j - 1] END)))
    for j in range(1, n + 2)], ''))) END AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

OP13_SQL = """
WITH RECURSIVE t AS (SELECT list(c ORDER BY i) AS crc FROM (
  SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
r AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
l AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
      FROM r WHERE length(run) >= 6 GROUP BY ALL),
b AS (SELECT run, n, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS h FROM l),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, [CAST('0x' || h[2 * i - 1 : 2 * i] AS BIGINT)
        for i in range(1, length(h) // 2 + 1)]),
        lambda c, x: xor(c >> 8, crc[CAST(xor(c, x) & 255 AS INT) + 1]))) AS h FROM b, t),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM h) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut
      FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
p AS (SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM d x JOIN d y ON x.cut = y.cut AND x.i = y.i AND x.word <> y.word
      UNION SELECT d.word, d.n, w.word, w.n FROM d JOIN w ON d.cut = w.word
      UNION SELECT w.word, w.n, d.word, d.n FROM d JOIN w ON d.cut = w.word),
f AS (SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n FROM p GROUP BY word, n),
g AS (SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
        CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM w LEFT JOIN f ON w.word = f.word),
c AS (SELECT word, word AS root, 0 AS k FROM g
      UNION ALL SELECT c.word, g.form, k + 1 FROM c JOIN g ON c.root = g.word WHERE g.form IS NOT NULL)
SELECT g.word, form, root, n, n_near, form_n
FROM g JOIN (SELECT word, arg_max(root, k) AS root FROM c GROUP BY word) USING (word)
"""

#: Learned models, iterations and tokenizers are outside SQL: their tests compare with brute force.
ORACLES: dict[str, str] = {"op9_warc": OP9_SQL, "op11_suffixes": OP11_SQL, "op13_variants": OP13_SQL}

"""One thin query per operator: production parameters, whole tables, and
the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.align import alignments, link_counts
from starledger.llm.common import crc_mod, shared_table, table, text_of
from starledger.llm.exact_dedup import exact_dedup
from starledger.llm.filter_audit import audit_filters, failure_masks, text_filters
from starledger.llm.lm import score_texts
from starledger.llm.mixing import interleave
from starledger.llm.pieces import MODEL, N_BEST, decode, encode
from starledger.llm.pii import find_pii, span_text
from starledger.llm.quality import THRESHOLD, classify
from starledger.llm.simhash import near_dedup
from starledger.llm.substring_dedup import substring_dedup
from starledger.llm.topk import exact_top_k
from starledger.llm.url_filter import filter_urls
from starledger.llm.warc import read_archive, write_archive
from starledger.session import scratch_path

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


#: Target shares of the sources; any other source shares one small queue.
SOURCE_WEIGHTS = {"src0": 0.24, **{f"src{i}": 0.04 for i in range(1, 20)}}


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors["vec_id"] % 20 == 0, k=20)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, crc_mod(docs["doc_id"], 5) != 1)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best segmentation of every text, the scores and digests of the
    N best, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.withColumn("text_sha256", F.sha2(text_of(docs, "text").cast("binary"), 256))
    coded = encode(docs, MODEL, N_BEST, carry=["text_sha256"]).select(
        "doc_id", "text_sha256", "ids", "score", F.transform("nbest", lambda b: F.struct(
            b["score"].alias("score"), F.size(b["ids"]).alias("n_ids"), F.xxhash64(b["ids"]).alias("ids_hash"))).alias("nbest"))
    back = decode(coded, MODEL).withColumn("decoded_sha256", F.sha2(F.col("decoded").cast("binary"), 256)).drop("decoded")
    return back.withColumn("round_trip", F.col("decoded_sha256") == F.col("text_sha256"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                    held_out=crc_mod(F.col("id"), 5) == 0, threshold=THRESHOLD)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc-archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), shingle=3, seed=42)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return interleave(docs, SOURCE_WEIGHTS)[0]


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        span_text(F.col("found")).alias("spans"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignments(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    stored = shared_table(aligned.withColumn("groups_sha256", digest).drop("groups"), "alignments")
    return link_counts(stored).select(F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
                                      "n_best", "count_sum", "groups_sha256")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    masks = failure_masks(docs, table(spark, sf_dir, "labels"), text_filters(text_of(docs, "text")), "E", docs["lang"])
    return audit_filters(masks, "ABCDE")


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup(table(spark, sf_dir, "documents"), window=20)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_top_k": op1_exact_top_k,
        "op2_url_filter": op2_url_filter,
        "op3_lm_scoring": op3_lm_scoring,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_warc": op6_warc,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_mixing": op9_mixing,
        "op10_pii": op10_pii,
        "op11_token_alignment": op11_token_alignment,
        "op12_filter_audit": op12_filter_audit,
        "op13_substring_dedup": op13_substring_dedup,
    }


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""


OP12_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         CAST(len(words) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INTEGER)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INTEGER)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
         + 16 * CAST(coalesce(min(w.doc_id) OVER (PARTITION BY text) < w.doc_id, false) AS INTEGER) AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM b a JOIN b b ON b.bit <> a.bit JOIN b c ON c.bit NOT IN (a.bit, b.bit) JOIN b d ON d.bit NOT IN (a.bit, b.bit, c.bit)
  JOIN b e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit,
         CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM o)),
r AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM m CROSS JOIN s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""

OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, md5(array_to_string(w[s + 1:s + 20], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
again AS (SELECT doc_id, s FROM (
  SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, s + k AS p FROM (SELECT doc_id, s, unnest(range(0, 20)) AS k FROM again)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM d WHERE len(w) > 0),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": OP1_SQL,
        "op6_warc": OP6_SQL,
        "op8_exact_dedup": OP8_SQL,
        "op12_filter_audit": OP12_SQL,
        "op13_substring_dedup": OP13_SQL,
    }

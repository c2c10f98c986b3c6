"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.llm import bpe, chat, ctw, decontam, html, minhash, quality, runs, search, sharding, substring, toxicity, warc
from relaylens.llm.common import saved, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words found in each document."""
    report = decontam.Contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).report()
    digest = F.sha2(F.encode(F.concat_ws(",", "item_ids"), "UTF-8"), 256)
    return report.select(F.col("doc.id").alias("doc_id"), "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality metrics and the verdict of risk-controlled rules per document."""
    out = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines and passages of 50 words and more that an earlier ranked place already has."""
    out = substring.deduplicate_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("removed_spans").cast("long").alias("n_removed"), "removed_spans", "text")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    score = F.col("toxicity").alias("score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score, (F.col("toxicity") >= toxicity.REJECT_AT).cast("int").alias("predicted"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    back = warc.round_trip(pages)
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree and unigram log probabilities of every document."""
    return ctw.lm_scores(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and the decoded text per document."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document under the byte limit."""
    placed = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "shard_id", "shard_depth", "shard_bytes", "row_bytes")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation added to the table, whose texts are control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-target examples of every conversation, written, read back and digested."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], given.schema)
    return chat.digests(saved(chat.expand(given.unionByName(added)), "chat-examples", chat.WRITE_LONG))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of them with a planted tail."""
    return runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


#: Windows joined to document word positions. Joined words are windows' keys: no word holds a blank.
OP1_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS ws
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
dp AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, sizes WHERE len(w) >= k),
dwin AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS ws FROM dp),
hit AS (SELECT doc_id, dwin.k, p, item_id FROM dwin JOIN win USING (k, ws)),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op9_sql(limit: int = sharding.DEFAULT_LIMIT) -> str:
    """Smallest depth at which a row's bucket fits; the directory splits only buckets above the limit. Rows of a bucket
    that no bit separates (overflow pages) are left to the tests."""
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS row_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS h
  FROM documents),
l AS (SELECT unnest(range(0, {sharding.HASH_BITS + 1})) AS depth),
s AS (
  SELECT depth, h >> ({sharding.HASH_BITS} - depth) AS prefix, sum(row_bytes)::BIGINT AS shard_bytes
  FROM d, l GROUP BY ALL HAVING sum(row_bytes) <= {limit}),
f AS (
  SELECT d.doc_id, d.row_bytes, d.h, min(s.depth) AS shard_depth, arg_min(s.shard_bytes, s.depth) AS shard_bytes
  FROM d JOIN s ON (d.h >> ({sharding.HASH_BITS} - s.depth)) = s.prefix GROUP BY ALL)
SELECT doc_id,
       CASE WHEN shard_depth = 0 THEN 'root'
            ELSE lpad(bin(h >> ({sharding.HASH_BITS} - shard_depth)), shard_depth::INT, '0') END AS shard_id,
       shard_depth::INT AS shard_depth, shard_bytes, row_bytes::BIGINT AS row_bytes
FROM f
"""


#: Integer scores of all documents that share a term with an item.
OP11_SQL = r"""
WITH dt AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
tf AS (SELECT rid, doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
len AS (SELECT rid, sum(tf)::BIGINT AS n FROM tf GROUP BY rid),
tot AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
it AS (
  SELECT item_id, iid, term, count(*) AS q
  FROM (SELECT item_id, iid, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT item_id, text, row_number() OVER () AS iid FROM (SELECT DISTINCT item_id, text FROM benchmark)))
  GROUP BY ALL),
sc AS (
  SELECT it.iid, it.item_id, tf.rid, tf.doc_id,
         sum(q * floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df.df + 1)::DOUBLE))::BIGINT
             * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * len.n * nd) // l))))::BIGINT AS score
  FROM it JOIN tf USING (term) JOIN df USING (term) JOIN len USING (rid), tot GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM rk WHERE rank <= 10
"""

#: Digests of the texts themselves; formatted_chars is each example's length: marks, roles and escaped texts.
OP12_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(24 + length(role) + length(regexp_replace(text, '([<\[])(\\*)(\|[A-Za-z_]+\|>|/?s>|/?SYS>>|/?INST\])', '\1\2\\\3', 'g'))) OVER w AS upto
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR i = n THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_minhash": op6_minhash,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_bpe": op8_bpe,
    "op9_sharding": op9_sharding,
    "op10_html": op10_html,
    "op11_search": op11_search,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_decontamination": OP1_SQL,
    "op9_sharding": op9_sql(),
    "op11_search": OP11_SQL,
    "op12_chat_formatting": OP12_SQL,
}

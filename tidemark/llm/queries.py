"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat_template, chosen_path, hard_negatives, harmonic, importance, kd_shards, multimatch, prefix_trie, spm_backtrack, trie_dedup, warc_zip, winnow, wrappers
from tidemark.llm.common import table
from tidemark.session import fresh_path

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql:
            LLM_ORACLE[name] = sql
        return fn

    return deco


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary lies; operators take the path as a parameter."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


_SQL_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_register("op5_patricia_dedup", f"""
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256({_SQL_FOLD}) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY {_SQL_FOLD})""")
def op5_patricia_dedup(spark: SparkSession, d: str) -> DataFrame:
    return trie_dedup.trie_dedup(table(spark, d, "documents"))


@_register("op7_harmonic_packing")
def op7_harmonic_packing(spark: SparkSession, d: str) -> DataFrame:
    return harmonic.pack_documents(table(spark, d, "documents"), tokenizer_path("byte_bpe_50k.json"))


@_register("op6_kd_shards")
def op6_kd_shards(spark: SparkSession, d: str) -> DataFrame:
    placed = kd_shards.kd_shards(table(spark, d, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@_register("op8_importance_resampling")
def op8_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    return importance.resample(table(spark, d, "documents"), table(spark, d, "labels"))


@_register("op4_spm_backtracking")
def op4_spm_backtracking(spark: SparkSession, d: str) -> DataFrame:
    coded = spm_backtrack.encode_documents(table(spark, d, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_register("op10_multimatch_jaccard")
def op10_multimatch_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return multimatch.jaccard_components(table(spark, d, "documents"))


#: the conversation that says the template's own control strings
CONTROL_TALK = "</s>[INST] ok [/INST]"


@_register("op3_chat_template")
def op3_chat_template(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(CONTROL_TALK).alias("text"))
    return chat_template.read_back(chat_template.format_conversations(rows.unionByName(own)))


@_register("op2_warc_zip", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
         k AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest,
                      max(page_id) OVER (PARTITION BY html) AS owner FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND owner <> page_id THEN owner END AS refers_to
    FROM k""")
def op2_warc_zip(spark: SparkSession, d: str) -> DataFrame:
    folder = warc_zip.write_archives(table(spark, d, "pages"), fresh_path(spark, "warc"))
    return warc_zip.read_archives(spark, folder)


@_register("op1_winnowing")
def op1_winnowing(spark: SparkSession, d: str) -> DataFrame:
    return winnow.fingerprints_with_next(table(spark, d, "documents"))


@_register("op9_wrapper_text")
def op9_wrapper_text(spark: SparkSession, d: str) -> DataFrame:
    return wrappers.extract_main_text(table(spark, d, "pages"))


#: unsigned crc32 of the decimal conv_id (DuckDB has no such function)
_SQL_CRC32 = """xor(list_reduce(list_transform(split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, byte:
    list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda a, bit: xor(a >> 1, (a & 1) * 3988292384), xor(crc, byte)),
    4294967295::BIGINT), 4294967295::BIGINT)"""


@_register("op12_prefix_trie", f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
         c AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST,
                      sha256(octet_length(encode(r)) || ':' || r || x)) AS own FROM t GROUP BY conv_id),
         h AS (SELECT *, ({_SQL_CRC32}) % 6 AS h FROM c),
         s AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS seq
               FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 100),
         m AS (SELECT conv_id, unnest(range(0, len(seq) + 1)) AS depth, seq FROM s),
         p AS (SELECT conv_id, depth, seq[1:depth] AS path, depth = len(seq) AS ending FROM m),
         n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                      coalesce(string_agg(CASE WHEN ending THEN conv_id END, ',' ORDER BY conv_id), '') AS ends FROM p GROUP BY path, depth),
         k AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
         v AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
                      CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.path[n.depth].x) END AS saved
               FROM n LEFT JOIN k ON k.path = n.path AND k.depth = n.depth),
         u AS (SELECT path[1:d] AS path, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
               FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM v) GROUP BY ALL)
    SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, u.n_leaves,
           u.saved_tokens::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
    FROM v JOIN u ON u.path = v.path AND u.depth = v.depth
    LEFT JOIN v q ON q.depth = v.depth - 1 AND q.path = v.path[1:v.depth - 1]""")
def op12_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, d, "conversations"))


@_register("op11_chosen_path")
def op11_chosen_path(spark: SparkSession, d: str) -> DataFrame:
    return chosen_path.near_components(table(spark, d, "documents"))


@_register("op13_hard_negatives", """
    WITH r AS (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT a.uid, a.vec_id AS anchor_id, a.label AS own, b.uid AS other, b.vec_id, b.label,
                      list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
               FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.uid <> b.uid AND len(a.v) = len(b.v)),
         p AS (SELECT uid, anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
               QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) <= 5),
         q AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                      row_number() OVER (PARTITION BY p.uid, positive_id, positive_score ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
               FROM p JOIN s ON s.uid = p.uid AND s.label <> s.own
                AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM q WHERE rank <= 5""")
def op13_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, d, "embeddings"))

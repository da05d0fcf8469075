"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.llm import (chat_format, decontaminate, embed_dedup, license_scan, lm_score, merkle_manifest, prefix_trie,
                           quality_gam, sentencepiece_lattice, simhash, token_binary, token_rollup, toxicity_pu)
from jobsmith.llm.common import Stored, held_out, table
from jobsmith.session import scratch_path


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("detections")


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.token_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2, seed=42)


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as good; background: all documents."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    return lm_score.cross_entropy_difference(docs, good, docs)


def op5_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), floor=0.9)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per leak of a benchmark item in a document."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), quality_gam.score("text", model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day one: every document comes in under the first tokenizer. Day two: documents labelled as poor
    are deleted (the batch is delivered twice). Day three: the long ones (over 1,000 characters) that
    are left are counted again by the second tokenizer."""
    docs = Stored(token_rollup.counted(table(spark, sf_dir, "documents")), "counted").df
    poor = table(spark, sf_dir, "labels").where("quality = 0").select(F.col("doc_id").alias("id"))
    first, second = (F.col(f"`{t}`") for t in token_rollup.TOKENIZERS)
    one, two = token_rollup.TOKENIZERS
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "token-rollup"))
    rollup.apply("day-1", token_rollup.signed(docs, 1, one, first))
    gone = token_rollup.signed(docs.join(poor, "id", "left_semi"), -1, one, first)
    rollup.apply("day-2", gone)
    rollup.apply("day-2", gone)
    left = docs.where("chars > 1000").join(poor, "id", "left_anti")
    rollup.apply("day-3", token_rollup.revised(left, (one, first), (two, second)))
    return rollup.totals()


def op9_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_pu.train(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity_pu.score("text", model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_lattice.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.tamper_report(table(spark, sf_dir, "documents"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings only, formatted, written, and digested from what was written."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    parts = Stored(chat_format.format_chat(turns.unionByName(own)), "chat")
    return chat_format.digest(parts.df)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_token_binary, op3_simhash, op4_lm_score, op5_embed_dedup,
                               op6_decontaminate, op7_quality_gam, op8_token_rollup, op9_toxicity_pu, op10_sentencepiece,
                               op11_merkle_manifest, op12_chat_format, op13_prefix_trie)}

#: CTEs crc_table(t) and, for a query's own ids(id), crcs(id, crc): CRC-32 of decimal ids
CRC = """
  crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
      SELECT i, list_reduce(list_prepend(i, range(8)),
                            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
      FROM (SELECT unnest(range(256)) AS i))),
  crcs AS (
    SELECT id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
    FROM ids, crc_table)"""

SQL: dict[str, str] = {
    "op8_token_rollup": """
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(chars) AS BIGINT) AS chars
FROM (
  SELECT source, lang, CASE WHEN length(t) > 1000 THEN 'word-2' ELSE 'blank-1' END AS tokenizer, length(t) AS chars,
         CASE WHEN length(t) > 1000
              THEN len(regexp_extract_all(t, '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+|[!-/:-@\\[-`{-~]'))
              ELSE len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) END AS tokens
  FROM (SELECT source, lang, coalesce(text, '') AS t FROM documents
        WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)))
GROUP BY source, lang, tokenizer""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE
  ids AS (SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL),{CRC},
  texts AS (
    SELECT d.*, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS now
    FROM documents d LEFT JOIN crcs ON d.doc_id = id),
  leaves AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, sha256(front || body) AS leaf, sha256(front || altered) AS found
    FROM (SELECT doc_id, source,
                 {"||".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))} AS front,
                 coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(now) || ':' || now, '-') AS altered FROM texts)),
  placed AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
  nodes AS (
    SELECT g, 0 AS level, pos, leaf AS d FROM placed
    UNION ALL
    SELECT g, level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM nodes) WHERE n > 1 GROUP BY g, level, pos // 3),
  subroots AS (SELECT g, d AS subroot FROM nodes QUALIFY level = max(level) OVER (PARTITION BY g)),
  tops AS (
    SELECT 0 AS level, g AS pos, subroot AS d FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, pos // 3),
  forest AS (
    SELECT g, level, pos, d FROM nodes UNION ALL
    SELECT -1, level, pos, d FROM tops),
  sides AS (
    SELECT g, level, pos, coalesce(lag(d, 2) OVER w, '') || coalesce(lag(d) OVER w, '') AS before,
           coalesce(lead(d) OVER w, '') || coalesce(lead(d, 2) OVER w, '') AS behind
    FROM forest f WHERE level < (SELECT max(level) FROM forest x WHERE x.g = f.g)
    WINDOW w AS (PARTITION BY g, level, pos // 3 ORDER BY pos)),
  folds AS (
    SELECT r, g, 0 AS level, pos, found AS d, '' AS proof FROM placed
    UNION ALL
    SELECT r, s.g, s.level + 1, s.pos // 3, sha256(before || d || behind), proof || before || behind
    FROM folds JOIN sides s USING (g, level, pos)),
  low AS (SELECT * FROM folds QUALIFY level = max(level) OVER (PARTITION BY r)),
  climbs AS (
    SELECT r, -1 AS g, 0 AS level, g AS pos, d, proof FROM low
    UNION ALL
    SELECT r, s.g, s.level + 1, s.pos // 3, sha256(before || d || behind), proof || before || behind
    FROM climbs JOIN sides s USING (g, level, pos)),
  ends AS (SELECT r, d, proof FROM climbs QUALIFY level = max(level) OVER (PARTITION BY r))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, e.d AS folded_root, e.d = root AS verified
FROM placed JOIN subroots USING (g) JOIN ends e USING (r)
CROSS JOIN (SELECT d AS root FROM tops ORDER BY level DESC LIMIT 1)""",
    "op12_chat_format": f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
  sized AS (
    SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 19 ELSE 23 + length(role) END
              + length(text) + len(regexp_extract_all(role || ' ' || text, '{chat_format.ANY.pattern}')) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op13_prefix_trie": f"""
WITH ids AS (SELECT DISTINCT conv_id AS id FROM conversations WHERE conv_id IS NOT NULL),{CRC},
  own AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations GROUP BY conv_id),
  built AS (
    SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:crc % 9], o.turns[crc % 9 + 1:]) AS turns
    FROM own o JOIN crcs ON o.conv_id = id LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
  places AS (
    SELECT conv_id, d, len(turns) AS n, sha256(CAST(to_json(turns[1:d]) AS VARCHAR)) AS node,
           sha256(CAST(to_json(turns[1:d - 1]) AS VARCHAR)) AS above, coalesce(strlen(turns[d].text), 0) AS bytes
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM built)),
  nodes AS (
    SELECT node, d, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n), '')) AS ends_sha256
    FROM places GROUP BY node, d),
  kids AS (SELECT above AS node, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY above, d),
  full_ AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node, d)),
  sums AS (
    SELECT p.node, p.d, sum(f.saved) AS saved, count(*) FILTER (f.n_children = 0) AS n_leaves
    FROM full_ f JOIN places p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY p.node, p.d)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_ f JOIN sums s USING (node, d) LEFT JOIN nodes u ON u.node = f.above AND u.d = f.d - 1"""}

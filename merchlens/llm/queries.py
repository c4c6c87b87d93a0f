"""The registered queries of the corpus operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm import (
    chat,
    decontaminate,
    langid,
    line_dedup,
    packing,
    quality,
    quality_score,
    sharding,
    simhash,
    spelling,
    toxicity,
    url_filter,
    vector_codes,
)
from merchlens.llm.common import ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(ready(spark), sf_dir)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash_near_dedup")
def simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_url_filter")
def filter_urls(spark, sf_dir):
    """Rule or language-model verdict of every page's url."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


@query("op3_toxicity")
def score_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_decontamination")
def find_leaks(spark, sf_dir):
    """Every document and test item of which the document holds a copy."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
owners AS (
  SELECT line_key, min(doc_id) AS owner FROM keyed
  WHERE length(line_key) >= 10 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT k.doc_id, k.line, k.pos, coalesce(o.owner < k.doc_id, false) AS gone
  FROM keyed k LEFT JOIN owners o USING (line_key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op5_line_dedup", OP5)
def dedup_lines(spark, sf_dir):
    """Lines of every document before and after the lines of smaller documents are dropped."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


PROBE = "</s>[INST] ok [/INST]"

OP6 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS r,
         regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS t
  FROM turns)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length('<s>[INST]  [/INST] </s>') + length(r) + length(t)) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


@query("op6_chat_formatting", OP6)
def format_chats(spark, sf_dir):
    """Every conversation formatted, then read back."""
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digest(chat.format_log(chat.log_of(turns)))


@query("op7_packing")
def pack_documents(spark, sf_dir):
    """Every piece of every document with its sequence and offset."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op8_sharding")
def shard_documents(spark, sf_dir):
    """Shard and slot of every document, equal texts together."""
    out = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_language_id")
def identify_languages(spark, sf_dir):
    """Language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op10_quality_rules")
def judge_quality(spark, sf_dir):
    """Measures and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


# Rounds unrolled: assign every part to its nearest entry, then floor the means.
OP11_ASSIGN = """
near{r} AS MATERIALIZED (
  SELECT vec_id, part, min(dist * 16 + entry) AS best FROM (
    SELECT x.vec_id, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS dist
    FROM cells x JOIN book{r} b USING (part, pos) GROUP BY x.vec_id, x.part, b.entry)
  GROUP BY vec_id, part)"""

OP11_REFINE = """
book{n} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT x.part, CAST(n.best % 16 AS BIGINT) AS entry, x.pos, CAST(floor(sum(x.v) / count(*)) AS BIGINT) AS v
    FROM cells x JOIN near{r} n USING (vec_id, part) GROUP BY ALL) m USING (part, entry, pos))"""

OP11 = (
    """
WITH kept AS (
  SELECT vec_id, label, embedding, len(embedding) // 8 AS wide FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT vec_id, (i - 1) // wide AS part, (i - 1) % wide AS pos,
         CAST(floor(4096 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (
  SELECT c.part, f.entry, c.pos, c.v FROM cells c JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 16) f USING (vec_id)),"""
    + ",".join(OP11_ASSIGN.format(r=r) + "," + OP11_REFINE.format(r=r, n=r + 1) for r in range(vector_codes.ROUNDS))
    + ","
    + OP11_ASSIGN.format(r=vector_codes.ROUNDS)
    + """,
coded AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(best % 16 AS INTEGER)), '' ORDER BY part) AS code,
         CAST(sum(best // 16) AS BIGINT) AS error
  FROM near6 GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(v, ',' ORDER BY part, entry, pos)) FROM book6) AS codebooks_sha256
FROM coded c JOIN kept k USING (vec_id)
"""
)


@query("op11_vector_code_compression", OP11)
def compress_vectors(spark, sf_dir):
    """Product code, errors and codebook digest of every vector."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@query("op13_spelling_variants")
def group_spellings(spark, sf_dir):
    """Form and root of every frequent word."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query("op12_quality_classifier")
def score_quality(spark, sf_dir):
    """Quality score of every document."""
    return quality_score.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

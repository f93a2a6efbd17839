"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from townsquare.llm import alignment, anchors, chat, divergence, language, linechunks, neardup, packing, quality, recompress, suffixes, topk, webpages
from townsquare.llm.common import table, tokenizer_path


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Similarity(width=2))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_webpages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webpages.extract(table(spark, sf_dir, "pages"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.dedup_substrings(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    extra = spark.createDataFrame(planted, "conv_id long, turn long, role string, text string")
    return chat.digests(turns.unionByName(extra))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), *alignment.vocabularies()).drop("groups")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.compress(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"), "label"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_near_dedup": op2_near_dedup,
        "op3_topk": op3_topk,
        "op4_line_dedup": op4_line_dedup,
        "op5_packing": op5_packing,
        "op6_quality": op6_quality,
        "op7_webpages": op7_webpages,
        "op8_substrings": op8_substrings,
        "op9_language": op9_language,
        "op10_chat": op10_chat,
        "op11_alignment": op11_alignment,
        "op12_divergence": op12_divergence,
        "op13_vector_codes": op13_vector_codes,
    }


_OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 5
"""



_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str, lower: bool = True) -> str:
    own = f"translate({text}, '{_UPPER}', '{_LOWER}')" if lower else text
    return f"regexp_extract_all(coalesce({own}, ''), '{pattern}')"


_OP1 = rf"""
WITH d AS (SELECT doc_id, {_words("text", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM documents),
b AS (SELECT item_id, {_words("text", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS size,
         unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS key
  FROM b WHERE len(w) > 0
), dw AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i,
         unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS key
  FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size
), hits AS (SELECT doc_id, i, size, item FROM dw JOIN bw USING (size, key)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_words("text", r"[^\x20\x09-\x0D]+")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
  FROM d WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sized AS (SELECT s.*, n FROM s JOIN sizes USING (doc_id)),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sized a JOIN sized b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), low AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN low USING (doc_id)
"""

_OP8 = rf"""
WITH d AS (SELECT doc_id, {_words("text", r"[^\x20\x09-\x0D]+", lower=False)} AS w FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i,
         unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS key
  FROM d WHERE len(w) >= 13
), judged AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM win),
out AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM judged WHERE gone),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, count(o.i) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (o.i IS NULL) AS text
  FROM each LEFT JOIN out o USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _chat_sql() -> str:
    """Digests of the conversations, and the length of their formatted form from the template."""
    template = chat.INSTRUCT
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    found = " + ".join(f"(length(t) - length(replace(t, {quoted(c)}, ''))) // {len(c)}" for c in template.controls)
    ends = sorted({c[:n] for c in template.controls for n in range(1, len(c))})
    tail = " OR ".join(f"ends_with(t, {quoted(e)})" for e in ends)
    marks = " ".join(f"WHEN {quoted(r)} THEN {len(x.opening + x.closing)}" for r, x in template.turns.items())
    after = " OR ".join(
        f"role = {quoted(r)} AND " + ("(i = 1" if "" in x.after else "(false")
        + "".join(f" OR previous = {quoted(p)}" for p in x.after if p) + ")"
        for r, x in template.turns.items()
    )
    ended = ", ".join(map(quoted, template.end_states))
    return rf"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS previous, lead(conv_id) OVER w IS NULL AS is_last
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, t)
), e AS (
  SELECT *, coalesce({after}, false) AS fits,
         length(t) + length(t) - length(replace(t, '\', '')) + {found} + CAST({tail} AS INT) + CASE role {marks} END AS written
  FROM o
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST({len(template.start)} + sum(written) AS BIGINT) AS formatted_chars,
       bool_and(fits) AND bool_or(is_last AND role IN ({ended})) AS valid,
       CAST(coalesce(min(i - 1) FILTER (NOT fits), -1) AS BIGINT) AS bad_turn
FROM e GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that have one. The classifier, the tokenizer, the parser of pages and the language model have
    none; their tests use held-out rows, exact round trips and small fixtures."""
    return {
        "op1_decontaminate": _OP1,
        "op2_near_dedup": _OP2,
        "op3_topk": _OP3,
        "op4_line_dedup": linechunks.ORACLE_SQL,
        "op8_substrings": _OP8,
        "op10_chat": _chat_sql(),
        "op12_divergence": divergence.oracle_sql(),
        "op13_vector_codes": anchors.oracle_sql(),
    }

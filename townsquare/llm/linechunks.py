"""Line dedup by content-defined chunks of lines, in DataFrame and SQL functions only.

Lines are hashed; a rolling hash over the last few line hashes decides where a chunk ends, so equal runs of lines are cut
alike wherever they stand. Chunks of several lines that occur more than once anywhere are removed but for their first
occurrence. Chunks are counted as whole strings, which is the byte comparison; the long strings are exchanged once per
task and text, all other exchanges carry 128-bit keys, and a key that two different texts share removes nothing.

A repeat that no boundary cuts out, one of two lines for instance, has no chunk of its own. ``dedup_runs`` therefore takes
every window of two lines beside the chunks, so that a repeated chunk grows as far as its neighbours repeat too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: modulus and base of the rolling hash; a chunk has MEAN lines on average, the hash covers WINDOW lines
MODULUS, BASE, MEAN, WINDOW = 2147483647, 1000003, 4, 2


def _chunks(text: str, mean: int, window: int) -> Column:
    """Array of (chunk, lines, start). Each one-element array binds a value, so that it is computed once per text."""
    rolled = "0"
    for back in range(window - 1, -1, -1):
        line = f"element_at(h, i - {back})" if back == 0 else f"(CASE WHEN i > {back} THEN element_at(h, i - {back}) ELSE 0 END)"
        rolled = line if rolled == "0" else f"(({rolled}) * {BASE} + {line}) % {MODULUS}"
    before = "(CASE WHEN j = 0 THEN 0 ELSE element_at(e, j) END)"
    chunk = f"named_struct('chunk', array_join(slice(l, {before} + 1, x - {before}), '\\n'), 'lines', x - {before}, 'start', {before})"
    return F.expr(f"""
      transform(array(split({text}, '\\n', -1)), l ->
        transform(array(transform(l, x -> CAST(conv(substring(md5(CAST(x AS BINARY)), 1, 8), 16, 10) AS BIGINT) % {MODULUS})), h ->
          transform(array(filter(sequence(1, size(l)), i -> i = size(l) OR ({rolled}) % {mean} = 0)), e ->
            transform(e, (x, j) -> {chunk}))[0])[0])[0]
    """)


def _key(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), F.col(text)).alias("k2")]


def repeated(docs: DataFrame, *, mean: int = MEAN, window: int = WINDOW) -> DataFrame:
    """``doc``, ``mark`` (a row of ``docs`` by id and text hash) and ``places``: the chunks to remove from it."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64("text").alias("mark"),
        F.posexplode(_chunks("text", mean, window)).alias("place", "c"),
    ).select("doc", "mark", "place", "c.chunk", "c.lines")
    several = rows.where((F.col("lines") > 1) & (F.trim(F.regexp_replace("chunk", r"\s+", " ")) != ""))
    first = F.min(F.struct("doc", "mark", "place")).alias("first")
    texts = several.groupBy("chunk").agg(first, F.count("*").alias("n")).select(*_key("chunk"), "first", "n")
    keys = texts.groupBy("k1", "k2").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.count("*").alias("texts"))
    keys = keys.where((F.col("texts") == 1) & (F.col("n") > 1)).select("k1", "k2", "first")
    found = several.select(*_key("chunk"), "doc", "mark", "place").join(keys, ["k1", "k2"])
    later = found.where(F.struct("doc", "mark", "place") != F.col("first"))
    return later.groupBy("doc", "mark").agg(F.collect_set("place").alias("places"))


def dedup_lines(docs: DataFrame, *, mean: int = MEAN, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated chunks cut out of ``text``; adds ``n_lines`` and ``n_removed`` (lines).

    The first occurrence, by doc_id and place, stays; within a document too. A NULL id counts as the smallest. Rows that
    repeat id and text are one document: they are cut alike. NULL text stays NULL with 0 lines, an empty text has one
    line. Chunks of one line or of blanks alone stay. Columns named like the two results are replaced.
    """
    names = [n for n in docs.columns if n not in ("n_lines", "n_removed")]
    own = docs.select(*(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)), F.col("text").alias("whole"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64("text").alias("mark"))
    marked = own.join(repeated(docs, mean=mean, window=window), ["doc", "mark"], "left")
    left_places = F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), F.col("places"))  # by hash, in order
    kept = F.transform(left_places, lambda i: F.element_at("chunks", i + 1))
    lines = F.coalesce(F.aggregate("chunks", F.lit(0).cast("long"), lambda n, c: n + c["lines"]), F.lit(0))
    cut = marked.withColumn("chunks", F.when(F.col("places").isNotNull(), _chunks("whole", mean, window)))
    n_lines = F.when(F.col("whole").isNull(), 0).otherwise(F.size(F.split("whole", "\n", -1))).cast("long")
    left = F.aggregate(kept, F.lit(0).cast("long"), lambda n, c: n + c["lines"])
    cut = cut.select(
        *(f"c{i}" for i in range(len(names))),
        n_lines.alias("n_lines"),
        F.when(F.col("places").isNotNull(), lines - left).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("places").isNotNull(), F.array_join(F.transform(kept, lambda c: c["chunk"]), "\n")).otherwise(F.col("whole")).alias("text"),
    )
    return cut.select(*(F.col("text") if n == "text" else F.col(f"c{i}").alias(n) for i, n in enumerate(names)), "n_lines", "n_removed")


def _windows(text: str) -> Column:
    """Array of (start, lines, window): every two lines that are not blank, with the blank ones between them."""
    return F.expr(f"""
      transform(array(split({text}, '\\n', -1)), l ->
        transform(array(filter(sequence(1, size(l)), i -> element_at(l, i) RLIKE '\\\\S')), f ->
          transform(slice(f, 1, greatest(size(f) - 1, 0)), (x, j) ->
            named_struct('start', x - 1, 'lines', element_at(f, j + 2) - x + 1,
                         'window', array_join(slice(l, x, element_at(f, j + 2) - x + 1), '\\n'))))[0])[0]
    """)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc``, ``mark`` (as in ``repeated``) and ``gone``: numbers, from 0, of the lines in windows that an earlier row
    has, or the same row further up without overlap. Windows are compared as whole strings, but only those whose key
    occurs twice."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64("text").alias("mark"), "text")
    keyed = own.select("doc", "mark", F.explode(_windows("text")).alias("w")).select(*_key("w.window"), "doc", "mark", "w.start", "w.lines")
    twice = keyed.groupBy("k1", "k2").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("k1", "k2")
    maybe = keyed.join(twice, ["k1", "k2"]).groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "lines")).alias("spans"))
    cut = "struct(s.start AS start, array_join(slice(l, s.start + 1, s.lines), '\\n') AS window)"
    some = own.join(maybe, ["doc", "mark"]).withColumn("w", F.expr(f"transform(array(split(text, '\\n', -1)), l -> transform(spans, s -> {cut}))[0]"))
    strings = some.select("doc", "mark", F.explode("w").alias("w")).select("doc", "mark", "w.start", "w.window")
    texts = strings.groupBy("window").agg(F.min(F.struct("doc", "mark", "start")).alias("first")).select(*_key("window"), "first")
    keys = texts.groupBy("k1", "k2").agg(F.min("first").alias("first"), F.count("*").alias("texts")).where(F.col("texts") == 1)
    found = keyed.join(keys.select("k1", "k2", "first"), ["k1", "k2"])
    below = (F.col("doc") == F.col("first.doc")) & (F.col("mark") == F.col("first.mark"))
    later = F.when(below, F.col("start") >= F.col("first.start") + F.col("lines")).otherwise(F.struct("doc", "mark") > F.struct("first.doc", "first.mark"))
    spans = found.where(later).groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "lines")).alias("spans"))
    lines = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["lines"] - 1)))
    return spans.select("doc", "mark", F.array_distinct(lines).alias("gone"))


def dedup_runs(docs: DataFrame, *, mean: int = MEAN, window: int = WINDOW) -> DataFrame:
    """As ``dedup_lines``, and every run of two or more lines with text that stands in an earlier row, or further up in
    the same one, goes as well. Of each line that goes, an earlier one with the same text stays somewhere."""
    names = [n for n in docs.columns if n not in ("n_lines", "n_removed")]
    own = docs.select(*(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)), F.col("text").alias("whole"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64("text").alias("mark"))
    removed = repeated(docs, mean=mean, window=window).join(repeated_windows(docs), ["doc", "mark"], "full")
    marked = own.join(removed, ["doc", "mark"], "left").withColumn("chunks", F.when(F.col("places").isNotNull(), _chunks("whole", mean, window)))
    cut = F.flatten(F.expr("transform(transform(places, p -> element_at(chunks, p + 1)), c -> sequence(c.start, c.start + c.lines - 1))"))
    none = F.array().cast("array<int>")
    marked = marked.withColumn("gone", F.array_union(F.coalesce(cut, none), F.coalesce("gone", none)))
    split = F.split("whole", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))  # by hash, in order
    some = F.size("gone") > 0
    out = marked.withColumn("lines", split).select(
        *(f"c{i}" for i in range(len(names))),
        F.when(F.col("whole").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        F.when(some, F.array_join(F.transform(left, lambda i: F.element_at("lines", i + 1)), "\n")).otherwise(F.col("whole")).alias("text"),
    )
    return out.select(*(F.col("text") if n == "text" else F.col(f"c{i}").alias(n) for i, n in enumerate(names)), "n_lines", "n_removed")


#: The same in DuckDB: lines with their rolling hash, chunks between boundaries, first occurrences by content.
ORACLE_CTE = f"""
line_rows AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, len(string_split(text, chr(10))) AS n
  FROM docs_in WHERE text IS NOT NULL
), line_hashes AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) % {MODULUS} AS h FROM line_rows
), line_ends AS (
  SELECT *, (i = n OR (coalesce(lag(h) OVER w, 0) * {BASE} + h) % {MODULUS} % {MEAN} = 0) AS ends FROM line_hashes
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), line_chunks AS (
  SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM line_ends
), chunks AS (
  SELECT doc_id, place, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS lines FROM line_chunks GROUP BY doc_id, place
), judged AS (
  SELECT *, lines > 1 AND regexp_matches(chunk, '[^ \\t\\n\\r\\f\\v]')
    AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, place) > 1 AS gone
  FROM chunks
), docs_out AS (
  SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text,
         CAST(sum(lines) AS BIGINT) AS n_lines, CAST(coalesce(sum(lines) FILTER (gone), 0) AS BIGINT) AS n_removed
  FROM judged GROUP BY doc_id
)"""

ORACLE_SQL = f"""WITH docs_in AS (SELECT doc_id, text FROM documents), {ORACLE_CTE}
SELECT d.doc_id, o.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN docs_out o USING (doc_id)"""

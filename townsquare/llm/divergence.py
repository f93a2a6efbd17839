"""Quality rules: how far a document's characters and words are from those of its language, in DataFrame functions only.

Two histograms are compared by Jensen-Shannon distance: the classes of the characters, and the most common words of the
language with one more bin for all other words. The references are sums over every document of a language. A text too short
for a histogram is not judged by it. Everything about one text is computed inside its row: no exchange carries texts, and the
only large exchange holds one count per task, language and word.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from townsquare.llm.common import stored

#: fixed values: word separators, symbols, words of a window
_BLANKS, _SYMBOLS, _SPAN = r"\x20\x09-\x0D", "#*$%&|<>", 5
#: character classes as the insides of regular expressions; the last class is what none of them holds
CLASSES = ["a-z", "A-Z", "0-9", _BLANKS, r".,;:!?'\"()\-", r"\x{80}-\x{24F}", r"\x{250}-\x{2FFF}", r"\x{3000}-\x{10FFFF}"]
#: marks cut from both ends of a word before it is looked up
_MARKS = ".,;:!?'\"()"


@dataclass(frozen=True)
class Rules:
    """``common`` words per language, of ``longest`` characters at most; a language with less than ``least_share`` of all
    words has no reference (so there are 1 / ``least_share`` at most). A text of ``least_chars`` characters is judged by its
    classes, one of ``least_words`` words by its words; a distance above the limit rejects it."""

    common: int = 100
    longest: int = 30
    least_share: float = 0.001
    least_chars: int = 200
    least_words: int = 50
    class_limit: float = 0.3
    word_limit: float = 0.55
    least_base_words: int = 10
    repeat_percent: int = 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a one-element array binds it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{_BLANKS}]+"), "")


def _repeated(w: Column) -> Column:
    """Words of ``w`` in windows that occur twice or more. Each word is hashed once, a window by its words' hashes. Where these repeat, windows are sorted by hash and compared word by
    word with their neighbours (two different windows of one text with the same 64-bit hash could hide a repeat)."""
    same = lambda x, y: (x["h"] == y["h"]) & F.forall(F.sequence(F.lit(0), F.lit(_SPAN - 1)), lambda k: F.get(w, x["i"] + k) == F.get(w, y["i"] + k))  # noqa: E731, E501
    starts = F.sequence(F.lit(0), F.size(w) - _SPAN)
    hashes = _let(F.transform(w, lambda x: F.xxhash64(x)), lambda own: F.transform(starts, lambda i: F.xxhash64(*(F.get(own, i + k) for k in range(_SPAN)))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: F.coalesce(same(x, F.get(s, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, k + 1)), F.lit(False)))
        gaps = lambda p: F.transform(p, lambda i, k: F.least(F.lit(_SPAN), F.coalesce(i - F.get(p, k - 1), F.lit(_SPAN))))
        return _let(F.sort_array(F.transform(twice, lambda x: x["i"])), lambda p: F.aggregate(gaps(p), F.lit(0).cast("long"), lambda n, g: n + g))

    none = F.lit(0).cast("long")

    def found(h: Column) -> Column:
        windows = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _let(F.sort_array(windows), covered)).otherwise(none)

    return F.when(F.size(w) > _SPAN, _let(hashes, found)).otherwise(none)


def _base(text: Column, w: Column) -> list[Column]:
    """Columns of a text that is not NULL, with words ``w``."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{_BLANKS}]"))
    return [
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, f"[^{_SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(w).alias("n_repeat_words"),
    ]


def classes(text: Column) -> Column:
    """Characters of each class, as an array. Each class is taken out of what the ones before it left."""

    def count(rest: Column, found: list[Column], left: list[str]) -> Column:
        size = F.length(rest).cast("long")
        if not left:
            return F.array(*found, size)
        return _let(F.regexp_replace(rest, f"[{left[0]}]+", ""), lambda x: count(x, [*found, size - F.length(x)], left[1:]))

    return count(text, [], CLASSES)


def _bare(word: Column) -> Column:
    """A word in lower case without the marks around it."""
    return F.btrim(F.lower(word), F.lit(_MARKS))


def _stripped(text: Column) -> Column:
    """A text without the marks around its words, but for words of marks alone. Each run of marks is read once."""
    marks = _MARKS.replace("(", r"\(").replace(")", r"\)")
    before, behind = f"(?<![^{_BLANKS}])[{marks}]++(?=[^{_BLANKS}])", f"(?<=[^{marks}{_BLANKS}])[{marks}]++(?![^{_BLANKS}])"
    return F.regexp_replace(text, f"(?=[{marks}])(?:{before}|{behind})", "")


def references(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """A row per language with a share of the words: ``lang``, ``chars`` (per class), ``words`` and ``times`` (the common ones),
    ``n_words`` (all). Counts are whole numbers, so they do not depend on the order of the rows. Documents without text or
    language give nothing."""
    own = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    each = own.select("lang", F.explode(F.split(_stripped(F.col("text")), f"[{_BLANKS}]+")).alias("word")).where("word <> ''")
    counted = stored(each.groupBy("lang", F.lower("word").alias("word")).agg(F.count("*").alias("n")), "word-counts")
    total = counted.groupBy("lang").agg(F.sum("n").alias("n_words"))
    by_count = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    eligible = counted.where((F.btrim("word", F.lit(_MARKS)) != "") & (F.length("word") <= rules.longest))
    top = eligible.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= rules.common)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    sizes = [F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
    chars = own.select("lang", classes(F.col("text")).alias("chars")).groupBy("lang").agg(F.array(*sizes).alias("chars"))
    share = F.col("n_words") >= rules.least_share * F.sum("n_words").over(Window.partitionBy(F.lit(1)))  # a row per language
    found = total.withColumn("enough", share).where("enough").join(listed, "lang").join(chars, "lang")
    return found.select("lang", "chars", F.col("top.word").alias("words"), F.col("top.n").alias("times"), "n_words")


def _term(p: Column, q: Column) -> Column:
    """What a bin adds to twice the divergence, in bits."""
    part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(F.lit(0.0))
    return part(p) + part(q)


def _sum(values: Column, kind: str) -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda a, x: a + x)


def _distance(twice: Column) -> Column:
    """Jensen-Shannon distance from twice the divergence; rounding never makes it less than 0."""
    return F.sqrt(F.greatest(twice / 2, F.lit(0.0)))


def _class_distance(own: Column, chars: Column) -> Column:
    terms = lambda n, m: F.zip_with(own, chars, lambda x, y: _term(x / n, y / m))
    return _let(_sum(own, "long"), lambda n: _let(_sum(chars, "long"), lambda m: _distance(_sum(terms(n, m), "double"))))


@dataclass(frozen=True)
class Lexicon:
    """The references as values of a plan. Common words of all languages are numbered by slot, a slot being the crc32 of a
    word modulo the number of slots, so that a word is looked up among the few words of its slot."""

    languages: Column  # chars, times (by number of the word; NULL where the language's list lacks it), listed, n_words
    slots: Column  # first number and words of each slot; NULL where a slot has none
    size: int

    @classmethod
    def of(cls, known: DataFrame) -> Lexicon:
        """1 / ``least_share`` rows at most, each of ``common`` words and ``longest`` characters at most."""
        rows = known.select("chars", "words", "times", "n_words").orderBy("lang").toArrow().to_pylist()
        distinct = {w for r in rows for w in r["words"]}
        size = 16 * max(1, len(distinct))
        slot = {w: zlib.crc32(w.encode()) % size for w in distinct}
        order = sorted(distinct, key=lambda w: (slot[w], w))
        slots: list[dict | None] = [None] * size
        for number, word in enumerate(order):
            own = slots[slot[word]] = slots[slot[word]] or {"first": number, "words": []}
            own["words"].append(word)
        languages = []
        for r in rows:
            times = dict(zip(r["words"], r["times"]))
            own = {"chars": r["chars"], "times": [times.get(w) for w in order], "listed": sum(r["times"]), "n_words": r["n_words"]}
            languages.append(own)
        kind = "array<struct<chars:array<bigint>,times:array<bigint>,listed:bigint,n_words:bigint>>"
        value = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
        return cls(value(languages, kind), value(slots, "array<struct<first:int,words:array<string>>>"), size)

    def number(self, slots: Column, word: Column) -> Column:
        """The number of a word, NULL for one that is not common."""
        slot = F.get(slots, (F.crc32(word.cast("binary")) % self.size).cast("int"))
        place = F.array_position(slot["words"], word)
        return F.when(place > 0, slot["first"] + place.cast("int") - 1)

    def histogram(self, w: Column) -> Column:
        """(number, n) of the common words of a list."""

        def runs(s: Column) -> Column:
            starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
            count = lambda e, i, k: (F.coalesce(F.get(e, k + 1), F.size(s)) - i).cast("long")
            return _let(starts, lambda e: F.transform(e, lambda i, k: F.struct(F.get(s, i).alias("word"), count(e, i, k).alias("n"))))

        found = _let(self.slots, lambda slots: F.filter(F.transform(w, lambda x: self.number(slots, x)), lambda x: x.isNotNull()))
        none = F.array().cast("array<struct<word:int,n:bigint>>")
        return _let(F.sort_array(found), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none))


def _word_distance(histogram: Column, n: Column, r: Column) -> Column:
    """Bins: each common word of the language, and all other words. A bin that the text lacks adds its whole share."""
    own = F.transform(histogram, lambda h: F.struct(h["n"].alias("n"), F.get(r["times"], h["word"]).alias("m")))

    def twice(hit: Column) -> Column:
        mine, theirs = (_sum(F.transform(hit, lambda x: x[c]), "long") for c in ("n", "m"))
        shared = _sum(F.transform(hit, lambda x: _term(x["n"] / n, x["m"] / r["n_words"])), "double")
        return shared + _term(1 - mine / n, 1 - r["listed"] / r["n_words"]) + (r["listed"] - theirs) / r["n_words"]

    return _distance(_let(F.filter(own, lambda x: x["m"].isNotNull()), twice))


def judge(docs: DataFrame, known: DataFrame | None = None, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``class_distance``, ``word_distance`` and ``kept``; columns of these names are replaced.

    ``known`` are references (made from ``docs`` where none are given). The distance is that to the nearest language, so a
    document whose language is NULL or wrong is judged like any other; it is NULL for a text below the guard and where
    there are no references, and does not reject then. A NULL text counts as one without words. Repeated rows count as
    often as they occur and are judged alike; NULL ids do not matter.
    """
    known = stored(references(docs, rules) if known is None else known, "references")
    lexicon = Lexicon.of(known)
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept"]
    names = [n for n in docs.columns if n not in results]
    kept = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]
    plain = [f"c{i}" for i in range(len(names))]
    text = F.coalesce(F.col(f"c{names.index('text')}"), F.lit(""))

    def nearest(enough: Column, distance: Callable[[Column], Column]) -> Column:
        return F.when(enough, _let(lexicon.languages, lambda r: F.array_min(F.transform(r, distance))))

    def of_words(w: Column) -> Column:
        n = F.size(w).cast("long")
        found = _let(lexicon.histogram(F.transform(w, _bare)), lambda h: nearest(n >= rules.least_words, lambda r: _word_distance(h, n, r)))
        return F.struct(*_base(text, w), found.alias("word_distance"))

    class_distance = _let(classes(text), lambda c: nearest(F.length(text) >= rules.least_chars, lambda r: _class_distance(c, r["chars"])))
    own = docs.select(*kept).withColumn("own", _let(words(text), of_words)).withColumn("class_distance", class_distance)
    own = own.select(*plain, *(F.col("own")[n].alias(n) for n in results[:5]), "class_distance", F.col("own")["word_distance"].alias("word_distance"))
    base_failed = (F.col("n_words") < rules.least_base_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    own = own.withColumn("base_failed", base_failed)
    far = F.coalesce(F.col("class_distance") > rules.class_limit, F.lit(False)) | F.coalesce(F.col("word_distance") > rules.word_limit, F.lit(False))
    return own.select(*(F.col(c).alias(n) for c, n in zip(plain, names)), *results[:-1], (~F.col("base_failed") & ~far).alias("kept"))


def report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The counts and verdicts of every document."""
    found = judge(docs.select("doc_id", "text", "lang"), None, rules)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def oracle_sql(rules: Rules = Rules()) -> str:
    """The same with one row per word and window."""
    insides = [c.replace("'", "''") for c in CLASSES]
    count = ", ".join(f"length(regexp_replace(t, '[^{c}]+', '', 'g'))" for c in insides)
    marks = _MARKS.replace("'", "''")
    term = lambda p, q: f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"  # noqa: E731, E501
    split = lambda t: f"regexp_extract_all({t}, '[^{_BLANKS}]+')"
    k = len(CLASSES) + 1
    return rf"""
WITH t0 AS (SELECT row_number() OVER () AS r, doc_id, lang, text, coalesce(text, '') AS t FROM documents),
t1 AS (SELECT *, {split("t")} AS w, [{count}] AS c0 FROM t0),
d AS MATERIALIZED (
  SELECT *, list_transform({split("lower(t)")}, lambda x: trim(x, '{marks}')) AS bare, list_append(c0, length(t) - CAST(list_sum(c0) AS BIGINT)) AS c,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_BLANKS}]')) AS lines FROM t1
), win AS (
  SELECT r, unnest(range(len(w) - {_SPAN - 1})) AS i, unnest(list_transform(range(len(w) - {_SPAN - 1}), lambda i: array_to_string(w[i + 1:i + {_SPAN}], ' '))) AS g
  FROM d WHERE len(w) >= {_SPAN}
), twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {_SPAN})) AS p FROM twice) GROUP BY r),
counted AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(bare) AS word FROM d WHERE text IS NOT NULL AND lang IS NOT NULL) GROUP BY ALL),
total AS (SELECT lang, sum(n) AS m FROM counted GROUP BY lang QUALIFY sum(n) >= {rules.least_share} * sum(sum(n)) OVER ()),
top AS (
  SELECT lang, word, n FROM counted WHERE word <> '' AND length(word) <= {rules.longest}
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {rules.common}
), ref AS (SELECT lang, m, (SELECT sum(n) FROM top x WHERE x.lang = y.lang) AS listed FROM total y WHERE lang IN (SELECT lang FROM top)),
refc AS (
  SELECT lang, i, sum(c[i]) AS y FROM d, range(1, {k + 1}) q(i) WHERE text IS NOT NULL AND lang IN (SELECT lang FROM ref) GROUP BY lang, i
), refn AS (SELECT lang, i, y, sum(y) OVER (PARTITION BY lang) AS m FROM refc),
cd AS (
  SELECT r, min(dist) AS class_distance FROM (
    SELECT r, lang, sqrt(greatest(sum({term("p", "q")}) / 2, 0)) AS dist
    FROM (SELECT d.r, x.lang, CAST(d.c[x.i] AS DOUBLE) / length(t) AS p, CAST(x.y AS DOUBLE) / x.m AS q FROM d, refn x WHERE length(t) >= {rules.least_chars})
    GROUP BY r, lang) GROUP BY r
), hist AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(bare) AS word FROM d WHERE len(w) >= {rules.least_words}) GROUP BY ALL),
hit AS (
  SELECT h.r, t.lang, sum(h.n) AS mine, sum(t.n) AS theirs, sum({term("(CAST(h.n AS DOUBLE) / len(w))", "(CAST(t.n AS DOUBLE) / m)")}) AS shared
  FROM hist h JOIN top t USING (word) JOIN total USING (lang) JOIN d ON d.r = h.r GROUP BY h.r, t.lang
), wd AS (
  SELECT r, min(dist) AS word_distance FROM (
    SELECT d.r, sqrt(greatest((coalesce(shared, 0) + {term("(1 - CAST(coalesce(mine, 0) AS DOUBLE) / len(w))", "(1 - CAST(listed AS DOUBLE) / m)")}
                               + CAST(listed - coalesce(theirs, 0) AS DOUBLE) / m) / 2, 0)) AS dist
    FROM d CROSS JOIN ref LEFT JOIN hit ON hit.r = d.r AND hit.lang = ref.lang WHERE len(w) >= {rules.least_words}) GROUP BY r
), base AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^{_SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)
), judged AS (SELECT *, n_words < {rules.least_base_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(class_distance > {rules.class_limit}, false) AND NOT coalesce(word_distance > {rules.word_limit}, false) AS kept
FROM judged LEFT JOIN cd USING (r) LEFT JOIN wd USING (r)
"""

"""Language identification by words first, then by ever shorter character n-grams.

A known word adds its log frequency in each language. A word that no language knows is scored by its longest known
character n-grams: five characters, else four, and so on down to one. The frequencies are counted in Spark over a bounded
sample of labelled documents, which bounds the model that is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from townsquare.llm.common import held_out

#: 0 is the whole word; otherwise the length of an n-gram of the word between marks.
WORD, LONGEST = 0, 5
_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    found = _LETTERS.findall(text.lower())
    return found if all(map(str.isalpha, found)) else [w for w in found if w.isalpha()]


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: by kind, the row of each known word or n-gram in ``scores``
    places: dict[int, dict[str, int]]
    scores: np.ndarray
    prior: np.ndarray

    def of_word(self, word: str) -> np.ndarray:
        """Log frequencies of a word, or the mean over its longest known n-grams; zeros if none is known."""
        place = self.places[WORD].get(word)
        if place is not None:
            return self.scores[place]
        for n in range(LONGEST, 0, -1):
            known = self.places[n]
            found = [known[g] for g in grams(word, n) if g in known]
            if found:
                return self.scores[found].mean(axis=0)
        return np.zeros(len(self.languages))


class Scorer:
    """Scores texts with a model; keeps the log frequencies of up to ``room`` words it has met as rows of a matrix."""

    def __init__(self, model: Model, room: int = 250_000) -> None:
        self.model, self.room = model, room
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.matrix = np.zeros((1024, len(self.model.languages)))

    def _learn(self, word: str) -> int:
        row = self.rows[word] = len(self.rows)
        if row == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[row] = self.model.of_word(word)
        return row

    def score(self, text: str | None) -> tuple[str, float]:
        found = words(text or "")
        if not found or not self.model.languages:
            return "und", 0.0
        if len(self.rows) > self.room:
            self._clear()
        for word in set(found).difference(self.rows):
            self._learn(word)
        rows = np.fromiter(map(self.rows.__getitem__, found), np.int64, len(found))
        total = self.model.prior + self.matrix[rows].sum(axis=0)
        total = np.exp(total - total.max())
        top = int(total.argmax())
        return self.model.languages[top], float(total[top] / total.sum())


def _count(flush: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            keys = list(counts)
            return pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([k[0] for k in keys], pa.string()),
                    "kind": pa.array([k[1] for k in keys], pa.int32()),
                    "gram": pa.array([k[2] for k in keys], pa.string()),
                    "n": pa.array([counts[k] for k in keys], pa.int64()),
                }
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, times in Counter(words(text or "")).items():
                    counts[lang, WORD, word] += times
                    for n in range(1, LONGEST + 1):
                        for g in grams(word, n):
                            counts[lang, n, g] += times
                if len(counts) > flush:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return count


def train(labelled: DataFrame, *, docs_per_language: int = 600) -> Model:
    """Fit on ``lang`` and ``text``; ``doc_id`` only helps to choose the sample.

    The bound is about ``docs_per_language`` documents per language (by the hash of id and text); the model holds every word
    and n-gram of these. NULL languages and texts are left out."""
    own = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    bounds = own.groupBy("lang").count().collect()  # one row per language
    if not bounds:
        return Model([], {n: {} for n in range(LONGEST + 1)}, np.zeros((0, 0)), np.zeros(0))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**31))
    below = F.lit(False)
    for row in bounds:
        share = min(1.0, docs_per_language / row["count"])
        below = below | ((F.col("lang") == row["lang"]) & (place < int(share * 2**31)))
    counted = own.where(below).select("lang", "text").mapInArrow(_count(300_000), "lang string, kind int, gram string, n long")
    table = counted.groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(r["lang"] for r in bounds)
    number = {lang: i for i, lang in enumerate(languages)}
    places: dict[int, dict[str, int]] = {n: {} for n in range(LONGEST + 1)}
    lang, kind, gram, n = (table.column(c).to_pylist() for c in ("lang", "kind", "gram", "n"))
    at = []
    total = 0
    for k, g in zip(kind, gram):
        place = places[k].get(g)
        if place is None:
            place = places[k][g] = total
            total += 1
        at.append(place)
    scores = np.zeros((total, len(languages)))
    scores[at, [number[x] for x in lang]] = n
    for k, known in places.items():
        own_rows = np.fromiter(known.values(), np.int64, len(known))
        part = scores[own_rows] + 0.5
        scores[own_rows] = np.log(part / part.sum(axis=0))
    return Model(languages, places, scores, np.zeros(len(languages)))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for every row. A text that is NULL or has no letter is ``und`` with score 0; a
    tie goes to the first language by name. Repeated rows are scored alike; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    """Fit on the folds that are not held out, predict every document."""
    model = train(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    found = identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

Words and runs of marks are hashed into a fixed number of slots, alone and with the next one; a word that repeats the one
before it is hashed as a repeat. Each partition of a bounded training sample runs the updates in order; after every round
the state is averaged over the partitions, which start the next round from it. Scores are sparse dot products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from townsquare.llm.common import fold, giving_back, held_out, slices, stored, texts

#: what a byte of a text is: 0 blank, 1 letter or digit, 2 mark. Bytes from 0x80 are letters.
_KIND = np.array([1 if b >= 128 or chr(b).isalnum() else 2 if 33 <= b <= 126 else 0 for b in range(256)], np.uint8)
_REPEAT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_UNIT = 2**24
_PRIME = 0x100000001B3
#: bytes of a word that are hashed for all words of a slice at a time; what is longer is hashed byte by byte
_AT_ONCE = 64
#: bytes of text whose words are hashed together
_SLICE = 1 << 18


def token_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit FNV-1a hashes of the runs of letters and digits, or of marks, of lower-cased text. No word is
    remembered, so a worker holds nothing that grows with the vocabulary."""
    text = np.frombuffer(data, np.uint8)
    kind = np.zeros(len(text) + 2, np.uint8)
    kind[1:-1] = _KIND[text]
    cut = np.flatnonzero(kind[1:] != kind[:-1])
    filled = kind[cut[:-1] + 1] > 0
    starts, sizes = cut[:-1][filled], np.diff(cut)[filled]
    order = np.argsort(-sizes, kind="stable")  # the words that have a byte at some place come first
    first, left = starts[order], -sizes[order]
    value = np.full(len(starts), 0xCBF29CE484222325, np.uint64)
    for place in range(min(_AT_ONCE, -int(left.min(initial=0)))):
        alive = np.searchsorted(left, -place)
        value[:alive] ^= text[first[:alive] + place]
        value[:alive] *= np.uint64(_PRIME)
    for i in range(np.searchsorted(left, -_AT_ONCE)):
        own = int(value[i])
        for byte in data[first[i] + _AT_ONCE : first[i] - left[i]]:
            own = (own ^ byte) * _PRIME & 0xFFFFFFFFFFFFFFFF
        value[i] = own
    hashes = np.empty_like(value)
    hashes[order] = value
    return starts, hashes


def features(data: list[bytes | None], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots of each text with their values, the vector being of length 1; empty for a text without words."""
    whole = b"\n".join(text or b"" for text in data).lower()
    starts, hashes = token_hashes(whole)
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(text or b"") + 1 for text in data)]))
    for start, end in zip(bounds[:-1], bounds[1:]):
        one = hashes[start:end]
        if not len(one):
            yield np.zeros(0, np.int64), np.zeros(0)
            continue
        repeat = np.append(False, one[1:] == one[:-1])
        one = np.where(repeat, _REPEAT, one)
        two = (one[:-1] * _MIX) ^ (one[1:] >> np.uint64(7)) ^ one[1:]
        slots = (np.concatenate([one, two]) * _MIX >> np.uint64(64 - bits)).astype(np.int64)
        slots, times = np.unique(slots, return_counts=True)
        values = np.sqrt(times)
        yield slots, values / np.sqrt((values**2).sum())


@dataclass
class Leader:
    """State of the updates: per slot the adjusted gradient sum ``z`` and the squared gradient sum ``n``."""

    z: np.ndarray
    n: np.ndarray
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02

    def weights(self, slots: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> float:
        """Update with one row; its log loss before the update."""
        w = self.weights(slots)
        score = sigmoid(float(w @ values))
        gradient = (score - label) * values
        sigma = (np.sqrt(self.n[slots] + gradient**2) - np.sqrt(self.n[slots])) / self.alpha
        self.z[slots] += gradient - sigma * w
        self.n[slots] += gradient**2
        return -float(np.log(score if label else 1 - score))


def sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-max(-35.0, min(35.0, x))))


@dataclass(frozen=True)
class Model:
    """Weights by slot; the last one is the constant term."""

    weights: np.ndarray
    bits: int


def train(
    labelled: DataFrame, *, bits: int = 18, rounds: int = 4, passes: int = 20, close: float = 0.02, parts: int = 4
) -> Model:
    """Fit on ``text`` and ``label`` (0 or 1; other values are left out, NULL text is empty).

    ``labelled`` must be a bounded sample (see ``sample``): each of ``parts`` tasks holds the features of its rows. In a round
    it reads them until a pass has a mean log loss below ``close`` (each row's before its own update), ``passes`` times at
    most. Nothing else depends on how many rows there are. The state has 2**bits + 1 slots. Its changes are added up as whole numbers of 2**-24, so that the order of the parts does not matter.
    An empty sample gives a model that scores 0.5.
    """
    rows = stored(labelled.where(F.col("label").isin(0, 1)).select("text", F.col("label").cast("int")), "quality-sample")
    size = 2**bits + 1
    z, n = np.zeros(size), np.zeros(size)
    count = rows.count()
    if not count:
        return Model(z, bits)
    part = F.pmod(F.xxhash64("text"), F.lit(parts))  # so many parts, however many partitions there are
    dealt = rows.withColumn("part", part).repartition(parts, "part").sortWithinPartitions("part", F.xxhash64("text", F.lit(1)), "label")
    for _ in range(rounds):
        start = rows.sparkSession.sparkContext.broadcast((z, n))

        def learn(batches, start=start):
            leader = Leader(*(x.copy() for x in start.value))
            examples = []
            for batch in slices(batches, "text", _SLICE):
                for (slots, values), label in zip(features(texts(batch, "text"), bits), batch.column("label").to_pylist()):
                    examples.append((np.append(slots, size - 1).astype(np.int32), np.append(values, 0.3).astype(np.float32), label))
            for _ in range(passes):
                if sum(leader.learn(*example) for example in examples) < close * len(examples):
                    break
            before = start.value
            slots = np.flatnonzero((leader.z != before[0]) | (leader.n != before[1]))
            change = [np.rint(len(examples) * _UNIT * (own[slots] - old[slots])).astype(np.int64) for own, old in zip((leader.z, leader.n), before)]
            yield pa.RecordBatch.from_arrays([pa.array(slots), *map(pa.array, change)], names=["slot", "z", "n"])

        states = dealt.mapInArrow(giving_back(learn), "slot long, z long, n long").groupBy("slot")
        mean = states.agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow()  # at most one row per slot
        slots = mean.column("slot").to_numpy()
        z[slots] += mean.column("z").to_numpy() / (_UNIT * count)
        n[slots] += mean.column("n").to_numpy() / (_UNIT * count)
        start.unpersist()
    return Model(Leader(z, n).weights(), bits)


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """``text`` and ``label`` of at most ``sample_rows`` labelled documents that are not held out: those whose label row
    has the smallest hash of its id. The bound makes the ids small enough to broadcast."""
    own = labels.where((fold() != 1) & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("label"))
    chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``, which replace columns of these names. Empty and NULL texts get
    the score of the constant term; repeated rows are scored alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")  # only texts go to Python, only scores come back
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from giving_back(run)(columns)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for column in columns:
            scores = []
            for batch in slices(iter([pa.RecordBatch.from_arrays([column], names=["text"])]), "text", _SLICE):
                for slots, values in features(texts(batch, "text"), model.bits):
                    scores.append(sigmoid(float(model.weights[slots] @ values) + 0.3 * float(model.weights[-1])))
            yield pa.array(scores, pa.float64())

    found = docs.drop("score", "predicted").withColumn("score", scored("text"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    return train(sample(docs, labels))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on labelled documents that are not held out, score every document."""
    found = score(docs.select("doc_id", "text"), fitted(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")

"""Near-duplicate documents: MinHash bands with sequential Bayesian verification.

Texts with equal words form a class; only one document of a class is compared. Bands of MinHash values put classes into
buckets. The smallest member of a bucket is compared with the others; this joins most groups of copies, however large. The
members of buckets that still hold several components are then split by shingles: linked sets share one of the rarest few
of each, at places that leave room for the overlap they need. Among those that share such a shingle, pivots are compared
with the members of other components, more of them each round, until all have been pivots or one component is left. No
link is missed and no pair inside a component is emitted.

A candidate pair compares its signatures batch by batch and is dropped once the posterior probability of reaching the
threshold falls below the miss probability; survivors are compared on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from townsquare.llm.common import giving_back, slices, spaced_words, stored, stored_small, texts


#: rows with whole texts that pass between Spark and a Python worker at a time
_BATCH = 1_000


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``width`` words, linked from ``percent`` of the union on; ``bands`` times ``rows`` MinHash values.

    A pair at the threshold shares no band with probability (1 - 0.8 ** 6) ** 40 = 5e-6 at the defaults.
    """

    width: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    batch: int = 24
    miss: float = 1e-6

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def least_matches(self) -> list[tuple[int, int]]:
        """(values compared, least matches to go on): below it the posterior probability of the threshold, from a uniform
        prior, is under ``miss``. One byte of each value is kept, so unequal values match once in 256."""
        grid = (np.arange(20_000) + 0.5) / 20_000
        match = grid + (1 - grid) / 256
        above = grid >= self.percent / 100
        out = []
        for n in range(self.batch, self.hashes + 1, self.batch):
            least = 0
            for m in range(n + 1):
                log = m * np.log(match) + (n - m) * np.log1p(-match)
                mass = np.exp(log - log.max())
                if mass[above].sum() / mass.sum() >= self.miss:
                    break
                least = m + 1
            out.append((n, least))
        return out


def shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``width`` words; fewer words are one shingle, none give the empty set."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width))))


class Sketcher:
    """MinHash values of many texts at a time."""

    def __init__(self, how: Similarity, room: int = 20_000) -> None:
        self.how, self.room, self.known = how, room, {}
        random = np.random.default_rng(20_240_601)
        self.factors = random.integers(0, 2**32, how.hashes, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.terms = random.integers(0, 2**32, how.hashes, dtype=np.uint64).astype(np.uint32)

    def _hash(self, word: bytes) -> int:
        if len(self.known) >= self.room:
            self.known.clear()
        value = self.known[word] = xxhash.xxh64_intdigest(word) | 1
        return value

    def names(self, words: list[bytes]) -> np.ndarray:
        """64-bit names of a text's shingles, repeated ones included."""
        get, own = self.known.get, self._hash
        one = np.fromiter((get(w) or own(w) for w in words), np.uint64, len(words))
        width = min(self.how.width, len(one))
        if not width:
            return one
        name = one[: len(one) - width + 1].copy()
        for i in range(1, width):
            name = (name ^ (name >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[i : len(one) - width + 1 + i]
        name = (name ^ (name >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return name ^ (name >> np.uint64(31)) ^ np.uint64(width)

    def sketch(self, data: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Set sizes, band keys (texts x bands) and signatures (texts x hashes, one byte each)."""
        names = [self.names(w) for w in data]
        sizes = np.array([len(np.unique(x)) for x in names], np.int64)
        filled = np.flatnonzero(sizes)
        values = np.full((len(data), self.how.hashes), 0, np.uint32)
        if len(filled):
            whole = np.concatenate([names[i] for i in filled])
            low = (whole >> np.uint64(32)).astype(np.uint32)
            starts = np.cumsum([0, *(len(names[i]) for i in filled[:-1])])
            for j in range(self.how.hashes):
                values[filled, j] = np.minimum.reduceat(low * self.factors[j] + self.terms[j], starts)
        keys = np.zeros((len(data), self.how.bands), np.uint64)
        wide = values.astype(np.uint64).reshape(len(data), self.how.bands, self.how.rows)
        keys += np.arange(1, self.how.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(self.how.rows):
            keys = (keys ^ wide[:, :, r]) * np.uint64(0xFF51AFD7ED558CCD)
            keys ^= keys >> np.uint64(33)
        # the low bits of a least value are no longer even, so spread them before a byte is kept
        mixed = values * np.uint32(0x85EBCA6B)
        return sizes, keys.view(np.int64), (mixed ^ (mixed >> np.uint32(15))).astype(np.uint32) >> np.uint32(24)


_SKETCH = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, signature binary"


def _sketch(how: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(how)
        for batch in slices(batches, "text", 1 << 20):
            data = [spaced_words(t or b"", lower=True) for t in texts(batch, "text")]
            sizes, keys, signatures = sketcher.sketch(data)
            digests = [np.frombuffer(blake2b(b" ".join(w), digest_size=16).digest(), np.int64) for w in data]
            offsets = pa.array(np.arange(len(data) + 1, dtype=np.int32) * how.bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array([int(d[0]) for d in digests], pa.int64()),
                    pa.array([int(d[1]) for d in digests], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1))),
                    pa.array([s.astype(np.uint8).tobytes() for s in signatures], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "signature"],
            )

    return run


def promising(pairs: DataFrame, sketches: DataFrame, how: Similarity) -> DataFrame:
    """Pairs ``a``, ``b`` whose signatures do not rule the threshold out."""
    own = sketches.select("doc_id", "signature")
    both = pairs.join(own.toDF("b", "sb"), "b").join(own.toDF("a", "sa"), "a").select("a", "b", "sa", "sb")
    steps = how.least_matches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, how.hashes) for i in (2, 3)
            )
            alive, matches, start = np.arange(len(left)), np.zeros(len(left), np.int64), 0
            for end, least in steps:
                matches[alive] += (left[alive, start:end] == right[alive, start:end]).sum(axis=1)
                alive, start = alive[matches[alive] >= least], end
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(alive)), batch.column(1).take(pa.array(alive))], names=["a", "b"])

    return both.mapInArrow(giving_back(run), "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, how: Similarity) -> DataFrame:
    """Pairs with their verdict ``linked`` from the full sets."""
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    both = pairs.join(own.toDF("b", "tb"), "b").join(own.toDF("a", "ta"), "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, last, ours = [], None, set()
            for ta, tb in zip(batch.column(2), batch.column(3)):
                ta, tb = ta.as_py() or b"", tb.as_py() or b""
                if ta != last:
                    last, ours = ta, shingles(spaced_words(ta, lower=True), how.width)
                theirs = shingles(spaced_words(tb, lower=True), how.width)
                common = len(ours & theirs)
                out.append(common > 0 and 100 * common >= how.percent * (len(ours) + len(theirs) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.bool_())], names=["a", "b", "linked"])

    return both.mapInArrow(giving_back(run), "a long, b long, linked boolean")


def components(nodes: DataFrame, edges: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """``node``, ``component`` for all ``nodes`` (``node``, ``component`` so far), joined along ``edges`` (``a``, ``b``).

    Every component takes the smallest label among itself and its neighbours, follows that label once more, and edges
    inside a component vanish; the remaining edges shrink at least by half each time. ``edges`` are read once, in a write
    with ``batch_rows``.
    """
    left = nodes.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = nodes.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    open_ = edges.join(left, "a").join(right, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    open_ = stored(open_.where("a <> b").distinct(), "edges", batch_rows)
    while not open_.isEmpty():
        both = open_.union(open_.select("b", "a"))
        parent = both.groupBy("a").agg(F.least("a", F.min("b")).alias("p"))
        over = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jumped = stored(parent.join(over, "p", "left").select("a", F.coalesce("pp", "p").alias("p")), "parents")
        nodes = nodes.join(jumped.toDF("component", "p"), "component", "left")
        nodes = nodes.select("node", F.coalesce("p", "component").alias("component"))
        moved = open_.join(jumped.toDF("a", "pa"), "a").join(jumped.toDF("b", "pb"), "b")
        open_ = stored(moved.select(F.col("pa").alias("a"), F.col("pb").alias("b")).where("a <> b").distinct(), "edges")
    return stored(nodes, "labels")


def spread(members: DataFrame, key: str) -> DataFrame:
    """Keys whose members (with ``component``) lie in several components."""
    ends = members.groupBy(key).agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return ends.where("x < y").select(key)


def rare_shingles(nodes: DataFrame, docs: DataFrame, how: Similarity) -> DataFrame:
    """``shingle``, ``node``, ``size``, ``most``: for every node its rarest shingles.

    Shingles are ordered by the number of these nodes that have them. If two linked sets share their first common
    shingle at place i of one, the overlap is at most size - i, which allows partners of up to ``most`` shingles. Rows
    that allow no partner of ``percent`` of the own size are left out; two linked sets both have a row for that shingle,
    and the smaller one's allows partners of its own size or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(how)
        for batch in slices(batches, "text", 1 << 20):
            names = [np.unique(sketcher.names(spaced_words(t or b"", lower=True))) for t in texts(batch, "text")]
            sizes = np.array([len(x) for x in names], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), sizes)),
                    pa.array(np.repeat(sizes, sizes)),
                    pa.array(np.concatenate(names).view(np.int64)),
                ],
                names=["node", "size", "shingle"],
            )

    own = docs.join(nodes.select(F.col("node").alias("doc_id")), "doc_id").select("doc_id", "text")
    rows = stored(own.mapInArrow(giving_back(run), "node long, size long, shingle long"), "shingles", _BATCH)
    order = Window.partitionBy("node", "size").orderBy("n", "shingle")
    placed = rows.join(rows.groupBy("shingle").agg(F.count("*").alias("n")), "shingle")
    placed = placed.withColumn("i", F.row_number().over(order) - 1)
    # 100 * (size - i) >= percent / (100 + percent) * 100 * (size + partner), solved for the partner
    most = F.floor((F.lit(100 + how.percent) * (F.col("size") - F.col("i")) - how.percent * F.col("size")) / how.percent)
    placed = placed.withColumn("most", most).where(F.col("most") * 100 >= how.percent * F.col("size"))
    return placed.select("shingle", "node", "size", "most")


def near_duplicates(docs: DataFrame, how: Similarity = Similarity()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``.

    Words are runs of other than blanks, A-Z lower-cased. A text without words, a NULL text and a row without an id are
    linked with nothing and kept. ``component_id`` is the smallest id reachable over links; ``kept`` marks that document.
    Repeated rows are judged alike; classes that share their smallest id count as one. Other columns are not read.
    """
    sketches = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(_sketch(how)), _SKETCH), "sketches", _BATCH)
    filled = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"))
    first = filled.select("d1", "d2", "doc_id", "bands").join(classes, ["d1", "d2"]).where(F.col("doc_id") == F.col("node"))
    banded = first.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = stored_small(banded.join(shared.select("bucket", "low"), "bucket"), "members")
    labels = stored(members.select("node").distinct().withColumn("component", F.col("node")), "labels")
    own = labels.select(F.col("node").alias("doc_id"))
    kept_texts = docs.select(F.col("doc_id").cast("long"), "text").join(own, "doc_id", "left_semi")
    kept_texts = stored(kept_texts.distinct(), "texts")  # repeated rows once
    signatures = stored(sketches.select("doc_id", "signature").join(own, "doc_id", "left_semi").distinct(), "signatures")

    def join_up(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        alive = promising(stored(pairs.distinct(), "pairs"), signatures, how)
        linked = verified(stored_small(alive, "promising"), kept_texts, how).where("linked").select("a", "b")
        return components(labels, linked, _BATCH)

    labels = join_up(members.where("low < node").select(F.col("low").alias("a"), F.col("node").alias("b")), labels)

    left = members.select("bucket", "node").join(labels, "node")
    nodes = stored(left.join(spread(left, "bucket"), "bucket").select("node").distinct(), "open")
    if not nodes.isEmpty():
        rare = rare_shingles(nodes, kept_texts, how).join(labels, "node")
        rare = stored_small(rare.join(spread(rare, "shingle"), "shingle").drop("component"), "rare")
        pivots = rare.where("most >= size").toDF("shingle", "a", "sa", "ma")
        # about as many pivots of a shingle have ranks up to r as if they were numbered, but no group is gathered for it
        chance = F.pmod(F.xxhash64("shingle", "a"), F.lit(2**31)) / 2**31
        counted = pivots.join(pivots.groupBy("shingle").agg(F.count("*").alias("n")), "shingle")
        pivots = stored(counted.select("shingle", "a", "sa", "ma", (1 + F.floor(chance * F.col("n"))).alias("rank")), "pivots")
        low, high, last = 0, 8, pivots.agg(F.max("rank")).first()[0] or 0
        while low < last:
            now = pivots.where((F.col("rank") > low) & (F.col("rank") <= high)).join(labels.toDF("a", "ca"), "a")
            met = now.join(rare.join(labels, "node"), "shingle").where("component <> ca and size <= ma and sa <= most")
            met = met.where("sa < size or sa = size and a < node")
            labels = join_up(met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")), labels)
            low, high = high, high * 16

    joined = sketches.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"], "left")
    joined = joined.join(labels, "node", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "node"))
    out = joined.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

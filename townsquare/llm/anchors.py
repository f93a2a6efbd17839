"""Codes of vectors by parts (product quantisation), with an anchors hierarchy over each part.

Rows are cut into tiles inside the scan tasks. Over each part of a tile stands a tree of balls, built from the middle: anchors
are added one by one, each the point farthest from its anchor so far, and steal the points nearer to them; pairs of balls
whose union is smallest are merged up to one root, and every anchor is split further in the same way. A ball caches its
centre, radius, and the sums and count of its points.

A round of the codebook's refinement walks the trees from the root. A ball inherits the entries that may own points of its
parent, and drops those that lie farther from all its points than its centre's nearest one; once one entry is left, the
ball's cached sums go to it whole. Points of leaves are compared with the entries left there. What a round brings to the
driver is one sum per part, entry and component, which the codebook's size bounds.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from townsquare.llm.common import stored

PARTS, ENTRIES, SCALE, ROUNDS = 4, 256, 1024, 4
#: whole components below this keep every squared distance and sum of a tile exact in 64-bit numbers
_RANGE = 1 << 24


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=-1, dtype=np.float64))


@dataclass
class Tree:
    """Balls as arrays. Points are in ``order``, so that a ball is a range of it; children are ranges of balls."""

    order: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    sums: np.ndarray
    left: np.ndarray  # -1: a leaf
    right: np.ndarray

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as found:
            return cls(**found)


def anchor_sets(points: np.ndarray, count: int) -> list[np.ndarray]:
    """At most ``count`` sets of point numbers, each around an anchor. Every set keeps its distances in falling order: a new
    anchor at distance d from an old one can steal no point nearer than d / 2 to that."""
    centres = [points[0]]
    away = _distances(points, points[0])
    order = np.argsort(-away, kind="stable")
    owned, far = [order], [away[order]]
    while len(centres) < count:
        widest = max(range(len(owned)), key=lambda i: far[i][0])
        if far[widest][0] == 0:
            break
        new = points[owned[widest][0]]
        apart = _distances(np.asarray(centres), new)
        taken, taken_far = [], []
        for i in range(len(centres)):
            reach = int(np.searchsorted(-far[i], -apart[i] / 2, side="right"))
            if not reach:
                continue
            to_new = _distances(points[owned[i][:reach]], new)
            steal = np.flatnonzero(to_new < far[i][:reach])
            if len(steal):
                taken.append(owned[i][steal])
                taken_far.append(to_new[steal])
                owned[i], far[i] = np.delete(owned[i], steal), np.delete(far[i], steal)
        rows, distances = np.concatenate(taken), np.concatenate(taken_far)
        order = np.argsort(-distances, kind="stable")
        centres.append(new)
        owned.append(rows[order])
        far.append(distances[order])
    return owned


def build(points: np.ndarray, leaf: int = 24) -> Tree:
    """The hierarchy over whole-number points, at least one."""
    balls: list[tuple] = []  # start, stop, centre, radius, sums, left, right
    order = np.empty(len(points), np.int64)
    wide = points.astype(np.float64)

    def ball(rows: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        sums = points[rows].sum(axis=0, dtype=np.int64)
        centre = sums / len(rows)
        return centre, float(_distances(wide[rows], centre).max()), sums

    def merged(sets: list[np.ndarray]) -> list:
        """Sets joined pairwise, smallest union first, to one nested list of (rows, children)."""
        nodes = [(rows, None, *ball(rows)[:2]) for rows in sets]
        while len(nodes) > 1:
            centres, radii = np.array([n[2] for n in nodes]), np.array([n[3] for n in nodes])
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
            size = np.maximum((apart + radii[:, None] + radii[None]) / 2, np.maximum(radii[:, None], radii[None]))
            size[np.tril_indices(len(nodes))] = np.inf
            # disjoint pairs of the smallest unions are joined at once, half of the balls at most
            used, joined = np.zeros(len(nodes), bool), []
            for flat in np.argsort(size, axis=None, kind="stable")[: 4 * len(nodes)]:
                i, j = divmod(int(flat), len(nodes))
                if i < j and not used[i] and not used[j]:
                    used[i] = used[j] = True
                    rows = np.concatenate([nodes[i][0], nodes[j][0]])
                    joined.append((rows, (nodes[i], nodes[j]), *ball(rows)[:2]))
                if 4 * len(joined) >= len(nodes):
                    break
            nodes = [n for n, u in zip(nodes, used) if not u] + joined
        return nodes[0]

    # a stack instead of recursion: (rows or merged node, start, place in the parent)
    stack: list[tuple] = [((np.arange(len(points)), None), 0, None)]
    while stack:
        node, start, parent = stack.pop()
        rows, children = node[0], node[1]
        centre, radius, sums = ball(rows)
        index = len(balls)
        balls.append([start, start + len(rows), centre, radius, sums, -1, -1])
        if parent is not None:
            balls[parent[0]][parent[1]] = index
        if children is None and len(rows) > leaf and radius > 0:
            sets = anchor_sets(wide[rows], max(2, int(np.sqrt(len(rows)))))
            if len(sets) > 1:
                children = merged([rows[s] for s in sets])[1]
        if children is None:
            order[start : start + len(rows)] = rows
        else:
            stack.append((children[0], start, (index, 5)))
            stack.append((children[1], start + len(children[0][0]), (index, 6)))
    start, stop, centre, radius, sums, left, right = (np.array(x) for x in zip(*balls))
    return Tree(order, start, stop, centre, radius, sums, left, right)


def first_of_equals(entries: np.ndarray) -> np.ndarray:
    """Which entries are the first with their components: the others never win a tie."""
    out = np.zeros(len(entries), bool)
    out[np.unique(entries, axis=0, return_index=True)[1]] = True
    return out


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number points and entries, a few points at a time."""
    out = np.empty((len(points), len(entries)), np.int64)
    step = max(1, (1 << 21) // max(1, entries.size))
    for at in range(0, len(points), step):
        apart = points[at : at + step, None, :].astype(np.int64) - entries[None]
        out[at : at + step] = (apart * apart).sum(axis=2)
    return out


def walk(tree: Tree, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None, int]]:
    """Level by level: (balls, their one owner, -1) for balls wholly owned, and (one leaf, its entries, 0) for the others."""
    apart = np.sqrt(((entries[:, None].astype(np.float64) - entries[None]) ** 2).sum(axis=2))
    level, left = np.zeros(1, np.int64), first_of_equals(entries)[None]
    while len(level):
        centre, radius = tree.centre[level], tree.radius[level]
        away = ((centre[:, None] - entries[None]) ** 2).sum(axis=2)
        away[~left] = np.inf
        owner = away.argmin(axis=1)
        nearest = away[np.arange(len(level)), owner]
        # all points of a ball are nearer to the owner if the plane between the two lies beyond the radius; the margin is
        # far above rounding, so a tie is never decided here
        margin = 2 * radius[:, None] * apart[owner] + 1e-6 * (1 + np.where(left, away, 0))
        kept = left & ~(away - nearest[:, None] > margin)
        kept[np.arange(len(level)), owner] = True
        whole = kept.sum(axis=1) == 1
        if whole.any():
            yield level[whole], owner[whole], -1
        ends = ~whole & (tree.left[level] < 0)
        for ball, own in zip(level[ends], kept[ends]):
            yield np.array([ball]), np.flatnonzero(own), 0
        inner = ~whole & ~ends
        level, left = np.concatenate([tree.left[level[inner]], tree.right[level[inner]]]), np.concatenate([kept[inner]] * 2)


def assign(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of every point, ties to the lower index."""
    out = np.empty(len(points), np.int64)
    for balls, owners, leaf in walk(tree, entries):
        if leaf < 0:
            for ball, owner in zip(balls, owners):
                out[tree.order[tree.start[ball] : tree.stop[ball]]] = owner
        else:
            rows = tree.order[tree.start[balls[0]] : tree.stop[balls[0]]]
            out[rows] = owners[squared(points[rows], entries[owners]).argmin(axis=1)]
    return out


def gather(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the points each entry owns; a wholly owned ball gives its cached ones."""
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    for balls, owners, leaf in walk(tree, entries):
        if leaf < 0:
            np.add.at(sums, owners, tree.sums[balls])
            np.add.at(counts, owners, (tree.stop - tree.start)[balls])
        else:
            rows = tree.order[tree.start[balls[0]] : tree.stop[balls[0]]]
            own = owners[squared(points[rows], entries[owners]).argmin(axis=1)]
            np.add.at(sums, own, points[rows])
            np.add.at(counts, own, 1)
    return sums, counts


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id``, ``label`` and ``point``: floor(scale * x) of every component, without the rows that have none."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", bad)
    kept = vectors.where(usable)
    too_large = F.exists("vector", lambda x: F.abs(x * scale) >= _RANGE)
    point = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    checked = F.when(too_large, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(point)
    return kept.select("vec_id", "label", checked.alias("point"))


def _tiles(points: DataFrame, parts: int, tile_bytes: int) -> DataFrame:
    """One row per tile: its ids, labels and points, and a tree per part."""
    label_type = points.schema["label"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                width = max(1, len(batch.column("point")[at]))
                take = max(1, min(batch.num_rows - at, tile_bytes // (4 * width) - size))
                held.append(batch.slice(at, take))
                size, at = size + take, at + take
                if size * 4 * width >= tile_bytes:
                    yield tile(held)
                    held, size = [], 0
        if held:
            yield tile(held)

    def tile(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        points = rows.column("point").combine_chunks()
        lengths = np.unique(points.value_lengths().to_numpy())
        if len(lengths) != 1 or lengths[0] % parts:
            raise ValueError(f"vectors of {lengths.tolist()} components can't all be cut into {parts} equal parts")
        matrix = points.flatten().to_numpy().reshape(rows.num_rows, -1)
        trees = [build(p).dump() for p in np.split(matrix, parts, axis=1)]
        wrap = lambda column: pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), column.combine_chunks())
        columns = [wrap(rows.column("vec_id")), wrap(rows.column("label")), pa.array([matrix.tobytes()]), pa.array([trees], pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, names=["vec_ids", "labels", "points", "trees"])

    schema = f"vec_ids array<long>, labels array<{label_type.simpleString()}>, points binary, trees array<binary>"
    return points.mapInArrow(run, schema)


def _matrix(batch: pa.RecordBatch, row: int) -> np.ndarray:
    ids = len(batch.column("vec_ids")[row])
    return np.frombuffer(batch.column("points")[row].as_py(), np.int32).reshape(ids, -1)


def _round(tiles: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Sums and counts by part, entry and place (-1: the count); a task sends one row of each at most."""
    shared = tiles.sparkSession.sparkContext.broadcast(books)  # parts x entries x components, fixed by the codebook

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        total = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                trees = batch.column("trees")[row].as_py()
                for part, points in enumerate(np.split(_matrix(batch, row), len(books), axis=1)):
                    sums, counts = gather(Tree.load(trees[part]), points, books[part])
                    total[part] += np.column_stack([counts, sums])
        for part, own in enumerate(total):
            entry, place = np.nonzero(own)
            columns = [np.full(len(entry), part), entry, place - 1, own[entry, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "total"])

    found = tiles.mapInArrow(run, "part long, entry long, place long, total long")
    return found.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))


def fit(points: DataFrame, tiles: DataFrame, *, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """The codebooks: parts of the rows with the smallest ids, refined. An entry that owns nothing stays."""
    seeds = points.where(F.col("vec_id").isNotNull()).orderBy("vec_id", "point").limit(entries).select("point").toArrow()
    if not seeds.num_rows:
        return []
    start = np.array(seeds.column("point").to_pylist(), np.int64)
    books = np.split(start, parts, axis=1)
    for _ in range(rounds):
        found = _round(tiles, books).toArrow()  # parts x entries x (components + 1) rows at most
        part, entry, place, total = (found.column(c).to_numpy() for c in ("part", "entry", "place", "total"))
        for p, book in enumerate(books):
            table = np.zeros((len(book), book.shape[1] + 1), np.int64)
            own = part == p
            table[entry[own], place[own] + 1] = total[own]
            used = table[:, 0] > 0
            book[used] = table[used, 1:] // table[used, :1]
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def codes(tiles: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits per part) and ``error`` of every point of the tiles."""
    shared = tiles.sparkSession.sparkContext.broadcast(books)
    names = ["vec_id", "label", "code", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                matrix, trees = _matrix(batch, row), batch.column("trees")[row].as_py()
                error, own = np.zeros(len(matrix), np.int64), []
                for part, points in enumerate(np.split(matrix, len(books), axis=1)):
                    entry = assign(Tree.load(trees[part]), points, books[part])
                    own.append(entry)
                    error += ((points.astype(np.int64) - books[part][entry]) ** 2).sum(axis=1)
                code = ["".join(f"{x:02x}" for x in entry) for entry in zip(*(o.tolist() for o in own))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids")[row].values, batch.column("labels")[row].values, pa.array(code), pa.array(error)], names=names
                )

    label_type = tiles.schema["labels"].dataType.elementType.simpleString()
    return tiles.mapInArrow(run, f"vec_id long, label {label_type}, code string, error long")


def compress(
    vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE, rounds: int = ROUNDS, tile_bytes: int = 1 << 20
) -> DataFrame:
    """Codes of ``vectors`` (``vec_id``, ``vector``, ``label``): ``vec_id``, ``code``, ``error``, ``label_error`` (the error
    of all rows with this label, NULL labels being one) and ``codebooks_sha256``.

    Rows whose vector is NULL or empty or holds a NULL or a component that is not finite are left out. All others are coded,
    repeated rows and NULL ids too; only rows with an id begin codebooks, those of the smallest ids, ties by components.
    With fewer rows than ``entries`` a codebook is smaller. Vectors whose lengths differ or are no multiple of ``parts``,
    and components of 2**24 / ``scale`` and more, are errors. Other columns are not read; without rows there is no result.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits per part")
    points = stored(whole_numbers(vectors.select(F.col("vec_id").cast("long"), "label", "vector"), scale), "points")
    tiles = stored(_tiles(points, parts, tile_bytes), "tiles")
    books = fit(points, tiles, parts=parts, entries=entries, rounds=rounds)
    if not books:
        books = [np.zeros((1, 0), np.int64)] * parts if points.isEmpty() else _no_ids()
    found = stored(codes(tiles, books), "codes")
    totals = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "own")
    summed = found.join(totals, F.col("label").eqNullSafe(F.col("own")))
    return summed.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _no_ids() -> list[np.ndarray]:
    raise ValueError("no row has an id to begin the codebooks with")


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE, rounds: int = ROUNDS) -> str:
    """The same by comparing every part with every entry, the rounds written out one after the other."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT n, k, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d
  FROM (SELECT n, k, c.entry, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM p JOIN c{r} c USING (k)) GROUP BY n, k
)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
  SELECT k, entry, i, CAST(sum(v) AS BIGINT) AS total, count(*) AS m
  FROM (SELECT k, entry, unnest(x) AS v, unnest(range(len(x))) AS i FROM p JOIN a{r} USING (n, k)) GROUP BY k, entry, i
), c{r + 1} AS MATERIALIZED (
  SELECT k, entry, coalesce(y, c.x) AS x FROM c{r} c
  LEFT JOIN (SELECT k, entry, list((total - ((total % m) + m) % m) // m ORDER BY i) AS y FROM s{r} GROUP BY k, entry) USING (k, entry)
)""")
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT n, k, e[k * len(e) // {parts} + 1:(k + 1) * len(e) // {parts}] AS x FROM v, range({parts}) t(k)
), c0 AS (SELECT k, n - 1 AS entry, x FROM p WHERE n <= {entries}),
{", ".join(steps)},
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY k, entry)) AS codebooks_sha256 FROM c{rounds}),
coded AS (
  SELECT n, string_agg(printf('%02x', entry), '' ORDER BY k) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY n
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (n), books
"""

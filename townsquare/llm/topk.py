"""Exact top-k by inner product: tiled matrix products, partial selection per tile, tree merge of the lists.

Queries are read in blocks of bounded size; each block meets all vectors, tile by tile, inside the scan tasks. A task
keeps the best k of every query over its tiles, so it emits one list per query and block; the lists are merged in two
levels, first by query and task group, then by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from townsquare.llm.common import scratch

_FOUND = "block int, query int, part int, query_id long, vec_id long, score long"
_LONG = (-(2**63), 2**63 - 1)


def whole_numbers(ids: pa.Array, vectors: pa.Array, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and floor(scale * x) by dimension; rows with a NULL id or vector, or a NULL or non-finite component are left
    out (also one beyond the range of doubles once scaled). Whole numbers stay exact as doubles."""
    out: dict[int, list] = {}
    starts = vectors.offsets.to_numpy()
    flat = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    good = (ids.is_valid().to_numpy(zero_copy_only=False)) & (vectors.is_valid().to_numpy(zero_copy_only=False))
    ids = ids.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
    sizes = np.diff(starts)
    for size in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == size))
        with np.errstate(invalid="ignore"):
            matrix = np.floor(flat[starts[rows][:, None] + np.arange(size)] * scale)
        finite = np.isfinite(matrix).all(axis=1)
        out[int(size)] = (ids[rows][finite], matrix[finite])
    return out


def products(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Exact integer inner products. Doubles hold them exactly below 2**53; beyond it Python integers do the work and the
    score is held to the range of a long."""
    if not tile.size or not queries.size:
        return np.zeros((len(queries), len(tile)))
    if float(np.abs(queries).max()) * float(np.abs(tile).max()) * tile.shape[1] < 2**53:
        return (queries @ tile.T).astype(float)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object)
    return np.clip(whole(queries) @ whole(tile).T, *_LONG)


def best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of every query, ties to the smaller id, by query and rank."""
    order = np.lexsort((ids, -score, query))
    ordered = query[order]
    first = np.append(True, ordered[1:] != ordered[:-1])
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[rank < k]


def _search(block: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], number: int, k: int, scale: int, tile: int):
    """One list of at most k for every query of the block, from all vectors of a task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        least = {size: np.full(len(own), -np.inf) for size, (_, own, _) in block.items()}
        for batch in batches:
            for size, (ids, matrix) in whole_numbers(batch.column(0), batch.column(1), scale).items():
                if size not in block:
                    continue
                _, own, queries = block[size]
                for at in range(0, len(ids), tile):
                    there = ids[at : at + tile]
                    scores = products(queries, matrix[at : at + tile])
                    scores[own[:, None] == there[None, :]] = -np.inf
                    floor = least[size]
                    if len(there) > k:
                        floor = np.maximum(floor, np.partition(scores, len(there) - k, axis=1)[:, len(there) - k])
                    query, place = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
                    query, score, found = query, scores[query, place], there[place]
                    if size in kept:
                        old = kept[size]
                        query, score, found = (np.concatenate(x) for x in zip(old, (query, score, found)))
                    top = best(query, score, found, k)
                    kept[size] = query, score, found = query[top], score[top], found[top]
                    full = np.bincount(query, minlength=len(own)) >= k
                    last = np.searchsorted(query, np.flatnonzero(full), side="right") - 1
                    least[size][full] = score[last]
        part = TaskContext.get().partitionId()
        for size, (query, score, found) in kept.items():
            places, own, _ = block[size]
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(len(query), number, np.int32)),
                    "query": pa.array(places[query].astype(np.int32)),
                    "part": pa.array(np.full(len(query), part, np.int32)),
                    "query_id": pa.array(own[query]),
                    "vec_id": pa.array(found),
                    "score": pa.array([int(x) for x in score], pa.int64()),
                }
            )

    return search


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    scale: int = 256,
    block_rows: int = 16384,
    tile_rows: int = 2048,
    fan_in: int = 64,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best vectors of every query row, its own id excluded.

    Where the queries are more than one block of ``block_rows``, the lists of each block are written to the shared folder
    before the next block is read, so the driver and each task hold one block, and the plan does not grow.

    Both frames: id, then vector. Components become floor(scale * x); ties go to the smaller id. Rows with a NULL id or
    vector or a NULL or non-finite component take no part; vectors of another dimension than the query's are no
    candidates. A repeated query row gets a list of its own, a repeated vector row is listed as often as it occurs.
    """
    spark = vectors.sparkSession
    vectors, queries = (d.select(d[d.columns[0]].cast("long"), d[d.columns[1]].cast("array<double>")) for d in (vectors, queries))
    rows = queries.count()
    count = max(1, -(-rows // block_rows))
    names = ["id", "vector"]
    queries = queries.toDF(*names).withColumn("block", F.pmod(F.xxhash64(*names), F.lit(count)))
    found, folder = None, scratch(spark, "top-lists") if count > 1 else None
    for number in range(count):
        own = queries.where(F.col("block") == number).select(*names).toArrow().combine_chunks()
        if not len(own):
            continue
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in own.columns]
        block, place = {}, 0
        for size, (ids, matrix) in whole_numbers(*columns, scale).items():
            block[size] = np.arange(place, place + len(ids)), ids, matrix
            place += len(ids)
        found = vectors.mapInArrow(_search(block, number, k, scale, tile_rows), _FOUND)
        if folder:
            found.write.mode("append").parquet(folder)
            found = True
    result = "query_id long, rank int, vec_id long, score long"
    if found is None:
        return spark.createDataFrame([], result)
    if folder:
        found = spark.read.schema(_FOUND).parquet(folder)
    order = [F.col("score").desc(), "vec_id"]
    group = Window.partitionBy("block", "query", "part").orderBy(*order)
    merged = found.withColumn("part", (F.col("part") / fan_in).cast("int"))
    merged = merged.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= k)
    last = Window.partitionBy("block", "query").orderBy(*order)
    merged = merged.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")

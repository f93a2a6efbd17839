"""Benchmark decontamination by suffix arrays over the training text.

The documents are cut into shards inside the scan tasks. Each shard gets a suffix array over its words, every suffix of
every benchmark item is looked up in it by binary search, word by word, which yields the longest verbatim match and the
range of the array that matches an item window. The ranges are mapped back to documents.

A shard only holds runs of words that the benchmark knows and that are long enough for a window: no match can reach
across an unknown word. The benchmark is read in blocks of bounded size; each block is one more pass through the same
task, without an exchange, so neither side is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from townsquare.llm.common import giving_back, hashed_words, scratch, slices, texts

_STATE = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


@dataclass(frozen=True)
class Block:
    """Some benchmark items: their words as numbers, item after item, each closed by a 0."""

    vocabulary: dict[bytes, int]
    words: np.ndarray
    #: first position and length in words of every window, and the item it belongs to
    starts: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    items: list[str]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def block_of(items: list[tuple[str, bytes]], window: int) -> Block:
    """Number the words of some items. Items without words have no window."""
    vocabulary: dict[bytes, int] = {}
    words: list[int] = []
    starts, lengths, owners, names = [], [], [], []
    for name, text in items:
        found = hashed_words(text)
        if not found:
            continue
        size = min(window, len(found))
        first = np.arange(len(words), len(words) + len(found) - size + 1)
        starts.append(first)
        lengths.append(np.full(len(first), size))
        owners.append(np.full(len(first), len(names)))
        names.append(name)
        words += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in found] + [0]
    whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, lengths, owners)]
    return Block(vocabulary, np.array(words or [0], np.int32), *whole, names)


def known_runs(tokens: np.ndarray, doc: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of known words (number over 0) of one document, at least ``shortest`` long: their words, each run closed by a
    0, and the position of each in ``tokens`` (-1 at the closing 0)."""
    known = tokens > 0
    change = np.ones(len(tokens), bool)
    change[1:] = (known[1:] != known[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(change)
    size = np.diff(np.append(start, len(tokens)))
    keep = known[start] & (size >= max(1, shortest)) if len(start) else np.zeros(0, bool)
    start, size = start[keep], size[keep]
    closed = np.cumsum(size + 1) - 1
    place = np.full(int(size.sum()) + len(size), -1, np.int64)
    inside = np.ones(len(place), bool)
    inside[closed] = False
    place[inside] = np.arange(int(size.sum())) + np.repeat(start - np.append(0, np.cumsum(size)[:-1]), size)
    return np.where(inside, tokens[place], 0), place


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Positions of all words over 0, in the order of the suffixes that start there and end at the next 0.

    Prefix doubling; each round sorts only the suffixes that are still tied and have not ended.
    """
    array = np.flatnonzero(words)
    ends = np.flatnonzero(words == 0)
    left = np.zeros(len(words), np.int64)
    left[array] = ends[np.searchsorted(ends, array)] - array
    array = array[np.argsort(words[array], kind="stable")]
    rank = np.zeros(len(words), np.int64)

    def number(at: np.ndarray, head: np.ndarray) -> None:
        first = np.maximum.accumulate(np.where(head, at, -1))
        rank[array[at]] = first + 1

    keys = words[array]
    if len(array):
        number(np.arange(len(array)), np.append(True, keys[1:] != keys[:-1]))
    width = 1
    while len(array):
        ranks = rank[array]
        same = ranks[1:] == ranks[:-1]
        tied = (np.append(False, same) | np.append(same, False)) & (left[array] >= width)
        at = np.flatnonzero(tied)
        if not len(at):
            break
        place = array[at]
        first, second = rank[place], rank[place + width]
        order = np.lexsort((second, first))
        array[at] = place[order]
        first, second = first[order], second[order]
        number(at, np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        width *= 2
    return array


def _bound(words, array, low, high, depth, wanted):
    """First place in each range of the array whose word at ``depth`` is not below ``wanted``."""
    low, high = low.copy(), high.copy()
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        below = words[array[middle] + depth] < wanted[active]
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
        active = active[low[active] < high[active]]
    return low


def search(words: np.ndarray, array: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Binary-search every suffix of the block: longest match, one place of it, and the range of each window."""
    suffix = np.flatnonzero(block.words)
    longest, place = np.zeros(len(suffix), np.int64), np.full(len(suffix), -1, np.int64)
    window_of = np.full(len(block.words), -1, np.int64)
    window_of[block.starts] = np.arange(len(block.starts))
    from_, to = np.zeros(len(block.starts), np.int64), np.zeros(len(block.starts), np.int64)
    low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(array), np.int64)
    active, depth = np.arange(len(suffix)), 0
    while len(active):
        wanted = block.words[suffix[active] + depth]
        first = _bound(words, array, low[active], high[active], depth, wanted)
        after = _bound(words, array, first, high[active], depth, wanted + 1)
        found = (wanted > 0) & (after > first)
        active, low_, high_ = active[found], first[found], after[found]
        low[active], high[active] = low_, high_
        depth += 1
        longest[active], place[active] = depth, array[low_]
        window = window_of[suffix[active]]
        full = (window >= 0) & (block.lengths[window] == depth)
        from_[window[full]], to[window[full]] = low_[full], high_[full]
    return longest, place, from_, to


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def _shard(batch: pa.RecordBatch, text: str, block: Block):
    """The words of a slice of documents as numbers (0: unknown), their document, and words per document."""
    lookup = block.vocabulary.get
    numbers, counts = [], []
    for data in texts(batch, text):
        found = hashed_words(data or b"")
        counts.append(len(found))
        numbers.append(np.fromiter((lookup(w, 0) for w in found), np.int32, len(found)))
    counts = np.array(counts, np.int64)
    tokens = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
    return tokens, np.repeat(np.arange(len(counts)), counts), counts


def _scan(block: Block, text: str, shard_bytes: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, shard_bytes):
            tokens, doc, counts = _shard(batch, text, block)
            base = np.cumsum(counts) - counts
            words, place = known_runs(tokens, doc, block.shortest)
            array = suffix_array(words)
            _, _, low, high = search(words, array, block)
            spans = [[(s["start"], s["end"]) for s in x or []] for x in batch.column("spans").to_pylist()]
            items = [set(x or []) for x in batch.column("items").to_pylist()]
            mark = np.zeros(len(tokens) + 1, np.int64)
            for w in np.flatnonzero(high > low):
                at = place[array[low[w] : high[w]]]
                np.add.at(mark, at, 1)
                np.add.at(mark, at + block.lengths[w], -1)
                for d in np.unique(doc[at]):
                    items[d].add(block.items[block.owners[w]])
            hit = np.cumsum(mark)[:-1] > 0
            edge = np.ones(len(tokens) + 1, bool)
            edge[1:-1] = (hit[1:] != hit[:-1]) | (doc[1:] != doc[:-1])
            cuts = np.flatnonzero(edge)
            for start, end in zip(cuts[:-1], cuts[1:]):
                if hit[start]:
                    d = doc[start]
                    spans[d].append((int(start - base[d]), int(end - base[d])))
            named = [[{"start": s, "end": e} for s, e in _merged(x)] for x in spans]
            new = {
                "n_words": pa.array(counts),
                "spans": pa.array(named, batch.schema.field("spans").type),
                "items": pa.array([sorted(x) for x in items], batch.schema.field("items").type),
            }
            columns = [new.get(f.name, batch.column(f.name)) for f in batch.schema]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return scan


def blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes`` of text: the only part of it the driver holds at once."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_bytes)
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("item"), F.lit(count)) == k) if count > 1 else rows
        found = [(r["item"], bytes(r["text"])) for r in part.collect() if r["item"] is not None and r["text"]]
        if found:
            yield block_of(found, window)


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, window: int = 10, shard_bytes: int = 8 << 20, block_bytes: int = 16 << 20
) -> DataFrame:
    """Every row of ``docs`` (all its columns but clashing ones) with ``n_words``, ``spans`` and ``items``.

    ``spans``: merged word ranges that some item window matches verbatim; ``items``: names of the items with a matching
    window. A window is ``window`` consecutive item words; a shorter item is one window, an item without words none.
    NULL or empty text has no words. An item without an id is skipped. Where the benchmark is more than one block of
    ``block_bytes``, the hits of a block are written to the shared folder, by text, before the next block is searched; the
    driver and a task hold one block (the driver two while it reads the next). Columns of ``docs`` named like the three results
    are replaced; a repeated row is treated like any other.
    """
    return _flagged(docs.drop("n_words", "spans", "items"), "text", benchmark, window, shard_bytes, block_bytes)


def _flagged(kept: DataFrame, text: str, benchmark: DataFrame, window: int, shard_bytes: int, block_bytes: int) -> DataFrame:
    state = T._parse_datatype_string(_STATE)
    out = kept.select(
        "*", *(F.lit(0 if f.name == "n_words" else F.array()).cast(f.dataType).alias(f.name) for f in state)
    )
    schema = T.StructType([*kept.schema, *state])
    none = block_of([], window)
    earlier, last = None, none
    for number, block in enumerate(blocks(benchmark, window, block_bytes)):
        if number:
            earlier = earlier or scratch(kept.sparkSession, "benchmark-hits")
            _hits(kept, text, last, shard_bytes).write.mode("append").parquet(earlier)
        last = block
    if earlier:
        found = kept.sparkSession.read.parquet(earlier).groupBy("k1", "k2", "items").agg(F.first("spans").alias("spans"))
        found = found.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))
        names = [f"c{i}" for i in range(len(schema))]
        plain = out.toDF(*names)
        keyed = plain.drop(*names[-2:]).withColumns(dict(zip(["k1", "k2"], _text_key(names[kept.columns.index(text)]))))
        state = (F.coalesce(c, F.array().cast(schema[n].dataType)) for c, n in (("s", "spans"), ("i", "items")))
        out = keyed.join(found, ["k1", "k2"], "left").select(*names[:-2], *state).toDF(*schema.names)
    return out.mapInArrow(giving_back(_scan(last, text, shard_bytes)), schema)


def _text_key(text: str) -> list[Column]:
    return [F.xxhash64(F.col(f"`{text}`")).alias("k1"), F.xxhash64(F.lit("second"), F.col(f"`{text}`")).alias("k2")]


def _hits(docs: DataFrame, text: str, block: Block, shard_bytes: int) -> DataFrame:
    """Spans and items of one block by 128-bit hash of the text, for the texts that have any."""
    state = T._parse_datatype_string(_STATE)
    rows = docs.select(F.col(f"`{text}`").alias("text"), *(F.lit(0 if f.name == "n_words" else F.array()).cast(f.dataType).alias(f.name) for f in state))
    found = rows.mapInArrow(_scan(block, "text", shard_bytes), T.StructType([rows.schema["text"], *state]))
    return found.where(F.size("items") > 0).select(*_text_key("text"), "spans", "items")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, window: int = 10, shard_bytes: int = 4 << 20, block_bytes: int = 16 << 20
) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs; columns unchanged.

    All cases as in ``contamination``; clashing columns are kept here.
    """
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    flagged = _flagged(plain, f"c{names.index('text')}", benchmark, window, shard_bytes, block_bytes).where(F.size("items") == 0)
    return flagged.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, *, least: int = 10, shard_bytes: int = 8 << 20, block_bytes: int = 16 << 20
) -> DataFrame:
    """For every item suffix that some document matches over ``least`` words or more: the longest match and where.

    Returns ``item_id`` (string), ``item_word`` (position of the suffix), ``length`` in words, and ``doc_id``,
    ``doc_word`` of one longest match (the smallest such pair). Ties, NULLs and empty texts as in ``contamination``.
    """
    schema = "item_id string, item_word long, length long, doc_id long, doc_word long"
    folder, any_block = scratch(docs.sparkSession, "longest"), False
    for block in blocks(benchmark, least, block_bytes):
        suffix = np.flatnonzero(block.words)
        ends = np.flatnonzero(block.words == 0)
        item = np.searchsorted(ends, suffix)
        first = np.append(0, ends + 1)[item]

        def scan(batches, block=block, suffix=suffix, item=item, first=first):
            for batch in slices(batches, "text", shard_bytes):
                tokens, doc, counts = _shard(batch, "text", block)
                words, place = known_runs(tokens, doc, least)
                longest, at, _, _ = search(words, suffix_array(words), block)
                found = np.flatnonzero(longest >= least)
                where = place[at[found]]
                ids = batch.column("doc_id").to_pylist()
                base = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": pa.array([block.items[i] for i in item[found]], pa.string()),
                        "item_word": pa.array((suffix - first)[found], pa.int64()),
                        "length": pa.array(longest[found], pa.int64()),
                        "doc_id": pa.array([ids[d] for d in doc[where]], pa.int64()),
                        "doc_word": pa.array(where - base[doc[where]], pa.int64()),
                    }
                )

        docs.select("doc_id", "text").mapInArrow(scan, schema).write.mode("append").parquet(folder)
        any_block = True
    if not any_block:
        return docs.sparkSession.createDataFrame([], schema)
    found = docs.sparkSession.read.schema(schema).parquet(folder)
    best = F.min(F.struct((-F.col("length")).alias("short"), "doc_id", "doc_word")).alias("best")
    return (
        found.groupBy("item_id", "item_word")
        .agg(best)
        .select("item_id", "item_word", (-F.col("best.short")).alias("length"), "best.doc_id", "best.doc_word")
    )


def report(docs: DataFrame, benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """Per document: words, words hit, items with a hit window, digest of their names, verdict."""
    found = contamination(docs.select("doc_id", "text"), benchmark, window=window)
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
        "spans",
    )

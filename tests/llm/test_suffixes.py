import hashlib
import re

import numpy as np
import pytest

from townsquare.llm import suffixes

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for item, item_text in items:
            theirs = words(item_text)
            size = min(window, len(theirs))
            for s in range(len(theirs) - size + 1 if theirs else 0):
                for p in range(len(own) - size + 1):
                    if own[p : p + size] == theirs[s : s + size]:
                        hit.update(range(p, p + size))
                        names.add(str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id long")


def result(frame):
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [16 << 20, 300])
def test_equals_brute_force(spark, documents, corpus, block_bytes):
    docs = [(d, t.upper() if d % 3 else t) for d, t in corpus(1)]
    items = [(i, t) for i, (_, t) in enumerate(corpus(1)[::6])] + [(77, "w3"), (78, "W1-w2"), (79, ""), (80, None), (9, "none here")]
    docs += [(None, docs[0][1]), (5, None), (6, ""), (5, None), (7, "--- ..."), (8, "w3")]
    found = suffixes.contamination(documents(docs), benchmark(spark, items), shard_bytes=400, block_bytes=block_bytes)
    out = sorted(
        (
            r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["items"]),
            hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest(), bool(r["items"]),
        )
        for r in found.where("doc_id is not null").collect()
    )
    assert out == sorted(x for x in brute(docs, items, 10) if x[0] is not None)
    report = result(suffixes.report(documents(docs), benchmark(spark, items)))
    assert report == brute(docs, items, 10)


def test_removal_keeps_all_columns_and_clean_rows(spark, documents):
    text = " ".join(f"q{i}" for i in range(12))
    docs = documents([(1, "a " + text), (2, "clean"), (3, None), (2, "clean")])
    clean = suffixes.decontaminate(docs.withColumn("items", docs.doc_id), benchmark(spark, [(1, text)]))
    assert clean.columns == [*docs.columns, "items"]
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 2, 3]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(suffixes.report(documents([(1, "a b")]), none))[0][:4] == (1, 2, 0, 0)
    assert suffixes.report(documents([(1, "a")]).limit(0), benchmark(spark, [(1, "a")])).count() == 0


def test_longest_matches(spark, documents):
    item = " ".join(f"q{i}" for i in range(30))
    docs = documents([(1, "x " + " ".join(f"q{i}" for i in range(5, 20))), (2, " ".join(f"q{i}" for i in range(3, 18)))])
    found = {(r["item_word"]): (r["length"], r["doc_id"], r["doc_word"]) for r in suffixes.longest_matches(docs, benchmark(spark, [(4, item)])).collect()}
    assert found[3] == (15, 2, 0) and found[5] == (15, 1, 1) and found[10] == (10, 1, 6)
    assert set(found) == set(range(3, 11))


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    for size in (0, 1, 200):
        tokens = np.append(rng.integers(0, 3, size), 0).astype(np.int32)
        suffix = lambda p: tokens[p : p + int(np.flatnonzero(tokens[p:] == 0)[0])].tolist()  # noqa: B023, E731
        array = suffixes.suffix_array(tokens)
        assert sorted(array) == np.flatnonzero(tokens).tolist()
        listed = [suffix(p) for p in array]
        assert listed == sorted(listed)


def test_very_long_text(spark, documents):
    text = " ".join(f"v{i % 5000}" for i in range(200_000))
    item = " ".join(f"v{i}" for i in range(100, 112))
    row = suffixes.report(documents([(1, text)]), benchmark(spark, [(1, item)])).first()
    assert (row["n_words"], row["n_hit"]) == (200_000, 12 * 40)


def test_blocks_one_at_a_time(spark, documents, corpus):
    """Many blocks: the plan is that of two blocks, copies and clashing columns included, and no block outlives its pass."""
    import gc
    import weakref

    alive, most = [], []
    plain = suffixes.block_of

    def watched(rows, window):
        gc.collect()
        most.append(sum(x() is not None for x in alive))
        block = plain(rows, window)
        alive.append(weakref.ref(block))
        return block

    rows = [(d, t, "x") for d, t in corpus(1)] * 2 + [(None, None, "y"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 string")
    items = [(i, t) for i, (_, t) in enumerate(corpus(1)[::6])]
    suffixes.block_of = watched
    try:
        plans = []
        for size in (16 << 20, 300, 100):
            found = suffixes.contamination(docs, benchmark(spark, items), shard_bytes=400, block_bytes=size)
            plans.append(found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
            out = sorted((r["doc_id"] or -1, r["k1"], r["n_words"], str(r["spans"]), str(sorted(r["items"]))) for r in found.collect())
            expected = out if size == 16 << 20 else expected
            assert found.columns == ["doc_id", "text", "k1", "n_words", "spans", "items"] and out == expected
            assert suffixes.decontaminate(docs, benchmark(spark, items), block_bytes=size).count() == sum(x[4] == "[]" for x in out)
    finally:
        suffixes.block_of = plain
    assert set(plans) == {1} and len(most) > 10 and max(most) <= 3

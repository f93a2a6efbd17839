import hashlib
import re

import pytest

from townsquare.llm import recompress

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        if d is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s : s + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        gone = set()
        for s in range(len(w) - window + 1):
            if d is not None and first[tuple(w[s : s + window])] < d:
                gone.update(range(s, s + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(docs, window=13, **options):
    out = recompress.dedup_substrings(docs, window=window, **options)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("window", [2, 3, 5, 13, 20])
def test_equals_brute_force(documents, corpus, window):
    rows = corpus(7, count=70, words=12, length=70)
    rows += [(1, None), (2, ""), (3, "x " * 40), (4, "y " + "x " * 25), (5, "x " * 13 + "z " * 13), (6, "a b " * 30), (7, "b a " * 9)]
    rows += [(None, rows[0][1]), (8, rows[0][1]), (8, rows[0][1]), (9, " ".join("abcdefghijklm")), (10, " ".join("abcdefghijklm"))]
    assert found(documents(rows), window, shard_bytes=500, bucket_bytes=700) == brute(rows, window)


def test_text_is_what_is_left(documents):
    shared = " ".join(f"s{i}" for i in range(20))
    out = recompress.dedup_substrings(documents([(1, shared), (2, f"before\n{shared}\tafter")]), with_text=True)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: shared, 2: "before after"}


def test_empty_table_and_long_text(documents):
    assert found(documents([(1, "a")]).limit(0)) == []
    rows = [(1, " ".join(f"v{i}" for i in range(50_000))), (2, " ".join(f"v{i}" for i in range(40_000, 60_000)))]
    assert found(documents(rows)) == brute(rows, 13)


def test_windows_of_one_word_are_refused(documents):
    with pytest.raises(ValueError):
        found(documents([(1, "a")]), 1)

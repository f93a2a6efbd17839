import pyarrow as pa
import pytest

from townsquare.llm import common, neardup
from townsquare.llm.common import spaced_words


def brute(rows, width, percent=80):
    sets = {d: neardup.shingles(spaced_words((t or "").encode(), True), width) for d, t in rows if d is not None}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def found(docs, width, **options):
    out = neardup.near_duplicates(docs, neardup.Similarity(width=width, **options)).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out}


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force(documents, corpus, width):
    rows = corpus(2, count=90, length=80)
    rows += [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "a b c"), (7, "A b  c")]
    assert found(documents(rows), width) == brute(rows, width)


def test_chain_of_links_whose_ends_are_apart(documents):
    base = [f"w{i}" for i in range(100)]
    rows = [(50 - k, " ".join(base[4 * k : 60 + 4 * k])) for k in range(11)]
    expected = brute(rows, 2)
    assert {x[1] for x in expected.values()} == {40}
    assert found(documents(rows), 2) == expected


def test_one_large_group_of_near_copies(documents):
    """Copies of one text that each lack some words: many pairs of copies are not linked to the smallest one."""
    import random

    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(w for w in base if rng.random() > 0.04)) for i in range(200)]
    assert found(documents(rows), 2) == brute(rows, 2)


def test_rows_without_id_or_words_stand_alone(documents):
    rows = [(None, "a b c d"), (3, "a b c d"), (9, "a b c d"), (3, "a b c d"), (None, None), (8, "")]
    out = neardup.near_duplicates(documents(rows), neardup.Similarity(width=2)).collect()
    assert sorted((tuple(r) for r in out), key=repr) == sorted(
        [(None, 3, None, True), (3, 3, 3, True), (3, 3, 3, True), (9, 3, 3, False), (None, 0, None, True), (8, 0, 8, True)], key=repr
    )


def test_empty_table(documents):
    assert found(documents([(1, "a")]).limit(0), 2) == {}


def test_bounds_keep_pairs_at_the_threshold():
    for n, least in neardup.Similarity().least_matches():
        assert least < 0.8 * n
        assert n < 100 or least > 0.5 * n


def test_links_are_not_written_and_texts_go_to_python_in_small_batches(spark, documents, corpus, monkeypatch):
    key, written = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def noted(df, name, batch_rows=None):
        written.append((name, batch_rows))
        return common.stored(df, name, batch_rows)

    monkeypatch.setattr(neardup, "stored", noted)
    rows = corpus(5, count=80)
    neardup.near_duplicates(documents(rows), neardup.Similarity(width=2)).count()
    names = [name for name, _ in written]
    assert "linked" not in names and "edges" in names
    assert dict(written)["sketches"] == 1000 and ("edges", 1000) in written

    sizes = lambda batches: (pa.record_batch([pa.array([b.num_rows])], names=["n"]) for b in batches)
    before = spark.conf.get(key)
    stored = common.stored(spark.range(0, 2500, 1, 1).mapInArrow(sizes, "n long"), "sizes", 1000)
    assert sorted(r.n for r in stored.collect()) == [500, 1000, 1000]
    assert spark.conf.get(key) == before and spark.conf.get(key, None) is None


def test_few_rows_of_many_tasks_are_written_to_few_files(spark):
    small = common.stored_small(spark.range(0, 500, 1, 50), "small")
    assert len(small.inputFiles()) <= 4 and small.distinct().count() == 500

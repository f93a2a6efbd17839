import math

import pytest

from townsquare.llm import topk


def brute(rows, queries, k):
    whole = lambda v: [math.floor(256 * x) for x in v]
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if queries(q):
            scored = [(-sum(a * b for a, b in zip(whole(v), whole(w))), i) for i, w in good if i != q and len(w) == len(v)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_equals_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, 0.25, 0.001, -0.001, 2.0]) for _ in range(3)]) for i in range(300)]
    rows += [(None, [1.0, 1.0, 1.0]), (400, None), (450, [None, 1.0, 1.0]), (500, [math.nan, 1.0, 2.0]), (550, [math.inf, 0.0, 0.0])]
    rows += [(600, [1.0]), (601, [2.0]), (650, []), (651, [])]
    frame = spark.createDataFrame(rows, "id long, v array<float>").repartition(5)
    for block, tile in ((2, 7), (16384, 2048)):
        found = topk.top_k(frame, frame.where("id % 50 = 0"), 5, block_rows=block, tile_rows=tile, fan_in=2)
        assert sorted(tuple(r) for r in found.collect()) == brute(rows, lambda q: q % 50 == 0, 5)


def test_repeated_rows_and_extra_columns(spark):
    rows = [(0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "y"), (3, [1.0, 0.0], "z"), (3, [1.0, 0.0], "z")]
    frame = spark.createDataFrame(rows, "id long, v array<double>, score string")
    found = [tuple(r) for r in topk.top_k(frame, frame.where("id = 0"), 5).collect()]
    assert sorted(found) == sorted([(0, 1, 3, 65536), (0, 2, 3, 65536)] * 2)


@pytest.mark.parametrize("value,score", [(1e6, 256**2 * 10**12 * 2), (1e300, 2**63 - 1)])
def test_large_components_stay_exact(spark, value, score):
    frame = spark.createDataFrame([(0, [value, value]), (1, [value, value])], "id long, v array<double>")
    assert topk.top_k(frame, frame.where("id = 0"), 1).first()["score"] == score


def test_empty_tables(spark):
    frame = spark.createDataFrame([(0, [1.0])], "id long, v array<double>")
    assert topk.top_k(frame, frame.limit(0)).count() == 0
    assert topk.top_k(frame.limit(0), frame).count() == 0


def test_the_plan_does_not_grow_with_the_blocks(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    found = [topk.top_k(frame, frame, 5, block_rows=n) for n in (100, 10)]
    plans = [f._jdf.queryExecution().optimizedPlan().toString() for f in found]
    assert all("MapInArrow" not in p and "Union" not in p for p in plans) and len({p.count("\n") for p in plans}) == 1
    first, second = (sorted(tuple(r) for r in f.collect()) for f in found)
    assert first == second == brute(rows, lambda q: True, 5)

import random

import pytest

from townsquare.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text), with columns that clash with names the operators use."""

    def build(rows, partitions=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, node long, shard int, score string"
        values = [(i, t, "en", "s", len(t or ""), 1, 2, "x") for i, t in rows]
        return spark.createDataFrame(values, schema).repartition(partitions)

    return build


@pytest.fixture
def corpus():
    """Random texts over few words, with planted exact copies, near copies and shared passages."""

    def build(seed, count=60, words=40, length=60):
        rng = random.Random(seed)
        vocabulary = [f"w{i}" for i in range(words)] + ["Été", "ß", " x", "á"]
        make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
        texts = [make(rng.randrange(0, length)) for _ in range(count)]
        passage = make(30)
        for i in range(0, count, 5):
            at = rng.randrange(0, len(texts[i]) + 1)
            texts[i][at:at] = passage[rng.randrange(0, 8) :]
        for i in range(3, count, 7):
            texts[i] = list(texts[i - 1])
            if texts[i] and i % 2:
                texts[i][rng.randrange(len(texts[i]))] = "changed"
        joined = [rng.choice([" ", "\n", "\t "]).join(t) for t in texts]
        return [(rng.randrange(10**6) * 100 + i, t) for i, t in enumerate(joined)]

    return build

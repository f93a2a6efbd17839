import math
import random
import re
from collections import Counter

import duckdb
import pytest

from pyspark.sql import functions as F

from townsquare.llm import divergence

RULES = divergence.Rules(common=6, least_words=12, least_chars=40, class_limit=0.3, word_limit=0.55, least_share=0.05)
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept"]


def classes(text):
    out = [len(re.findall("[" + c.replace(r"\x{", r"\u{").replace(r"\u{80}-\u{24F}", "\x80-ɏ").replace(r"\u{250}-\u{2FFF}", "ɐ-⿿")
                          .replace(r"\u{3000}-\u{10FFFF}", "　-\U0010ffff") + "]", text)) for c in divergence.CLASSES]
    return [*out, len(text) - sum(out)]


def distance(p, q):
    total = 0
    for x, y in zip(p, q):
        total += sum(v * math.log2(2 * v / (x + y)) for v in (x, y) if v > 0)
    return math.sqrt(max(total / 2, 0))


def brute(rows, rules):
    """Counts and distances of each text, by definition."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    bare = lambda w: [x.lower().strip(divergence._MARKS) for x in w]
    known = {}
    for _, text, lang in rows:
        if text is not None and lang is not None:
            words, chars = known.setdefault(lang, (Counter(), [0] * (len(divergence.CLASSES) + 1)))
            words.update(bare(split(text)))
            chars[:] = [a + b for a, b in zip(chars, classes(text))]
    everything = sum(sum(w.values()) for w, _ in known.values())
    known = {k: v for k, v in known.items() if sum(v[0].values()) >= rules.least_share * everything and any(v[0])}
    out = []
    for _, text, _ in rows:
        text = text or ""
        words = split(text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        counts = Counter(windows)
        repeated = {p for i, w in enumerate(windows) if counts[w] > 1 for p in range(i, i + 5)}
        lines = [x for x in text.split("\n") if split(x)]
        base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        failed = len(words) < rules.least_base_words or 100 * len(repeated) > rules.repeat_percent * len(words)
        by_class, by_word = [], []
        for counted, chars in known.values():
            own = classes(text)
            if len(text) >= rules.least_chars:
                by_class.append(distance([x / len(text) for x in own], [x / sum(chars) for x in chars]))
            eligible = [(-n, w.encode()) for w, n in counted.items() if w and len(w) <= rules.longest]
            top = [w.decode() for _, w in sorted(eligible)[: rules.common]]
            if len(words) >= rules.least_words:
                mine, total = Counter(bare(words)), sum(counted.values())
                p, q = [mine[w] / len(words) for w in top], [counted[w] / total for w in top]
                by_word.append(distance([*p, 1 - sum(p)], [*q, 1 - sum(q)]))
        a, b = (min(x) if x else None for x in (by_class, by_word))
        out.append((*base, failed, a, b, not failed and not (a or 0) > rules.class_limit and not (b or 0) > rules.word_limit))
    return out


def texts(seed=3):
    rng = random.Random(seed)
    words = {"en": "the of and to in is cat dog house tree".split(), "fr": "le la et de été maison Été arbre".split()}
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "fr"])
        own = [rng.choice(words[lang]) + rng.choice(["", "", ".", ","]) for _ in range(rng.randrange(60))]
        if i % 9 == 0:
            own = [w.upper() + "!!" for w in own]
        if i % 11 == 0:
            own = own[:8] * 4
        if i % 13 == 0:
            own = [f"w{rng.randrange(99)} |" for _ in own]
        text = "".join(w + rng.choice([" ", " ", "\n", " \t", "\n\n"]) for w in own)
        rows.append((i, text, None if i % 17 == 0 else "xx" if i == 50 else lang))
    rows += [(None, None, "en"), (200, "", None), (200, "", "fr"), (201, " \n\x0b ", "en"), (3, rows[3][1], "en"), (202, "日本 語 " * 30, "fr")]
    rows += [(203, "the of and " * 4000, None), (204, "a b c d e", "en"), (205, "one two three four five " * 2 + "six", "en"), (206, "ΩΑΣ 🙂🙂 | # " * 8, "en")]
    return rows


def near(a, b):
    return len(a) == len(b) and all(x == y if not isinstance(x, float) else y is not None and math.isclose(x, y, abs_tol=1e-9) for x, y in zip(a, b))


def test_equals_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, "x", i, "c") for i, r in enumerate(rows)], "doc_id long, text string, lang string, kept string, `own.x` int, c0 string").repartition(4)
    found = {r["own.x"]: r for r in divergence.judge(docs, rules=RULES).collect()}
    expected = brute(rows, RULES)
    assert len(found) == len(rows)
    for i, (row, want) in enumerate(zip(rows, expected)):
        got = tuple(found[i][c] for c in COLUMNS)
        assert near(got, want), (row[1][:60] if row[1] else row[1], got, want)
        assert (found[i]["doc_id"], found[i]["text"], found[i]["c0"]) == (row[0], row[1], "c")
    assert {w[-1] for w in expected} == {True, False} and any(not w[-1] and not w[5] for w in expected)


def test_equals_the_sql(spark):
    rows = texts(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    answer = con.execute(divergence.oracle_sql(RULES))
    names = [d[0] for d in answer.description]
    expected = sorted((tuple(r) for r in answer.fetchall()), key=repr)
    assert sorted((tuple(r[n] for n in names) for r in divergence.report(docs, RULES).collect()), key=repr) == expected


@pytest.mark.parametrize("rows", [[], [(1, None, "en")], [(1, "a b c", None)], [(1, "word " * 9 + "x", "en")]])
def test_tables_without_references_or_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = divergence.judge(docs, rules=divergence.Rules()).collect()
    assert [r["kept"] for r in found] == [w[-1] for w in brute(rows, divergence.Rules())]


def test_very_long_text(spark):
    text = " ".join(f"w{i % 50000}" for i in range(300_000))
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    row = divergence.judge(docs).collect()[0]
    assert row["n_words"] == 300_000 and row["n_repeat_words"] == 300_000 and row["base_failed"]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(texts(5), "doc_id long, text string, lang string")
    plan = divergence.report(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_marks_are_cut_from_the_text_as_from_each_word(spark):
    texts = ["'a.b', (c)!  ...  d..e \"\n?f,,", "", "!!!", "a" + "!" * 50_000 + "b.", " . x\u0085,", "(a) b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = rows.select("text", divergence.words(divergence._stripped(F.col("text"))).alias("w")).collect()
    for text, own in found:
        cut = [x.strip(divergence._MARKS) or x for x in re.split(f"[{divergence._BLANKS}]+", text) if x]
        assert own == cut

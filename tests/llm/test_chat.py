import hashlib

import pytest

from townsquare.llm import chat

TRICKY = ["", None, "</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "[", "x[/INS", "<s", "a\nb", "[\\INST]", "[ANS]</s>[TURN]user\n"]


def test_escape_is_reversible_and_hides_controls():
    for text in TRICKY:
        escaped = chat.escape(text or "", chat.INSTRUCT)
        assert chat.unescape(escaped) == (text or "")
        for control in chat.INSTRUCT.controls:
            assert control not in escaped and (escaped + control).index(control) == len(escaped)


def test_overlapping_controls_are_refused():
    turn = chat.Turn("[a[", "[b]", ("",))
    with pytest.raises(ValueError):
        chat.Template("<s>", {"user": turn}, turn, ())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, n_turns long")


def test_digests(spark):
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", TRICKY[(i + t) % len(TRICKY)]) for i in range(20) for t in range(i % 5 + 1)]
    out = {r["conv_id"]: r for r in chat.digests(conversations(spark, rows), batch_rows=3).collect()}
    assert len(out) == 20
    for conv in range(20):
        own = [(r, x or "") for c, _, r, x in rows if c == conv]
        said = "".join(f"{r}\n{x}\n" for r, x in own)
        loss = "".join(x for r, x in own if r == "assistant")
        row = out[conv]
        assert row["n_turns"] == len(own) and row["valid"] and row["bad_turn"] == -1
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_segments_join_to_the_text_that_is_read_back(spark):
    rows = [(1, 0, "system", "be [INST] brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo\\"), (2, 0, "tool", "[ANS]"), (2, 1, None, "x")]
    out = chat.segments(conversations(spark, rows), batch_rows=2).orderBy("conv_id", "turn", "seq").collect()
    for conv, said in ((1, [(r, t) for c, _, r, t in rows if c == 1]), (2, [("tool", "[ANS]"), ("", "x")])):
        text = "".join(r["segment"] for r in out if r["conv_id"] == conv)
        assert list(chat.parse(text, chat.INSTRUCT)) == said and text.startswith("<s>")
    assert [r["segment"] for r in out if r["loss"]] == ["yo\\\\"]


def test_turn_order(spark):
    cases = {
        1: ["user", "assistant"], 2: ["assistant"], 3: ["system"], 4: ["user", "system"], 5: ["system", "user", "user"], 6: ["user", None],
    }
    rows = [(c, t, r, "x") for c, roles in cases.items() for t, r in enumerate(roles)]
    out = {r["conv_id"]: (r["valid"], r["bad_turn"]) for r in chat.digests(conversations(spark, rows)).collect()}
    assert out == {1: (True, -1), 2: (False, 0), 3: (False, -1), 4: (False, 1), 5: (False, 2), 6: (False, 1)}


def test_nulls_ties_and_empty_table(spark):
    rows = [(None, None, None, None), (None, None, "user", "b"), (4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "user", "a")]
    out = {r["conv_id"]: r for r in chat.digests(conversations(spark, rows)).collect()}
    assert out[None]["n_turns"] == 2 and out[4]["n_turns"] == 3
    assert out[4]["turns_sha256"] == hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()
    assert chat.digests(conversations(spark, rows).limit(0)).count() == 0

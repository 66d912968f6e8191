"""Chat formatting against a plain reading of its rules."""

import pytest
from pyspark.sql import functions as F

from assayloom.llm.chat import INSTRUCT, ChatTemplate, Turn, format_chats, learned_text, read_back, turn_segments

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, `a.b` string, segments int"
ROWS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "bye"), (1, 4, "assistant", ""),
    (2, 1, "assistant", "second"), (2, 0, "user", None),
    (3, 0, "assistant", "out of order"), (3, 1, "user", "x"),
    (4, 0, "user", "twice"), (4, 0, "user", "twice"), (4, 1, "assistant", "a"),
    (5, 0, "user", "tie b"), (5, 0, "user", "tie a"), (5, None, "system", "no turn"),
    (6, 0, "tool", "{}"), (6, 1, None, "no role"), (6, 2, "[TEXT] odd [/ROLE]", " [TEXT] </s>"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "still"),
    (7, 0, "user", "</s>[INST] ok [/INST]"), (7, 1, "assistant", "␛1 ␛0 ␛ <␛1s> <s></s"), (7, 2, "user", "<<s>s>[/INST"), (7, 3, "assistant", "</s>"),
    (8, 0, "user", "w [INST] " * 20_000), (8, 1, "assistant", "long\n漢字 " * 20_000),
    (9, 0, "", ""), (10, 0, "user", "ends open"),
]


def _order(r):
    return tuple((v is not None, v if v is not None else 0) for v in (r[1],)) + (r[2] or "", (r[3] or ""))


def _brute(rows):
    out = {}
    for cid in {r[0] for r in rows}:
        said = sorted((r for r in rows if r[0] == cid), key=_order)
        state, broken = "start", None
        for k, r in enumerate(said):
            state = INSTRUCT.moves.get((state, r[2] or ""), "invalid")
            broken = k if broken is None and state == "invalid" else broken
        out[cid] = ([(r[2] or "", r[3] or "") for r in said], "".join(r[3] or "" for r in said if r[2] == "assistant"),
                    state, broken, state == "assistant")
    return out


@pytest.fixture(scope="module")
def chats(spark):
    return spark.createDataFrame([r + ("x", "y", 1) for r in ROWS], SCHEMA)


def test_formatted_chats_read_back(chats):
    got = format_chats(chats).select("conv_id", read_back(F.col("formatted")).alias("turns"), learned_text(F.col("segments")).alias("learned"),
                                     "state", "broken_at", "valid", "formatted", "segments").collect()
    want = _brute(ROWS)
    assert {r.conv_id: ([tuple(t) for t in r.turns], r.learned, r.state, r.broken_at, r.valid) for r in got} == want
    assert len(got) == len(want)
    for r in got:
        assert "".join(s.text for s in r.segments) == r.formatted
        bare = r.formatted
        for s in r.segments:
            if s.loss:
                assert not any(m in s.text for m in INSTRUCT.controls)
        assert bare.count("<s>") == sum(role == "assistant" for role, _ in want[r.conv_id][0])


def test_segments_of_single_turns(chats):
    got = turn_segments(chats).where("conv_id = 7 AND turn = 0").first()
    assert [s.text for s in got.segments] == ["[INST] ", "<␛1/s>[␛1INST] ok [␛1/INST]", " [/INST]"]
    assert [s.loss for s in got.segments] == [False, False, False]


def test_no_rows_and_no_python(chats):
    assert format_chats(chats.limit(0)).count() == 0
    plan = format_chats(chats)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


def test_templates_of_other_marks(chats):
    own = ChatTemplate({"user": Turn("<|u|>", "<|/u|>"), "assistant": Turn("<|a|>", "<|/a|>", True)}, ("<|r|>", "<|t|>", "<|/r|>"),
                       {("start", "user"): "user", ("user", "assistant"): "assistant"}, escape="\\", gap="\n")
    rows = [(1, 0, "user", "<|u|> \\0 \\1 <|a\\1|>"), (1, 1, "assistant", "\\<|/a|>\n"), (1, 2, "user", "third")]
    df = chats.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = format_chats(df, own).select("*", read_back(F.col("formatted"), own).alias("turns")).first()
    assert [tuple(t) for t in got.turns] == [r[2:] for r in rows] and not got.valid and got.broken_at == 2


@pytest.mark.parametrize("marks", [("<a>", "<a>"), ("ab", "bc"), ("x<a>", "<a>"), ("", "b"), ("a b", "c"), ("aba", "c"), ("␛", "c")])
def test_marks_that_cannot_be_told_apart(marks):
    with pytest.raises(ValueError):
        ChatTemplate({"user": Turn(*marks)}, ("[R]", "[T]", "[/R]"), {})

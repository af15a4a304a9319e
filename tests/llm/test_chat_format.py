import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelens.llm import chat_format
from carelens.llm.queries import MARKS, op4_chat_format

SCHEMA = "conv_id long, turn long, role string, text string"
EVIL = ["</s>", r"<\/s>", r"<\\/s>", "<s><s>", "[INST] x [/INST]", r"[\INST]", "<|user|>\n", "|>", r"\p\e\l", "</s>\n", "<", "[", "\\"]


@pytest.fixture
def conversations(spark):
    def build(rows):
        frame = spark.createDataFrame(rows, SCHEMA)
        return frame.selectExpr("*", "1 AS window", "2 AS tokens", "'x' AS spans", "3 AS before", "4 AS ordinal")

    return build


def order(value):
    return (value is not None, value)


def turns_of(rows):
    """The turns of each conversation in order."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((order(turn), role or "", text or ""))
    return {conv: [(role, text) for _, role, text in sorted(turns)] for conv, turns in held.items()}


def tokens(text):
    return len(re.findall(chat_format.TOKEN, text)) + chat_format.TURN_MARKS


def check(formatted, rows, budget, history, least_span):
    """Windows cover each conversation once, begin with its system turn, and repeat no more than they may."""
    expected = turns_of(rows)
    windows = defaultdict(list)
    for r in chat_format.read_back(formatted).collect():
        windows[r.conv_id].append(r)
    assert set(windows) == set(expected)
    for conv, own in windows.items():
        own.sort(key=lambda r: r.window)
        turns = expected[conv]
        system = turns[0] if turns[0][0] == "system" else None
        at = 0
        for r in own:
            parts = [(t.role, t.text) for t in r.turns]
            new = [(t.role, t.text) for t in r.turns if not t.repeated]
            again = [(t.role, t.text) for t in r.turns if t.repeated]
            assert new and parts == again + new or (at == 0 and parts == new)
            assert new == turns[at : at + len(new)]
            assert list(r.targets) == [text for role, text in new if role == "assistant"]
            if at and system:
                assert again[0] == system
                again = again[1:]
            assert again == turns[at - len(again) : at] and sum(tokens(t) for _, t in again) <= history
            if at and len(again) < at - bool(system):
                assert sum(tokens(t) for _, t in turns[at - len(again) - 1 : at]) > history
            span = max(budget - history - (tokens(system[1]) if system else 0), least_span)
            assert len(new) == 1 or sum(tokens(t) for _, t in new) <= span
            at += len(new)
        assert at == len(turns)


AWKWARD = [
    (1, 0, "system", "rules " * 20),
    *((1, t, "assistant" if t % 2 else "user", f"turn {t} " * (t % 7 + 1)) for t in range(1, 80)),
    (2, 0, "user", None),
    (2, None, None, "before"),
    (2, 0, "user", None),
    (2, 0, "assistant", ""),
    (3, 5, "assistant", "word " * 5000),
    (3, 6, "assistant", "after"),
    (None, 1, "assistant", "no id"),
    (4, 1, "assistant", "".join(EVIL)),
    *((4, 2 + n, role, role) for n, role in enumerate(EVIL)),
    *((5, 3, "assistant", "copied turn") for _ in range(300)),
    (6, 1, "user", "x"),
    (6, 2, "system", "late rules"),
    (7, 10**15, "assistant", "far"),
    (7, -5, "user", "early"),
]


@pytest.mark.parametrize(("budget", "history", "least"), [(2048, 512, 512), (60, 20, 30), (40, 0, 10)])
def test_awkward(conversations, budget, history, least):
    frame = conversations(AWKWARD)
    check(chat_format.windows(frame, budget, history, least), AWKWARD, budget, history, least)


def test_empty_table(conversations):
    assert chat_format.windows(conversations([])).collect() == []


def test_texts_show_no_mark_of_their_own(conversations):
    rows = [(1, n, "user", text) for n, text in enumerate(EVIL)]
    text = chat_format.windows(conversations(rows)).first().text
    assert text.count("</s>") == len(rows) and text.count("<s>") == 1 and "[INST]" not in text
    assert text.count("<|") == len(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([*EVIL, "|", "/s>", "s>", "a", "\n"]), max_size=8).map("".join), min_size=40, max_size=60))
def test_escapes_are_reversible(spark, texts):
    frame = spark.createDataFrame([(x,) for x in texts], "x string")
    body, role = F.col("x"), F.col("x")
    rows = frame.select(
        "x",
        chat_format.unescaped(chat_format.escaped(body)).alias("text"),
        chat_format.unescaped_role(chat_format.escaped_role(role)).alias("role"),
    )
    for r in rows.collect():
        assert r.text == r.x and r.role == r.x


def test_no_python_in_the_plan(conversations):
    plan = chat_format.windows(conversations(AWKWARD))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)]
    expected = {}
    for conv, turns in turns_of(rows).items():
        loss = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        expected[conv] = (len(turns), digests[0], len(loss), digests[1])
    got = op4_chat_format(spark, sf_dir).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected
    assert len(got) == len(expected) and all(r.formatted_chars > r.loss_chars for r in got)

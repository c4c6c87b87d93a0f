from __future__ import annotations

import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlens.llm import chat

PIECES = st.lists(st.sampled_from([*chat.CONTROL.pattern, "<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "é", "\n", " "]))


@given(st.lists(st.tuples(PIECES.map("".join), PIECES.map("".join)), max_size=5))
def test_round_trip(turns):
    made = [chat.render(role, text) for role, text in turns]
    assert chat.parse("".join(m[0] for m in made)) == turns


@given(PIECES.map("".join))
def test_loss_span(text):
    segment, start, length = chat.render("assistant", text)
    assert chat.unescape(segment[start : start + length]) == text
    assert chat.render("user", text)[2] == 0


SCHEMA = "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string, extra string"


def messages(spark, log):
    out = {}
    for r in chat.format_log(spark.createDataFrame([(*row, "x") for row in log], SCHEMA)).collect():
        out.setdefault(r.conv_id, []).extend(chat.parse(r.segment))
    return out


def test_events_are_folded(llm):
    log = [
        (1, 0, 1, "message", "user", "hi"),
        (1, 1, 2, "message", "assistant", ""),
        (1, 1, 3, "delta", "assistant", "Hel"),
        (1, 1, 4, "delta", "assistant", "lo"),
        (1, 0, 5, "edit", "user", "hi there"),  # undoes turn 1
        (1, 1, 6, "message", "assistant", "A"),
        (1, 1, 7, "regenerate", "assistant", None),
        (1, 1, 8, "delta", "assistant", "B"),
        (1, 1, 9, "delta", "assistant", "C"),
        (2, 0, 1, "delta", "user", "late start"),
        (None, None, None, "message", None, None),
    ]
    assert messages(llm, log) == {
        1: [("user", "hi there"), ("assistant", "BC")],
        2: [("user", "late start")],
        None: [("", "")],
    }
    assert messages(llm, log[::-1]) == messages(llm, log)
    assert messages(llm, []) == {}


def test_digest(llm):
    rows = [(7, 1, "assistant", "</s>\\[INST] é"), (7, 0, "user", None), (7, 1, "assistant", "</s>\\[INST] é"), (8, 2, "system", "s" * 100_000)]
    turns = llm.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("seq", F.lit(9))
    out = {r.conv_id: r for r in chat.digest(chat.format_log(chat.log_of(turns))).collect()}
    told = "user\n\n" + 2 * "assistant\n</s>\\[INST] é\n"
    assert out[7].n_turns == 3 and out[7].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert out[7].loss_chars == 26
    assert out[7].loss_sha256 == hashlib.sha256((2 * "</s>\\[INST] é").encode()).hexdigest()
    assert out[8].loss_chars == 0 and out[8].formatted_chars == len(chat.render("system", "s" * 100_000)[0])

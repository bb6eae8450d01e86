import random

import pytest
from cases import SMALL
from pyspark.sql import functions as F

from shelfmark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, spans string"


def _read(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return {r["conv_id"]: r for r in chat.read_chats(chat.format_chats(frame)).collect()}


def test_hostile_texts_come_back_as_they_were(spark):
    draw = random.Random(5)
    parts = ["<", "|", "\\", "<|", "<\\|", chat.START, chat.SEP, chat.END, chat.NEWLINE, "assistant\n", "\n", "a", "é", "😀", ""]
    rows = [(conv, turn, draw.choice(["user", "assistant", "assistant", "sys\ntem", chat.NEWLINE, chat.END, ""]),
             "".join(draw.choice(parts) for _ in range(draw.randint(0, 12))))
            for conv in range(60) for turn in range(draw.randint(1, 9))]
    got = _read(spark, rows)
    for conv in range(60):
        turns = [(role, text) for c, _, role, text in rows if c == conv]
        assert [tuple(t) for t in got[conv]["turns"]] == turns
        assert got[conv]["loss_text"] == "".join(text for role, text in turns if role == "assistant")
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert got[conv]["formatted"].count(chat.START) == got[conv]["formatted"].count(chat.END) == blocks
        assert got[conv]["formatted"].count(chat.SEP) == len(turns) - blocks


def test_known_format(spark):
    got = _read(spark, [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 3, "assistant", "c<|im_end|>")])
    assert got[1]["formatted"] == (
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_sep|>c<\\|im_end|><|im_end|>\n")


def test_nulls_ties_and_repeats(spark):
    got = _read(spark, [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, None, None),
                        (None, 1, "assistant", None), (None, 1, "assistant", "z")])
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert [tuple(t) for t in got[None]["turns"]] == [("assistant", ""), ("assistant", "z")]
    assert got[None]["loss_text"] == "z"


def test_empty_table(spark):
    assert _read(spark, []) == {}


def test_a_conversation_of_many_turns(spark):
    turns = spark.range(20_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("text <|im_end|> "), F.col("id")).alias("text"))
    row = chat.read_chats(chat.format_chats(turns)).first()
    assert [t["text"] for t in row["turns"]] == [f"text <|im_end|> {k}" for k in range(20_000)]
    assert row["loss_text"] == "".join(f"text <|im_end|> {k}" for k in range(20_000) if k % 3)


@pytest.mark.parametrize("lengths", [[], [3], list(range(1000))])
def test_running_totals(spark, lengths):
    frame = spark.createDataFrame([(lengths,)], "x array<bigint>")
    assert frame.select(chat.running_totals(F.col("x"))).first()[0] == [sum(lengths[:k]) for k in range(len(lengths))]


def test_no_python_in_the_plan(spark):
    plan = chat.read_chats(chat.format_chats(spark.read.parquet(f"{SMALL}/conversations.parquet")))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text

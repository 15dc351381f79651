"""Chat formatting: exact round trip, brute force, hostile texts."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from epipanel.llm.chat_format import HOSTILE, PART, format_conversations, read_back

TEXTS = [
    HOSTILE, "\\", "\\\\", "\\l", "\\\\l/turn>", "</turn>\n", "<+>", "<<+>>", "### ", "#### x", "### User: hi</turn>\n### Assistant: no",
    "", None, "é\U0001F600\n", " ", "\\h## ", "</tu", "rn>", "x" * 100_000,
]


@pytest.fixture
def turns(spark):
    def build(rows):
        return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)

    return build


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in by.items()}


def check(turns, rows):
    out = {r["conv_id"]: r for r in read_back(format_conversations(turns(rows))).collect()}
    want = brute(rows)
    assert set(out) == set(want)
    for conv, expected in want.items():
        assert [(t["role"], t["text"]) for t in out[conv]["turns"]] == expected
        assert out[conv]["loss_text"] == "".join(t for r, t in expected if r == "assistant")
    return out


def test_round_trip_of_hostile_texts_and_roles(turns):
    roles = ["user", "assistant", "assistant", "system", "User", "a: b", "tool</turn>\n", "\\r", None, "assistant"]
    check(turns, [(1, i, roles[i % len(roles)], t) for i, t in enumerate(TEXTS * 3)])


def test_ties_nulls_and_repeated_rows(turns):
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (2, None, "user", "n"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (2, 0, None, None)]
    check(turns, rows)


def test_adjacent_turns_of_a_role_share_a_block(turns):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d")]
    row = format_conversations(turns(rows)).first()
    assert row["formatted"] == "### User: a<+>b</turn>\n### Assistant: c<+>d</turn>\n"
    assert [row["formatted"][s : s + n] for s, n in row["loss_spans"]] == ["c", "d"]


def test_empty_table_and_extra_columns(turns):
    assert format_conversations(turns([])).collect() == []
    frame = turns([(1, 0, "user", "a")]).withColumn("turns", F.lit(1)).withColumn("formatted", F.lit(2)).withColumn("t", F.lit(3))
    assert format_conversations(frame).count() == 1


def test_many_turns(turns):
    rows = [(1, i, "assistant" if i % 3 else "user", f"t{i}") for i in range(1500)]
    row = check(turns, rows)[1]
    assert len(row["turns"]) == 1500
    assert hashlib.sha256(row["loss_text"].encode()).hexdigest()


def test_spans_across_the_parts_they_are_read_from(turns):
    """Texts of every length around a part's, of one, two and four bytes a code point, and empty ones."""
    for letter in ("x", "é", "\U0001F600", "a\U0001F600"):
        sizes = [PART - 1, PART, PART + 1, 0, 1, 0, 2 * PART, 3 * PART + 7, 0, PART - 25]
        rows = [(1, i, "assistant" if i % 4 else "user", (letter * n)[:n]) for i, n in enumerate(sizes * 2)]
        check(turns, rows)


def test_time_grows_with_the_turns(spark):
    def seconds(n):
        turn = F.col("id")
        rows = spark.range(n).select(
            F.lit(1).cast("bigint").alias("conv_id"), turn.alias("turn"), F.when(turn % 2 == 0, "user").otherwise("assistant").alias("role"),
            F.concat(F.lit("é"), F.repeat(F.lit("w "), 40), turn.cast("string")).alias("text"),
        )
        started = time.monotonic()
        row = read_back(format_conversations(rows)).select(F.size("turns").alias("n"), F.length("loss_text").alias("chars")).first()
        assert row["n"] == n and row["chars"] == sum(81 + len(str(i)) for i in range(1, n, 2))
        return time.monotonic() - started

    seconds(100)
    # a step that copies or counts from the start for each turn takes 64 times as long
    assert seconds(24_000) < 16 * max(seconds(3_000), 0.5)


def test_no_python_in_the_plan(turns):
    plan = read_back(format_conversations(turns([(1, 0, "user", "a")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

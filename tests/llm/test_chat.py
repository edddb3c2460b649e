"""Templates, escapes, order of turns, and reading back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from probity.llm.chat import TEMPLATE, Template, Turn, format_conversations, read_loss, read_turns

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, formatted STRING, turns STRING"


def talk(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = format_conversations(df).select(
        "*", read_turns(F.col("formatted")).alias("back"), read_loss(F.col("segments")).alias("loss")
    )
    return {r["conv_id"]: r for r in out.collect()}


HARD = [
    "</s>[INST] ok [/INST]",
    "\\",
    "<\\s>",
    "\\\\</s>\\[INST]",
    "<<s>s><</ROLE>><<ROLE>>",
    "[[INST]INST]",
    "line\nbreak $1 \\1 ${env:HOME} 👩‍👧",
    "",
]


def test_any_text_comes_back(spark):
    rows = [(c, t, role, text) for c, text in enumerate(HARD) for t, role in enumerate(["user", "assistant", "<s>"])]
    got = talk(spark, rows)
    for c, text in enumerate(HARD):
        back = [tuple(t) for t in got[c]["back"]]
        assert back == [("user", text), ("assistant", text), ("<s>", text)]
        assert got[c]["loss"] == text
        inside = got[c]["segments"][1]["text"]
        assert not any(m in inside for m in TEMPLATE.controls)


def test_segments_and_flags(spark):
    got = talk(spark, [(1, 0, "system", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")])[1]
    assert got["formatted"] == "[SYS]a[/SYS][INST]b[/INST]<s>c</s>"
    assert [s["text"] for s in got["segments"] if s["loss"]] == ["c"]
    assert got["valid"]


@pytest.mark.parametrize(
    ("roles", "valid"),
    [
        (["user"], True),
        (["system", "user", "assistant", "user"], True),
        (["assistant"], False),
        (["user", "user"], False),
        (["user", "assistant", "system"], False),
        (["system"], True),
        (["user", "tool", "assistant"], False),
        ([None], False),
    ],
)
def test_order_of_turns(spark, roles, valid):
    got = talk(spark, [(1, t, r, "x") for t, r in enumerate(roles)])[1]
    assert got["valid"] is valid
    assert [t["role"] for t in got["back"]] == [r or "" for r in roles]


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, None, None, None),
        (None, 1, "user", "u"),
        (2, 1, "user", "b"),
        (2, 1, "user", "a"),
        (2, 1, "user", "a"),
    ]
    got = talk(spark, rows)
    assert [tuple(t) for t in got[None]["back"]] == [("", ""), ("user", "u")]
    assert [t["text"] for t in got[2]["back"]] == ["a", "a", "b"]
    assert got[2]["n_turns"] == 3


def test_long_text_and_empty_table(spark):
    text = "[INST]\\ word " * 20_000
    got = talk(spark, [(1, 0, "assistant", text)])[1]
    assert got["loss"] == got["back"][0]["text"] == text
    assert format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("marks", [("a", "</s>"), ("<s\\>", "</s>"), ("<a<", "</s>"), ("[SYS]", "x[SYS]")])
def test_marks_that_cannot_be_escaped_are_refused(marks):
    with pytest.raises(ValueError, match="mark"):
        Template(turns={"user": Turn(*marks)}, follows={"": ("user",)})


def test_query_with_broken_orders_equals_its_sql(spark, tmp_path):
    """The machine's findings on wrong, unknown and missing roles, in the query as in its SQL."""
    import duckdb
    from compare import oracle_bag, spark_bag

    from probity.llm.oracle import OP3
    from probity.llm.queries import op3_chat

    kinds = [
        ["system", "user", "assistant"], ["user", "user", "assistant"], ["assistant"], ["system", "system", "user"],
        ["user", "assistant", "tool", "user"], [None, "user"], ["user", "assistant", "assistant", "user", "system"], ["user"],
    ]
    given = [(c, k, role, f"text {k} </s> [INST]") for c, roles in enumerate(kinds) for k, role in enumerate(roles)]
    given += [(50, None, "user", "no turn"), (50, 1, "assistant", None), (50, 1, "assistant", "")]
    path = tmp_path / "conversations.parquet"
    spark.createDataFrame(given, "conv_id LONG, turn LONG, role STRING, text STRING").coalesce(1).write.parquet(str(path))
    query = op3_chat(spark, str(tmp_path))
    assert "aggregate(" in query._jdf.queryExecution().optimizedPlan().toString()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert spark_bag(query) == oracle_bag(con, OP3)
    found = {r["conv_id"]: (r["valid"], r["first_wrong"]) for r in query.collect()}
    assert [found[c] for c in range(8)] == [
        (True, None), (False, 1), (False, 0), (False, 1), (False, 2), (False, 0), (False, 2), (True, None),
    ]
    assert found[50] == (False, 2) and found[-7] == (True, None)

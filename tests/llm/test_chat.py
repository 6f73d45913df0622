import duckdb

from sparkmart.llm import chat
from sparkmart.llm.queries import QUERIES


def test_prefix_masks_and_odd_rows(spark):
    rows = [(1, "chosen", 0, "user", "hi"), (1, "rejected", 0, "user", "hi"), (1, "chosen", 1, "assistant", "yes"), (1, "rejected", 1, "assistant", "no"),
            (1, "rejected", 2, None, None), (2, "chosen", 0, "user", "same"), (2, "rejected", 0, "user", "same"), (3, "chosen", None, "user", "a"),
            (3, "chosen", None, "user", "a"), (None, "chosen", 0, "user", "x"), (4, "other", 0, "user", "x"), (4, None, 0, "user", "x"),
            (5, "rejected", 0, "assistant", "Éé\U0001f600")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "pair_id long, side string, turn int, role string, text string, n int")
    got = {r.pair_id: r for r in chat.format_preferences(df).collect()}
    assert set(got) == {1, 2, 3, 5}
    assert got[1].prompt == "<|user|>\nhi<|end|>\n" and got[1].n_prompt_turns == 1
    assert got[1].chosen == "<|assistant|>\nyes<|end|>\n" and [tuple(m) for m in got[1].chosen_mask] == [(14, 0), (11, 1)]
    assert got[1].rejected == "<|assistant|>\nno<|end|>\n<||>\n<|end|>\n" and [m.loss for m in got[1].rejected_mask] == [0, 1, 0, 0]
    assert got[2].chosen == got[2].rejected == "" and got[2].chosen_mask == []
    assert got[3].n_prompt_turns == 0 and got[3].chosen == 2 * "<|user|>\na<|end|>\n" and got[3].rejected == ""
    for r in got.values():
        for text, mask in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
            assert sum(m.length for m in mask) == len(text)
    assert got[5].rejected[14:14 + got[5].rejected_mask[1].length] == "Éé\U0001f600<|end|>\n"
    assert chat.format_preferences(df.where("false")).count() == 0


def test_swapped_replies(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "A"), (0, 2, "user", "later"), (1, 0, "user", "r"), (1, 1, "assistant", "B"),
            (2, 0, "user", "alone"), (2, 1, "assistant", "C"), (4, 0, "user", "no reply"), (None, 0, "user", "x"), (-1, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: (r.prompt, r.chosen, r.rejected) for r in chat.format_preferences(chat.swapped_replies(df)).collect()}
    show = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    later = show("user", "later")
    assert got == {0: (show("user", "q"), show("assistant", "A") + later, show("assistant", "B") + later),
                   1: (show("user", "r"), show("assistant", "B"), show("assistant", "A")),
                   2: (show("user", "alone"), show("assistant", "C"), ""),
                   4: (show("user", "no reply"), "", ""), -1: (show("", ""), "", "")}


def test_swapped_replies_of_no_rows_and_long_texts(spark):
    kinds = "conv_id int, turn long, role string, text string"
    assert chat.format_preferences(chat.swapped_replies(spark.createDataFrame([], kinds))).count() == 0
    long = "word " * 100_000
    df = spark.createDataFrame([(2, 0, "user", long), (2, 1, "assistant", long), (2, 2, "user", long), (3, 0, "assistant", "x")], kinds)
    got = {r.pair_id: r for r in chat.format_preferences(chat.swapped_replies(df)).collect()}
    assert len(got[2].chosen) == 2 * len(long) + 2 * 8 + 14 + 9 and [m.loss for m in got[2].rejected_mask] == [0, 1, 0, 0]


def test_partners_of_ids_that_are_no_integers(spark):
    rows = [("4", 0, "assistant", "A"), ("5", 0, "assistant", "B"), ("x7", 0, "assistant", "C"), ("007", 0, "assistant", "D"), ("6", 0, "assistant", "E"),
            ("", 0, "assistant", "F")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r.pair_id: r.rejected for r in chat.format_preferences(chat.swapped_replies(df)).collect()}
    show = lambda text: f"<|assistant|>\n{text}<|end|>\n"
    assert got == {"4": show("B"), "5": show("A"), "x7": "", "007": "", "6": "", "": ""}


def test_query_against_sql_and_native(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    df = QUERIES["op3_preference_format"](spark, sf)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(chat.ORACLE).fetchall())

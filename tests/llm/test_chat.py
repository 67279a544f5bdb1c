import pytest

from ledgerflow.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def rows(frame):
    return {(r["conv_id"], r["turn"]): r for r in frame.collect()}


def test_nested_quotes(spark):
    talk = [(1, 0, "a", "First thing.\nSecond line here."), (1, 1, "b", "> second LINE, here\nI agree."),
            (1, 2, "c", "> > First thing.\n> > Second line here.\n> I agree\n\nMe too."),
            (1, 3, "d", "On Monday c wrote:\n>> I agree.\n>> more\nAn answer\n to nothing."), (1, 4, "e", "New topic."),
            (1, 5, "f", ">First\n>thing. second\n> line HERE\nWrapped."), (2, 0, "g", "> Me too.\nOther talk.")]
    got = rows(chat.format_chats(spark.createDataFrame(talk, SCHEMA)))
    assert [got[1, t]["reply_to"] for t in range(6)] == [None, 0, 1, 1, None, 0]
    assert [got[1, t]["body"] for t in range(3)] == ["First thing.\nSecond line here.", "I agree.", "\nMe too."]
    assert got[1, 3]["body"] == "An answer\n to nothing." and got[1, 3]["quote_levels"] == 2
    assert [got[1, t]["depth"] for t in range(6)] == [0, 1, 2, 2, 0, 1]
    assert [got[1, t]["thread"] for t in range(6)] == [0, 0, 0, 0, 4, 0]
    assert [got[1, t]["position"] for t in range(6)] == [1, 2, 3, 4, 6, 5]
    assert got[2, 0]["reply_to"] is None and got[2, 0]["position"] == 1


def test_the_earliest_original_and_ties(spark):
    talk = [(1, 0, "a", "same"), (1, 1, "b", "same"), (1, 2, "c", "> same\nyes"), (1, 3, "d", "> unknown\n> yes")]
    got = rows(chat.format_chats(spark.createDataFrame(talk, SCHEMA)))
    assert got[1, 2]["reply_to"] == 0 and got[1, 3]["reply_to"] == 2


def test_nulls_repeats_and_long_texts(spark):
    long = "\n".join(f"line {i}" for i in range(3000))
    talk = [(1, 0, "a", long), (1, 1, None, "> " + long.replace("\n", "\n> ")), (1, 1, None, "> " + long.replace("\n", "\n> ")),
            (None, 0, "x", "hello"), (None, 1, "x", "> hello"), (2, None, "x", "> hello"), (2, 0, "x", None), (3, 0, "x", "")]
    frame = spark.createDataFrame(talk, SCHEMA).selectExpr("*", "1 AS Position", "2 AS body")
    out = chat.format_chats(frame).collect()
    assert len(out) == len(talk)
    twice = [r for r in out if (r["conv_id"], r["turn"]) == (1, 1)]
    assert len(twice) == 2 and all(r["reply_to"] == 0 and r["position"] == 2 and r["body"] == "" for r in twice)
    assert all(r["reply_to"] is None for r in out if r["conv_id"] != 1)
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_chain_and_no_python(spark):
    chain = [(1, t, "u", (f"> message {t - 1} says this\n" if t else "") + f"message {t} says this") for t in range(200)]
    frame = chat.format_chats(spark.createDataFrame(chain, SCHEMA))
    got = rows(frame)
    assert all(got[1, t]["depth"] == t and got[1, t]["thread"] == 0 and got[1, t]["position"] == t + 1 for t in range(200))
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text,level", [("no", 0), (">a", 1), ("> > b", 2), (">>> c", 3), ("a > b", 0), (" >\t> d", 2), ("> " * 50_000, 50_000)])
def test_levels(spark, text, level):
    assert chat.parse(spark.createDataFrame([(1, 0, "r", text)], SCHEMA)).first()["quote_levels"] == level


def test_rewrapped_quote_of_some_paragraphs(spark):
    first = "One two three four\nfive six.\n\nSeven eight\nnine ten.\n\nEleven twelve."
    quote = "> One two three\n> four five\n> six.\n>\n> Seven\n> eight nine ten.\nI agree."
    got = rows(chat.format_chats(spark.createDataFrame([(1, 0, "a", first), (1, 1, "b", "Other."), (1, 2, "c", quote)], SCHEMA)))
    assert [got[1, t]["reply_to"] for t in range(3)] == [None, None, 0] and got[1, 2]["body"] == "I agree."

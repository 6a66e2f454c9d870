from pyspark.sql import functions as F

from tickspark.llm.chat_format import format_conversations, loss_text, parse_turns

TURNS = "conv_id bigint, turn bigint, role string, text string"


def read(df):
    out = format_conversations(df)
    return {r.conv_id: r for r in out.select("conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"),
                                             loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_round_trip_of_hostile_texts(spark):
    texts = ["", "\\", "\\h", "### user: x", "</turn>", "</turn>\n### assistant: y", "<part>", "####", "\\\\b\\", "</turn", "é\U0001F600\n\n", "a" * 20_000]
    roles = ["user", "assistant", "assistant", "a: b", "###", "", "assistant"]
    rows = [(c, i, roles[(i * c + i) % len(roles)], texts[(i + c) % len(texts)]) for c in range(1, 9) for i in range(12)]
    got = read(spark.createDataFrame(rows, TURNS))
    for c in range(1, 9):
        mine = [(r, t) for k, _, r, t in rows if k == c]
        assert [tuple(t) for t in got[c].turns] == mine
        assert got[c].loss == "".join(t for r, t in mine if r == "assistant")


def test_adjacent_turns_are_merged_in_order(spark):
    rows = [(1, 3, "assistant", "c"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 2, "user", "b")]
    r = read(spark.createDataFrame(rows, TURNS))[1]
    assert r.formatted == "### user: a<part>b<part>b</turn>\n### assistant: c</turn>\n"


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (None, None, None, None), (2, 1, None, None), (3, 1, "assistant", None)]
    df = spark.createDataFrame(rows, TURNS).withColumn("t", F.lit(1)).withColumn("pieces", F.lit(2))
    got = read(df)
    assert [tuple(t) for t in got[None].turns] == [("", ""), ("user", "x")]
    assert [tuple(t) for t in got[2].turns] == [("", "")] and got[3].loss == ""
    assert format_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = format_conversations(spark.createDataFrame([], TURNS))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))

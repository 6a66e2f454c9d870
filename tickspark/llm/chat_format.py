"""Chat formatting with Spark expressions only.

``format_conversations`` sorts the turns of a conversation, merges adjacent turns of one role and
concatenates them::

    ### user: first text<part>second text</turn>
    ### assistant: answer</turn>

A backslash and the control strings are written as codes inside texts and roles, so no text can
end a turn or start one, and ``parse_turns`` gets back every turn as it came. ``loss_spans`` marks the
places of assistant texts in the formatted string.

Defined cases: a null text is an empty one, a null role an empty name. Turns with equal numbers follow
by role, then text; turns without a number come first. Repeated rows are turns of their own. Rows with
a null ``conv_id`` form one conversation. An empty table gives an empty table. Other columns are ignored.
A conversation comes out as one string, so its turns meet in one row by definition; nothing else
is gathered per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template and their codes. The backslash comes first when
#: writing and last when reading.
START, END, PART, COLON = "### ", "</turn>\n", "<part>", ": "
CODES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"), ("<part>", "\\p")]
ROLE_CODES = [*CODES, (":", "\\c")]


def escape(text: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes: list[tuple[str, str]] = CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans`` (code points from 0, end exclusive) of each conversation.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``.
    """
    rows = turns.select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    first_of_run = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (
        F.get("turns", i - 1)["role"] != F.get("turns", i)["role"]))
    runs = sorted_turns.withColumn("starts", first_of_run).select("conv_id", F.transform("starts", lambda s, j: F.struct(
        F.get("turns", s)["role"].alias("role"),
        F.transform(F.slice("turns", s + 1, F.coalesce(F.get("starts", j + 1), F.size("turns")) - s),
                    lambda t: escape(t["text"])).alias("texts"))).alias("runs"))
    pieces = runs.select("conv_id", F.flatten(F.transform("runs", _pieces)).alias("pieces"))
    placed = pieces.select("conv_id", "pieces", F.aggregate(
        "pieces", F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS ARRAY<INT>)").alias("ends")),
        lambda acc, p: F.struct((acc["at"] + F.length(p["text"])).alias("at"),
                                F.array_append(acc["ends"], acc["at"] + F.length(p["text"])).alias("ends")),
        lambda acc: acc["ends"]).alias("ends"))
    spans = F.filter(F.transform("pieces", lambda p, i: F.struct(
        (F.get("ends", i) - F.length(p["text"])).alias("start"), F.get("ends", i).alias("end"), p["role"].alias("role"))),
        lambda s: s["role"] == F.lit(loss_role))
    return placed.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"], s["end"])).alias("loss_spans"))


def _pieces(run: Column) -> Column:
    """A merged turn as pieces: its marks, with no role, and its texts, with the role."""
    mark = lambda text: F.struct(text.alias("text"), F.lit(None).cast("string").alias("role"))
    texts = F.flatten(F.transform(run["texts"], lambda t, i: F.when(i == 0, F.array(F.struct(
        t.alias("text"), run["role"].alias("role")))).otherwise(F.array(mark(F.lit(PART)), F.struct(
            t.alias("text"), run["role"].alias("role"))))))
    head = mark(F.concat(F.lit(START), escape(run["role"], ROLE_CODES), F.lit(COLON)))
    return F.concat(F.array(head), texts, F.array(mark(F.lit(END))))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    segments = F.split(formatted, r"\Q" + END + r"\E")
    segments = F.slice(segments, 1, F.size(segments) - 1)

    def turns(segment: Column) -> Column:
        head = F.substring_index(segment, COLON, 1)
        role = unescape(F.substr(head, F.lit(len(START) + 1)), ROLE_CODES)
        body = F.substr(segment, F.length(head) + len(COLON) + 1)
        return F.transform(F.split(body, r"\Q" + PART + r"\E"),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(segments, turns))


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, with codes turned back."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")

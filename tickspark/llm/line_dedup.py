"""Line deduplication: runs of lines that occur again, found by prefix doubling over line-ID sequences.

A document is the sequence of its lines' IDs. Round ``k`` names the run of ``2 ** k`` lines at every position: the
name of the run of twice the length is made of the names of its two halves. Positions with one name are
an interval of the suffix array whose common prefix has at least that many lines; an interval with one position is
settled and leaves, so rounds end when no longer run occurs twice. Only equality of prefixes decides here,
so positions are kept by interval, not put in one total order, which would sort the positions of a very
common line in one task.

The first occurrence of a run, by key, text hash and position, stays. At every position the longest run that
occurred earlier is found: the rounds give its largest power of two, a descent through the smaller ones the rest.
In the descent positions with one prefix are a group, and a step divides it by the names of the next lines. A
position with an earlier one in its part moves on with that part; the first of a part stays and speaks for it, as it
shares the prefix and comes before the others, and it stands in the part as well for those that moved. So a level has at most
about two rows a position. A longest run is deleted whole where it has at least ``min_words`` words; shorter
lines go only with the run they belong to.

Defined cases: a null text stays null and has no lines; an empty text is one empty line. Lines are cut at ``\\n`` and
compared as they are. Rows with equal key and text are one document and get the same result. A document that
loses all lines gets an empty text. Null keys come last. Empty tables give empty tables. Other
columns stay; ``n_lines`` and ``n_deleted`` replace equal names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tickspark.llm.common import WORD, fitting_name, map_batches, stored


def _name(*parts: str) -> list[Column]:
    """A name of 128 bits."""
    return [F.xxhash64(F.lit(seed), *parts).alias(c) for seed, c in ((1, "na"), (2, "nb"))]


def _place() -> Column:
    return F.struct(F.col("key").isNull().alias("i"), F.col("key").alias("k"), F.col("h").alias("h"), F.col("pos").alias("p"))


def _is_first() -> Column:
    return F.col("key").eqNullSafe(F.col("fk")) & (F.col("h") == F.col("fh")) & (F.col("pos") == F.col("fp"))


def _shared(rows: DataFrame, names: list[str]) -> DataFrame:
    """``names`` that more than one row has, with the first place of each."""
    return stored(rows.groupBy(*names).agg(F.count("*").alias("n"), F.min(_place()).alias("first")).where("n > 1").select(
        *names, F.col("first.k").alias("fk"), F.col("first.h").alias("fh"), F.col("first.p").alias("fp")), "intervals")


def _repeated(runs: DataFrame) -> DataFrame:
    """``runs`` whose name occurs at more than one place, with ``later``: whether one of the others is earlier."""
    found = _shared(runs, ["na", "nb"])
    return runs.join(found, ["na", "nb"]).select("key", "h", "pos", "na", "nb", "w", (~_is_first()).alias("later"))


def _longest(rounds: list[DataFrame]) -> DataFrame:
    """``key``, ``h``, ``pos``, ``lines`` and ``w`` (words) of the longest run that occurred earlier, at each position that has one.

    ``rounds``: the repeated runs of 1, 2, 4, ... lines.
    """
    tops = None
    for k, active in enumerate(rounds):
        rows = active.where("later").select("key", "h", "pos", F.struct(F.lit(k).alias("k"), "na", "nb", "w").alias("top"))
        tops = rows if tops is None else tops.unionByName(rows)
    tops = stored(tops.groupBy("key", "h", "pos").agg(F.max("top").alias("top")).select("key", "h", "pos", "top.*"), "tops")
    columns = ["key", "h", "pos", "na", "nb", "w", "lines", "asks"]
    held = None
    for k in reversed(range(len(rounds))):
        size = F.lit(1 << k).cast("bigint")
        if held is not None:
            rest = rounds[k].select(F.col("key").alias("key2"), F.col("h").alias("h2"), F.col("pos").alias("pos2"),
                                    F.col("na").alias("na2"), F.col("nb").alias("nb2"), F.col("w").alias("w2"))
            tried = stored(held.join(rest, F.col("key").eqNullSafe(F.col("key2")) & (F.col("h") == F.col("h2")) & (
                F.col("pos") + F.col("lines") == F.col("pos2")), "left").select(*columns, "na2", "nb2", "w2"), "tried")
            names = ["na", "nb", "na2", "nb2"]
            parts = _shared(tried.where("na2 IS NOT NULL"), names)
            stays = F.struct("na", "nb", "w", "lines", "asks")
            moves = lambda asks: F.struct(*_name("na", "nb", "na2", "nb2"), (F.col("w") + F.col("w2")).alias("w"),
                                          (F.col("lines") + size).alias("lines"), asks.alias("asks"))
            to = F.when(F.col("fh").isNull(), F.array(stays)).when(_is_first(), F.array(stays, moves(F.lit(False)))).otherwise(
                F.array(moves(F.col("asks"))))
            held = tried.join(parts, names, "left").select("key", "h", "pos", F.explode(to).alias("to")).select("key", "h", "pos", "to.*")
        started = tops.where(F.col("k") == k).select(*columns[:6], size.alias("lines"), F.lit(True).alias("asks"))
        if k:  # runs of one line have nothing left to try
            started = started.unionByName(rounds[k].where("NOT later").select(*columns[:6], size.alias("lines"), F.lit(False).alias("asks")))
        held = started if held is None else held.unionByName(started)
        held = stored(held, "held")
    return held.where("asks").select("key", "h", "pos", "lines", "w")


def later_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 8) -> DataFrame:
    """``key``, ``h`` (xxhash64 of the text), ``pos`` and ``lines``: runs that occurred earlier, the longest at each position."""
    lines = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    runs = stored(lines.select("key", "h", "pos", *_name("line"), F.regexp_count("line", F.lit(WORD)).cast("bigint").alias("w")), "lines")
    rounds: list[DataFrame] = []
    while True:
        size = 1 << len(rounds)
        active = stored(_repeated(runs), "repeated")
        if size == 1:
            # Rows of one document more than once. Apart from the join, whose large partitions Spark may then split.
            active = stored(active.distinct(), "repeated")
        if active.isEmpty():
            break
        rounds.append(active)
        half = active.select(F.col("key").alias("key2"), F.col("h").alias("h2"), (F.col("pos") - size).alias("pos2"),
                             F.col("na").alias("na2"), F.col("nb").alias("nb2"), F.col("w").alias("w2"))
        joined = active.join(half, F.col("key").eqNullSafe(F.col("key2")) & (F.col("h") == F.col("h2")) & (F.col("pos") == F.col("pos2")))
        runs = stored(joined.select("key", "h", "pos", *_name("na", "nb", "na2", "nb2"), (F.col("w") + F.col("w2")).alias("w")), "runs")
    if not rounds:
        return runs.select("key", "h", "pos", F.lit(0).cast("bigint").alias("lines")).limit(0).withColumnRenamed("key", key)
    return _longest(rounds).where(F.col("w") >= min_words).select(F.col("key").alias(key), "h", "pos", "lines")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 8, n_lines: str = "n_lines",
                n_deleted: str = "n_deleted") -> DataFrame:
    """``docs`` with later copies of repeated runs taken out of ``text``, and columns ``n_lines`` and ``n_deleted``."""
    docs = docs.drop(n_lines, n_deleted)
    spans = later_copies(docs, key, text, min_words).groupBy(F.col(key).alias("k"), F.col("h").alias("h")).agg(
        F.collect_list(F.struct("pos", "lines")).alias("runs"))
    spans = stored(spans, "deleted")
    k, h, runs = (fitting_name(docs, c) for c in ("k", "h", "runs"))
    wide = docs.join(spans.select(F.col("k").alias(k), F.col("h").alias(h), F.col("runs").alias(runs)),
                     F.col(key).eqNullSafe(F.col(k)) & (F.xxhash64(text) == F.col(h)), "left").select(*docs.columns, runs)
    place = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField(n_lines, LongType()), StructField(n_deleted, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, gone = [], [], []
            for t, cut in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                lines = t.split("\n") if t is not None else []
                total.append(len(lines))
                if cut:
                    edge = np.zeros(len(lines) + 1, np.int64)
                    np.add.at(edge, [c["pos"] for c in cut], 1)
                    np.add.at(edge, [c["pos"] + c["lines"] for c in cut], -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    gone.append(int(len(lines) - keep.sum()))
                    t = "\n".join([lines[i] for i in np.flatnonzero(keep)])
                else:
                    gone.append(0)
                texts.append(t)
            columns = [*batch.columns[:-1], pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], n_lines, n_deleted])

    return map_batches(wide, run, schema)

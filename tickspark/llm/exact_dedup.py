"""Exact duplicates of normalised texts, by composable polynomial fingerprints and a comparison in chunks.

A text is normalised (runs of ASCII white space become one space) and its UTF-8 bytes are cut into chunks. The
fingerprint of bytes b_1 ... b_n is the polynomial b_1 * r^(n-1) + ... + b_n modulo 2^61 - 1, at two points r. Chunk hashes
compose: the text's is the sum of each chunk's times r to the number of bytes behind it. So the chunks of a huge text are
hashed by many tasks and added up by a ``groupBy``; those of others are added where they are made.

Rows of equal fingerprint and length are counted by a ``groupBy``. Where there are several, their chunks are compared:
equal chunks at the same place of a fingerprint collapse, before and after they move, and a place that is left with
two different chunks gives a collision away. Texts of such a fingerprint are told apart by their SHA-256 as well. No task holds
a group or a huge text twice: only chunks move.

Defined cases: a null text is an empty one; white space at the ends becomes one space and stays, non-ASCII space is text.
Of equal texts the smallest key stays, null keys being the largest; of rows with that key exactly one stays. Repeated rows
are rows of their own. An empty table gives an empty one. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import map_batches, stored
from tickspark.llm.spread import numbered, spread_join

MODULUS = 2**61 - 1
#: Points at which the polynomials are taken; any two numbers below the modulus will do.
POINTS = tuple(int.from_bytes(hashlib.sha256(f"point {i}".encode()).digest()[:7], "big") for i in (1, 2))
CHUNK = 1 << 16
#: Texts of more bytes are hashed by several tasks.
HUGE = 1 << 20
#: Fingerprints that occur more than once, up to which their list is sent to all tasks (24 bytes each).
LISTED = 200_000
# Runs that are not one space already.
_BLANKS = re.compile(rb"[\t-\r][\t-\r ]*| [\t-\r ]+")


def normalised(text: bytes) -> bytes:
    return _BLANKS.sub(b" ", text)


class Fingerprint:
    """Chunk hashes at both points, for chunks of up to ``chunk`` bytes."""

    def __init__(self, modulus: int, chunk: int) -> None:
        self.modulus = modulus
        self.powers = []
        for r in POINTS:
            powers, p = np.empty(chunk, np.uint64), 1
            for i in range(chunk - 1, -1, -1):
                powers[i], p = p, p * r % modulus
            # A byte times half a power, 2**16 times, stays below 2**56.
            self.powers.append((powers >> np.uint64(32), powers & np.uint64(0xFFFFFFFF)))

    def of(self, chunk: bytes) -> tuple[int, int]:
        values = np.frombuffer(chunk, np.uint8).astype(np.uint64)
        n = len(values)
        return tuple(((int(values @ high[len(high) - n:]) << 32) + int(values @ low[len(low) - n:])) % self.modulus
                     for high, low in self.powers)

    def shifted(self, hashes: tuple[int, int], behind: int) -> tuple[int, int]:
        """What a chunk adds to a text's fingerprint when ``behind`` bytes follow it."""
        return tuple(h * pow(r, behind, self.modulus) % self.modulus for h, r in zip(hashes, POINTS))


def chunks(text: bytes, size: int) -> list[bytes]:
    return [text[a: a + size] for a in range(0, len(text), size)]


def chunk_rows(docs: DataFrame, key: str, column: str, chunk: int, huge: int, modulus: int) -> DataFrame:
    """A row per text, with its fingerprint ``f1``, ``f2`` unless it is huge, its SHA-256 and its ``chunks``.

    A huge text has a row for each chunk besides (``behind`` not null), and no chunks in its own.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, prints = TaskContext.get().partitionId(), 0, Fingerprint(modulus, chunk)
        fields = ["row", "key", "size", "behind", "f1", "f2", "sha", "chunks"]
        types = [pa.int64(), None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary())]
        for batch in batches:
            held, weight, place = {f: [] for f in fields}, 0, []

            def flush(held=held, place=place, batch=batch):
                columns = [batch.column(0).take(pa.array(place, pa.int64())) if f == "key" else pa.array(held[f], t) for f, t in zip(fields, types)]
                return pa.RecordBatch.from_arrays(columns, fields)

            for i, text in enumerate(batch.column(1)):
                text = normalised(text.as_py() or b"")
                row, parts, seen = numbered(seen, task), chunks(text, chunk), seen + 1
                sha, n = hashlib.sha256(text).digest(), len(text)
                if n > huge:
                    made = [(None, None, None, sha, []), *[(n - a * chunk - len(p), None, None, None, [p]) for a, p in enumerate(parts)]]
                else:
                    f1 = f2 = 0
                    for p in parts:
                        (a, b), (h1, h2) = prints.shifted((f1, f2), len(p)), prints.of(p)
                        f1, f2 = (a + h1) % modulus, (b + h2) % modulus
                    made = [(None, f1, f2, sha, parts)]
                for values in made:
                    place.append(i)
                    for f, v in zip(("row", "size", "behind", "f1", "f2", "sha", "chunks"), (row, n, *values)):
                        held[f].append(v)
                weight += n
                if weight > 1 << 24:
                    yield flush()
                    weight = 0
                    for values in (*held.values(), place):
                        values.clear()
            if place:
                yield flush()

    return map_batches(docs.select(F.col(key).alias("key"), F.col(column).cast("binary").alias("text")), run, (
        f"row bigint, key {kind}, size bigint, behind bigint, f1 bigint, f2 bigint, sha binary, chunks array<binary>"))


def composed(huge_chunks: DataFrame, chunk: int, modulus: int) -> DataFrame:
    """``row``, ``f1`` and ``f2`` of huge texts, from chunks hashed by many tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprint(modulus, chunk)
        for batch in batches:
            terms = [prints.shifted(prints.of(c.as_py()), b.as_py()) for c, b in zip(batch.column(2), batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t[0] for t in terms], pa.int64()), pa.array([t[1] for t in terms], pa.int64())], ["row", "t1", "t2"])

    dealt = huge_chunks.select("row", "behind", F.col("chunks")[0].alias("chunk")).repartition("row", "behind")
    total = lambda t: F.pmod(F.sum(F.col(t).cast("decimal(38,0)")), F.lit(modulus).cast("decimal(38,0)")).cast("bigint")
    return map_batches(dealt, run, "row bigint, t1 bigint, t2 bigint").groupBy("row").agg(total("t1").alias("f1"), total("t2").alias("f2"))


PRINT = ["f1", "f2", "size"]


def collisions(texts: DataFrame, pieces: DataFrame, repeated: DataFrame, listed: int, chunk: int) -> DataFrame:
    """The fingerprints among ``repeated`` whose texts differ somewhere; ``pieces`` are the chunks of huge texts."""
    if repeated.limit(listed + 1).count() <= listed:
        of_many = F.broadcast(repeated.select(*PRINT))
        texts, pieces = (t.join(of_many, PRINT, "left_semi") for t in (texts, pieces))
    no = F.floor((F.col("size") - F.col("behind") - 1) / chunk).cast("int")
    every = texts.select(*PRINT, F.posexplode("chunks").alias("no", "chunk")).unionByName(
        pieces.select(*PRINT, no.alias("no"), F.col("chunks")[0].alias("chunk")))
    same = every.groupBy(*PRINT, "no", "chunk").agg(F.count("*").alias("n"))
    return same.groupBy(*PRINT, "no").agg(F.count("*").alias("n")).where("n > 1").select(*PRINT).distinct()


def exact_duplicates(docs: DataFrame, key: str = "doc_id", column: str = "text", chunk: int = CHUNK, huge: int = HUGE,
                     modulus: int = MODULUS, listed: int = LISTED) -> DataFrame:
    """One row per document: ``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``modulus`` is for tests: a small one makes fingerprints collide.
    """
    if not 0 < chunk <= CHUNK:
        raise ValueError(f"chunks have 1 to {CHUNK} bytes")
    made = stored(chunk_rows(docs, key, column, chunk, huge, modulus), "chunks", "zstd")
    whole, pieces = made.where("behind IS NULL AND f1 IS NOT NULL"), made.where("behind IS NOT NULL")
    large = made.where("behind IS NULL AND f1 IS NULL").drop("f1", "f2")
    found = stored(composed(pieces, chunk, modulus), "composed")
    narrow = ["row", "key", *PRINT, "sha"]
    rows = stored(whole.select(*narrow).unionByName(large.join(found, "row").select(*narrow)), "fingerprints")
    repeated = stored(rows.groupBy(*PRINT).agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    bad = stored(collisions(whole, pieces.drop("f1", "f2").join(found, "row"), repeated, listed, chunk), "collisions")
    if bad.isEmpty():
        rows = rows.withColumn("apart", F.lit(b""))
    else:  # only texts whose fingerprint collides need their digest to tell them apart
        marked = rows.join(bad.withColumn("hit", F.lit(True)), PRINT, "left")
        rows = stored(marked.withColumn("apart", F.when(F.col("hit"), F.col("sha")).otherwise(F.lit(b""))).drop("hit"), "apart")
    same = [*PRINT, "apart"]
    groups = stored(rows.groupBy(*same).agg(F.count("*").alias("group_size"), F.min("key").alias("keep_id")), "groups")
    members = stored(spread_join(rows, groups, same), "members")
    tied = (F.col("group_size") > 1) & F.col("key").eqNullSafe(F.col("keep_id"))
    stays = members.where(tied).groupBy(*same).agg(F.min("row").alias("stays"))
    first = spread_join(members.where(tied), stays, same).withColumn("kept", F.col("row") == F.col("stays")).drop("stays")
    rest = members.where(~tied).withColumn("kept", F.col("group_size") == 1)
    return first.unionByName(rest).select(
        F.col("key").alias(key), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))

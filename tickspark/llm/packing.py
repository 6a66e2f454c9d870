"""Best-fit packing of documents into sequences of fixed length, by best-two-fit.

A bin is filled greedily with the longest pieces that fit; then its smallest piece is replaced, as long
as that helps, by the two unpacked pieces whose sum fills the widened gap best.

Only a piece's length matters for packing and there are at most ``capacity`` lengths. So the plan is made
from the histogram of lengths: each step builds one bin and repeats it as often as the remaining counts
allow, which uses up one length or leaves fewer of it than one bin takes. The plan has a few entries
per length however many documents there are. Spark numbers the pieces of each length, and a piece's number
tells its bin and place. A hot length is numbered in hash buckets whose counts are added up.

Defined cases: null and empty texts become one piece that holds the end token. Repeated rows are documents
of their own. Columns of the input named like those added are replaced; other columns stay. An empty
table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickspark.llm.common import fitting_name, map_batches, stored
from tickspark.llm.tokens import encoder

ROWS_PER_BUCKET = 20_000


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id",
                 text: str = "text", ids: bool = True) -> DataFrame:
    """The pieces of every text: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked, ``ids``.

    A document is its ids and ``end_id``. Only documents longer than ``capacity`` are cut; all pieces but the
    first have ``capacity`` ids.
    """
    rows = docs.select(key, text)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * ids
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer_path)
        for batch in batches:
            at, piece, start, length, crc, values = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                raw = code.encode(t or "") + end
                n = len(raw) // 4
                a, b = 0, (n - 1) % capacity + 1
                k = 0
                while a < n:
                    at.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    part = raw[4 * a: 4 * b]
                    crc.append(zlib.crc32(part))
                    if ids:
                        values.append(np.frombuffer(part, "<i4"))
                    a, b, k = b, b + capacity, k + 1
            out = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if ids:
                out.append(pa.array(values, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return map_batches(rows, run, schema)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for so many pieces of each length: (how many bins, [(length, pieces of it in each bin)])."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    lengths = np.arange(capacity + 1)
    plan = []
    while left.any():
        used = np.zeros_like(left)
        gap = capacity

        def longest_at_most() -> np.ndarray:
            return np.maximum.accumulate(np.where(left > used, lengths, 0))

        while gap and (n := int(longest_at_most()[gap])):
            take = min(int(left[n] - used[n]), gap // n)
            used[n] += take
            gap -= take * n
        while gap and used.sum() > 1:
            small = int(np.flatnonzero(used)[0])
            fits, wide = longest_at_most(), gap + small
            a = np.flatnonzero(left > used)
            a = a[(a > 0) & (a < wide)]
            b = fits[np.minimum(wide - a, a)]
            alone = (b == a) & (left[a] - used[a] < 2)
            b = np.where(alone, fits[np.maximum(a - 1, 0)], b)
            total = np.where(b > 0, a + b, 0)
            if not len(a) or total.max() <= small:
                break
            i = int(total.argmax())
            used[small] -= 1
            used[a[i]] += 1
            used[b[i]] += 1
            gap = wide - int(total[i])
        held = np.flatnonzero(used)
        times = int((left[held] // used[held]).min())
        left[held] -= times * used[held]
        plan.append((times, [(int(n), int(used[n])) for n in held[::-1]]))
    return plan


def pack(pieces: DataFrame, capacity: int = 1024, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: its sequence and its place there, without gaps.

    ``length`` is from 1 to ``capacity``. Rows with another or no length raise an error.
    """
    pieces = stored(pieces.drop("sequence_id", "offset"), "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}  # at most ``capacity`` rows
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    first, entries, taken = 0, [], dict.fromkeys(counts, 0)
    for times, held in best_two_fit(counts, capacity):
        offset = 0
        for n, each in held:
            entries.append((n, taken[n], each, first, offset))
            taken[n] += times * each
            offset += n * each
        first += times
    entries.sort()
    plan = np.array(entries, np.int64).reshape(-1, 5)

    buckets = max(64, sum(counts.values()) // ROWS_PER_BUCKET)
    bucket, place, before, number = (fitting_name(pieces, c) for c in ("bucket", "place", "before", "number"))
    sortable = [c for c, kind in pieces.dtypes if not kind.startswith(("map", "variant"))]
    salted = pieces.withColumn(bucket, F.pmod(F.xxhash64(*sortable), F.lit(buckets)))
    ranked = salted.withColumn(place, F.row_number().over(Window.partitionBy(length, bucket).orderBy(*sortable)))
    starts = salted.groupBy(length, bucket).count().select(length, bucket, (F.sum("count").over(
        Window.partitionBy(length).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))).alias(before))
    numbered = ranked.join(starts, [length, bucket]).select(
        *pieces.columns, (F.coalesce(before, F.lit(0)) + F.col(place) - 1).alias(number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = plan[:, 0] << 48 | plan[:, 1]
        for batch in batches:
            n = batch.column(batch.schema.get_field_index(length)).to_numpy(zero_copy_only=False).astype(np.int64)
            r = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            e = plan[np.searchsorted(key, n << 48 | r, side="right") - 1] if len(n) else plan[:0]
            r = r - e[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(e[:, 3] + r // np.maximum(e[:, 2], 1)), pa.array(e[:, 4] + r % np.maximum(e[:, 2], 1) * n)],
                [*batch.schema.names[:-1], "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructType
    schema = StructType([*pieces.schema.fields]).add("sequence_id", LongType()).add("offset", LongType())
    return map_batches(numbered, run, schema)

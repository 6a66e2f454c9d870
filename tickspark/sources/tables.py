"""Partitioned tick tables: scans, idempotent writes, exports and maintenance.

Facts are Parquet partitioned by ``event_date`` and sorted by (symbol_id, time) inside the files,
so a day prunes directories and a symbol prunes row groups.
"""

from __future__ import annotations

import hashlib
import math
import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark import functions as X
from tickspark.operators.joins import anti_existing
from tickspark.operators.ordered import pick_row, whole_row_hash
from tickspark.operators.ticks import optional_symbol_filter, time_slice
from tickspark.schemas import L1_CSV

DATE = "event_date"
FILE_BYTES = 128 << 20
#: Buckets of a bar table: the tasks that read or join it.
BUCKETS = 256
#: Days of one batch up to which its times, and not only its days, narrow what it is compared with.
MAX_SPANS = 100


def with_event_date(df: DataFrame, ts: str = "ts_exchange") -> DataFrame:
    return df.withColumn(DATE, F.to_date(ts))


def scan_ticks(spark: SparkSession, path: str, start: str, end: str, ids: list[int] | None = None,
               ts: str = "ts_exchange") -> DataFrame:
    """Ticks of ``[start, end)``: partitions are pruned by date, row groups by symbol and time."""
    return optional_symbol_filter(time_slice(spark.read.parquet(path), start, end, ts), ids)


def _root(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """Partition days, from the directory names; no data is read."""
    root, fs = _root(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(DATE + "="))


def day_files(spark: SparkSession, path: str, day: str) -> list[tuple[str, int]]:
    """Name and bytes of a day's data files, from the listing."""
    root, fs = _root(spark, f"{path}/{DATE}={day}")
    files = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(root) if s.isFile()] if fs.exists(root) else []
    return sorted(f for f in files if not f[0].startswith(("_", ".")))


def listing_hash(files: list[tuple[str, int]]) -> str:
    """Changes whenever a day is written, since every write names its files anew."""
    return hashlib.sha256(repr(files).encode()).hexdigest()[:32]


def mark_day(spark: SparkSession, path: str, day: str, kind: str, value: str) -> None:
    """Leave a hidden, empty file in a day's folder; it goes when the day is overwritten or dropped."""
    root, fs = _root(spark, f"{path}/{DATE}={day}")
    for s in fs.listStatus(root):
        if s.getPath().getName().startswith(f"_{kind}-"):
            fs.delete(s.getPath(), False)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(root, f"_{kind}-{value}"), True).close()


def is_marked(spark: SparkSession, path: str, day: str, kind: str, value: str) -> bool:
    root, fs = _root(spark, f"{path}/{DATE}={day}/_{kind}-{value}")
    return fs.exists(root)


def drop_days(spark: SparkSession, path: str, days: list[str]) -> None:
    _, fs = _root(spark, path)
    for day in days:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DATE}={day}"), True)


def write_partitioned(df: DataFrame, path: str, sort: list[str], mode: str = "append", **options) -> None:
    """Write into date partitions, sorted by ``sort``.

    Ranges of (date, sort) are balanced by sampling, so neither a hot day nor a hot symbol lands in
    one task, and each file covers a narrow symbol range. Adaptive execution merges small ranges.
    """
    (df.repartitionByRange(DATE, *sort).sortWithinPartitions(DATE, *sort)
     .write.mode(mode).options(**options).partitionBy(DATE).parquet(path))


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` written once under ``path``, where readers of the table do not see it, and read from there.

    A batch is needed several times (its days, its keys, the sampling of a range); this way its source and parsers
    run once, and what they gave is the same each time.
    """
    spark = df.sparkSession
    root, fs = _root(spark, f"{path}/_staged-{uuid.uuid4().hex}")
    try:
        df.write.parquet(root.toString())
        yield spark.read.schema(df.schema).parquet(root.toString())
    finally:
        fs.delete(root, True)


def _beside(path: str) -> str:
    """The folder ``path`` lies in: an overwrite of ``path`` leaves what is staged there alone."""
    return posixpath.dirname(path.rstrip("/")) or "."


def _on_days(live: DataFrame, days: list) -> DataFrame:
    """Live rows of the given days, as a filter on the partitions; None is the partition of rows without a time."""
    there = F.col(DATE).isin([d for d in days if d is not None])
    return live.filter(there | F.col(DATE).isNull() if None in days else there)


def _touched_days(live: DataFrame, rows: DataFrame) -> DataFrame:
    """Live rows of the days that ``rows`` touch."""
    return _on_days(live, [r[0] for r in rows.select(DATE).distinct().collect()])  # one row per calendar day


def _touched_times(live: DataFrame, rows: DataFrame, ts: str) -> DataFrame:
    """Live rows between the first and last time that ``rows`` have on each of their days.

    Days are partitions and a batch's files cover its narrow time, so what is left of the live table is found from
    partition names and Parquet statistics: the stored keys a batch is compared with do not grow with the day.
    """
    spans = rows.groupBy(DATE).agg(F.min(ts).alias("first"), F.max(ts).alias("last")).collect()  # one row per calendar day
    near = [(F.col(DATE) == r[DATE]) & F.col(ts).between(F.lit(r["first"]), F.lit(r["last"])) if r[DATE] else F.col(DATE).isNull()
            for r in spans[:MAX_SPANS]]
    live = _on_days(live, [r[DATE] for r in spans])
    return live.filter(reduce(or_, near, F.lit(False))) if len(spans) <= MAX_SPANS else live


def write_ticks_idempotent(df: DataFrame, path: str, key: list[str], sort: list[str] | None = None,
                           ts: str = "ts_exchange", first_by: str = "ts_ingest",
                           all_days: bool = False) -> None:
    """Append rows whose key is not stored yet; among new duplicates the earliest arrival wins.

    ``df`` is evaluated once, see :func:`staged`. Duplicates collapse in a map-side combined min_by, so a key delivered
    many times is cheap. A message delivered again carries its exchange time, so only stored rows of the times the
    batch has are read; ``all_days`` compares with the whole table.
    """
    spark = df.sparkSession
    with staged(with_event_date(df, ts), path) as batch:
        rows = dedup_first(batch, key, first_by)
        if stored_days(spark, path):
            live = spark.read.schema(rows.schema).parquet(path)
            rows = anti_existing(rows, live if all_days else _touched_times(live, batch, ts), key)
        write_partitioned(rows, path, sort or ["symbol_id", ts])


def dedup_first(df: DataFrame, key: list[str], first_by: str = "ts_ingest") -> DataFrame:
    """One row per key: the earliest by ``first_by``, a NULL being the earliest, then by a hash of the row."""
    rest = [c for c in df.columns if c not in key]
    at = F.coalesce(F.unix_micros(first_by), F.lit(-(10**17))).cast("decimal(18,0)")
    rank = (at * F.expr("100000000000000000000BD") + whole_row_hash(rest)).cast("decimal(38,0)")
    return pick_row(df, key, rank, last=False)


def upsert_latest(new: DataFrame, path: str, key: list[str], ts: str = "ts_exchange") -> None:
    """Insert or replace rows by key: the new row wins, among several the one with the highest hash. Only the touched
    days are rewritten; ``new`` is evaluated once."""
    spark = new.sparkSession
    with staged(with_event_date(new, ts), path) as batch:
        rows = batch.withColumn("_version", F.lit(1))
        if stored_days(spark, path):
            live = _touched_days(spark.read.schema(batch.schema).parquet(path), batch)
            rows = rows.unionByName(live.withColumn("_version", F.lit(0)))
        rest = [c for c in rows.columns if c not in key]
        rank = (F.col("_version").cast("decimal(1,0)") * F.expr("100000000000000000000BD") + whole_row_hash(rest)).cast("decimal(38,0)")
        # Files of the days read above are replaced only when the job commits, after all reads.
        write_partitioned(pick_row(rows, key, rank).drop("_version"), path, key, "overwrite", partitionOverwriteMode="dynamic")


def open_bucketed(spark: SparkSession, table: str, path: str, columns: str, by: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The bucketed table under ``path`` as ``table`` of the session's catalog, which a new session has to be told of.

    ``columns`` is its DDL without the day. Tables of equal ``by`` and ``buckets`` join on ``by`` without an exchange:
    a bucket is hashed by symbol and time, so a hot symbol fills all of them alike.
    """
    names = ", ".join(f"`{c}`" for c in by)
    root, fs = _root(spark, path)
    fs.mkdirs(root)
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {table} ({columns}, {DATE} DATE) USING parquet PARTITIONED BY ({DATE})
                  CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS LOCATION '{path}'""")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


def write_bucketed(df: DataFrame, table: str, path: str, by: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Store the days of ``df`` in a bucketed table, replacing those it already has; returns the table.

    ``by`` is the symbol and a time column. One task writes one bucket, so a day has one sorted file per bucket.
    """
    spark = df.sparkSession
    rows = with_event_date(df, by[-1])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    stored = open_bucketed(spark, table, path, columns, by, buckets)
    (rows.select(*stored.columns).repartition(buckets, *by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").insertInto(table))
    return spark.table(table)


def export_csv(df: DataFrame, path: str, order: list[str], by: list[str] | None = None) -> None:
    """Gzip CSV with header; each file is in time order and files follow each other in range order.

    ``df`` is evaluated once, see :func:`staged`: finding the ranges reads it before they are filled.
    """
    with staged(df, _beside(path)) as rows:
        writer = rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
        if by:
            writer = writer.partitionBy(*by)
        writer.csv(path, header=True, compression="gzip", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def export_parquet(df: DataFrame, path: str, ts: str = "ts_second", sort: list[str] | None = None) -> None:
    write_partitioned(with_event_date(df, ts), path, sort or ["symbol_id", ts], "overwrite",
                      partitionOverwriteMode="dynamic")


def rotate_files(l1: DataFrame, path: str, hours: int = 24, max_records: int = 5_000_000) -> None:
    """One folder of gzip CSV files per symbol and rotation window; big windows split by count.

    A run replaces the windows it has records of and leaves the others, so pass whole windows; repeating it changes
    nothing. ``l1`` is evaluated once, see :func:`staged`.
    """
    window = X.time_bucket(F.timestamp_micros("timestamp"), f"{hours} hours")
    with staged(l1, _beside(path)) as rows:
        (rows.withColumn("rotation", F.date_format(window, "yyyyMMdd_HHmmss"))
         .repartitionByRange("symbol", "timestamp").sortWithinPartitions("symbol", "timestamp")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records)
         .partitionBy("symbol", "rotation")
         .csv(path, header=True, compression="gzip"))


def load_fallback_csv(spark: SparkSession, path: str, schema=L1_CSV) -> DataFrame:
    """Read exported CSV back; a malformed line keeps its text in ``_corrupt_record``."""
    full = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}, _corrupt_record string"
    return spark.read.csv(path, schema=full, header=True, mode="PERMISSIVE",
                          timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", columnNameOfCorruptRecord="_corrupt_record")


def retention(spark: SparkSession, path: str, cutoff: str, ts: str = "ts_exchange",
              sort: list[str] | None = None) -> None:
    """Drop rows before ``cutoff``: whole days by directory, the boundary day by rewriting it."""
    at = X.utc_instant(cutoff)
    boundary = at.date().isoformat()
    days = stored_days(spark, path)
    if boundary in days and at.time() != at.time().min:
        day = spark.read.parquet(path).filter(F.col(DATE) == F.to_date(F.lit(boundary)))
        kept = day.filter(F.col(ts) >= X.instant(cutoff))
        if kept.isEmpty():
            drop_days(spark, path, [boundary])
        else:
            write_partitioned(kept, path, sort or ["symbol_id", ts], "overwrite", partitionOverwriteMode="dynamic")
    drop_days(spark, path, [d for d in days if d < boundary])


def archive(spark: SparkSession, path: str, archive_path: str, cutoff: str, ts: str = "ts_exchange",
            sort: list[str] | None = None) -> None:
    """Copy rows before ``cutoff`` to the archive, then drop them from the live table.

    The copy overwrites the archive's days and equal rows are stored once, in the first run as in a repeated
    one; dropping starts only after the copy has been committed.
    """
    live = spark.read.parquet(path)
    old = live.filter((F.col(DATE) <= F.lit(X.utc_instant(cutoff).date())) & (F.col(ts) < X.instant(cutoff)))
    if stored_days(spark, archive_path):
        old = old.unionByName(_touched_days(spark.read.parquet(archive_path), old))
    old = old.dropDuplicates()
    write_partitioned(old, archive_path, sort or ["symbol_id", ts], "overwrite", partitionOverwriteMode="dynamic",
                      compression="zstd")
    retention(spark, path, cutoff, ts, sort)


def fragmented_days(spark: SparkSession, path: str, before_day: str, file_bytes: int = FILE_BYTES) -> dict[str, int]:
    """Days before ``before_day`` in more files than their bytes fill, and how many files they should have.

    Read from the listing alone. A day that :func:`compact` has written and nobody has touched since is left out,
    however its files turned out.
    """
    plan = {}
    for day in stored_days(spark, path):
        if day < before_day:
            files = day_files(spark, path, day)
            wanted = max(1, math.ceil(sum(size for _, size in files) / file_bytes))
            if len(files) > wanted and not is_marked(spark, path, day, "compacted", listing_hash(files)):
                plan[day] = wanted
    return plan


def compact(spark: SparkSession, path: str, before_day: str, ts: str = "ts_exchange", sort: list[str] | None = None,
            file_bytes: int = FILE_BYTES) -> list[str]:
    """Rewrite fragmented days before ``before_day`` into few, sorted, zstd-compressed files; returns those days.

    Each is a job of its own, committed on its own: a run that was cut short goes on where it stopped. Whole days are
    left alone, so the cost follows what was written since the last run, not the history.
    """
    order = sort or ["symbol_id", ts]
    plan = fragmented_days(spark, path, before_day, file_bytes)
    for day, files in plan.items():
        rows = spark.read.parquet(path).filter(F.col(DATE) == F.to_date(F.lit(day)))
        (rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite")
         .options(partitionOverwriteMode="dynamic", compression="zstd").partitionBy(DATE).parquet(path))
        mark_day(spark, path, day, "compacted", listing_hash(day_files(spark, path, day)))
    return list(plan)


def migrate_layout(spark: SparkSession, source: str, path: str, ts: str = "ts_exchange",
                   sort: list[str] | None = None) -> None:
    """Move an unpartitioned history into the date-partitioned layout."""
    write_partitioned(with_event_date(spark.read.parquet(source), ts), path, sort or ["symbol_id", ts],
                      "overwrite", partitionOverwriteMode="dynamic")


def latest_version(df: DataFrame, key: list[str], version: str) -> DataFrame:
    """One row per key: the one with the highest version."""
    return pick_row(df, key, F.col(version))

"""Stored tables: idempotent writes, upserts, retention, archive, compaction, pruning."""

import glob
import os

from pyspark.sql import functions as F

from tickspark.sources import tables as S

KEY = ["symbol_id", "ts_exchange", "update_id"]


def rows(spark, *items):
    return spark.createDataFrame([(s, t, u, i) for s, t, u, i in items],
                                 "symbol_id long, t string, update_id long, i string").select(
        "symbol_id", F.to_timestamp("t").alias("ts_exchange"), "update_id", F.to_timestamp("i").alias("ts_ingest"))


A = (1, "2024-01-01 10:00:00", 1, "2024-01-01 10:00:01")
A_LATE = (1, "2024-01-01 10:00:00", 1, "2024-01-01 10:00:09")
B = (1, "2024-01-02 10:00:00", 2, "2024-01-02 10:00:01")
C = (2, "2024-01-03 23:59:59", 3, "2024-01-04 00:00:01")


def ids(spark, path):
    return sorted((r.symbol_id, r.update_id) for r in spark.read.parquet(path).collect())


def test_first_arrival_wins_within_and_across_batches(spark, tmp_path):
    p = str(tmp_path / "t")
    S.write_ticks_idempotent(rows(spark, A_LATE, A, B), p, KEY)
    S.write_ticks_idempotent(rows(spark, A_LATE, C), p, KEY)
    S.write_ticks_idempotent(rows(spark, A_LATE, C), p, KEY)
    assert ids(spark, p) == [(1, 1), (1, 2), (2, 3)]
    first = spark.read.parquet(p).filter("update_id = 1").first()
    assert first.ts_ingest.second == 1


def test_upsert_replaces_only_touched_days(spark, tmp_path):
    p = str(tmp_path / "t")
    S.upsert_latest(rows(spark, A, B, C), p, ["ts_exchange", "symbol_id"])
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{p}/event_date=2024-01-0[13]/*.parquet")}
    S.upsert_latest(rows(spark, (1, B[1], 99, B[3])), p, ["ts_exchange", "symbol_id"])
    assert ids(spark, p) == [(1, 1), (1, 99), (2, 3)]
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{p}/event_date=2024-01-0[13]/*.parquet")} == before


def test_retention_boundary(spark, tmp_path):
    p = str(tmp_path / "t")
    mid = (1, "2024-01-02 12:00:00", 5, B[3])
    S.write_ticks_idempotent(rows(spark, A, B, mid, C), p, KEY)
    S.retention(spark, p, "2024-01-02 12:00:00")
    assert ids(spark, p) == [(1, 5), (2, 3)]
    S.retention(spark, p, "2024-01-03")
    assert ids(spark, p) == [(2, 3)]
    S.retention(spark, p, "2024-01-03 00:00:00")
    assert ids(spark, p) == [(2, 3)]


def test_archive_can_be_repeated(spark, tmp_path):
    live, old = str(tmp_path / "t"), str(tmp_path / "a")
    S.write_ticks_idempotent(rows(spark, A, B, C), live, KEY)
    S.archive(spark, live, old, "2024-01-02 11:00:00")
    S.write_ticks_idempotent(rows(spark, A), live, KEY)  # a delivery that comes again
    S.archive(spark, live, old, "2024-01-02 11:00:00")
    assert ids(spark, live) == [(2, 3)] and ids(spark, old) == [(1, 1), (1, 2)]


def test_compact_keeps_rows_in_fewer_files(spark, tmp_path):
    p = str(tmp_path / "t")
    for u in range(6):
        S.write_ticks_idempotent(rows(spark, (1, "2024-01-01 10:00:00", u, A[3])), p, KEY)
    S.compact(spark, p, "2024-01-02")
    files = glob.glob(f"{p}/event_date=2024-01-01/*.parquet")
    assert len(files) == 1 and "zstd" in files[0] and len(ids(spark, p)) == 6


def test_scan_prunes_partitions_and_pushes_filters(spark, tmp_path):
    p = str(tmp_path / "t")
    S.write_ticks_idempotent(rows(spark, A, B, C), p, KEY)
    scan = S.scan_ticks(spark, p, "2024-01-02", "2024-01-03", ids=[1]).select("update_id")
    assert [r[0] for r in scan.collect()] == [2]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = scan._jdf.queryExecution().explainString(mode)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "EqualTo(symbol_id,1)" in plan and "GreaterThanOrEqual(ts_exchange" in plan


def test_csv_keeps_malformed_lines_apart(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("exchange,symbol,timestamp,local_timestamp,ask_amount,ask_price,bid_price,bid_amount\n"
                 "v,A,1,2,1.0,2.0,3.0,4.0\nv,A,oops,2,1.0,2.0,3.0,4.0\n")
    df = S.load_fallback_csv(spark, str(p)).cache()
    assert df.filter("_corrupt_record IS NULL").count() == 1 and df.filter("_corrupt_record IS NOT NULL").count() == 1


def times(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_compaction_leaves_whole_days_alone(spark, tmp_path):
    p, days = str(tmp_path / "t"), ["2024-01-01", "2024-01-02", "2024-01-03"]
    for i in range(3):
        S.write_partitioned(S.with_event_date(rows(spark, *[(s, f"{d} 10:00:00", i, f"{d} 10:00:01") for d in days for s in (1, 2)])), p, KEY)
    want = sorted(map(tuple, spark.read.parquet(p).collect()))
    assert S.compact(spark, p, "2024-01-03") == days[:2]
    assert all(len(S.day_files(spark, p, d)) == 1 for d in days[:2]) and len(S.day_files(spark, p, days[2])) > 1
    before = times(p)
    assert S.compact(spark, p, "2024-01-03") == [] and times(p) == before
    S.write_partitioned(S.with_event_date(rows(spark, (9, "2024-01-02 11:00:00", 9, "2024-01-02 11:00:01"))), p, KEY)
    assert S.compact(spark, p, "2024-01-03") == ["2024-01-02"]  # a late row came
    assert sorted(map(tuple, spark.read.parquet(p).collect())) == sorted([*want, *[tuple(r) for r in spark.read.parquet(p).filter("symbol_id = 9").collect()]])
    # Files that turned out smaller than planned are not written again and again.
    S.compact(spark, p, "2024-01-04", file_bytes=1)
    before = times(p)
    assert S.compact(spark, p, "2024-01-04", file_bytes=1) == [] and times(p) == before


def test_rotation_can_be_repeated(spark, tmp_path):
    p = str(tmp_path / "t")
    l1 = spark.createDataFrame([("a", 1_700_000_000_000_000, 1.0), ("a", 1_700_000_000_000_001, 2.0), ("b", 1_700_100_000_000_000, 3.0)],
                               "symbol string, timestamp long, bid_price double")
    for _ in range(2):
        S.rotate_files(l1, p)
    S.rotate_files(l1.filter("symbol = 'b'"), p)
    assert spark.read.csv(p, header=True).count() == 3


def test_a_batch_is_evaluated_once(spark, tmp_path):
    p, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    batch = rows(spark, A, A_LATE, B, C)
    counted = batch.mapInArrow(count, batch.schema)
    for n in (1, 2, 3):
        S.write_ticks_idempotent(counted, p, KEY)
        assert seen.value == 4 * n
    assert ids(spark, p) == [(1, 1), (1, 2), (2, 3)]
    S.upsert_latest(counted, str(tmp_path / "u"), KEY)
    S.upsert_latest(counted, str(tmp_path / "u"), KEY)
    assert seen.value == 4 * 5 and not glob.glob(f"{tmp_path}/*/_staged*")


def test_staging_goes_when_a_write_fails(spark, tmp_path):
    p = str(tmp_path / "t")
    try:
        with S.staged(rows(spark, A), p):
            raise RuntimeError
    except RuntimeError:
        pass
    assert not glob.glob(f"{p}/_staged*")


def test_rows_without_a_time_are_kept_once(spark, tmp_path):
    p = str(tmp_path / "t")
    for _ in range(2):
        S.write_ticks_idempotent(rows(spark, (1, None, 5, B[3]), B), p, KEY)
    assert spark.read.parquet(p).count() == 2


def test_only_near_times_are_compared(spark, tmp_path):
    p = str(tmp_path / "t")
    S.write_ticks_idempotent(rows(spark, A, B, C, (1, "2024-01-01 23:00:00", 8, A[3])), p, KEY)
    batch = S.with_event_date(rows(spark, A, (3, "2024-01-01 10:30:00", 1, A[3])))
    near = S._touched_times(spark.read.parquet(p), batch, "ts_exchange")
    assert [r.update_id for r in near.collect()] == [1]
    text = near._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [" in text and "GreaterThanOrEqual(ts_exchange" in text


def test_exports_evaluate_their_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    l1 = spark.createDataFrame([(f"s{i % 3}", 1_700_000_000_000_000 + i, float(i)) for i in range(50)],
                               "symbol string, timestamp long, bid_price double")
    for write in (S.rotate_files, lambda df, p: S.export_csv(df, p, ["symbol", "timestamp"])):
        for _ in range(2):
            before = seen.value
            write(l1.mapInArrow(count, l1.schema), str(tmp_path / "out"))
            assert seen.value - before == 50
        assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 50
        assert os.listdir(tmp_path) == ["out"]  # nothing staged is left

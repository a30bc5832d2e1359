"""Streams over text files: what is stored, and what a failure leaves behind."""

import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tarnlake.__main__ import main
from tarnlake.schemas import LEDGER, SAMPLES
from tarnlake.session import work_folder
from tarnlake.sources import message_stream, read_snapshot
from tarnlake.streaming import (
    BatchStore,
    ProgressLog,
    cut_for_replay,
    drain,
    finish,
    ingest,
    parse_messages,
    progress_rows,
    replay,
    store_batch,
)


def record(i, **more):
    return json.dumps({"SITE_ID": f"s{i}", "DATE_SMP": f"{2000 + i}-01-01 00:00:00", "PH_LAB": "6,5", **more})


@pytest.fixture
def messages(spark, tmp_path):
    """Four files of five messages; the third file holds two bad ones."""
    for f in range(4):
        lines = [record(5 * f + i) for i in range(5)]
        if f == 2:
            lines[0], lines[1] = "garbage", "{broken"
        (tmp_path / f"{f}.txt").write_text("\n".join(lines) + "\n")
    return message_stream(spark, str(tmp_path), files_per_batch=1), spark.read.text(str(tmp_path))


def stored(spark, store):
    return sorted(map(str, store.table(spark, SAMPLES).drop("batch_id").collect()))


def test_stream_stores_what_the_batch_form_parses(spark, messages):
    stream, lines = messages
    store = BatchStore(work_folder(spark, "store"))
    query = drain(ingest(stream, SAMPLES, store, work_folder(spark, "progress")))
    assert stored(spark, store) == sorted(map(str, parse_messages(lines, SAMPLES).collect()))

    ledger = store.ledger(spark)
    assert ledger.schema.fieldNames() == LEDGER.fieldNames()
    rows = {r.version_id: r for r in ledger.collect()}
    assert sorted(rows) == ["batch_0", "batch_1", "batch_2", "batch_3"]
    assert {r.row_count for r in rows.values()} == {5}
    assert sorted(r.corrupt_count for r in rows.values()) == [0, 0, 0, 2]
    assert sum(p.row_count for p in progress_rows(spark, query).collect()) == 20

    bad = next(v for v, r in rows.items() if r.corrupt_count).removeprefix("batch_")
    kept = store.corrupt_messages(spark).collect()
    assert sorted(map(tuple, kept)) == [(int(bad), "garbage"), (int(bad), "{broken")]

    first = rows["batch_0"]
    assert first.description == "Batch 0"
    assert f"/year={first.min_datestamp.year}/batch_id=0/attempt=" in first.snapshot_path
    restored = read_snapshot(spark, ledger, "batch_0", SAMPLES)
    low, high = restored.agg(F.min("DATE_SMP"), F.max("DATE_SMP")).first()
    assert (low, high, restored.count()) == (first.min_datestamp, first.max_datestamp, 5)
    assert restored.columns == SAMPLES.fieldNames()
    with pytest.raises(LookupError):
        read_snapshot(spark, ledger, "batch_77")


@pytest.mark.parametrize("stage", ["before", "rows_only", "after"])
def test_a_failed_batch_runs_again_and_nothing_doubles(spark, messages, stage):
    stream, lines = messages
    store, checkpoint = BatchStore(work_folder(spark, "store")), work_folder(spark, "progress")
    seen = []

    def failing(batch, batch_id, target, date_column):
        seen.append(batch_id)
        broken = batch_id == 1 and seen.count(1) == 1
        if broken and stage == "before":
            raise RuntimeError("planned")
        if broken and stage == "rows_only":
            batch.write.parquet(f"{target.rows}/year=2000/batch_id={batch_id}/attempt=1")
            raise RuntimeError("planned")
        store_batch(batch, batch_id, target, date_column)
        if broken:
            raise RuntimeError("planned")

    with pytest.raises(StreamingQueryException):
        drain(ingest(stream, SAMPLES, store, checkpoint, on_batch=failing))
    complete = 10 if stage == "after" else 5
    assert store.table(spark, SAMPLES).count() == complete, "only complete batches are shown"

    drain(ingest(stream, SAMPLES, store, checkpoint, on_batch=failing))
    assert seen == [0, 1, 1, 2, 3]
    assert stored(spark, store) == sorted(map(str, parse_messages(lines, SAMPLES).collect()))
    assert store.ledger(spark).count() == 4


def test_a_failed_second_try_changes_nothing(spark):
    store = BatchStore(work_folder(spark, "store"))
    good = spark.createDataFrame([("s", 1), ("t", 2)], "SITE_ID string, DATE_SMP int").withColumn("DATE_SMP", F.lit("2020-01-01").cast("date"))
    store_batch(good, 0, store, "DATE_SMP")
    before = [sorted(map(str, df.collect())) for df in (store.table(spark, good.schema), store.ledger(spark, DateType()))]
    with pytest.raises(Exception, match="planned"):
        store_batch(good.withColumn("SITE_ID", F.raise_error(F.lit("planned")).cast("string")), 0, store, "DATE_SMP")
    after = [sorted(map(str, df.collect())) for df in (store.table(spark, good.schema), store.ledger(spark, DateType()))]
    assert before == after and len(before[0]) == 2

    store_batch(good.limit(1), 0, store, "DATE_SMP")
    assert store.table(spark, good.schema).count() == 1, "the newest try counts"
    first, second = (r.snapshot_path for r in spark.read.parquet(store.ledger_folder).orderBy("attempt").collect())
    assert spark.read.parquet(first).count() == 2 and spark.read.parquet(second).count() == 1


def test_compacted_ledger_says_the_same(spark):
    store = BatchStore(work_folder(spark, "store"))
    rows = spark.createDataFrame([("s",)], "SITE_ID string").withColumn("DATE_SMP", F.lit("2020-01-01").cast("timestamp"))
    for number in (0, 1, 2, 1):
        store_batch(rows, number, store, "DATE_SMP")
    before = sorted(map(str, store.ledger(spark).collect()))
    main(["compact-ledger", "--store", store.root], spark)
    assert sorted(map(str, store.ledger(spark).collect())) == before and len(before) == 3
    assert len(spark.read.parquet(store.ledger_folder).inputFiles()) == 1
    store_batch(rows, 3, store, "DATE_SMP")
    assert store.ledger(spark).count() == 4 and store.table(spark, rows.schema).count() == 4


def test_batch_without_rows_or_dates(spark):
    store = BatchStore(work_folder(spark, "store"))
    none = spark.createDataFrame([], SAMPLES)
    undated = spark.createDataFrame([("s",)], "SITE_ID string").select(
        "SITE_ID", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SAMPLES.fields[1:]]
    )
    store_batch(none, 0, store, "DATE_SMP")
    store_batch(undated, 1, store, "DATE_SMP")
    rows = sorted(store.ledger(spark).collect(), key=lambda r: r.version_id)
    assert [(r.row_count, r.min_datestamp) for r in rows] == [(0, None), (1, None)]
    assert all("/year=unknown/" in r.snapshot_path for r in rows)
    assert store.table(spark, SAMPLES).count() == 1


def test_drain_gives_up_after_the_timeout(spark, messages):
    stream, _ = messages
    query = parse_messages(stream, SAMPLES).writeStream.format("noop")
    running = query.option("checkpointLocation", work_folder(spark, "progress")).trigger(processingTime="1 hour").start()
    with pytest.raises(TimeoutError):
        drain(running, 1)
    assert not running.isActive


def test_replay_keeps_the_pace_of_the_source(spark, messages):
    stream, lines = messages
    target = work_folder(spark, "replayed")
    query = drain(replay(parse_messages(stream, SAMPLES), target, work_folder(spark, "progress")))
    assert [p.row_count for p in progress_rows(spark, query).orderBy("batch_id").collect()] == [5, 5, 5, 5]
    again = parse_messages(spark.read.text(target), SAMPLES)
    assert sorted(map(str, again.collect())) == sorted(map(str, parse_messages(lines, SAMPLES).collect()))


def test_replay_by_rows_keeps_its_pace_and_ends(spark):
    rows = spark.range(20).select(F.col("id").cast("string").alias("SITE_ID"))
    started = time.monotonic()
    sent = replay(cut_for_replay(rows.coalesce(1), 5), work_folder(spark, "out"), work_folder(spark, "progress"), "1 second")
    query = finish(sent, 60)
    assert not query.isActive and time.monotonic() - started >= 3
    counts = [p.row_count for p in progress_rows(spark, query).where("row_count > 0").collect()]
    assert counts == [5, 5, 5, 5]


def test_finish_gives_up_after_the_timeout(spark):
    rows = cut_for_replay(spark.range(20).select(F.col("id").cast("string").alias("SITE_ID")).coalesce(1), 5)
    sent = replay(rows, work_folder(spark, "out"), work_folder(spark, "progress"), "1 hour")
    with pytest.raises(TimeoutError):
        finish(sent, 2)
    assert not sent.isActive


def test_progress_log_is_written_in_groups(spark, messages):
    stream, _ = messages
    target = work_folder(spark, "log")
    log = ProgressLog(spark, target, batches_per_write=3)
    spark.streams.addListener(log)
    try:
        query = drain(replay(parse_messages(stream, SAMPLES), work_folder(spark, "out"), work_folder(spark, "progress")))
        for _ in range(100):
            if spark.read.schema("row_count long").parquet(target).count() >= 4:
                break
            query.awaitTermination(1)
    finally:
        spark.streams.removeListener(log)
    rows = spark.read.parquet(target).orderBy("batch_id").collect()
    assert [(r.batch_id, r.row_count) for r in rows][:4] == [(0, 5), (1, 5), (2, 5), (3, 5)]

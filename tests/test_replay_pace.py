"""The replay's figures are whole beyond the micro-batches that Spark remembers, its batches full and in order."""

import pytest
from pyspark.sql import functions as F

from tarnlake.session import folders_like, unless_set, work_folder
from tarnlake.streaming import cut_for_replay, finish, replay
from tarnlake.streaming.replay import _LOGS, numbered_in_order
from workloads.queries import QUERIES


def test_replay_pace_beyond_a_hundred_batches(spark):
    folder = work_folder(spark, "many-events")
    spark.range(505_001).selectExpr("id AS event_id").coalesce(1).write.parquet(f"{folder}/events.parquet")
    assert [tuple(r) for r in QUERIES["stream_replay_pace"](spark, folder).collect()] == [(505_001, 0)]


def test_replay_pace_of_no_events(spark):
    folder = work_folder(spark, "no-events")
    spark.range(0).selectExpr("id AS event_id").write.parquet(f"{folder}/events.parquet")
    assert [tuple(r) for r in QUERIES["stream_replay_pace"](spark, folder).collect()] == [(0, 0)]


@pytest.mark.parametrize("parts", [1, 7])
def test_all_micro_batches_but_the_last_are_full_and_in_order(spark, parts):
    source = work_folder(spark, "numbers")
    spark.range(0, 2345, 1, parts).withColumn("text", F.format_string("row %05d", "id")).write.mode("overwrite").parquet(source)
    stored = spark.read.parquet(source)
    order = [r["id"] for r in numbered_in_order(stored).orderBy("__number").collect()]
    assert order == list(range(2345))
    target = work_folder(spark, "out")
    seen = []
    stream = cut_for_replay(stored, 500).writeStream.foreachBatch(lambda df, _: seen.append([r["id"] for r in df.collect()]))
    finish(stream.option("checkpointLocation", target).trigger(processingTime="0 seconds").start(), 120)
    assert [len(s) for s in seen if s] == [500, 500, 500, 500, 345]
    assert [i for s in seen for i in s] == list(range(2345))


def test_nothing_to_replay(spark):
    none = spark.range(0).withColumn("text", F.lit("x"))
    seen = []
    stream = cut_for_replay(none, 5).writeStream.foreachBatch(lambda df, _: seen.append(df.count()))
    finish(stream.option("checkpointLocation", work_folder(spark, "p")).trigger(processingTime="0 seconds").start(), 60)
    assert sum(seen) == 0


def test_logs_of_a_long_replay_do_not_pile_up(spark, monkeypatch):
    rows = spark.range(0, 30, 1, 1).select(F.col("id").cast("string").alias("text"))
    target, checkpoint = work_folder(spark, "out"), work_folder(spark, "p")
    key, least = "spark.sql.streaming.fileSink.log.cleanupDelay", "spark.sql.streaming.minBatchesToRetain"
    for k in _LOGS:
        monkeypatch.setitem(_LOGS, k, "0s")
    spark.conf.set(least, "2")
    try:
        finish(replay(cut_for_replay(rows, 1), target, checkpoint, "0 seconds"), 120)
    finally:
        spark.conf.unset(least)
    for log in (f"{checkpoint}/sources/0", f"{target}/_spark_metadata"):
        assert 0 < len(folders_like(spark, f"{log}/*")) < 20
    assert sorted(int(r["value"].split('"')[3]) for r in spark.read.text(target).collect()) == list(range(30))
    assert spark.conf.get(key, None) is None


def test_settings_of_the_session_stay(spark):
    key = "spark.sql.streaming.fileSink.log.cleanupDelay"
    spark.conf.set(key, "7s")
    try:
        with unless_set(spark, {key: "60s"}):
            assert spark.conf.get(key) == "7s"
        assert spark.conf.get(key) == "7s"
    finally:
        spark.conf.unset(key)
    with pytest.raises(ValueError), unless_set(spark, {key: "60s"}):
        assert spark.conf.get(key) == "60s"
        raise ValueError
    assert spark.conf.get(key, None) is None

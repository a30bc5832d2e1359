"""Results kept batch by batch equal those over the whole history, after every batch."""

import random

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import annual_metrics, latest_per_key
from tarnlake.session import folders_like, work_folder
from tarnlake.streaming import NewestRows, YearlyMetrics

SAMPLE = "SITE_ID string, PROGRAM_ID int, DATE_SMP date, PH_LAB string, SO4_UEQ_L string, NO3_UEQ_L string, n int"


def batches(spark, seed):
    rng = random.Random(seed)
    days = [None, *(f"20{y}-0{m}-11" for y in (20, 21) for m in (1, 5))]
    out = []
    for number in range(5):
        rows = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice(days), rng.choice(["6,5", "7,25", "NaN", "x", None]), "1", None, rng.randrange(99)) for _ in range(rng.choice([0, 3, 12]))]
        out.append(spark.createDataFrame(rows, SAMPLE.replace("DATE_SMP date", "DATE_SMP string")).withColumn("DATE_SMP", F.col("DATE_SMP").cast("date")))
    return out


def content(df):
    return sorted(map(str, df.collect()))


def union(frames, spark):
    out = spark.createDataFrame([], SAMPLE)
    for df in frames:
        out = out.unionAll(df)
    return out


def test_newest_rows_after_every_batch(spark):
    keys, parts = ["SITE_ID", "PROGRAM_ID"], batches(spark, 1)
    state, seen = NewestRows(work_folder(spark, "s"), tuple(keys), "DATE_SMP", ("n",), buckets=3), []
    schema = parts[0].schema
    assert state.table(spark, schema).count() == 0
    for number in (3, 0, 4, 3, 1, 2):
        state.merge(parts[number], number)
        seen.append(parts[number])
        assert content(state.table(spark, schema)) == content(latest_per_key(union(seen, spark), keys, "DATE_SMP", ["n"]))
    reader, before = state.table(spark, schema), content(state.table(spark, schema))
    wrong = parts[2].withColumn("n", F.raise_error(F.lit("planned")).cast("int"))
    with pytest.raises(Exception, match="planned"):
        state.merge(wrong.unionAll(parts[1]) if parts[2].count() else union(parts, spark).withColumn("n", F.raise_error(F.lit("planned")).cast("int")), 9)
    assert content(state.table(spark, schema)) == before and state.vacuum(spark, 3600) == 0 and content(reader) == before
    assert state.vacuum(spark, 0) > 0 and content(state.table(spark, schema)) == before
    assert not folders_like(spark, f"{state.root}/_aside/*")


def test_a_batch_writes_only_the_buckets_it_touches(spark):
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("2020-01-01").cast("date").alias("d"))
    state = NewestRows(work_folder(spark, "s"), ("k",), "d", buckets=16)
    assert state.merge(rows, 0) == 16 and state.merge(rows.where("k = 7").withColumn("d", F.lit("2021-01-01").cast("date")), 1) == 1
    assert state.table(spark, rows.schema).where("d = DATE'2021-01-01'").collect()[0]["k"] == 7
    assert state.table(spark, rows.schema).count() == 100


def test_metrics_after_inserts_repeats_and_withdrawals(spark):
    parts, names = batches(spark, 2), {"site": "SITE_ID", "program": "PROGRAM_ID"}
    state, held = YearlyMetrics(work_folder(spark, "m")), {}

    def same():
        whole = annual_metrics(union(held.values(), spark), **names)
        return content(state.metrics(spark).select(*whole.columns)) == content(whole)

    for number, df in ((0, parts[4]), (1, parts[1]), (0, parts[0]), (2, parts[2]), (1, parts[1]), (3, parts[3])):
        state.put(df, number)
        held[number] = df
        assert same()
    with pytest.raises(Exception, match="planned"):
        state.put(union(parts, spark).withColumn("PH_LAB", F.raise_error(F.lit("planned")).cast("string")), 2)
    assert same()
    state.withdraw(spark, 2)
    del held[2]
    assert same()

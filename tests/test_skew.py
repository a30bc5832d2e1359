"""Operators on tables where one key holds a large share of the rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import enrich, enrich_sql, except_all, latest_per_key, row_number_desc
from tarnlake.session import work_folder


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows, a third of them with one key, half of the rest with a NULL key or date."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, 7).when(n % 3 == 1, n % 40).cast("int").alias("k"),
        F.when(n % 5 > 0, F.date_add(F.lit("2020-01-01"), (n % 90).cast("int"))).alias("d"),
        n.alias("tie"),
    )


def numbered_by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.k, []).append(r)
    for k, members in groups.items():
        members.sort(key=lambda r: (r.d is not None, r.d, r.tie) if r.d else (False, None, r.tie), reverse=True)
        for i, r in enumerate(members, 1):
            yield k, r.d, r.tie, i


@pytest.mark.parametrize("rows_per_task", [50, 400, 5_000_000])
def test_row_numbers_over_slices(spark, hot, rows_per_task):
    rows = hot.collect()
    with_date = [r for r in rows if r.d]
    expected = set(numbered_by_hand(with_date))
    got = row_number_desc(hot.filter("d IS NOT NULL"), ["k"], "d", ["tie"], rows_per_task=rows_per_task)
    assert got.columns == ["k", "d", "tie", "row_num"]
    assert {tuple(r) for r in got.collect()} == expected
    assert got.count() == len(with_date)


@pytest.mark.parametrize("rows_per_task", [50, 5_000_000])
def test_null_dates_are_numbered_last(spark, hot, rows_per_task):
    rows = row_number_desc(hot, ["k"], "d", ["tie"], rows_per_task=rows_per_task).collect()
    for k in {r.k for r in rows}:
        members = sorted((r for r in rows if r.k == k), key=lambda r: r.row_num)
        assert [r.row_num for r in members] == list(range(1, len(members) + 1))
        undated = [r.d is None for r in members]
        assert undated == sorted(undated)


def test_hot_slices_are_spread(spark, hot):
    """Rows of the hot key are numbered slice by slice; how offsets are joined is left to Spark."""
    plan = row_number_desc(hot, ["k"], "d", ["tie"], rows_per_task=50)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"row_number\(\) windowspecdefinition\(k#\d+, __slice#\d+", text)
    assert "strategy=broadcast" not in text


@pytest.mark.parametrize("rows_per_task", [1, 7, 1_000_000])
def test_except_all_in_chunks(spark, hot, rows_per_task):
    left, right = hot.select("k"), hot.filter("tie % 4 = 0").select("k")
    expected = Counter(r.k for r in left.collect()) - Counter(r.k for r in right.collect())
    assert Counter(r.k for r in except_all(left, right, rows_per_task).collect()) == expected


def test_copies_of_one_row_are_written_by_many_tasks(spark, hot):
    got = except_all(hot.select("k"), hot.select("k").limit(0), rows_per_task=20)
    writers = got.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(writers) > 4 and max(w["count"] for w in writers) < 500


def test_samples_of_a_hot_site_are_spread(spark, hot):
    samples = hot.select(F.col("k").alias("SITE_ID"), (F.col("k") % 2).alias("PROGRAM_ID"), "tie")
    sites = samples.select("SITE_ID", "PROGRAM_ID").distinct()
    methods = spark.createDataFrame([(1, "m")], "PROGRAM_ID int, METHOD string")
    plain, spread = (enrich(samples, sites, methods, spread=n) for n in (1, 16))
    assert spread.columns == plain.columns
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = enrich(samples, sites, methods, spread=16)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"Exchange hashpartitioning\(SITE_ID_LTM#\d+, PROGRAM_ID_LTM#\d+, __part_l#\d+", plan)


@pytest.mark.parametrize("form", [enrich, enrich_sql])
@pytest.mark.parametrize("times, shuffled", [(4, True), (400, False)])
def test_copies_of_sites_are_broadcast_only_where_all_copies_are_small(spark, hot, form, times, shuffled):
    samples = hot.select(F.col("k").alias("SITE_ID"), (F.col("k") % 2).alias("PROGRAM_ID"), "tie")
    folder = work_folder(spark, "sites")
    samples.select("SITE_ID", "PROGRAM_ID").distinct().write.mode("overwrite").parquet(folder)
    sites = spark.read.parquet(folder)
    methods = spark.createDataFrame([(1, "m")], "PROGRAM_ID int, METHOD string").limit(0)
    size = int(str(sites._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(times * size))
    try:
        joined = form(samples, sites, methods, spread=8)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == samples.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert bool(re.search(r"SortMergeJoin \[SITE_ID\w*#\d+, PROGRAM_ID\w*#\d+L?, __part", plan)) == shuffled


def test_collapse_sends_one_row_per_key_and_task(spark, hot):
    """A hot key is reduced before the shuffle: the plan aggregates on both sides of it."""
    plan = latest_per_key(hot, ["k"], "d", ["tie"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") == 1 and "Window" not in plan


def test_collapse_properties(spark, hot):
    once = latest_per_key(hot, ["k"], "d", ["tie"])
    rows = once.collect()
    assert len(rows) == len({r.k for r in rows}) == hot.select("k").distinct().count()
    assert set(rows) == set(latest_per_key(once, ["k"], "d", ["tie"]).collect())
    assert set(rows) <= set(hot.collect())

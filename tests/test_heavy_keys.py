"""Hot keys are found and split with nothing said about them."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import enrich, enrich_sql, heavy_keys, row_number_desc
from tarnlake.operators.heavy import find_heavy

ROWS = 90_000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows with key 7, a sixth with none, the rest over 20 000 keys; few files hold the hot ones."""
    n = F.col("id")
    key = F.when(n < ROWS // 3, 7).when(n < ROWS // 2, None).otherwise(n % 20_000).cast("long")
    return spark.range(ROWS, numPartitions=8).select(
        key.alias("SITE_ID"), (key % 3).alias("PROGRAM_ID"), F.date_add(F.lit("2020-01-01"), (n % 90).cast("int")).alias("d"), n.alias("tie")
    )


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def tables(spark, hot):
    sites = spark.range(20_000).select(
        F.col("id").alias("SITE_ID"), (F.col("id") % 3).alias("PROGRAM_ID"), F.concat(F.lit("s"), "id").alias("NAME")
    )
    return hot, sites, spark.createDataFrame([(0, "a"), (1, "b")], "PROGRAM_ID bigint, METHOD string")


@pytest.mark.parametrize("share, least", [(0.01, 10_000), (0.2, 1), (0.5, 1), (0.00005, 1)])
def test_heavy_keys_as_a_full_count(hot, share, least):
    counts = Counter(r.SITE_ID for r in hot.collect())
    expected = {k: n for k, n in counts.items() if n > share * ROWS and n >= least}
    got = heavy_keys(hot, ["SITE_ID"], share, least).collect()
    assert {r.SITE_ID: r.n_rows for r in got} == expected and len(got) == len(expected)


def test_heavy_keys_of_several_columns_and_of_nothing(hot):
    got = {(r.SITE_ID, r.PROGRAM_ID): r.n_rows for r in heavy_keys(hot, ["SITE_ID", "PROGRAM_ID"], 0.05).collect()}
    assert got == {(7, 1): ROWS // 3 + hot.filter(f"tie >= {ROWS // 2} AND SITE_ID = 7").count(), (None, None): ROWS // 6}
    assert heavy_keys(hot.limit(0), ["SITE_ID"], 0.05, 1).collect() == []


def test_few_heavy_hashes_reach_the_driver(hot):
    """However many keys there are, no more than two by share."""
    found = find_heavy(hot.withColumn("SITE_ID", F.col("tie")), ["SITE_ID"], 0.001, 1)
    assert found == ({}, ROWS)


def test_estimates_are_not_below_the_counts(hot):
    found = sorted(find_heavy(hot, ["SITE_ID"], 0.1).rows.values())
    counts = sorted(Counter(r.SITE_ID for r in hot.collect()).values())[-2:]
    assert len(found) == 2 and all(n <= estimate <= n + 0.05 * ROWS for n, estimate in zip(counts, found))


def test_keys_are_numbered_alike_with_and_without_slices(hot):
    args = (["SITE_ID"], "d", ["tie"])
    found = row_number_desc(hot, *args)
    assert found.columns == [*hot.columns, "row_num"] and dict(found.dtypes)["row_num"] == "bigint"
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and re.search(r"windowspecdefinition\(SITE_ID#\d+L, __slice#\d+", plan)
    groups = {}
    for r in hot.collect():
        groups.setdefault(r.SITE_ID, []).append(r)
    expected = Counter()
    for rows in groups.values():
        rows.sort(key=lambda r: (r.d, r.tie), reverse=True)
        expected.update((*r, i) for i, r in enumerate(rows, 1))
    assert Counter(map(tuple, found.collect())) == expected


def test_no_slices_without_a_heavy_key(spark, hot):
    even = hot.withColumn("SITE_ID", F.col("tie") % 500)
    plan = row_number_desc(even, ["SITE_ID"], "d", ["tie"])._jdf.queryExecution().optimizedPlan().toString()
    assert "__slice" not in plan and "Join" not in plan


@pytest.mark.parametrize("form", [enrich, enrich_sql])
def test_samples_of_a_hot_site_are_found_and_spread(spark, tables, no_broadcast, form):
    found, plain = form(*tables), form(*tables, spread=1)
    assert found.columns == plain.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))
    assert "__part" in found._jdf.queryExecution().optimizedPlan().toString()
    assert "__part" not in plain._jdf.queryExecution().optimizedPlan().toString()


def largest_and_median(joined):
    """Rows of the join's tasks, with neither merging nor splitting at run time."""
    sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    return sizes[-1], sizes[len(sizes) // 2]


def test_largest_join_task_is_near_the_median(spark, tables, no_broadcast):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        most, median = largest_and_median(enrich(*tables, spread=1))
        assert most > 10 * median
        most, median = largest_and_median(enrich(*tables))
        assert most <= 3 * median
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sites_that_are_broadcast_are_not_searched(tables):
    plan = enrich(*tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "__part" not in plan


def test_keys_of_two_types_are_left_alone(spark, tables, no_broadcast):
    samples, sites, methods = tables
    odd = sites.withColumn("SITE_ID", F.col("SITE_ID").cast("int"))
    assert "__part" not in enrich(samples, odd, methods)._jdf.queryExecution().optimizedPlan().toString()
    assert enrich(samples, odd, methods).filter("NAME IS NOT NULL").count() == samples.filter("SITE_ID IS NOT NULL").count()

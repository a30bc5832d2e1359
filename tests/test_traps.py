"""Edge cases of the data, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarnlake.functions import decimal_comma, null_tokens_to_null, order_date, parse_timestamp, trailing_number
from tarnlake.operators import (
    annual_metrics,
    between,
    enrich,
    enrich_sql,
    except_all,
    latest_batch,
    latest_per_key,
    null_profile,
    reconcile_ids,
)
from tarnlake.schemas import SAMPLES
from tarnlake.streaming import parse_messages


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def column(df):
    return [r[0] for r in df.collect()]


def test_text_that_is_no_number_is_null(spark):
    df = texts(spark, "true", "<0.5", "", "6,08", "1,234,5", "6.1", "NaN", None)
    assert column(df.select(decimal_comma("v"))) == [None, None, None, 6.08, None, 6.1, None, None]


def test_every_spelling_that_spark_reads_as_a_number_is_kept(spark):
    spellings = ["+1", "-1,5", ".5", "5.", "1e3", " 7 ", "\t8\n", "6.1d", "6.1f", "0x1p3", "Infinity", "-inf", "INF", "+infinity"]
    junk = ["e3", "d", "--1", "ND", "n/a", "1 2", "١", "+", "-", ".", "i", "in", "+NaN", "nan", "\u00a01"]
    df = texts(spark, *spellings, *junk)
    by_cast = F.nullif(F.regexp_replace("v", ",", ".").try_cast("double"), F.lit(float("nan")))
    got = df.select("v", decimal_comma("v").alias("ours"), by_cast.alias("cast")).collect()
    assert [r for r in got if r.ours != r.cast] == []
    assert all(r.ours is not None for r in got[: len(spellings)])


def test_nan_in_json_does_not_reach_the_mean(spark):
    lines = ['{"SITE_ID":"a","PH_LAB":NaN}', '{"SITE_ID":"a","PH_LAB":"NaN"}', '{"SITE_ID":"a","PH_LAB":"6,5"}']
    rows = parse_messages(texts(spark, *lines).toDF("value"), SAMPLES)
    got = annual_metrics(rows, "SITE_ID", "PROGRAM_ID").first()
    assert (got.AVG_PH, got.TOTAL_SAMPLES) == (6.5, 3)


@pytest.mark.parametrize("keep_corrupt", [False, True])
def test_bad_json_is_a_row_of_nulls(spark, keep_corrupt):
    lines = ["garbage", "", "null", '[{"SITE_ID":"x"}]', '{"nobody":"x"}', '{"site_id":"x"}']
    rows = parse_messages(texts(spark, *lines).toDF("value"), SAMPLES, keep_corrupt=keep_corrupt)
    assert rows.count() == len(lines)
    assert rows.select(*SAMPLES.fieldNames()).dropna("all").count() == 0
    if keep_corrupt:
        bad = column(rows.select("_corrupt_record").dropna())
        assert "garbage" in bad and '{"nobody":"x"}' not in bad


def test_json_numbers_and_booleans_become_text(spark):
    rows = parse_messages(texts(spark, '{"SITE_ID":7,"PROGRAM_ID":true}').toDF("value"), SAMPLES)
    assert tuple(rows.select("SITE_ID", "PROGRAM_ID").first()) == ("7", "true")


def test_timestamps_in_the_stream(spark):
    values = ['"2020-01-02 03:04:05"', '"2020-01-02"', '"02/01/2020"', "1577934245", "null"]
    lines = [f'{{"DATE_SMP":{v}}}' for v in values]
    rows = parse_messages(texts(spark, *lines).toDF("value"), SAMPLES)
    assert column(rows.select(F.col("DATE_SMP").cast("string"))) == [
        "2020-01-02 03:04:05",
        "2020-01-02 00:00:00",
        None,
        "2020-01-02 03:04:05",
        None,
    ]


def test_binary_message_values(spark):
    df = texts(spark, '{"SITE_ID":"a"}').select(F.col("v").cast("binary").alias("value"))
    assert parse_messages(df, SAMPLES).first().SITE_ID == "a"


def test_parse_timestamp(spark):
    df = texts(spark, "2020-01-02 03:04:05", "02/01/2020")
    assert column(df.select(parse_timestamp("v").cast("string"))) == ["2020-01-02 03:04:05", None]


def test_another_timestamp_format_in_the_stream(spark):
    lines = [f'{{"DATE_SMP":{v}}}' for v in ('"02/01/2020 03:04"', '"2020-01-02 03:04:00"', "1577934240", '"x"')]
    rows = parse_messages(texts(spark, *lines).toDF("value"), SAMPLES, "dd/MM/yyyy HH:mm")
    assert column(rows.select(F.col("DATE_SMP").cast("string"))) == ["2020-01-02 03:04:00"] * 3 + [None]


def test_years_order_as_dates(spark):
    day = dt.date
    df = texts(spark, "2008", "2008-12-31", "present", "")
    assert column(df.select(order_date(df, "v"))) == [day(2008, 1, 1), day(2008, 12, 31), None, None]
    for kind in ("int", "double", "decimal(6,0)"):
        df = spark.range(1).select(F.lit(2008).cast(kind).alias("v"))
        assert column(df.select(order_date(df, "v"))) == [day(2008, 1, 1)]


def test_same_day_rows_follow_the_tie_break(spark):
    rows = [("a", "2020-01-01 08:00:00", 2, "x"), ("a", "2020-01-01 23:00:00", 1, "y"), ("a", "2019-05-05 00:00:00", 9, "z")]
    df = spark.createDataFrame(rows, "k string, d string, tie int, v string")
    for partitions in (1, 3):
        got = latest_per_key(df.repartition(partitions), ["k"], "d", ["tie"]).collect()
        assert [r.v for r in got] == ["x"]


def test_rows_equal_in_date_and_tie_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([("a", "2020", str(i)) for i in range(50)], "k string, d string, v string")
    seen = {latest_per_key(df.repartition(n), ["k"], "d", []).first().v for n in (1, 4, 16)}
    assert len(seen) == 1


def test_null_dates_and_null_keys_keep_one_row(spark):
    rows = [("a", None, 1), ("a", None, 2), (None, "2020", 3), (None, "2021", 4)]
    df = spark.createDataFrame(rows, "k string, d string, tie int")
    got = sorted(latest_per_key(df, ["k"], "d", ["tie"]).collect(), key=lambda r: r.tie)
    assert [tuple(r) for r in got] == [("a", None, 2), (None, "2021", 4)]


def test_keys_are_a_parameter(spark):
    df = spark.createDataFrame([("s", "p", "2020"), ("s", "q", "2021")], "SITE_ID string, PROGRAM_ID string, d string")
    assert latest_per_key(df, ["SITE_ID"], "d", []).count() == 1
    assert latest_per_key(df, ["SITE_ID", "PROGRAM_ID"], "d", []).count() == 2


@pytest.mark.parametrize("form", [enrich, enrich_sql])
def test_a_missing_site_hides_the_method(spark, form):
    samples = spark.createDataFrame([("s1", "p"), ("s2", "p"), (None, "p")], "SITE_ID string, PROGRAM_ID string")
    sites = spark.createDataFrame([("s1", "p", "lake")], "SITE_ID string, PROGRAM_ID string, SITE_NAME string")
    methods = spark.createDataFrame([("p", "m1"), ("p", "m2")], "PROGRAM_ID string, METHOD string")
    rows = form(samples, sites, latest_per_key(methods, ["PROGRAM_ID"], "METHOD", ["METHOD"])).collect()
    got = {(r.SITE_ID_LTM, r.SITE_NAME, r.METHOD, r.PROGRAM_ID_METHODE) for r in rows}
    assert got == {("s1", "lake", "m2", "p"), ("s2", None, None, None), (None, None, None, None)}
    assert len(rows) == 3
    assert form(samples, sites, methods).count() == 4, "methods that are not collapsed fan out"


def test_range_keeps_both_ends_and_drops_null(spark):
    df = texts(spark, "1", "2", "3", "4", None)
    assert column(between(df, "v", F.lit("2"), F.lit("3"))) == ["2", "3"]


def test_latest_batch_is_numeric(spark):
    df = texts(spark, "batch_9", "batch_10", "foo").toDF("version_id")
    assert latest_batch(df).first().version_id == "batch_10"
    assert column(texts(spark, "batch_12", "foo", "batch_99999999999").select(trailing_number("v"))) == [12, None, None]


def test_column_names_match_in_any_case(spark):
    df = spark.createDataFrame([("a", "2020")], "k string, END_YEAR string")
    assert latest_per_key(df, ["K"], "end_year", []).columns == ["k", "END_YEAR"]
    with pytest.raises(ValueError, match="available columns.*END_YEAR"):
        latest_per_key(df, ["k"], "UPDATE_DATE", [])


def test_null_ids_match_each_other(spark):
    left, right = texts(spark, "a", "b", None, "a"), texts(spark, "b", None, "c", "c")
    assert {tuple(r) for r in reconcile_ids(left, right, "v").collect()} == {("right", "a"), ("left", "c")}
    assert reconcile_ids(left, right, "v").count() == 2


def test_except_all_counts_copies(spark):
    left, right = texts(spark, "a", "a", "a", None, None, "b"), texts(spark, "a", None, "c", "b", "b")
    assert sorted(column(except_all(left, right)), key=str) == [None, "a", "a"]


def test_group_without_numbers_has_a_count(spark):
    df = spark.createDataFrame(
        [("s", "p", dt.datetime(2024, 1, 1), None, "x", "")],
        "SITE_ID string, PROGRAM_ID string, DATE_SMP timestamp, PH_LAB string, SO4_UEQ_L string, NO3_UEQ_L string",
    )
    assert tuple(annual_metrics(df, "SITE_ID", "PROGRAM_ID").first()) == ("s", "p", 2024, None, None, None, 1)


def test_null_profile_has_a_row_per_column(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "`a.b` int, c string")
    assert [tuple(r) for r in null_profile(df).collect()] == [(0, "a.b", "int", 1), (1, "c", "string", 2)]


def test_missing_value_texts(spark):
    df = texts(spark, "NA", "", "n/a", "None", "x", None)
    assert column(df.select(null_tokens_to_null("v"))) == [None, None, None, None, "x", None]


def test_odd_column_names_survive_the_collapse(spark):
    schema = StructType([StructField(n, StringType()) for n in ("k.1", "a b", "date")])
    df = spark.createDataFrame([("x", "1", "2020"), ("x", "2", "2021")], schema)
    assert [tuple(r) for r in latest_per_key(df, ["k.1"], "date", ["a b"]).collect()] == [("x", "2", "2021")]

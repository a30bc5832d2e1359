"""Sources, sinks and session helpers."""

import pytest

from tarnlake.schemas import METHODS
from tarnlake.session import input_bytes, size_shuffles, work_folder
from tarnlake.sources import (
    append_table,
    create_schema_if_absent,
    create_table_if_absent,
    kafka_options,
    overwrite_batch,
    overwrite_table,
    read_delimited,
    read_jdbc,
    read_table,
    redelimit,
    to_messages,
    write_batches,
    write_delimited,
)
from tarnlake.sources.jdbc import jdbc_options


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a;b"), (2, 'q"c,d'), (3, None)], "n int, v string")


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_delimited_round_trip(spark, rows, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    write_delimited(rows, first, ";")
    redelimit(spark, first, second)
    assert as_set(read_delimited(spark, second, rows.schema, ",")) == as_set(rows)
    assert read_delimited(spark, first).dtypes == [("n", "string"), ("v", "string")]
    assert read_delimited(spark, first, infer=True).dtypes == [("n", "int"), ("v", "string")]


def test_missing_values_in_a_file(spark, tmp_path):
    (tmp_path / "m.csv").write_text("n;v\n1;NA\n2;x\n")
    path = str(tmp_path / "m.csv")
    assert as_set(read_delimited(spark, path, infer=True, missing_value_texts=True)) == {(1, None), (2, "x")}


def test_sinks(spark, rows):
    target = work_folder(spark, "t")
    overwrite_table(rows, target)
    overwrite_table(rows, target)
    append_table(rows.limit(1), target)
    assert read_table(spark, target).count() == 4


def test_a_batch_is_replaced_not_repeated(spark, rows):
    target = work_folder(spark, "t")
    for batch in (0, 1, 1):
        overwrite_batch(rows, target, batch)
    assert spark.read.parquet(target).groupBy("batch_id").count().collect() == [(0, 3), (1, 3)] or as_set(
        spark.read.parquet(target).groupBy("batch_id").count()
    ) == {(0, 3), (1, 3)}


def test_many_batches_at_once(spark, rows):
    target = work_folder(spark, "t")
    write_batches(rows, target, "n")
    write_batches(rows.filter("n = 2"), target, "n")
    assert read_table(spark, target).count() == 3


def test_ddl_keeps_what_is_there(spark, rows):
    folder, location = work_folder(spark, "s"), work_folder(spark, "t")
    for turn in (1, 2):
        create_schema_if_absent(spark, "tarn_test", folder)
        create_table_if_absent(spark, "tarn_test.rows", rows.schema, location)
        if turn == 1:
            append_table(rows, "tarn_test.rows")
    assert as_set(read_table(spark, "tarn_test.rows")) == as_set(rows)
    overwrite_table(rows.limit(1), "tarn_test.copy")
    assert read_table(spark, "tarn_test.copy").count() == 1
    for name in ("rows", "copy"):
        spark.sql(f"DROP TABLE tarn_test.{name}")
    spark.sql("DROP SCHEMA tarn_test")


def test_messages_leave_out_nulls(spark, rows):
    assert as_set(to_messages(rows)) == {('{"n":1,"v":"a;b"}',), ('{"n":2,"v":"q\\"c,d"}',), ('{"n":3}',)}


def test_connector_options(spark):
    assert kafka_options("h:1", "t", max_per_batch=5000) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5000",
    }
    assert jdbc_options("u", "t", "d", fetchsize="9") == {"url": "u", "dbtable": "t", "driver": "d", "fetchsize": "9"}
    with pytest.raises(ValueError, match="bound"):
        read_jdbc(spark, "u", "t", partition_column="n")


def test_work_folder_needs_shared_storage_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(Session(), "x")


def test_work_folder_is_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    assert not named or folder.startswith(named)


def test_shuffles_grow_with_the_input(spark, monkeypatch):
    path = "/root/testdata/sf0.01/orders.parquet"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_shuffles(spark, path) == int(before)
    size = input_bytes(spark, path)
    monkeypatch.setattr("tarnlake.session.BYTES_PER_SHUFFLE_PARTITION", size // 100)
    try:
        assert size_shuffles(spark, path) >= 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_method_columns():
    assert METHODS.fieldNames()[0] == "PROGRAM_ID"

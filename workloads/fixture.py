"""The given tables in the roles the operators need.

samples: orders with their customer's nation; sites: customers in credit; methods:
suppliers; batches: half-years of orders; messages: events as JSON lines.
"""

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators import ledger_rows
from tarnlake.session import configure, size_shuffles, work_folder
from tarnlake.sources import (
    message_stream,
    overwrite_table,
    read_table,
    write_batches,
    write_messages,
)
from tarnlake.streaming import BatchStore, store_batches

FIRST_YEAR = 1995


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    configure(spark)
    size_shuffles(spark, path)
    return read_table(spark, path)


def comma_text(column: str):
    text = F.col(column).cast("decimal(18,2)").cast("string")
    return F.replace(text, F.lit("."), F.lit(","))


def samples(spark, sf_dir) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    so4 = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.col("o_orderkey").cast("string"), F.lit(",5")))
        .when(F.col("o_orderstatus") == "P", "NaN")
        .otherwise("<0,5")
    )
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_custkey").alias("SITE_ID"),
        F.col("c_nationkey").alias("PROGRAM_ID"),
        F.col("o_orderdate").alias("DATE_SMP"),
        comma_text("o_totalprice").alias("PH_LAB"),
        so4.alias("SO4_UEQ_L"),
        comma_text("c_acctbal").alias("NO3_UEQ_L"),
        F.col("o_orderkey").alias("SAMPLE_NO"),
    )


def sites(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal >= 0")
        .select(
            F.col("c_custkey").alias("SITE_ID"),
            F.col("c_nationkey").alias("PROGRAM_ID"),
            F.col("c_name").alias("SITE_NAME"),
            F.col("c_mktsegment").alias("STATE"),
            (F.lit(2000) + F.col("c_custkey") % 20).cast("int").alias("UPDATE_DATE"),
        )
    )


def methods(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("PROGRAM_ID"),
        (F.lit(1990) + F.col("s_suppkey") % 30).cast("string").alias("END_YEAR"),
        F.col("s_name").alias("METHOD"),
        F.col("s_suppkey").alias("METHOD_NO"),
    )


def numbered_orders(spark, sf_dir) -> DataFrame:
    """Orders with the number of the half-year they belong to."""
    date = F.col("o_orderdate")
    half = F.when(F.month(date) > 6, 1).otherwise(0)
    return table(spark, sf_dir, "orders").withColumn("batch_id", (F.year(date) - FIRST_YEAR) * 2 + half)


def ledger(spark, sf_dir, snapshot_root="snapshots") -> DataFrame:
    return ledger_rows(numbered_orders(spark, sf_dir), "batch_id", "o_orderdate", snapshot_root)


def stored_ledger(spark, sf_dir, snapshot_root="snapshots") -> DataFrame:
    """The ledger as a table of its own, as it is in use: a few rows, read in no time."""
    folder = work_folder(spark, "ledger")
    overwrite_table(ledger(spark, sf_dir, snapshot_root), folder)
    return read_table(spark, folder)


def stored_snapshots(spark, sf_dir) -> tuple[DataFrame, str]:
    """Orders as one snapshot per batch; the batch's year comes from the stored ledger."""
    root = work_folder(spark, "snapshots")
    kept = stored_ledger(spark, sf_dir, root)
    years = kept.select(
        F.regexp_extract("version_id", r"(\d+)", 1).cast("int").alias("batch_id"),
        F.year("min_datestamp").alias("year"),
    )
    orders = numbered_orders(spark, sf_dir).join(years, "batch_id")
    write_batches(orders, root, "year", "batch_id", rebalance=True)
    return kept, root


def short_batches(spark, sf_dir) -> DataFrame:
    """Orders with the number of their stretch of twelve days: some 200 batches."""
    stretch = F.floor(F.datediff("o_orderdate", F.lit(f"{FIRST_YEAR}-01-01").cast("date")) / 12)
    return table(spark, sf_dir, "orders").withColumn("batch_id", stretch.cast("int"))


def short_batch_store(spark, sf_dir, *parts):
    """A store with these batches of orders, stored part by part, and the rows' schema."""
    store, orders = BatchStore(work_folder(spark, "store")), short_batches(spark, sf_dir)
    for part in parts or (F.lit(True),):
        store_batches(orders.where(part), "batch_id", store, "o_orderdate")
    return store, orders.drop("batch_id").schema


def file_sizes(rows: int, batches: int = 4, files_per_batch: int = 8, most_rows: int = 5_000_000) -> tuple[int, int]:
    """Rows per file and files per micro-batch that give about ``batches`` micro-batches.

    A file holds ``most_rows`` at most; a micro-batch of a large table then has more files.
    """
    rows_per_file = max(1, min(most_rows, math.ceil(rows / (files_per_batch * batches))))
    return rows_per_file, math.ceil(math.ceil(rows / rows_per_file) / batches)


def event_messages(spark, sf_dir) -> DataFrame:
    """All events as a message stream that Spark reads in about four micro-batches."""
    events = table(spark, sf_dir, "events")
    rows_per_file, files_per_batch = file_sizes(events.count())
    folder = work_folder(spark, "messages")
    write_messages(events, folder, rows_per_file=rows_per_file)
    return message_stream(spark, folder, files_per_batch)


def event_file_stream(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows_per_file, files_per_batch = file_sizes(events.count())
    folder = work_folder(spark, "event-files")
    events.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)

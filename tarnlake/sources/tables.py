"""Parquet folders and catalog tables: scans, sinks, DDL and snapshots.

A target that holds a ``/`` is a folder, any other a catalog table.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.functions.text import trailing_number
from tarnlake.operators.batches import FOLDED
from tarnlake.session import delete_folders, recover_folder, replace_folder


def read_table(spark: SparkSession, target: str, schema: StructType | None = None) -> DataFrame:
    if "/" not in target:
        return spark.table(target)
    recover_folder(spark, target)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(target)


def _write(df: DataFrame, target: str, mode: str) -> None:
    writer = df.write.mode(mode).format("parquet")
    writer.save(target) if "/" in target else writer.saveAsTable(target)


def append_table(df: DataFrame, target: str) -> None:
    _write(df, target, "append")


def overwrite_table(df: DataFrame, target: str) -> None:
    """Replace a table's rows; a write that fails leaves the old ones, and ``df`` may read the table itself.

    The new rows are written aside and take the table's place when they are complete: a folder
    by renaming, a catalog table by its name. A reader that listed the old files just before has
    to start again.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    if "/" in target:
        aside = f"{target.rstrip('/')}._aside-{mark}"
        try:
            df.write.parquet(aside)
            recover_folder(spark, target)
            replace_folder(spark, aside, target)
        finally:
            delete_folders(spark, [aside])
        return
    if not spark.catalog.tableExists(target):
        return _write(df, target, "error")
    aside = f"{target}_aside_{mark}"
    try:
        _write(df, aside, "error")
        spark.sql(f"DROP TABLE {target}")
        spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")


def overwrite_batch(df: DataFrame, folder: str, batch_id, column: str = "batch_id") -> str:
    """Store one batch as the partition ``column=batch_id``; storing it again replaces it.

    The append of a batch that may be retried: other batches are not touched and no
    shuffle or sort by the partition column is needed.
    """
    partition = f"{folder}/{column}={batch_id}"
    df.write.mode("overwrite").parquet(partition)
    return partition


def write_batches(df: DataFrame, folder: str, *columns: str, rebalance: bool = False) -> None:
    """Store many batches in one job, replacing just the partitions that occur in ``df``.

    Each task writes a file for every batch it has rows of. Where the rows of a batch are
    spread over all tasks, ``rebalance`` brings them together first, and a large batch
    still goes to as many tasks as its size asks for.
    """
    if rebalance:
        df = df.hint("rebalance", *columns)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(folder)
    )


def create_schema_if_absent(spark: SparkSession, name: str, location: str | None = None) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def create_table_if_absent(spark: SparkSession, name: str, schema: StructType, location: str | None = None) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet"
        + (f" LOCATION '{location}'" if location else "")
    )


def read_snapshot(
    spark: SparkSession, ledger: DataFrame, version_id: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """The stored rows of one version, the newest unless one is named; all columns, or a schema's."""
    if version_id:
        rows = ledger.filter(F.col("version_id") == version_id)
    else:
        rows = ledger.orderBy(trailing_number("version_id").desc_nulls_last())
    row = rows.select("snapshot_path", "version_id").first()
    if row is None:
        raise LookupError(f"no version {version_id or 'at all'} in the ledger")
    if FOLDED not in row["snapshot_path"]:
        return read_table(spark, row["snapshot_path"], schema)
    folded = read_table(spark, row["snapshot_path"], StructType([*schema.fields]).add("batch_id", "integer") if schema else None)
    number = int(row["version_id"].rpartition("_")[2])
    return folded.where(F.col("batch_id") == number).drop("batch_id")

"""The batch ledger and slices taken by it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.text import batch_label, trailing_number

# Root folder, year of the batch's first date (or UNKNOWN_YEAR), batch number.
SNAPSHOT_FOLDER = "%s/year=%s/batch_id=%s"
UNKNOWN_YEAR = "unknown"
# Where folders of many batches are, below the rows' folder; their files tell batches apart by a column.
FOLDED = "/_folded/"


def ledger_rows(df: DataFrame, batch_column: str, date_column: str, snapshot_root: str) -> DataFrame:
    """One ledger row per batch number found in ``df``, in a single aggregation."""
    per_batch = df.groupBy(F.col(batch_column).alias("batch")).agg(
        F.min(date_column).alias("min_datestamp"),
        F.max(date_column).alias("max_datestamp"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return per_batch.select(
        batch_label("batch").alias("version_id"),
        "min_datestamp",
        "max_datestamp",
        batch_label("batch", "Batch %s").alias("description"),
        F.format_string(
            SNAPSHOT_FOLDER,
            F.lit(snapshot_root),
            F.coalesce(F.year("min_datestamp").cast("string"), F.lit(UNKNOWN_YEAR)),
            F.col("batch").cast("string"),
        ).alias("snapshot_path"),
        "row_count",
        F.lit(0).cast("long").alias("corrupt_count"),
    )


def latest_batch(ledger: DataFrame) -> DataFrame:
    """The ledger row with the greatest batch number; ``batch_10`` comes after ``batch_9``."""
    return (
        ledger.withColumn("batch_number", trailing_number("version_id"))
        .orderBy(F.col("batch_number").desc_nulls_last(), F.col("version_id").desc())
        .limit(1)
    )


def between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows within a closed range; a NULL value is in no range."""
    return df.filter((F.col(column) >= low) & (F.col(column) <= high))


def latest_slice(df: DataFrame, date_column: str, ledger: DataFrame) -> DataFrame:
    """Rows whose date lies in the last batch's date range.

    The two bounds are scalar subqueries on the stored ledger: they reach the scan as
    pushed filters without going through the driver program.
    """
    last = latest_batch(ledger)
    return between(
        df, date_column, last.select("min_datestamp").scalar(), last.select("max_datestamp").scalar()
    )

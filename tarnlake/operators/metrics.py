"""Counts, ranges and yearly means."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.text import decimal_comma
from tarnlake.schemas import METRIC_COLUMNS


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def date_range(df: DataFrame, date_column: str) -> DataFrame:
    """First date, last date and row count in one pass."""
    return df.agg(
        F.min(date_column).alias("min_datestamp"),
        F.max(date_column).alias("max_datestamp"),
        F.count(F.lit(1)).alias("row_count"),
    )


def annual_metrics(
    df: DataFrame,
    site: str = "SITE_ID_LTM",
    program: str = "PROGRAM_ID_LTM",
    date: str = "DATE_SMP",
    measures: dict[str, str] = METRIC_COLUMNS,
) -> DataFrame:
    """Means of text measurements and sample counts per site, program and year.

    A mean skips values that are no number, the count does not.
    """
    read = df.select(
        F.col(site).alias("SITE_ID"),
        F.col(program).alias("PROGRAM_ID"),
        F.year(date).alias("YEAR"),
        *[decimal_comma(c).alias(c) for c in measures],
    )
    return read.groupBy("SITE_ID", "PROGRAM_ID", "YEAR").agg(
        *[F.avg(c).alias(mean) for c, mean in measures.items()],
        F.count(F.lit(1)).alias("TOTAL_SAMPLES"),
    )

"""Dimension tables out of delimited files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tarnlake.functions.text import first_chars
from tarnlake.sources.delimited import read_delimited
from tarnlake.sources.tables import overwrite_table, read_table


def load_dimension(
    spark: SparkSession,
    path: str,
    schema: StructType,
    target: str,
    end_year_column: str | None = None,
    sep: str = ";",
) -> DataFrame:
    """Replace ``target`` by the file's rows; with an end-year column, ``end_date`` is its year."""
    rows = read_delimited(spark, path, schema, sep)
    if end_year_column:
        rows = rows.withColumn("end_date", first_chars(end_year_column))
    overwrite_table(rows, target)
    return read_table(spark, target)

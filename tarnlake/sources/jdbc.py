"""Tables in a database with a JDBC driver on the class path."""

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, driver: str | None = None, **options: str) -> dict[str, str]:
    named = {"url": url, "dbtable": table, **options}
    return {**named, "driver": driver} if driver else named


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A table scan; with a partition column and its bounds, ``partitions`` tasks read it.

    The bounds only place the cuts: rows outside of them go to the first or last task.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, driver, **options))
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", driver: str | None = None, **options: str) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, driver, **options)).mode(mode).save()

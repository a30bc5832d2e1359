"""Looking at a table and testing it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """Position, name, type and NULL count of every column, from one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    profile = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(f"c{i}").alias("null_count"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*profile)))


def preview(df: DataFrame, order_by: list[str], rows: int = 20) -> DataFrame:
    """The first rows in a stated order, so that every look shows the same ones."""
    return df.orderBy(*order_by).limit(rows)


def check_not_empty(df: DataFrame, name: str, counted: bool = True) -> DataFrame:
    """One row (``check_name``, ``passed``, ``row_count``).

    Without ``counted`` the table is read until it shows a row, and ``row_count`` is left out.
    """
    rows = df if counted else df.limit(1)
    checked = rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(f"{name} is not empty").alias("check_name"),
        (F.col("row_count") > 0).alias("passed"),
        "row_count",
    )
    return checked if counted else checked.drop("row_count")


def assert_not_empty(df: DataFrame, name: str) -> None:
    """Raise where a table has no rows; reads no more than it takes to find one."""
    if df.isEmpty():
        raise AssertionError(f"{name} is empty")

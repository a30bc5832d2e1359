"""Dates and timestamps out of text and loosely typed columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, NumericType, StringType

from tarnlake.schemas import TIMESTAMP_FORMAT


def parse_timestamp(c, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text to timestamp by a pattern, NULL where it does not fit."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c, F.lit(fmt))


def resolve_column(df: DataFrame, name: str) -> str:
    """The name as spelt in ``df``, matched like Spark does; raises if there is none."""
    found = [c for c in df.columns if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"column {name!r} is missing; available columns: {df.columns}")
    return name if name in found else found[0]


def order_date(df: DataFrame, name: str) -> Column:
    """The date to order a history by: a date, a timestamp, a date-like text or a year."""
    name = resolve_column(df, name)
    kind = df.schema[name].dataType
    value = F.col(f"`{name}`")
    if isinstance(kind, FractionalType):
        value = value.try_cast("long")
    if isinstance(kind, (NumericType, StringType)):
        return value.cast("string").try_cast("date")
    return value.cast("date")

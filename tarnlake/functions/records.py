"""JSON records in and out of a text column."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# to_json cuts timestamps to milliseconds unless told otherwise.
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_record(
    c, schema: StructType, timestamp_format: str | None = None, corrupt_column: str | None = None
) -> Column:
    """A struct of the declared fields; text that is no such record gives NULL fields.

    A timestamp may be in Spark's own format (``2020-01-02 03:04:05``, a ``T`` for the
    space, a date alone) or epoch seconds; Spark reads these fast. Name any other format.
    With ``corrupt_column`` the struct also carries the text that could not be parsed.
    """
    options = {"mode": "PERMISSIVE"}
    if timestamp_format:
        options.update(timestampFormat=timestamp_format, enableDateTimeParsingFallback="true")
    if corrupt_column:
        schema = StructType(list(schema.fields)).add(corrupt_column, StringType())
        options["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_json((F.col(c) if isinstance(c, str) else c).cast("string"), schema, options)


def json_text(*columns: str) -> Column:
    """One JSON object per row; all columns unless some are named."""
    return F.to_json(
        F.struct(*(columns or ("*",))),
        {"timestampFormat": MICROSECONDS + "XXX", "timestampNTZFormat": MICROSECONDS},
    )

"""Delimited text files."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarnlake.functions.dates import resolve_column
from tarnlake.functions.records import MICROSECONDS
from tarnlake.functions.text import null_tokens_to_null

_FORMATS = {"timestampFormat": MICROSECONDS, "timestampNTZFormat": MICROSECONDS}


# Quotes are doubled within quotes, and blanks belong to the value.
_AS_IS = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _options(reader, sep: str, multi_line: bool = False):
    return reader.option("sep", sep).option("header", True).option("multiLine", multi_line).options(**_FORMATS, **_AS_IS)


def _header_schema(spark, path, sep, multi_line=False) -> StructType:
    """All columns of a file's header line, as text."""
    return StructType([StructField(c, StringType()) for c in _options(spark.read, sep, multi_line).csv(path).columns])


def _by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns out of text columns, found by name; what cannot be read becomes NULL."""
    return df.select(
        *[F.col(f"`{resolve_column(df, f.name)}`").try_cast(f.dataType).alias(f.name) for f in schema]
    )


def _without_missing_value_texts(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            null_tokens_to_null(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    sep: str = ";",
    infer: bool = False,
    missing_value_texts: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Files with a header line, the same in all files of a folder.

    A declared schema is matched by the header's names, in any order and letter case; other
    columns are left out, and a missing one raises. ``infer`` reads all files twice. With
    neither, every column is text. ``multi_line`` accepts line breaks within quotes; a file
    is then read by one task. ``missing_value_texts`` turns ``NA``, ``NaN``, ``null`` and the like
    in text columns into NULL.
    """
    reader = _options(spark.read, sep, multi_line)
    if schema:
        reader = reader.schema(_header_schema(spark, path, sep, multi_line)).option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    if schema:
        df = _by_name(df, schema)
    return _without_missing_value_texts(df) if missing_value_texts else df


def delimited_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    sep: str = ",",
    files_per_batch: int | None = None,
    missing_value_texts: bool = True,
) -> DataFrame:
    """The files of a folder, those there and those to come, as a stream of rows.

    Columns are matched by the names in the header of the files that are there at the start;
    a later file with another header fails the query. An empty folder counts as one whose
    files will have just the declared columns.
    """
    try:
        header = _header_schema(spark, folder, sep)
    except AnalysisException:
        header = schema
    found = header if len(header) else schema
    as_text = StructType([StructField(f.name, StringType()) for f in found])
    reader = _options(spark.readStream, sep).schema(as_text).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    df = _by_name(reader.csv(folder), schema)
    return _without_missing_value_texts(df) if missing_value_texts else df


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).options(**_FORMATS, **_AS_IS).csv(path)


def redelimit(
    spark: SparkSession,
    source: str,
    target: str,
    source_sep: str = ";",
    target_sep: str = ",",
    missing_value_texts: bool = False,
    multi_line: bool = False,
) -> None:
    """Rewrite delimited files with another delimiter; values pass through as text.

    Quotes and blanks at the edges stay; line breaks within quotes need ``multi_line``.

    With ``missing_value_texts``, ``NA`` and the like are written as empty fields.
    """
    rows = read_delimited(spark, source, sep=source_sep, missing_value_texts=missing_value_texts, multi_line=multi_line)
    write_delimited(rows, target, target_sep)

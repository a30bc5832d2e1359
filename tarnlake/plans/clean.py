"""First look at a delimited file, and its rewrite with commas."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.text import NUMBER_START
from tarnlake.sources.delimited import read_delimited, write_delimited

PROFILE = "position int, column_name string, data_type string, null_count long"


def _fits(c):
    """For each type, from the narrowest on, whether a text can be read as it."""
    return {
        "int": c.try_cast("int").isNotNull(),
        "bigint": c.try_cast("bigint").isNotNull(),
        "double": c.rlike(NUMBER_START) & c.try_cast("double").isNotNull(),
        "date": c.rlike(r"^\d{4}-\d\d-\d\d$") & c.try_cast("date").isNotNull(),
        "timestamp": c.rlike(r"^\d{4}-\d\d-\d\d[ T]\d") & c.try_cast("timestamp").isNotNull(),
        "boolean": F.lower(c).isin("true", "false"),
    }


def clean_file(spark: SparkSession, source: str, target: str, source_sep: str = ";") -> DataFrame:
    """Rewrite ``source`` with commas and return its column profile, from one pass over the rows.

    A column's type is the narrowest that all its values can be read as; the texts that stand
    for a missing value count as NULL and are left empty in the new file. A column without any
    value is text.
    """
    rows = read_delimited(spark, source, sep=source_sep, missing_value_texts=True)
    figures = []
    for i, name in enumerate(rows.columns):
        c = F.col(f"`{name}`")
        figures.append(F.count(c).alias(f"{i}"))
        figures += [F.count_if(fits).alias(f"{i} {kind}") for kind, fits in _fits(c).items()]
    seen = Observation()
    write_delimited(rows.observe(seen, F.count(F.lit(1)).alias("rows"), *figures), target)
    found = seen.get
    profile = []
    for i, name in enumerate(rows.columns):
        values = found.get(f"{i}", 0)
        kind = next((k for k in _fits(F.lit("")) if values and found[f"{i} {k}"] == values), "string")
        profile.append((i, name, kind, found.get("rows", 0) - values))
    return spark.createDataFrame(profile, PROFILE)

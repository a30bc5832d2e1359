"""Numbers and labels held in text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that the pandas CSV reader takes for a missing value.
MISSING_VALUE_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What text that can be read as a double starts with. Trying to read any other text is
# correct but throws and catches an exception per row, ten times the cost of this test.
NUMBER_START = r"^[\x00-\x20]*[+-]?[0-9.iI]"


def decimal_comma(c) -> Column:
    """Text with a decimal point or comma as a double; anything else becomes NULL.

    NaN becomes NULL too, so that it cannot spoil a mean.
    """
    text = F.replace(_column(c), F.lit(","), F.lit("."))
    number = F.nullif(text.try_cast("double"), F.lit(float("nan")))
    return F.when(text.rlike(NUMBER_START), number)


def trailing_number(c, prefix: str = "batch_") -> Column:
    """The digits after ``prefix`` as an int, NULL where there are none."""
    return F.regexp_extract(_column(c), rf"{prefix}(\d+)", 1).try_cast("int")


def first_chars(c, length: int = 4) -> Column:
    """The first characters of a value's text form (the year of a date-like text)."""
    return F.substring(_column(c).cast("string"), 1, length)


def batch_label(batch, template: str = "batch_%s") -> Column:
    return F.format_string(template, _column(batch).cast("string"))


def null_tokens_to_null(c, tokens=MISSING_VALUE_TEXTS) -> Column:
    value = _column(c)
    return F.when(~value.isin(*tokens), value)

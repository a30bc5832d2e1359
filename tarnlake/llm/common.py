"""What the operators of this package share: words, row batches, stored steps."""

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.session import work_folder

#: Rows of one Arrow batch handed to Python; with the documents' texts a few MB.
ROWS_PER_BATCH = 2000
#: A batch is worked off in pieces of about so many characters of text.
CHARS_PER_PIECE = 4_000_000
#: ASCII white space, as the contracts name it; ``bytes.split()`` splits at the same six.
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = 0x9E3779B97F4A7C15


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for Python stages; may be called again at any time.

    Batches are small, so that very long texts do not pile up in a worker. On one machine
    the workers find this package where the driver found it; on a cluster it has to be
    installed or sent along (``--py-files``), like any Python code of a Spark job.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    home = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared work folder and read back.

    Cuts the lineage: what comes after is computed once and a lost executor costs only the
    tasks it ran. ``cleanCheckpoints`` does not apply here, the folder goes with the session.
    """
    spark = df.sparkSession
    folder = work_folder(spark, label)
    df.write.mode("overwrite").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit values scattered (the finaliser of SplitMix64); another seed, another order."""
    x = values + np.uint64(seed * _STEP % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def text_pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches and their texts, cut at ``CHARS_PER_PIECE``; one long text is a piece by itself."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        start = chars = 0
        for i, text in enumerate(texts):
            chars += len(text or "")
            if chars >= CHARS_PER_PIECE or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, chars = i + 1, 0


def unsigned(values) -> np.ndarray:
    return np.asarray(values, dtype=np.int64).view(np.uint64)


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.int64)

"""Keys that hold a large share of a table's rows."""

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key with fewer rows than this is no burden to a task, whatever its share.
HEAVY_ROWS = 10_000
# Sketches are merged in this many groups first, so that no task merges those of all tasks.
MERGE_GROUPS = 64
# More counters a sketch may not have; keys are then found down to this share.
MOST_COUNTERS = 1 << 19
KEY = "__key"


class HeavyHashes(NamedTuple):
    """Hashes of heavy keys with their rows, as estimated, and the rows of the whole table."""

    rows: dict[int, int]
    total: int

    def pieces(self, rows_per_piece: float) -> dict[int, int]:
        return {key: math.ceil(n / rows_per_piece) for key, n in self.rows.items()}


def heavy_keys(df: DataFrame, keys: list[str], share: float, least_rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``share`` of all rows and at least ``least_rows``, and their exact ``n_rows``.

    Sketches name the keys that may qualify; only their rows are counted, each task sending one
    row per key. NULL is a key like any other. An empty table has no heavy key.
    """
    found = find_heavy(df, keys, share, least_rows)
    marked = df.withColumn(KEY, key_hash(keys)).join(heavy_table(df.sparkSession, found.rows), KEY, "left_semi")
    counted = marked.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter((F.col("n_rows") > F.lit(share * found.total)) & (F.col("n_rows") >= least_rows))


def find_heavy(df: DataFrame, keys: list[str], share: float, least_rows: int = HEAVY_ROWS) -> HeavyHashes:
    """One pass over the key columns: frequent-item sketches of key hashes, merged across tasks.

    A sketch of m counters misses no key with more than 7 / m of the rows, so every key above
    ``share`` is found; one that is a little lighter may come with them. At most 2 / ``share``
    hashes come to the driver. Two keys of one hash count as one key.
    """
    counters = min(MOST_COUNTERS, 1 << math.ceil(math.log2(max(8 / share, 64))))
    hashed = df.select(
        key_hash(keys).alias(KEY),
        F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("__group"),
    )
    merged = (
        hashed.groupBy("__group")
        .agg(F.expr(f"approx_top_k_accumulate({KEY}, {counters})").alias("sketch"), F.count(F.lit(1)).alias("n"))
        # Grouped, as the sketches of an empty table cannot be combined.
        .groupBy(F.lit("all"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch"), F.sum("n").alias("n"))
    )
    # An estimate is never below the count, and above it by less than half the share.
    most = min(counters, math.ceil(2 / share))
    row = merged.select("n", F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top")).first()
    if row is None:
        return HeavyHashes({}, 0)
    enough = [t for t in row["top"] if t["count"] > share * row["n"] and t["count"] >= least_rows]
    return HeavyHashes({t["item"]: t["count"] for t in enough}, row["n"])


def key_hash(keys):
    """One number for all key columns, NULLs included; columns of equal type and value give equal numbers."""
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def heavy_table(spark: SparkSession, values: dict[int, int], name: str = "__value") -> DataFrame:
    """Heavy hashes with a number each, to be joined to a table; a few at most, so they are broadcast."""
    return F.broadcast(spark.createDataFrame(list(values.items()), f"{KEY} bigint, {name} bigint"))


def usual_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

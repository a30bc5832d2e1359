"""Distinct ids, multiset difference and id reconciliation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_COPIES, _CHUNK = "__copies", "__chunk"


def distinct_ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def except_all(left: DataFrame, right: DataFrame, rows_per_task: int = 1_000_000) -> DataFrame:
    """``left EXCEPT ALL right``; columns match by position, NULLs count as equal.

    Only counts per distinct row are shuffled. The built-in operator then writes all
    copies of a row in one task from one in-memory list; here a row with more copies than
    ``rows_per_task`` is cut into chunks that go to different tasks.
    """
    columns = [F.col(f"`{c}`") for c in left.columns]
    signed = left.withColumn(_COPIES, F.lit(1).cast("long")).unionAll(
        right.withColumn(_COPIES, F.lit(-1).cast("long"))
    )
    surplus = signed.groupBy(*columns).agg(F.sum(_COPIES).alias(_COPIES)).filter(F.col(_COPIES) > 0)

    # A fixed number of partitions: adaptive execution would merge the chunks, which are
    # small only until they are written out.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = surplus.filter(F.col(_COPIES) <= rows_per_task)
    starts = F.sequence(F.lit(0).cast("long"), F.col(_COPIES) - 1, F.lit(rows_per_task).cast("long"))
    many = (
        surplus.filter(F.col(_COPIES) > rows_per_task)
        .select(*columns, _COPIES, F.explode(starts).alias(_CHUNK))
        .repartition(tasks, *columns, _CHUNK)
        .withColumn(_COPIES, F.least(F.lit(rows_per_task), F.col(_COPIES) - F.col(_CHUNK)))
    )
    counted = few.unionAll(many.drop(_CHUNK))
    each_copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col(_COPIES)))
    return counted.select(*columns, each_copy.alias(_CHUNK)).drop(_CHUNK)


def reconcile_ids(
    left: DataFrame,
    right: DataFrame,
    id_column: str,
    right_id_column: str | None = None,
    left_name: str = "left",
    right_name: str = "right",
) -> DataFrame:
    """Ids that only one side has, as rows of (``missing_in``, id).

    Both sides are tagged and grouped once, so there is a single shuffle of pre-aggregated
    ids and no join; a NULL id is an id like any other.
    """
    sides = left.select(F.col(id_column), F.lit(True).alias("l"), F.lit(False).alias("r")).unionAll(
        right.select(F.col(right_id_column or id_column), F.lit(False), F.lit(True))
    )
    found = sides.groupBy(id_column).agg(F.bool_or("l").alias("l"), F.bool_or("r").alias("r"))
    return found.filter(F.col("l") != F.col("r")).select(
        F.when(F.col("l"), right_name).otherwise(left_name).alias("missing_in"), id_column
    )

"""Row histories: rows that share a key, ordered by a date."""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tarnlake.functions.dates import order_date, resolve_column
from tarnlake.operators.heavy import KEY, find_heavy, heavy_table, key_hash, usual_tasks
from tarnlake.session import work_folder

_ORDER, _SLICE, _BEFORE = "__order_date", "__slice", "__rows_before"


def latest_per_key(
    df: DataFrame, keys: list[str], order_by: str, tie_break: list[str], ties_are_unique: bool = False
) -> DataFrame:
    """The newest row of each key: greatest date, then greatest ``tie_break`` values.

    Rows that agree on all of these are told apart by their other columns, so the result
    never depends on how the input is split. A key whose dates are all NULL keeps one row;
    NULL keys form one group.

    With ``ties_are_unique`` the caller declares that no two rows of a key agree in date and
    tie-break. The other columns then take no part in the order, and those that nobody reads
    are not scanned.

    Written as one ``max`` over a struct and not as ``row_number() = 1``: each task sends
    on one row per key at most, however hot the key, and Catalyst learns that the keys are
    unique, which lets it drop left joins whose columns nobody reads.
    """
    keys = [resolve_column(df, k) for k in keys]
    ties = [resolve_column(df, t) for t in tie_break]
    ties = [t for t in dict.fromkeys(ties) if t not in keys]
    others = [c for c in df.columns if c not in keys and c not in ties]
    date = order_date(df, order_by).alias(_ORDER)
    # Maps have no order; their sorted entries have.
    maps = {f.name for f in df.schema if isinstance(f.dataType, MapType)}
    ordered = [F.array_sort(F.map_entries(f"`{c}`")).alias(c) if c in maps else F.col(f"`{c}`") for c in ties + others]
    if ties_are_unique:
        order = F.struct(date, *ordered[: len(ties)])
        newest = [F.max_by(F.col(f"`{c}`"), order).alias(c) for c in ties + others]
        return df.groupBy(*_cols(keys)).agg(*newest).select(*_cols(df.columns))
    grouped = df.groupBy(*_cols(keys)).agg(F.max(F.struct(date, *ordered)).alias("__newest"))

    def value(c):
        entries = F.col(f"__newest.`{c}`")
        return (F.map_from_entries(entries) if c in maps else entries).alias(c)

    return grouped.select(*[F.col(f"`{c}`") if c in keys else value(c) for c in df.columns])


def row_number_desc(
    df: DataFrame,
    keys: list[str],
    order_by: str,
    tie_break: list[str],
    name: str = "row_num",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Number the rows of each key from the newest on, ties by descending ``tie_break``.

    A window puts all rows of a key into one task. Keys with more than two tasks' share of the
    rows are found first, in a pass over the key columns, and their rows alone are cut into sorted
    slices: each slice is numbered by itself, and a key that goes over several slices adds the
    rows that come before. With ``rows_per_task`` nothing is searched for and the whole table goes
    into slices of about that many rows. The numbers, of type ``bigint``, are the same either way.

    Where there are heavy keys the table is read once for them and once for the others, so its
    rows must be the same each time.
    """
    keys, order_by = [resolve_column(df, k) for k in keys], resolve_column(df, order_by)
    newest_first = [F.col(f"`{c}`").desc_nulls_last() for c in [order_by, *(resolve_column(df, t) for t in tie_break)]]
    tasks = usual_tasks(df.sparkSession)
    if rows_per_task is not None:
        slices = max(math.ceil(df.count() / rows_per_task) * 2, tasks)
        return _numbered_in_slices(df, keys, newest_first, name, slices)
    heavy = find_heavy(df, keys, 2 / tasks).rows
    if not heavy:
        return _numbered(df, keys, newest_first, name)
    marked, hot = df.withColumn(KEY, key_hash(keys)), heavy_table(df.sparkSession, heavy)
    others, few = (marked.join(hot, KEY, how).select(*_cols(df.columns)) for how in ("left_anti", "left_semi"))
    return _numbered(others, keys, newest_first, name).unionByName(
        _numbered_in_slices(few, keys, newest_first, name, tasks)
    )


def _numbered(df, keys, newest_first, name):
    window = Window.partitionBy(*_cols(keys)).orderBy(*newest_first)
    return df.withColumn(name, F.row_number().over(window).cast("long"))


def _numbered_in_slices(df, keys, newest_first, name, slices):
    folder = work_folder(df.sparkSession, "sorted-slices")
    (
        df.repartitionByRange(slices, *_cols(keys), *newest_first)
        .withColumn(_SLICE, F.spark_partition_id())
        .write.mode("overwrite")
        .parquet(folder)
    )
    sliced = df.sparkSession.read.parquet(folder)

    # A slice continues at most one key of earlier slices, so at most ``slices`` rows
    # are left here; Spark broadcasts them where they are below its limit.
    earlier = Window.partitionBy(*_cols(keys)).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    continued = (
        sliced.groupBy(*_cols(keys), _SLICE)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*_cols(keys), _SLICE, F.sum("n").over(earlier).alias(_BEFORE))
        .filter(F.col(_BEFORE) > 0)
    )
    within = Window.partitionBy(*_cols(keys), _SLICE).orderBy(*newest_first)
    numbered = sliced.withColumn(name, F.row_number().over(within)).alias("r")
    same_slice = F.col(f"r.{_SLICE}") == F.col(f"c.{_SLICE}")
    for k in keys:
        same_slice &= F.col(f"r.`{k}`").eqNullSafe(F.col(f"c.`{k}`"))
    return numbered.join(continued.alias("c"), same_slice, "left").select(
        *[F.col(f"r.`{c}`") for c in df.columns],
        (F.col(name) + F.coalesce(_BEFORE, F.lit(0))).alias(name),
    )


def _cols(names):
    return [F.col(f"`{n}`") for n in names]

"""Results kept up to date batch by batch, without going over the history again."""

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.functions.dates import resolve_column
from tarnlake.functions.text import decimal_comma
from tarnlake.operators.history import latest_per_key
from tarnlake.schemas import METRIC_COLUMNS
from tarnlake.session import delete_folders, folders_like, make_folder, replace_folder
from tarnlake.sources.tables import append_table, read_table

_LOG = "bucket int, version long, batch_id long"


@dataclass(frozen=True)
class NewestRows:
    """The newest row of each key, as ``latest_per_key`` over all batches would give it.

    Keys are dealt to hash buckets. A batch is merged with the buckets that its keys touch:
    these are written anew, then a log names the new folders, so readers see a batch in all its
    buckets or in none. Of a key the greatest row stays, whatever came first: late and repeated
    batches, and a batch that runs again after a failure, change nothing that is not theirs.
    """

    root: str
    keys: tuple[str, ...]
    order_by: str
    tie_break: tuple[str, ...] = ()
    buckets: int = 64

    def _folders(self, spark) -> dict[int, str]:
        """The current folder of each bucket; there are ``buckets`` of them at most."""
        log = spark.read.schema(_LOG).parquet(f"{self.root}/log")
        newest = log.groupBy("bucket").agg(F.max("version").alias("version")).collect()
        return {r["bucket"]: f"{self.root}/rows/bucket={r['bucket']}/version={r['version']}" for r in newest}

    def table(self, spark: SparkSession, schema: StructType) -> DataFrame:
        make_folder(spark, f"{self.root}/log")
        folders = self._folders(spark)
        return spark.read.schema(schema).parquet(*folders.values()) if folders else spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, batch_id: int) -> int:
        """Take a batch in; returns how many buckets were written."""
        spark, version = batch.sparkSession, time.time_ns()
        make_folder(spark, f"{self.root}/log")
        newest = latest_per_key(batch, list(self.keys), self.order_by, list(self.tie_break))
        hashed = F.xxhash64(*[F.col(f"`{resolve_column(batch, k)}`") for k in self.keys])
        bucket = F.pmod(hashed, F.lit(self.buckets)).cast("int")
        aside = f"{self.root}/_aside/{batch_id}-{version}"
        try:
            newest.withColumn("bucket", bucket).write.partitionBy("bucket").parquet(f"{aside}/batch")
            touched = [int(p.rpartition("=")[2]) for p in folders_like(spark, f"{aside}/batch/bucket=*")]
            if not touched:
                return 0
            kept = [p for b, p in self._folders(spark).items() if b in touched]
            rows = spark.read.schema(newest.schema).parquet(*[f"{aside}/batch/bucket={b}" for b in touched])
            if kept:
                rows = rows.unionAll(spark.read.schema(newest.schema).parquet(*kept))
            merged = latest_per_key(rows, list(self.keys), self.order_by, list(self.tie_break))
            merged.withColumns({"bucket": bucket, "version": F.lit(version)}).write.mode("append").partitionBy("bucket", "version").parquet(f"{self.root}/rows")
            log = spark.createDataFrame([(b, version, batch_id) for b in touched], _LOG)
            append_table(log.coalesce(1), f"{self.root}/log")
        finally:
            delete_folders(spark, [aside])
        return len(touched)

    def vacuum(self, spark: SparkSession, grace_seconds: float) -> int:
        """Remove folders that were replaced, or left by a failed merge, so long ago; returns how many."""
        before, current = time.time_ns() - int(grace_seconds * 1e9), set(self._folders(spark).values())
        place = lambda p: p[p.rindex("/bucket=") :]
        named = {place(p) for p in current}
        versions = folders_like(spark, f"{self.root}/rows/bucket=*/version=*")
        # A folder is replaced when the next version of its bucket comes.
        nexts: dict[str, int] = {}
        for path in sorted(versions, key=lambda p: (p.rpartition("/")[0], int(p.rpartition("=")[2]))):
            nexts[path.rpartition("/")[0] + "/last"] = int(path.rpartition("=")[2])
        gone = [p for p in versions if place(p) not in named and nexts[p.rpartition("/")[0] + "/last"] < before]
        delete_folders(spark, gone)
        return len(gone)


@dataclass(frozen=True)
class YearlyMetrics:
    """``annual_metrics`` over all batches, from sums and counts that each batch leaves.

    A batch's part is one folder, put in its place as a whole: storing a batch again replaces
    its part, withdrawing it takes the part away, and nothing else is computed anew.
    """

    root: str
    site: str = "SITE_ID"
    program: str = "PROGRAM_ID"
    date: str = "DATE_SMP"

    def _part(self, batch_id: int) -> str:
        return f"{self.root}/part={batch_id}"

    def put(self, batch: DataFrame, batch_id: int, measures: dict[str, str] = METRIC_COLUMNS) -> None:
        spark = batch.sparkSession
        read = batch.select(
            F.col(self.site).alias("SITE_ID"),
            F.col(self.program).alias("PROGRAM_ID"),
            F.year(self.date).alias("YEAR"),
            *[decimal_comma(c).alias(mean) for c, mean in measures.items()],
        )
        figures = [f(c).alias(f"{c}_{n}") for c in measures.values() for n, f in (("SUM", F.sum), ("COUNT", F.count))]
        parts = read.groupBy("SITE_ID", "PROGRAM_ID", "YEAR").agg(*figures, F.count(F.lit(1)).alias("TOTAL_SAMPLES"))
        aside = f"{self.root}/_aside-{batch_id}-{time.time_ns()}"
        try:
            parts.write.parquet(aside)
            replace_folder(spark, aside, self._part(batch_id))
        finally:
            delete_folders(spark, [aside])

    def withdraw(self, spark: SparkSession, batch_id: int) -> None:
        delete_folders(spark, [self._part(batch_id)])

    def metrics(self, spark: SparkSession, measures: dict[str, str] = METRIC_COLUMNS) -> DataFrame:
        """The means over the batches that are in, one row per site, program and year."""
        parts = read_table(spark, self.root)
        means = [(F.sum(f"{c}_SUM") / F.nullif(F.sum(f"{c}_COUNT"), F.lit(0))).alias(c) for c in measures.values()]
        return parts.groupBy("SITE_ID", "PROGRAM_ID", "YEAR").agg(*means, F.sum("TOTAL_SAMPLES").alias("TOTAL_SAMPLES"))

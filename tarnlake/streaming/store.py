"""The stored batches of a stream and their ledger.

Every try of a batch writes a folder of its own, which nothing changes later. The ledger is a
log: a row per try, last of all its writes, that names the folder and the range of dates in it.
Rows of a later fold of many batches into few files, and rows that withdraw a batch, follow in
the same log. Readers take the newest row of each batch, so that a retried batch leaves no
duplicates and a try that fails changes nothing; they open the folders that these rows name,
and no others.
"""

import math
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from tarnlake.operators.batches import FOLDED, SNAPSHOT_FOLDER, UNKNOWN_YEAR, between, latest_batch, ledger_rows
from tarnlake.schemas import ledger_schema
from tarnlake.session import delete_files, delete_folders, folders_like, input_bytes, make_folder, move_folder, work_folder
from tarnlake.sources.tables import append_table

CORRUPT = "_corrupt_record"
ATTEMPT = "attempt"
#: What the log has besides the ledger's columns. A fold carries its batch's attempt on.
_LOG = f"{ATTEMPT} long, generation long, withdrawn boolean"
FILE_BYTES = 128 << 20
GRACE_SECONDS = 24 * 3600


def _number(version="version_id"):
    return F.regexp_extract(version, r"batch_(\d+)", 1).try_cast("int")


@dataclass(frozen=True)
class BatchStore:
    """Folders of one stream's output; its rows have no columns ``year``, ``batch_id`` or ``attempt``."""

    root: str

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def ledger_folder(self) -> str:
        return f"{self.root}/ledger"

    def _log(self, spark, columns: StructType | None = None) -> DataFrame:
        wanted = StructType([*(columns or StructType.fromDDL("version_id string, snapshot_path string")).fields, *StructType.fromDDL(_LOG).fields])
        log = spark.read.schema(wanted).parquet(self.ledger_folder)
        return log.withColumns({"generation": F.coalesce("generation", F.lit(0)), "withdrawn": F.coalesce("withdrawn", F.lit(False))})

    def _commit(self, log: DataFrame, version_id: str) -> int:
        found = log.where((F.col("version_id") == version_id) & ~F.col("withdrawn")).agg(F.max(ATTEMPT)).first()[0]
        if found is None:
            raise LookupError(f"no version {version_id} in the ledger")
        return found

    def _state(self, log: DataFrame, as_of: str | None = None) -> DataFrame:
        """The newest row of each batch, now or just after ``as_of`` was stored; none of withdrawn ones."""
        if as_of is not None:
            log = log.where(F.col(ATTEMPT) <= self._commit(log, as_of))
        newest = F.max_by(F.struct(*log.columns), F.struct(ATTEMPT, "generation"))
        return log.groupBy("version_id").agg(newest.alias("row")).select("row.*").where("NOT withdrawn")

    def ledger(self, spark: SparkSession, date_type=None, as_of: str | None = None) -> DataFrame:
        """One row per batch; ``as_of`` names the version after which the ledger is asked for."""
        columns = ledger_schema(date_type) if date_type else ledger_schema()
        return self._state(self._log(spark, columns), as_of).select(*columns.fieldNames())

    def compact_ledger(self, spark: SparkSession, date_type=None) -> None:
        """Fold the ledger's files, one per batch, into one file; a job to run now and then.

        Rows of tries that later rows of the same batch replace are left out. The folded rows
        are in the folder before the old files go, and a row that is there twice counts once, so
        a run that is cut short does no harm. A reader that listed the old files just before has to
        start again.
        """
        log = self._log(spark, ledger_schema(date_type) if date_type else ledger_schema())
        old = spark.read.parquet(self.ledger_folder).inputFiles()
        following = Window.partitionBy("version_id").orderBy(ATTEMPT, "generation")
        kept = log.distinct().withColumn("next", F.lead("withdrawn").over(following))
        replaced = ~F.col("withdrawn") & F.coalesce(~F.col("next"), F.lit(False))
        append_table(kept.where(~replaced).drop("next").coalesce(1), self.ledger_folder)
        delete_files(spark, old)

    # Reading

    def _stored(self, spark, log, state: DataFrame, schema: StructType) -> DataFrame:
        """Rows of the batches of ``state`` with their ``batch_id`` and ``year``; other folders are not opened.

        The folders of a state come to the driver: one for each batch that is not folded yet, and
        a few for all others.
        """
        folders = state.groupBy("snapshot_path").agg(F.count(F.lit(1)).alias("batches")).collect()
        single = [r["snapshot_path"] for r in folders if FOLDED not in r["snapshot_path"]]
        folded = {r["snapshot_path"]: r["batches"] for r in folders if FOLDED in r["snapshot_path"]}
        columns = [*[F.col(f"`{c}`") for c in schema.fieldNames()], "batch_id", "year"]
        out = []
        if single:
            keys = StructType.fromDDL(f"year string, batch_id int, {ATTEMPT} long")
            reader = spark.read.schema(StructType([*schema.fields, *keys.fields])).option("basePath", self.rows)
            out.append(reader.parquet(*single).select(*columns))
        if folded:
            keys = StructType.fromDDL("batch_id int, generation long, year string")
            reader = spark.read.schema(StructType([*schema.fields, *keys.fields])).option("basePath", f"{self.rows}{FOLDED}")
            rows = reader.parquet(*folded)
            held = log.where(F.col("snapshot_path").isin([*folded])).groupBy("snapshot_path").agg(F.count_distinct("version_id").alias("n"))
            if any(r["n"] != folded[r["snapshot_path"]] for r in held.collect()):
                # Some batches of a fold are withdrawn, stored anew or not asked for.
                wanted = state.select(_number().alias("batch_id"), "generation")
                rows = rows.join(wanted, ["batch_id", "generation"], "left_semi")
            out.append(rows.select(*columns))
        if not out:
            return spark.createDataFrame([], StructType([*schema.fields, *StructType.fromDDL("batch_id int, year string").fields]))
        return out[0] if len(out) == 1 else out[0].unionAll(out[1])

    def table(self, spark: SparkSession, schema: StructType, as_of: str | None = None) -> DataFrame:
        """Rows of the batches that are in the ledger, with their ``batch_id``.

        With ``as_of`` the rows as they were when that version had been stored. The folders to
        read are chosen now: what is stored, folded or withdrawn later does not change the result.
        """
        log = self._log(spark)
        return self._stored(spark, log, self._state(log, as_of), schema).drop("year")

    def latest_slice(self, spark: SparkSession, schema: StructType, date_column: str) -> DataFrame:
        """Rows whose date lies in the last batch's date range, with their ``batch_id``.

        The ledger's bounds tell which batches can hold such rows; only their folders are
        opened, and the range is pushed into their scan.
        """
        log = self._log(spark, ledger_schema(schema[date_column].dataType))
        state = self._state(log)
        last = latest_batch(state)
        low, high = last.select("min_datestamp").scalar(), last.select("max_datestamp").scalar()
        meeting = state.where((F.col("max_datestamp") >= low) & (F.col("min_datestamp") <= high))
        return between(self._stored(spark, log, meeting, schema).drop("year"), date_column, low, high)

    def corrupt_messages(self, spark: SparkSession) -> DataFrame:
        """Messages that were no record or hold a value that could not be read.

        Of the latter, what could be read is in the table too. The texts are stored beside the
        rows, out of the way of the table.
        """
        texts = self.table(spark, StructType().add(CORRUPT, "string"))
        return texts.filter(F.col(CORRUPT).isNotNull()).select("batch_id", F.col(CORRUPT).alias("value"))

    def snapshot(self, spark: SparkSession, version_id: str, schema: StructType) -> DataFrame:
        """The rows of one version as it is now."""
        log = self._log(spark)
        state = self._state(log).where(F.col("version_id") == version_id)
        if state.isEmpty():
            raise LookupError(f"no version {version_id} in the ledger")
        return self._stored(spark, log, state, schema).drop("year", "batch_id")

    # Maintenance

    def compact(self, spark: SparkSession, schema: StructType, date_type=None, file_bytes: int = FILE_BYTES, keep_newest: int = 1) -> int:
        """Fold the folders of stored batches into few files of about ``file_bytes``; returns how many batches.

        The newest batches stay as they are, as a stream may store its last one again; so do
        batches without rows and folds all of whose batches are still current. The new files hold each batch's rows
        together, by year, and count from the ledger rows on that come last. Nothing is removed:
        readers that have begun go on, and ``vacuum`` clears up later.
        """
        columns = ledger_schema(date_type) if date_type else ledger_schema()
        log = self._log(spark, columns)
        state = self._state(log).withColumn("number", _number())
        held = log.where(~F.col("withdrawn")).groupBy("snapshot_path").agg(F.count_distinct("version_id").alias("held"))
        current = state.groupBy("snapshot_path").agg(F.count(F.lit(1)).alias("current")).join(held, "snapshot_path")
        broken = current.where((F.col("current") < F.col("held")) | ~F.col("snapshot_path").contains(FOLDED))
        # The newest batches by number: keep_newest rows.
        newest = state.orderBy(F.desc("number")).select("version_id").limit(keep_newest)
        chosen = state.where("row_count > 0").join(newest, "version_id", "left_anti").join(broken, "snapshot_path", "left_semi")
        generation = time.time_ns()
        target = f"{self.rows}{FOLDED}generation={generation}"
        year = F.regexp_extract("snapshot_path", r"year=([^/]+)", 1)
        facts = chosen.agg(F.count(F.lit(1)).alias("batches"), F.sum("row_count").alias("rows"), F.collect_set("snapshot_path").alias("folders")).first()
        if not facts["batches"]:
            return 0
        files = max(1, math.ceil(input_bytes(spark, *facts["folders"]) / file_bytes))
        stored = self._stored(spark, log, chosen, StructType([*schema.fields]).add(CORRUPT, "string"))
        seen = Observation()
        ordered = stored.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(files, "year", "batch_id", "row")
        ordered = ordered.sortWithinPartitions("year", "batch_id", "row").drop("row").observe(seen, F.count(F.lit(1)).alias("rows"))
        ordered.write.partitionBy("year").parquet(target)
        if seen.get.get("rows", 0) != facts["rows"]:
            raise RuntimeError(f"{seen.get.get('rows', 0)} rows folded, {facts['rows']} in the ledger")
        moved = {"snapshot_path": F.concat(F.lit(f"{target}/year="), year), "generation": F.lit(generation)}
        folded = chosen.withColumns(moved)
        append_table(folded.select(*log.columns).coalesce(1), self.ledger_folder)
        return facts["batches"]

    def vacuum(self, spark: SparkSession, grace_seconds: float = GRACE_SECONDS) -> list[str]:
        """Remove the folders that no reader needs and return their paths, below ``rows``.

        These are tries and folds that later rows of the ledger have replaced and tries that
        never came into it, ``grace_seconds`` ago or earlier; it has to be longer than any read and
        any try takes. Withdrawn batches stay, for readers of an earlier version.
        """
        before = time.time_ns() - int(grace_seconds * 1e9)
        patterns = (f"{self.rows}/year=*/batch_id=*/{ATTEMPT}=*", f"{self.rows}{FOLDED}generation=*/year=*", f"{self.rows}/_aside/*")
        found = [path for pattern in patterns for path in folders_like(spark, pattern)]
        if not found:
            return []
        on_disk = spark.createDataFrame([(p,) for p in found], "path string").withColumn("place", F.regexp_extract("path", r".*/rows/(.*)$", 1))
        following = Window.partitionBy("version_id").orderBy(ATTEMPT, "generation")
        tries = self._log(spark).where("NOT withdrawn").select("version_id", "snapshot_path", ATTEMPT, "generation").distinct()
        replaced = F.lead(F.greatest(ATTEMPT, "generation")).over(following)
        used = tries.withColumn("until", F.coalesce(replaced, F.lit((1 << 63) - 1)))
        used = used.groupBy(F.regexp_extract("snapshot_path", r".*/rows/(.*)$", 1).alias("place")).agg(F.max("until").alias("until"))
        started = F.regexp_extract("place", r"(\d+)(?:/year=[^/]+)?$", 1).cast("long")
        old = on_disk.join(used, "place", "left").where(F.coalesce("until", started) < before)
        gone = {r["path"]: r["place"] for r in old.select("path", "place").collect()}
        delete_folders(spark, [*gone])
        return sorted(gone.values())

    def rollback(self, spark: SparkSession, version_id: str, date_type=None) -> int:
        """Make the table what it was when ``version_id`` had been stored; returns how many batches change.

        Batches stored later are withdrawn, a batch stored anew since then is its former try
        again (if that was cleared up, an error says so and nothing changes). Rows that say this
        are added to the ledger, nothing is removed: other versions can still be read, and the
        stream goes on with its next batch.
        """
        log = self._log(spark, ledger_schema(date_type) if date_type else ledger_schema())
        then, now = self._state(log, version_id), self._state(log)
        mark = {ATTEMPT: F.lit(time.time_ns())}
        gone = now.join(then, "version_id", "left_anti").withColumns({**mark, "generation": F.lit(0).cast("long"), "withdrawn": F.lit(True)})
        same = now.select("version_id", ATTEMPT, "generation")
        back = then.join(same, ["version_id", ATTEMPT, "generation"], "left_anti").withColumns(mark)
        lost = [r[0] for r in back.select("snapshot_path").distinct().collect() if not folders_like(spark, r[0])]
        if lost:
            raise LookupError(f"cleared up since {version_id}: {', '.join(sorted(lost))}")
        changes = gone.select(*log.columns).unionAll(back.select(*log.columns))
        count = changes.count()
        if count:
            append_table(changes.coalesce(1), self.ledger_folder)
        return count

    def publish(self, spark: SparkSession, name: str, schema: StructType, date_type=None) -> None:
        """Make the catalog table ``name`` show the stored batches, by one partition per folder.

        Its partition columns are ``year`` (of a batch's first date) and ``folder``: a query on a
        year opens that year's folders only. The table is external and made where it is absent.
        Folds that hold batches which are no longer current are folded anew first.
        """
        make_folder(spark, self.ledger_folder)
        log = self._log(spark)
        held = log.where(~F.col("withdrawn") & F.col("snapshot_path").contains(FOLDED)).groupBy("snapshot_path").agg(F.count_distinct("version_id").alias("held"))
        current = self._state(log).groupBy("snapshot_path").agg(F.count(F.lit(1)).alias("current"))
        if not held.join(current, "snapshot_path").where("current < held").isEmpty():
            self.compact(spark, schema, date_type, keep_newest=0)
            log = self._log(spark)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}, year STRING, folder STRING) USING parquet "
            f"PARTITIONED BY (year, folder) LOCATION '{self.root}/published'"
        )
        folder = F.regexp_replace(F.regexp_replace("snapshot_path", r"^.*/rows/", ""), r"[/=]", "-")
        year = F.regexp_extract("snapshot_path", r"year=([^/]+)", 1)
        wanted = {(r[0], r[1]): r[2] for r in self._state(log).select(year, folder, "snapshot_path").distinct().collect()}
        shown = {tuple(part.split("=", 1)[1] for part in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        spec = lambda key: f"PARTITION (year='{key[0]}', folder='{key[1]}')"
        added = [f"{spec(k)} LOCATION '{p}'" for k, p in sorted(wanted.items()) if k not in shown]
        removed = [spec(k) for k in sorted(shown - set(wanted))]
        if added:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added)}")
        if removed:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(removed)}")


def publish_ledger(spark: SparkSession, store: BatchStore, name: str, date_type=None) -> None:
    """Make the catalog view ``name`` show the store's ledger, one row per batch."""
    make_folder(spark, store.ledger_folder)
    columns = ledger_schema(date_type) if date_type else ledger_schema()
    names = columns.fieldNames()
    log = f"{name}_log"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {log} ({columns.toDDL()}, {_LOG.replace(' long', ' BIGINT').replace(' boolean', ' BOOLEAN')}) USING parquet LOCATION '{store.ledger_folder}'")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'row.{c}' for c in names)} FROM ("
        f"SELECT max_by(struct(*), struct({ATTEMPT}, coalesce(generation, 0))) AS row FROM {log} GROUP BY version_id) "
        "WHERE NOT coalesce(row.withdrawn, false)"
    )


def store_batch(batch: DataFrame, batch_id: int, store: BatchStore, date_column: str) -> None:
    """Write one micro-batch; its messages are read and parsed once, on the way to the table.

    The ledger figures are taken from that same write. Rows are written aside and then moved to
    their place under the year of the batch's first date; what is aside, readers do not see.
    """
    spark = batch.sparkSession
    date_type = batch.schema[date_column].dataType
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in batch.columns else F.lit(False)
    # A moment in time goes through its microseconds; a date or a time without a zone through
    # its text, since the session's zone may have no such hour.
    in_zone = isinstance(date_type, TimestampType)

    def bound(value):
        return F.unix_micros(value) if in_zone else value.cast("string")

    seen = Observation()
    observed = batch.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(corrupt).alias("corrupt_count"),
        bound(F.min(date_column)).alias("low"),
        bound(F.max(date_column)).alias("high"),
        F.year(F.min(date_column)).alias("year"),
    )
    attempt = time.time_ns()
    aside = f"{store.rows}/_aside/{batch_id}-{attempt}"
    observed.write.parquet(aside)
    figures = seen.get
    year = figures.get("year") or UNKNOWN_YEAR
    snapshot = f"{SNAPSHOT_FOLDER % (store.rows, year, batch_id)}/{ATTEMPT}={attempt}"
    move_folder(spark, aside, snapshot)

    def moment(value):
        return F.timestamp_micros(F.lit(value).cast("long")) if in_zone else F.lit(value).cast("string").cast(date_type)

    ledger_row = spark.range(0, 1, 1, 1).select(
        F.lit(f"batch_{batch_id}").alias("version_id"),
        moment(figures.get("low")).alias("min_datestamp"),
        moment(figures.get("high")).alias("max_datestamp"),
        F.lit(f"Batch {batch_id}").alias("description"),
        F.lit(snapshot).alias("snapshot_path"),
        F.lit(figures.get("row_count", 0)).cast("long").alias("row_count"),
        F.lit(figures.get("corrupt_count", 0)).cast("long").alias("corrupt_count"),
        F.lit(attempt).alias(ATTEMPT),
    )
    append_table(ledger_row, store.ledger_folder)


def store_batches(rows: DataFrame, batch_column: str, store: BatchStore, date_column: str) -> None:
    """Store many numbered batches in one job, such as a history that was kept elsewhere.

    Each batch gets its folder and its ledger row, as if it had come by itself; a number that is
    there already is stored anew. Rows without a number are not allowed.
    """
    spark, attempt = rows.sparkSession, time.time_ns()
    figures = ledger_rows(rows, batch_column, date_column, store.rows)
    folder = work_folder(spark, "figures")
    figures.withColumn("batch_id", _number()).withColumn(
        "snapshot_path", F.concat("snapshot_path", F.lit(f"/{ATTEMPT}={attempt}"))
    ).write.mode("overwrite").parquet(folder)
    figures = spark.read.parquet(folder)
    if not figures.where("batch_id IS NULL").isEmpty():
        raise ValueError(f"rows without a {batch_column}")
    year = F.regexp_extract("snapshot_path", r"year=([^/]+)", 1).alias("year")
    named = rows.withColumnRenamed(batch_column, "batch_id").join(figures.select("batch_id", year), "batch_id")
    named = named.withColumn(ATTEMPT, F.lit(attempt)).hint("rebalance", "year", "batch_id")
    named.write.mode("append").partitionBy("year", "batch_id", ATTEMPT).parquet(store.rows)
    append_table(figures.drop("batch_id").withColumn(ATTEMPT, F.lit(attempt)).coalesce(1), store.ledger_folder)

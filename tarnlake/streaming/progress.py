"""Row counts and durations per micro-batch."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tarnlake.sources.tables import append_table, read_table

PROGRESS = "query_id string, batch_id long, row_count long, seconds double"


def _row(progress):
    facts = json.loads(progress.json) if hasattr(progress, "json") else progress
    duration = facts.get("durationMs", {}).get("triggerExecution", 0)
    return facts["id"], facts["batchId"], facts["numInputRows"], duration / 1000


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """All micro-batches of a query, as long as Spark remembers them all; else it raises.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates``. Use ``ProgressLog``
    for queries that run on.
    """
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(query.recentProgress) >= kept:
        raise RuntimeError(f"Spark remembers the last {kept} micro-batches only; use ProgressLog")
    return spark.createDataFrame([_row(p) for p in query.recentProgress], PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Appends one row per micro-batch to a table, for queries that run on.

    Register with ``spark.streams.addListener``. Rows are written in groups, so that a
    fast query does not leave a file per batch.
    """

    def __init__(self, spark: SparkSession, target: str, batches_per_write: int = 20):
        self.spark, self.target, self.batches_per_write = spark, target, batches_per_write
        self.waiting = []

    def rows(self) -> DataFrame:
        """What is written so far: all micro-batches once the log is closed."""
        return read_table(self.spark, self.target, PROGRESS)

    def flush(self):
        rows, self.waiting = self.waiting, []
        if rows:
            append_table(self.spark.createDataFrame(rows, PROGRESS).coalesce(1), self.target)

    def close(self):
        """Wait for the events on their way, write what is left and stop listening."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.waiting.append(_row(event.progress))
        if len(self.waiting) >= self.batches_per_write:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.flush()

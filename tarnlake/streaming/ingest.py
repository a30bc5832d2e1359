"""Parse a message stream and store every micro-batch once.

A batch leaves a folder of rows and a ledger row (``store``). Errors are not caught: the batch
then stays uncommitted and runs again, under the same id, after a restart.
"""

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tarnlake.functions.records import parse_record
from tarnlake.streaming.store import CORRUPT, BatchStore, store_batch


def parse_messages(
    messages: DataFrame,
    schema: StructType,
    timestamp_format: str | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Message values as typed rows; the same for a stream and for a table of messages.

    A value that is no record of the schema becomes a row of NULLs. ``keep_corrupt`` adds
    a column with the text of such values.
    """
    record = parse_record("value", schema, timestamp_format, CORRUPT if keep_corrupt else None)
    rows = messages.select(F.col("value").cast("string").alias("value"), record.alias("record"))
    if not keep_corrupt:
        return rows.select("record.*")
    corrupt = F.when(F.col("record").isNull(), F.col("value")).otherwise(F.col(f"record.{CORRUPT}"))
    return rows.select(*[f"record.`{f.name}`" for f in schema], corrupt.alias(CORRUPT))


def ingest(
    messages: DataFrame,
    schema: StructType,
    store: BatchStore,
    checkpoint: str,
    date_column: str = "DATE_SMP",
    timestamp_format: str | None = None,
    interval: str | None = None,
    on_batch=store_batch,
    published: str | None = None,
) -> StreamingQuery:
    """Start storing a message stream.

    Without ``interval`` the query takes all messages there are and ends; with one, such
    as ``"10 seconds"``, it goes on for ever. The checkpoint folder carries its progress
    over restarts. Each batch becomes a partition of the catalog table ``published``, if one is
    named.
    """

    def on_rows(batch, batch_id):
        on_batch(batch, batch_id, store, date_column)
        if published:
            store.publish(batch.sparkSession, published, schema, schema[date_column].dataType)

    writer = (
        parse_messages(messages, schema, timestamp_format, keep_corrupt=True)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_rows)
    )
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def finish(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Let a query with an interval send all there is now, at its pace, and end it.

    It raises after ``timeout`` seconds, as ``drain`` does.
    """
    late = threading.Event()

    def give_up():
        late.set()
        query.stop()

    timer = threading.Timer(timeout, give_up) if timeout is not None else None
    if timer:
        timer.start()
    try:
        query.processAllAvailable()
    finally:
        if timer:
            timer.cancel()
    if late.is_set():
        raise TimeoutError(f"stream {query.id} was not done after {timeout} s")
    query.stop()
    return query


def drain(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to end; stop it and raise after ``timeout`` seconds."""
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"stream {query.id} was not done after {timeout} s")
    return query

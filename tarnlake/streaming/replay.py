"""Send stored rows as messages, some at a time."""

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarnlake.session import folders_like, is_local, set_times, unless_set, work_folder
from tarnlake.sources.messages import to_messages


#: Time of the first block's file, in milliseconds; the next ones follow a millisecond apart.
_FIRST_TIME = 10**12
# Spark's logs of files read and written are listed in each micro-batch. By default they keep those of
# the last ten minutes, and a replay of many short micro-batches slows down with their number. (Their
# compaction interval has to stay as it is: who reads the target goes by it.)
_LOGS = {f"spark.sql.streaming.{log}.log.cleanupDelay": "60s" for log in ("fileSource", "fileSink")}
# Without Hadoop's native library, Spark's first choice starts several programs (chmod, readlink) for
# each of a micro-batch's log files on a local disk; this one, its choice for file systems that offer
# no more, starts fewer.
_LOCAL_LOGS = {
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
}
_FILE, _START, _PLACE, _NUMBER, _BLOCK = "__file", "__start", "__place", "__number", "__block"


def numbered_in_order(rows: DataFrame) -> DataFrame:
    """Stored ``rows`` with their number, from 0, in the order of their files and in these.

    No task sees all rows: each part is numbered by itself and shifted by the sizes of the parts
    before it, of which there are as many as files and splits. Rows that do not come from files
    are in the order of their partitions.
    """
    spark = rows.sparkSession
    folder = work_folder(spark, "numbered")
    # The number counts the rows of a partition from a multiple of 2^33 on.
    marked = rows.select("*", F.input_file_name().alias(_FILE), F.input_file_block_start().alias(_START), F.monotonically_increasing_id().alias(_PLACE))
    marked.write.mode("overwrite").parquet(folder)
    marked = spark.read.schema(marked.schema).parquet(folder)
    part = [_FILE, _START, F.shiftright(_PLACE, 33).alias("partition")]
    sizes = marked.groupBy(*part).agg(F.min(_PLACE).alias("first"), F.count(F.lit(1)).alias("rows")).orderBy(_FILE, _START, "partition").collect()
    shifts, before = [], 0
    for r in sizes:
        shifts.append((r[0], r[1], r["partition"], before - r["first"]))
        before += r["rows"]
    shift = spark.createDataFrame(shifts, f"{_FILE} string, {_START} long, partition long, shift long")
    number = (F.col(_PLACE) + F.col("shift")).alias(_NUMBER)
    return marked.withColumn("partition", F.shiftright(_PLACE, 33)).join(shift, [_FILE, _START, "partition"]).select(*[F.col(f"`{c}`") for c in rows.columns], number)


def cut_for_replay(rows: DataFrame, rows_per_batch: int) -> DataFrame:
    """Stored rows as a stream of micro-batches of ``rows_per_batch`` rows, in their order.

    Only the last micro-batch may have fewer. Spark's file streams count files, not rows, and
    take the oldest first: a block of rows is written as a file, and the files get times one
    after the other. A store that keeps no given times (an object store) keeps the sizes only.
    """
    spark = rows.sparkSession
    folder = work_folder(spark, "replay")
    numbered = numbered_in_order(rows).withColumn(_BLOCK, F.floor(F.col(_NUMBER) / rows_per_batch))
    blocks = numbered.repartition(_BLOCK).sortWithinPartitions(_BLOCK, _NUMBER).drop(_NUMBER)
    blocks.write.mode("overwrite").partitionBy(_BLOCK).parquet(folder)
    paths = folders_like(spark, f"{folder}/{_BLOCK}=*/*.parquet")
    set_times(spark, {p: _FIRST_TIME + int(p.rpartition(f"{_BLOCK}=")[2].split("/")[0]) for p in paths})
    stream = spark.readStream.schema(rows.schema.add(_BLOCK, "long")).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream.drop(_BLOCK)


def replay(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    interval: str | None = None,
    fmt: str = "text",
    servers: str | None = None,
) -> StreamingQuery:
    """Turn a stream of rows into a stream of JSON messages.

    How much goes out per batch is set on the source (``cut_for_replay``, ``maxFilesPerTrigger``
    or ``maxOffsetsPerTrigger``) and how often by ``interval``; without one the query sends
    all there is, in batches of that size, and ends. With one, ``finish`` ends it when all is sent.
    """
    writer = to_messages(rows).writeStream.outputMode("append").option("checkpointLocation", checkpoint).format(fmt)
    if fmt == "kafka":
        writer = writer.option("kafka.bootstrap.servers", servers).option("topic", target)
    else:
        writer = writer.option("path", target)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    with unless_set(rows.sparkSession, _LOGS | (_LOCAL_LOGS if is_local(rows.sparkSession, checkpoint) else {})):
        query = writer.start()
        # The source takes its settings in the query's own thread.
        while query.isActive and query.status["message"].startswith("Initializing"):
            time.sleep(0.01)
    return query

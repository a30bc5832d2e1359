"""Messages that carry one JSON record each, in a ``value`` column."""

from pyspark.sql import DataFrame, SparkSession

from tarnlake.functions.records import json_text


def kafka_options(servers: str, topic: str, starting: str = "earliest", max_per_batch: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_per_batch: int | None = None) -> DataFrame:
    """A topic from its first message on; needs Spark's Kafka package on the class path."""
    options = kafka_options(servers, topic, starting, max_per_batch)
    return spark.readStream.format("kafka").options(**options).load()


def message_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files as a message stream, one message per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def to_messages(df: DataFrame) -> DataFrame:
    """Each row as one message; NULL fields are left out of the JSON."""
    return df.select(json_text().alias("value"))


def write_messages(df: DataFrame, target: str, fmt: str = "text", servers: str | None = None, rows_per_file: int = 0) -> None:
    """Send rows as messages to a folder of text files or to a Kafka topic."""
    writer = to_messages(df).write.format(fmt).mode("append")
    if fmt == "kafka":
        writer.option("kafka.bootstrap.servers", servers).option("topic", target).save()
    else:
        writer.option("maxRecordsPerFile", rows_per_file).save(target)

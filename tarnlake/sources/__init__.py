"""Where tables come from and go to."""

from tarnlake.sources.delimited import delimited_stream, read_delimited, redelimit, write_delimited
from tarnlake.sources.jdbc import read_jdbc, write_jdbc
from tarnlake.sources.messages import (
    kafka_options,
    kafka_stream,
    message_stream,
    to_messages,
    write_messages,
)
from tarnlake.sources.tables import (
    append_table,
    create_schema_if_absent,
    create_table_if_absent,
    overwrite_batch,
    overwrite_table,
    read_snapshot,
    read_table,
    write_batches,
)

__all__ = [
    "append_table",
    "create_schema_if_absent",
    "create_table_if_absent",
    "delimited_stream",
    "kafka_options",
    "kafka_stream",
    "message_stream",
    "overwrite_batch",
    "overwrite_table",
    "read_delimited",
    "read_jdbc",
    "read_snapshot",
    "read_table",
    "redelimit",
    "to_messages",
    "write_batches",
    "write_delimited",
    "write_jdbc",
    "write_messages",
]

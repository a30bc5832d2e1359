"""Session settings and the shared work folder.

Nothing here is needed by the operators themselves: they take and return DataFrames.
"""

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Of a folder that is being replaced, until its successor is in place.
REPLACED = "._replaced-"

# One reduce task should see about this much compressed input.
BYTES_PER_SHUFFLE_PARTITION = 128 << 20

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join on a hot key is split into several tasks even where the aggregate above it
    # could have reused the join's partitioning: one more shuffle beats one endless task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Folders by the thousand are listed in so many tasks, not in one each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the plans rely on; may be called again at any time."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarnlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def _file_system(spark, path):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path lies on this machine's own file system."""
    return _file_system(spark, path)[0].getScheme() == "file"


@contextmanager
def unless_set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Runtime options for a while; those that the session has set itself stay as they are."""
    ours = {key: value for key, value in settings.items() if spark.conf.get(key, None) is None}
    try:
        for key, value in ours.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key in ours:
            spark.conf.unset(key)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Stored size of files or folders on any file system Spark can read."""
    total = 0
    for path in paths:
        fs, hadoop_path = _file_system(spark, path)
        total += fs.getContentSummary(hadoop_path).getLength()
    return total


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Raise the shuffle partition count to suit the inputs; never lower it.

    Adaptive execution merges partitions that turn out small but cannot add any.
    """
    wanted = math.ceil(input_bytes(spark, *paths) / BYTES_PER_SHUFFLE_PARTITION)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = max(current, wanted)
    if chosen != current:
        spark.conf.set("spark.sql.shuffle.partitions", str(chosen))
    return chosen


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a written folder its final name, on any file system Spark can write."""
    fs, from_path = _file_system(spark, source)
    to_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to_path.getParent())
    if not fs.rename(from_path, to_path):
        raise OSError(f"{source} could not be moved to {target}")


def delete_files(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, hadoop_path = _file_system(spark, path)
        fs.delete(hadoop_path, False)


def folders_like(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*``, on any file system Spark can read."""
    fs, hadoop_path = _file_system(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(hadoop_path) or []]


def set_times(spark: SparkSession, times: dict[str, int]) -> None:
    """Give files the times, in milliseconds, at which they count as written."""
    for path, time in times.items():
        fs, hadoop_path = _file_system(spark, path)
        fs.setTimes(hadoop_path, time, -1)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, hadoop_path = _file_system(spark, path)
        fs.delete(hadoop_path, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a written folder in the place of another, which stays until then.

    Between its two renames the target is absent for a moment; ``recover_folder`` brings the old
    one back should the driver end just there.
    """
    fs, target_path = _file_system(spark, target)
    old = f"{target.rstrip('/')}{REPLACED}{uuid.uuid4().hex[:12]}"
    had_one = fs.exists(target_path)
    if had_one:
        move_folder(spark, target, old)
    try:
        move_folder(spark, source, target)
    except Exception:
        if had_one:
            move_folder(spark, old, target)
        raise
    if had_one:
        delete_folders(spark, [old])


def recover_folder(spark: SparkSession, target: str) -> None:
    """Bring back what an unfinished ``replace_folder`` has set aside."""
    fs, target_path = _file_system(spark, target)
    if not fs.exists(target_path):
        for old in folders_like(spark, f"{target.rstrip('/')}{REPLACED}*")[:1]:
            move_folder(spark, old, target)


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared storage named by ``spark.checkpoint.dir``.

    Only a session that runs on one machine may do without the setting. The folder goes
    away when the driver ends, so results read from it stay valid for the session.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.gettempdir()
    session_folder = f"{root.rstrip('/')}/tarnlake-{spark.sparkContext.applicationId}"
    folder = f"{session_folder}/{label}-{uuid.uuid4().hex[:12]}"
    fs, hadoop_path = _file_system(spark, folder)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path.getParent())
    return folder

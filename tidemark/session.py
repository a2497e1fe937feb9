"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Adaptive execution splits skewed join
# partitions and coalesces small ones, so the number of shuffle partitions only
# needs an upper bound that fits the input (see ``shuffle_partitions``).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join below an aggregate on the same key is only split when this is on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keeps streaming state off the heap, so it may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def build_session(app: str = "tidemark", master: str | None = None, input_bytes: int = 0, **conf: str) -> SparkSession:
    """Create (or get) a session with the runtime settings; ``conf`` wins over them.

    ``input_bytes``, the size of the tables that its jobs read, sets the number of partitions with which shuffles
    start; adaptive execution coalesces them to the data that really flows.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_partitions(input_bytes, 1))}
    for key, value in {**RUNTIME_CONF, **(sized if input_bytes else {}), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def runtime_conf(spark: SparkSession) -> Iterator[None]:
    """The runtime settings that the launcher of this session left unset, for the time of a block.

    Time zones are fixed when a plan is made, and streams run to their end inside the block, so nothing is left behind
    in the caller's session. Without a launcher's choice, streams get one state partition per core.
    """
    launched = spark.sparkContext.getConf()
    wanted = dict(RUNTIME_CONF)
    if not launched.contains("spark.sql.shuffle.partitions") and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        wanted["spark.sql.shuffle.partitions"] = str(max(spark.sparkContext.defaultParallelism, 2))
    changed = {}
    for key, value in wanted.items():
        before = spark.conf.get(key, None)
        if not launched.contains(key) and before != value:
            changed[key] = before
            spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, before in changed.items():
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions of about 256 MB each, at least one per core."""
    return max(cores, -(-input_bytes // _TARGET_PARTITION_BYTES))


_folders: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and written tables that all executors can reach.

    It is the session's ``spark.checkpoint.dir``, else a folder in the launcher's warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work").rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; what is written there is deleted when the program ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _folders:
        atexit.register(delete_work_folders, spark)
    _folders.add(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def delete_work_folders(spark: SparkSession) -> None:
    """Delete what ``work_path`` gave out, while the session still runs."""
    if spark.sparkContext._jsc is None:
        return
    for path in list(_folders):
        delete_folder(spark, path)
        _folders.discard(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back, which cuts its lineage for good."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Stands for a null doc_id wherever documents are ordered or joined: null is the smallest id.
NULL_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def in_fold(folds: int, fold: int) -> Column:
    """True for rows whose crc32(doc_id as text) modulo ``folds`` is ``fold`` (a null id is in no fold)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def map_texts(
    docs: DataFrame, fn: Callable[[list], dict], schema: str, keep: dict[str, Column] | None = None,
    text: str = "text", block_bytes: int = 2 << 20,
) -> DataFrame:
    """One output row per input row: ``fn`` gets a block of texts (bytes or None) and returns columns of equal length.

    ``keep`` names the input columns passed through (default: doc_id); ``schema`` is the DDL of the columns ``fn`` adds.
    A block holds about ``block_bytes`` of text, so the memory of a task does not follow the batch size.
    """
    keep = {"doc_id": F.col("doc_id").cast("long")} if keep is None else keep
    source = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).cast("binary").alias("_text"))
    out = source.drop("_text").schema
    for field in StructType.fromDDL(schema).fields:
        out = out.add(field)
    names = list(keep)
    arrow_types = _arrow_types(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, batch.schema.names.index("_text"), block_bytes):
                result = fn(block.column(len(names)).to_pylist())
                arrays = [block.column(i) for i in range(len(names))]
                for name in out.names[len(names):]:
                    value = result[name]
                    arrays.append(value if isinstance(value, pa.Array) else pa.array(value, type=arrow_types[name]))
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return source.mapInArrow(run, out)


def _arrow_types(schema: StructType) -> dict[str, pa.DataType]:
    return {f.name: to_arrow_type(f.dataType) for f in schema.fields}


def blocks(batch: pa.RecordBatch, column: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, each with about ``block_bytes`` in one binary column (one row at least)."""
    rows, start, size = batch.num_rows, 0, 0
    values = batch.column(column)
    if values.nbytes <= block_bytes:
        if rows:
            yield batch
        return
    for i in range(rows):
        size += len(values[i].as_buffer() or b"") if values[i].is_valid else 0
        if size >= block_bytes or i == rows - 1:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0


class TwoGenerations:
    """A bounded cache: when the young half is full it becomes the old half, and the old half is dropped."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most, self.young, self.old = make, most, {}, {}

    def __call__(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[key] = value
        return value


_folders: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: that of spark.checkpoint.dir, else one below the warehouse."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    return (base or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work").rstrip("/")


#: While rows are written, unless the launcher has set them: shuffle files go as soon as the write ends (else they stay until
#: the driver collects its garbage), and a batch for Python holds 4 MB and not up to 10,000 texts.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    own = [name for name in _WRITING if not spark.sparkContext.getConf().contains(name)]
    before = {name: spark.conf.get(name) for name in own}
    for name in own:
        spark.conf.set(name, _WRITING[name])
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def cut(frame: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: later work, retries included, never repeats what led to
    them, so the shuffles behind them are deleted. The files are deleted when the session's program ends."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    if not _folders:
        atexit.register(_delete_folders, spark)
    _folders.add(path)
    with _writing(spark):
        frame.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(frame.schema).parquet(path)
    written._written_path = path
    return written


def release(*frames: DataFrame) -> None:
    """Deletes the files of rows from ``cut`` that nothing will read again; other frames are left alone."""
    for frame in frames:
        path = frame.__dict__.pop("_written_path", None)
        if path in _folders:
            _delete(frame.sparkSession, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _folders.discard(name)


def _delete_folders(spark: SparkSession) -> None:
    if spark.sparkContext._jvm is not None and spark.sparkContext._jsc is not None:
        for name in list(_folders):
            _delete(spark, name)


def splittable(right: DataFrame, key: str) -> DataFrame:
    """The aggregated side of a join on ``key`` whose other side may be skewed; use with ``splittable_on``.

    An aggregate by ``key`` is already partitioned by it, so Spark would join it without an exchange of its own, and
    adaptive execution can only split a hot partition between two exchanges. Joining on a hash of the key as well makes
    both sides exchange.
    """
    return right.withColumnRenamed(key, "_right_key").withColumn("_right_hash", F.xxhash64("_right_key"))


def splittable_on(left: DataFrame, key: str) -> Column:
    return (F.xxhash64(left[key]) == F.col("_right_hash")) & (left[key] == F.col("_right_key"))


def smallest_hashes(frame: DataFrame, group: str, id_: str, most: int, buckets: int = 64) -> DataFrame:
    """The rows of the ``most`` smallest id hashes of each group, with their rank. Ranked by bucket of the id first, so
    the task that ranks a group reads ``buckets * most`` rows of it at most."""
    order = [F.xxhash64(id_), F.col(id_)]
    bucket = F.pmod(F.xxhash64(id_), F.lit(buckets))
    for keys in ([F.col(group), bucket], [F.col(group)]):
        frame = frame.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
            F.col("rank") <= most)
    return frame


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, part: int) -> DataFrame:
    """Columns y and text of part 0 or 1 of the labelled documents of smallest id hash, ``per_class`` of each label.

    Labels other than 0 and 1 are left out. The rows are written once for all passes over them.
    """
    chosen = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("y")).distinct()
    chosen = smallest_hashes(chosen, "y", "_id", 2 * per_class).where(
        (F.col("rank") - 1) % 2 == part).select("_id", "y")
    # at most 2 * per_class ids of 16 bytes: a bound set by a parameter, so the texts need no shuffle
    return cut(docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("binary").alias("text")).join(
        F.broadcast(chosen), "_id").select("y", "text"))

"""Incremental file loading: every file exactly once per checkpoint."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from tidemark.session import path_exists
from tidemark.sources.schemas import evolve, store_schema, stored_schema, union_schema
from tidemark.streaming import runs

RESCUED = "_rescued_data"


class MixedLayout(ValueError):
    """CSV files whose headers disagree about the position of a column."""


def pending_files(spark: SparkSession, path: str, location: str, glob: str | None = None,
                  recursive: bool = False) -> list[str]:
    """The files below a folder whose schema no earlier load has looked at, whatever their modification times.

    Like the listing of a file stream this is a list on the driver, of new files only.
    """
    options = {"pathGlobFilter": glob} if glob else {}
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=recursive, **options).load(path).select("path")
    if path_exists(spark, _seen(location)):
        listed = listed.join(spark.read.schema("path string").parquet(_seen(location)), "path", "left_anti")
    return sorted(r.path for r in listed.collect())


def _seen(location: str) -> str:
    return f"{location}/_files"


def csv_headers(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The header line of each CSV file, read in one pass: the line of smallest position in the file's first block."""
    if not files:
        return {}
    lines = spark.read.text(files).filter(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("place"))
    found = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return {r.file: r.header for r in found.collect()}


def csv_layouts(headers: Iterable[str]) -> list[list[str]]:
    """The distinct headers, longest first: one entry per layout, however many files there are."""
    return sorted((next(csv.reader([h])) for h in set(headers)), key=lambda names: (-len(names), names))


def csv_names(schema_names: list[str], layouts: list[list[str]]) -> list[str]:
    """Schema columns followed by the columns that only the files have.

    CSV is read by position, so every header must agree with this order as far
    as it goes; files that lack the last columns are fine.
    """
    names = list(schema_names)
    for layout in layouts:
        names += [n for n in layout if n not in names]
    for layout in layouts:
        if layout != names[:len(layout)]:
            raise MixedLayout(f"header {layout} does not start like {names}")
    return names


def infer_schema(spark: SparkSession, files: list[str], fmt: str, headers: dict[str, str] | None = None,
                 **options) -> StructType:
    """Schema of some files. CSV files are inferred per layout (``headers``: header by file), as Spark takes the header
    of one file for all."""
    reader = spark.read.format(fmt).options(**options)
    if fmt != "csv":
        return reader.load(files).schema
    reader = reader.option("header", True).option("inferSchema", True)
    found = None
    for header in sorted(set(headers.values())):
        one = reader.load([f for f, h in headers.items() if h == header]).schema
        found = one if found is None else union_schema(found, one)
    types = {f.name: f for f in found.fields}
    return StructType([types[n] for n in csv_names([], csv_layouts(headers.values()))])


def prepare_schema(spark: SparkSession, path: str, fmt: str, location: str, mode: str, glob: str | None = None,
                   recursive: bool = False, **options) -> tuple[StructType, list[str]]:
    """Infer, compare with the stored schema, and store it.

    Returns the schema of the next load and the column names by position in the
    files (which for CSV may go on beyond the schema). A stream's schema is
    fixed when it starts, so this runs before each start. Exactly the files that
    no earlier load has seen are scanned, so the cost follows the new data.
    """
    stored, stored_names = stored_schema(spark, location)
    fixed = stored is not None and mode in ("rescue", "none")
    if fixed and fmt != "csv":
        return stored, stored.names
    pending = pending_files(spark, path, location, glob, recursive)
    if not pending:
        if stored is None:
            raise FileNotFoundError(f"no file in {path}: the schema can't be inferred")
        return stored, stored_names
    headers = csv_headers(spark, pending) if fmt == "csv" else {}
    found = stored if fixed else infer_schema(spark, pending, fmt, headers, **options)
    schema = evolve(stored, found, mode)
    names = csv_names([*schema.names, *[n for n in stored_names if n not in schema.names]],
                      csv_layouts(headers.values())) if fmt == "csv" else schema.names
    store_schema(spark, location, schema, names)
    spark.createDataFrame([(p,) for p in pending], "path string").coalesce(1).write.mode("append").parquet(_seen(location))
    return schema, names


def _loosely_typed(raw: Column, data_type) -> Column:
    """Cast text to a type, NULL when it does not fit."""
    if isinstance(data_type, (DateType, TimestampType, TimestampNTZType, StringType)) or not hasattr(
            data_type, "fields") and data_type.simpleString().split("<")[0] not in ("array", "map"):
        return raw.try_cast(data_type)
    return F.from_json(raw, data_type.json())


def rescue_json(lines: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Parse JSON text with a fixed schema; what does not fit goes to ``_rescued_data``.

    The rescue column is a JSON object of the unknown fields and of the known
    fields whose value has another type. Text that is no JSON object at all is
    rescued under ``_corrupt_record``. Other columns of ``lines`` are kept.
    """
    others = [c for c in lines.columns if c != value]
    names = schema.names
    parsed = lines.withColumn("__raw", F.from_json(F.col(value), "map<string,string>"))
    # Each field is cast once, into a struct that the rescue column looks at too.
    parsed = parsed.withColumn("__typed", F.struct(*[
        _loosely_typed(F.col("__raw")[f.name], f.dataType).alias(f.name) for f in schema.fields]))
    fits = F.array_compact(F.array(*[F.when(F.col("__typed")[n].isNotNull(), F.lit(n)) for n in names]))
    parsed = parsed.withColumn("__fits", fits)
    unknown = F.map_filter("__raw", lambda k, _: ~k.isin(names))
    misfit = F.map_filter("__raw", lambda k, v: k.isin(names) & v.isNotNull() & ~F.array_contains(F.col("__fits"), k))
    rescued = F.when(F.col("__raw").isNull() & F.col(value).isNotNull(),
                     F.create_map(F.lit("_corrupt_record"), F.col(value))).otherwise(F.map_concat(unknown, misfit))
    return parsed.withColumn("__rescued", rescued).select(
        "__typed.*", *others, F.when(F.size("__rescued") > 0, F.to_json("__rescued")).alias(RESCUED))


def rescue_columns(texts: DataFrame, schema: StructType) -> DataFrame:
    """Cast all-text columns to a fixed schema; unknown columns and values that do not fit are rescued.

    This is the CSV form: ``texts`` holds every column of the files as text.
    """
    known = {f.name: f.dataType for f in schema.fields}
    typed = {c: F.col(c).try_cast(t) if c in texts.columns else F.lit(None).cast(t) for c, t in known.items()}
    audit = [c for c in texts.columns if c.startswith("_") and c not in known]
    rescued = [
        x for c in texts.columns if c not in audit for x in (
            F.lit(c), F.when(typed[c].isNull(), F.col(c)) if c in known else F.col(c))]
    kept = F.map_filter(F.create_map(*rescued), lambda _, v: v.isNotNull())
    return texts.select(*[typed[c].alias(c) for c in known], *audit,
                        F.when(F.size(kept) > 0, F.to_json(kept)).alias(RESCUED))


def file_stream(spark: SparkSession, path: str, fmt: str, schema: StructType | str, max_files: int | None = None,
                max_bytes: str | None = None, glob: str | None = None, recursive: bool = False,
                **options) -> DataFrame:
    """Streaming read of a folder, with file and byte limits per trigger, name glob and recursion."""
    named = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes, "pathGlobFilter": glob,
             "recursiveFileLookup": recursive or None}
    chosen = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in named.items() if v is not None}
    return spark.readStream.format(fmt).schema(schema).options(**chosen, **options).load(path)


def table_stream(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """Stream an append-only table folder.

    Tables with rewritten versions or merged changes are no streaming source: a
    rewrite would arrive as new rows. Read those as a batch.
    """
    for marker in ("_history", "log", "base"):
        if path_exists(spark, f"{path}/{marker}"):
            raise ValueError(f"{path} is rewritten by its writer; read it as a batch")
    return file_stream(spark, path, "parquet", schema, **options)


def load_files(spark: SparkSession, path: str, fmt: str, registry: str, evolution: str, glob: str | None = None,
               recursive: bool = False, max_files: int | None = None, max_bytes: str | None = None,
               **options) -> DataFrame:
    """Streaming read of a landing folder under a stored, evolving schema.

    ``evolution`` is addNewColumns, rescue, failOnNewColumns or none. Adds
    ``_source_file`` and ``_load_time``. For JSON lines and CSV every mode but
    none adds ``_rescued_data``: fields the schema lacks and values that do not
    fit their type; none ignores the former and reads the latter as NULL.
    """
    schema, names = prepare_schema(spark, path, fmt, registry, evolution, glob, recursive, **options)
    provenance = {"_source_file": F.col("_metadata.file_path"), "_load_time": F.current_timestamp()}
    limits = {"glob": glob, "recursive": recursive, "max_files": max_files, "max_bytes": max_bytes}
    lines_only = fmt == "json" and str(options.get("multiLine", "false")).lower() != "true"
    if evolution == "none" or not (lines_only or fmt == "csv"):
        if evolution == "rescue":
            raise ValueError(f"rescue mode reads json lines and csv, not {fmt}")
        header = {"header": "true"} if fmt == "csv" else {}
        return file_stream(spark, path, fmt, schema, **limits, **header, **options).withColumns(provenance)
    if fmt == "json":
        lines = file_stream(spark, path, "text", "value string", **limits, **options).withColumns(provenance)
        return rescue_json(lines, schema)
    texts = StructType([StructField(n, StringType(), True) for n in names])
    stream = file_stream(spark, path, "csv", texts, **limits, header="true", **options)
    return rescue_columns(stream.withColumns(provenance), schema)


def copy_into(spark: SparkSession, path: str, fmt: str, schema: StructType | str, target: str, checkpoint: str,
              **options) -> int:
    """Load the files that no earlier call with this checkpoint has loaded; returns the rows loaded."""
    stream = file_stream(spark, path, fmt, schema, **options).withColumn("_source_file", F.col("_metadata.file_path"))
    run = runs.run_available(stream, target, checkpoint)
    return sum(rows for _, _, rows, *_ in runs.batch_log(spark).of(run))

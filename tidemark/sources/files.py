"""Batch file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.session import shared_dir

CORRUPT = "_corrupt_record"


def read_files(spark: SparkSession, path: str | list[str], fmt: str, schema: StructType | str | None = None,
               **options) -> DataFrame:
    """Read files of any built-in format; without a schema it is inferred."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header row. Inference reads the data twice; give a schema once it is known."""
    return read_files(spark, path, "csv", schema, header=True, inferSchema=schema is None)


def read_csv_permissive(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """CSV with a fixed schema that keeps bad lines, with their text in ``_corrupt_record``."""
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    return read_files(spark, path, "csv", with_corrupt, header=header, mode="PERMISSIVE",
                      columnNameOfCorruptRecord=CORRUPT)


def sound_rows(df: DataFrame) -> DataFrame:
    """Drop the rows that could not be parsed.

    A short or long line still fills some columns, so only the corrupt column
    tells. It is selected together with the data columns, as Spark requires.
    """
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = False) -> DataFrame:
    """JSON, one object per line or (``multi_line``) one document per file."""
    return read_files(spark, path, "json", schema, multiLine=multi_line)


def with_audit(df: DataFrame, method: str | None = None, run_id: str | None = None, loaded_at=None,
               source_file: bool = True, **tags: str) -> DataFrame:
    """Add load time, source file, ingestion method, run id and other constant tags."""
    at = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    columns = {"_ingested_at": at}
    if source_file:
        columns["_source_file"] = F.col("_metadata.file_path")
    for name, value in {"_ingestion_method": method, "_ingestion_run_id": run_id, **tags}.items():
        if value is not None:
            columns[name] = F.lit(value)
    return df.withColumns(columns)


def without_audit(df: DataFrame) -> DataFrame:
    """Drop the technical columns (those that start with an underscore)."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def export(df: DataFrame, path: str, fmt: str, single_file: bool = False, **options) -> None:
    """Write CSV or JSON files.

    ``single_file`` writes through one task: choose it for small results only.
    """
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").format(fmt).options(**({"header": True} if fmt == "csv" else {}), **options).save(path)


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append rows; new columns are fine, see ``read_merged``."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def create_table(df: DataFrame, name: str, replace: bool = True, location: str | None = None) -> None:
    """CREATE [OR REPLACE] TABLE ... AS SELECT, stored at ``location`` or in the shared folder."""
    location = location or f"{shared_dir(df.sparkSession)}/tables/{name}"
    df.write.mode("overwrite" if replace else "error").option("path", location).saveAsTable(name)


def read_merged(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read parquet files whose columns grew over time; missing columns are NULL.

    With the registered schema no footers are merged; without it Spark has to
    read the footer of every file.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def values_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small literal table, such as a list of rates or thresholds."""
    return spark.createDataFrame(rows, schema)

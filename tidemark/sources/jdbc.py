"""Reads from relational databases through Spark's JDBC source, and federated queries over them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000, partition_column: str | None = None,
                 lower_bound=None, upper_bound=None, num_partitions: int = 1) -> dict[str, str]:
    """Options of a JDBC read.

    ``num_partitions`` splits the read only together with a partition column
    and its bounds, so a larger number without them is refused. The bounds set
    the stride of the splits; they do not filter rows.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "pushDownPredicate": "true"}
    bounds = (partition_column, lower_bound, upper_bound)
    if num_partitions > 1 and None in bounds:
        raise ValueError("a split read needs partition_column, lower_bound and upper_bound")
    if None not in bounds:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                    "upperBound": str(upper_bound), "numPartitions": str(num_partitions)}
    optional = {"user": user, "password": password, "driver": driver}
    return options | {k: v for k, v in optional.items() if v is not None}


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """Full read of a table; filters and columns of later steps are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def register_jdbc_catalog(spark: SparkSession, name: str, url: str, driver: str, user: str | None = None,
                          password: str | None = None) -> None:
    """Register a database as catalog ``name`` so that aggregates and limits are pushed down too."""
    root = f"spark.sql.catalog.{name}"
    spark.conf.set(root, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    for key, value in {"url": url, "driver": driver, "user": user, "password": password,
                       "pushDownAggregate": "true", "pushDownLimit": "true"}.items():
        if value is not None:
            spark.conf.set(f"{root}.{key}", value)


def high_water_mark(loaded: DataFrame, column: str):
    """The largest loaded value of ``column``: one row with one value, NULL for an empty table."""
    return loaded.agg(F.max(column)).first()[0]


def newer_than_mark(source: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """The rows of ``source`` above the high-water mark of ``loaded``; all rows on the first run.

    The mark becomes a literal, so the filter is pushed into the source.
    """
    mark = high_water_mark(loaded, column)
    return source if mark is None else source.filter(F.col(column) > _literal(mark, source, column))


def _literal(value: date | datetime | object, df: DataFrame, column: str) -> Column:
    return F.lit(value).cast(df.schema[column].dataType)

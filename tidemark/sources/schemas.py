"""A stored schema per incremental source, and how new fields change it."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.types import (DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType,
                               StringType, StructField, StructType)

from tidemark.session import path_exists

MODES = ("addNewColumns", "rescue", "failOnNewColumns", "none")

# Numeric types from narrow to wide.
_WIDENING = (IntegerType(), LongType(), FloatType(), DoubleType())


_ENTRY = "schema_json string, names_json string, inferred_at string"


class NewColumns(ValueError):
    """The files have fields that the stored schema lacks."""


def stored_schema(spark: SparkSession, location: str) -> tuple[StructType | None, list[str]]:
    """The newest stored schema and the column names by position in the files; (None, []) before the first load."""
    if not path_exists(spark, location):
        return None, []
    newest = spark.read.schema(_ENTRY).json(location).orderBy("inferred_at", ascending=False).first()
    return StructType.fromJson(json.loads(newest.schema_json)), json.loads(newest.names_json)


def store_schema(spark: SparkSession, location: str, schema: StructType, names: list[str]) -> None:
    """Append an entry; an interrupted write leaves the entry before it in force."""
    at = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    row = [(schema.json(), json.dumps(names), at)]
    spark.createDataFrame(row, _ENTRY).coalesce(1).write.mode("append").json(location)


def new_fields(stored: StructType, found: StructType) -> list[StructField]:
    """Fields of ``found`` that ``stored`` lacks."""
    known = {f.name for f in stored.fields}
    return [f for f in found.fields if f.name not in known]


def common_type(a: DataType, b: DataType) -> DataType:
    """The wider of two types; text when neither contains the other."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return union_schema(a, b)
    if a in _WIDENING and b in _WIDENING:
        return max(a, b, key=_WIDENING.index)
    if {type(a), type(b)} == {DecimalType, DoubleType}:
        return DoubleType()
    return StringType()


def union_schema(stored: StructType, found: StructType) -> StructType:
    """All fields of both, stored ones first and in their order, with types widened."""
    types = {f.name: f.dataType for f in found.fields}
    fields = [StructField(f.name, common_type(f.dataType, types.get(f.name, f.dataType)), True) for f in stored.fields]
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in new_fields(stored, found)])


def evolve(stored: StructType | None, found: StructType, mode: str) -> StructType:
    """The schema for the next load.

    ``addNewColumns`` widens the stored schema; ``rescue`` and ``none`` keep it
    (the loader puts unknown fields in a rescue column, or ignores them);
    ``failOnNewColumns`` raises. Before the first load the found schema is taken.
    """
    if mode not in MODES:
        raise ValueError(f"unknown schema evolution mode {mode}")
    if stored is None:
        return found
    added = new_fields(stored, found)
    if mode == "failOnNewColumns" and added:
        raise NewColumns(f"new columns: {', '.join(f.name for f in added)}")
    if mode != "addNewColumns":
        return stored
    # A stored type never changes under a running table; only new fields are added.
    return StructType(stored.fields + [StructField(f.name, f.dataType, True) for f in added])

"""Lakehouse data operators on plain Apache Spark.

Every public function takes and returns DataFrames (or Columns) and leaves the
physical strategy to Catalyst and adaptive execution.
"""

__version__ = "0.1.0"

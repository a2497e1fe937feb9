"""The standard tables with their fixed schemas, and their canonical renamings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


@dataclass(frozen=True)
class Tables:
    """Lazy readers for the parquet tables of one directory.

    The schema is given, so opening a table runs no job; Catalyst prunes the
    columns and pushes the filters of whatever reads it.
    """

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    # Canonical names used by the silver and gold functions.

    def stores(self) -> DataFrame:
        """Nations with their region, in the role of stores: one row per store."""
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("store_id"),
            F.col("n_name").alias("store_name"),
            F.col("r_name").alias("store_region"),
        )

    def customers(self) -> DataFrame:
        return self.customer.join(self.stores(), F.col("c_nationkey") == F.col("store_id")).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("store_name").alias("city"),
            F.col("store_region").alias("region"),
            F.col("c_mktsegment").alias("tier"),
        )

    def products(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
        )

    def order_headers(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("order_amount"),
            F.col("o_orderpriority").alias("priority"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("customer_rating"),
        )

    def raw_lines(self) -> DataFrame:
        """Order lines as landed: (order_id, line_number) repeats with other payloads."""
        return self.lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").alias("list_amount"),
            F.col("l_discount").alias("discount_pct"),
            F.col("l_returnflag").alias("channel"),
            F.col("l_shipdate").alias("ship_date"),
        )

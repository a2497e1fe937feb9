"""Silver: deduplicate, validate, enrich and price order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import amount, basis_points, cents, share_of
from tidemark.operators.dedup import latest_per_key

def standardize(df: DataFrame, trim: Sequence[str] = (), upper: Sequence[str] = ()) -> DataFrame:
    """Trim text columns, and trim and upper-case others."""
    return df.withColumns({**{c: F.trim(c) for c in trim}, **{c: F.upper(F.trim(c)) for c in upper}})


LINE_KEY = ("order_id", "line_number")


def deduplicate_lines(raw_lines: DataFrame) -> DataFrame:
    """One row per order line: the one shipped last; ties are settled by the whole row."""
    order = [F.col("ship_date").desc_nulls_last()]
    order += [F.col(c).asc_nulls_last() for c in raw_lines.columns if c not in (*LINE_KEY, "ship_date")]
    return latest_per_key(raw_lines, LINE_KEY, order)


def valid_lines(raw_lines: DataFrame) -> DataFrame:
    """Deduplicate first and filter afterwards.

    The order matters: a line whose kept row is invalid disappears, it does not
    fall back to an older valid row.
    """
    return deduplicate_lines(raw_lines).filter("order_id IS NOT NULL AND quantity > 0")


def sales_facts(raw_lines: DataFrame, orders: DataFrame, products: DataFrame, attributes: Sequence[str] = ()) -> DataFrame:
    """Narrow fact rows: keys, order date, quantity, price and total amount in cents.

    Dimension attributes are left out on purpose: the gold tables aggregate on
    the keys first and join the attributes to the much smaller result. Product
    ``attributes`` that are asked for come with the price, from the same join.
    """
    return (
        valid_lines(raw_lines)
        .join(orders.filter("customer_id IS NOT NULL").select("order_id", "customer_id", "order_date"), "order_id")
        .join(products.select("product_id", "price", *attributes), "product_id")
        .select(
            "order_id", "line_number", "order_date", "customer_id", "product_id", "quantity", "price", *attributes,
            (F.col("quantity") * cents("price")).alias("total_cents"),
        )
    )


def silver_lines(raw_lines: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The stored silver table: facts with customer and product attributes."""
    facts = sales_facts(raw_lines, orders, products, ("product_name", "category"))
    return facts.join(customers, "customer_id").select(
        "order_id", "line_number", "order_date", "customer_id", "customer_name", "city", "tier",
        "product_id", "product_name", "category", "quantity", "price",
        amount("total_cents").alias("total_amount"),
    )


def priced_lines(raw_lines: DataFrame, orders: DataFrame, products: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Lines of orders in some statuses, with gross and net revenue in cents, order day and category."""
    gross, points = cents("list_amount"), basis_points("discount_pct")
    wanted = orders.filter(F.col("customer_id").isNotNull() & F.upper("status").isin(list(statuses)))
    return (
        raw_lines.filter("list_amount > 0 AND quantity > 0")
        .join(wanted.select("order_id", "customer_id", "order_date"), "order_id")
        .join(products.select("product_id", "category"), "product_id")
        .select(
            "order_id", "customer_id", "category", "channel", "quantity",
            points.alias("discount_points"),
            F.date_trunc("day", "order_date").cast("timestamp_ntz").alias("order_date"),
            gross.alias("gross_cents"),
            share_of(gross, 10_000 - points).alias("net_cents"),
        )
    )

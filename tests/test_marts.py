"""Golden checks of the layered tables on literal rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, quality, snapshots
from tidemark.plans import behaviour, gold, reports, silver

RAW = ("order_id string, line_number int, product_id string, supplier_id int, quantity int, list_amount double, "
       "discount_pct double, channel string, ship_date timestamp_ntz")
START = datetime(2023, 11, 14)


def line(i, product="P1", quantity=1, day=0, number=1, amount=10.0, discount=0.0):
    return (f"ORD-{i:04d}", number, product, 1, quantity, amount, discount, "web", START + timedelta(days=day))


@pytest.fixture(scope="module")
def shop(spark):
    products = spark.sql("SELECT * FROM VALUES ('P1', 'one', 'Books', 45.99BD), ('P2', 'two', 'Books', 10.00BD) "
                         "AS t(product_id, product_name, category, price)")
    customers = spark.sql("SELECT * FROM VALUES ('C1', 'ann', 'Oslo', 'North', 'Gold'), "
                          "('C2', 'bob', 'Rome', 'South', 'Silver') AS t(customer_id, customer_name, city, region, tier)")
    return products, customers


def headers(spark, ids, nulls=()):
    data = [(f"ORD-{i:04d}", None if i in nulls else f"C{1 + i % 2}", START + timedelta(days=i % 3), "F") for i in ids]
    return spark.createDataFrame(data, "order_id string, customer_id string, order_date timestamp_ntz, status string")


def bronze_batch(spark):
    """50 valid lines and 5 dirty ones: 2 without customer, quantity 0, quantity -1, 1 duplicate."""
    lines = [line(i, quantity=1 + i % 5) for i in range(1, 51)]
    lines += [line(9901), line(9902), line(9903, quantity=0), line(9904, quantity=-1), line(1, product="P2", quantity=3)]
    ids = [*range(1, 51), 9901, 9902, 9903, 9904]
    return spark.createDataFrame(lines, RAW), headers(spark, ids, nulls=(9901, 9902))


def silver_of(shop, raw, orders):
    products, customers = shop
    return silver.silver_lines(raw, orders, customers, products)


def test_55_bronze_rows_become_50_silver_rows(spark, shop, rows):
    raw, orders = bronze_batch(spark)
    clean = silver_of(shop, raw, orders)
    assert raw.count() == 55 and clean.count() == 50
    dirty = spark.createDataFrame([(f"ORD-{i}",) for i in (9901, 9902, 9903, 9904)], "order_id string")
    assert {r.status for r in quality.absence_check(clean, "order_id", dirty).collect()} == {"FILTERED (correct)"}
    profile = quality.null_profile(clean, ["order_id", "customer_id", "order_date", "total_amount"],
                                   {"invalid_quantities": F.col("quantity") <= 0})
    assert rows(profile) == [(50, 0, 0, 0, 0, 0)]


def test_second_batch_is_merged_to_75(spark, shop, path):
    raw, orders = bronze_batch(spark)
    checks = {"valid_quantity": "quantity > 0", "valid_amount": "total_amount > 0"}
    snapshots.commit(silver_of(shop, raw, orders), path + "/silver", "CREATE", checks=checks)
    more = spark.createDataFrame([line(i) for i in range(51, 76)] + [line(9905)], RAW)
    batch = silver_of(shop, more, headers(spark, [*range(51, 76), 9905], nulls=(9905,)))
    now = snapshots.read_as_of(spark, path + "/silver")
    merged = changes.upsert(now, batch, ["order_id", "line_number"], [F.col("order_date").desc()])
    snapshots.commit(merged, path + "/silver", "MERGE", checks=checks)
    assert snapshots.read_as_of(spark, path + "/silver", 0).count() == 50
    assert snapshots.read_as_of(spark, path + "/silver").count() == 75


def test_line_whose_kept_row_is_dirty_vanishes(spark, rows):
    raw = spark.createDataFrame([line(1, quantity=2, day=0), line(1, quantity=0, day=1), line(2, quantity=0, day=0),
                                 line(2, quantity=4, day=1)], RAW)
    assert rows(silver.valid_lines(raw), "order_id", "quantity") == [("ORD-0002", 4)]


def test_hot_line_does_not_change_the_result(spark, rows):
    raw = spark.range(3000).select(
        F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("order_id"),
        F.lit(1).alias("line_number"), F.lit("P1").alias("product_id"), F.lit(1).alias("supplier_id"),
        F.col("id").cast("int").alias("quantity"), F.lit(1.0).alias("list_amount"), F.lit(0.0).alias("discount_pct"),
        F.lit("web").alias("channel"), F.lit(START).cast("timestamp_ntz").alias("ship_date")).repartition(7)
    got = {r.order_id: r.quantity for r in silver.deduplicate_lines(raw).collect()}
    want = {}
    for r in raw.collect():
        want[r.order_id] = min(want.get(r.order_id, 10**9), r.quantity)
    assert got == want


def test_gold_tables(spark, shop, rows):
    products, customers = shop
    raw = spark.createDataFrame([line(2, "P1", 2), line(2, "P2", 1, number=2), line(5, "P2", 3), line(1, "P2", 1)], RAW)
    facts = silver.sales_facts(raw, headers(spark, [1, 2, 5]), products)
    # Orders 2 (customer C1) and 5 (C2) fall on day 2, order 1 (C2) on day 1.
    assert rows(gold.daily_revenue(facts, customers)) == [
        (START + timedelta(days=1), "Rome", 10.0, 1, 1, 10.0, 1),
        (START + timedelta(days=2), "Oslo", 101.98, 2, 3, 50.99, 1),
        (START + timedelta(days=2), "Rome", 30.0, 1, 3, 30.0, 1)]
    summary = rows(gold.customer_summary(facts, customers), "customer_id", "total_orders", "lifetime_spend",
                   "total_items", "avg_order_value", "unique_products_bought", "first_order_date", "last_order_date")
    assert summary == [("C1", 2, 101.98, 3, 50.99, 2, START + timedelta(days=2), START + timedelta(days=2)),
                       ("C2", 2, 40.0, 4, 20.0, 1, START + timedelta(days=1), START + timedelta(days=2))]
    performance = rows(gold.product_performance(facts, products), "product_id", "times_ordered", "total_units_sold",
                       "total_revenue", "unique_buyers", "avg_units_per_order")
    assert performance == [("P1", 1, 2, 91.98, 1, 2.0), ("P2", 3, 5, 50.0, 2, 1.67)]


def test_discount_impact_guards_zero_and_rolls_up(spark, shop, rows):
    products, customers = shop
    raw = spark.createDataFrame([line(1, amount=100.0, discount=0.1), line(3, amount=50.0), line(5, amount=-1.0)], RAW)
    priced = silver.priced_lines(raw, headers(spark, [1, 3, 5]), products, ["F"])
    sales = gold.customer_day_sales(priced, customers)
    impact = rows(gold.discount_impact(sales), "order_date", "gross_revenue", "net_revenue", "discount_impact_pct")
    assert impact == [(START, 50.0, 50.0, 0.0), (START + timedelta(days=1), 100.0, 90.0, 10.0)]
    assert rows(gold.region_rollup(sales)) == [("South", 150.0, 140.0, 2, 2, 70.0, 1, 70.0)]
    none = silver.priced_lines(raw, headers(spark, [1, 3, 5]), products, ["X"])
    assert rows(gold.customer_day_sales(none, customers)) == []


def test_the_fact_is_shuffled_four_times_and_products_are_read_once(spark, plan):
    import os
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    from tidemark.plans.tables import Tables
    from tidemark.registry import marts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.silver_lineitems(Tables(spark, "/root/testdata/sf0.001")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("part.parquet") == 1
    fact = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and any(
        k in line for k in ("order_id#", "l_orderkey#", "product_id#", "customer_id#"))]
    assert len(fact) <= 4 + 3  # four of the fact, and one of each table that joins it


def test_regional_slices_partition_the_fact_table(spark):
    fact = spark.sql("SELECT id, element_at(array('West', 'Midwest', 'South'), int(id % 3) + 1) AS store_region "
                     "FROM range(100)")
    parts = [reports.regional_slice(fact, r).count() for r in ("West", "Midwest", "South", "North")]
    assert sum(parts) == 100 and parts[3] == 0


def test_alert_and_share(spark, rows):
    orders = spark.createDataFrame([("completed", 10.0)] * 8 + [("cancelled", 1.0)] * 2, "status string, order_amount double")
    bad = F.col("status") != "completed"
    assert rows(reports.threshold_alert(orders, bad, 20.0)) == [(10, 2, 20.0, "OK")]
    assert rows(reports.threshold_alert(orders, bad, 19.9)) == [(10, 2, 20.0, "WARNING")]
    assert rows(reports.threshold_alert(orders.limit(0), bad, 20.0)) == [(0, 0, 0.0, "OK")]
    assert rows(reports.with_share(reports.status_summary(orders), "order_count"), "status", "pct_of_total") == [
        ("cancelled", 20.0), ("completed", 80.0)]


def test_funnel_counts_steps_in_order(spark, rows):
    at = lambda h: datetime(2024, 1, 1, h)
    events = spark.createDataFrame(
        [(1, "view", at(1)), (1, "click", at(2)), (1, "purchase", at(3)),
         (2, "click", at(1)), (2, "view", at(2)), (2, "purchase", at(3)),
         (3, "view", at(1)), (3, "click", at(1)), (4, "error", at(1))], "user_id int, event_type string, ts timestamp_ntz")
    assert rows(behaviour.funnel(events, ["view", "click", "purchase"]), "step", "users", "step_rate") == [
        (1, 3, 1.0), (2, 2, 2 / 3), (3, 1, 0.5)]


def test_retention_and_churn(spark, rows):
    orders = spark.createDataFrame(
        [("a", datetime(2024, 1, 5), 1.0), ("a", datetime(2024, 3, 1), 2.0), ("b", datetime(2024, 1, 9), 4.0)],
        "customer_id string, order_date timestamp_ntz, order_amount double")
    assert rows(behaviour.monthly_retention(orders), "months_later", "active_customers") == [(0, 2), (2, 1)]
    assert rows(behaviour.repeat_purchase(orders)) == [(2, 1, 50.0)]
    assert rows(behaviour.churn_features(orders, "2024-03-01")) == [("a", 56, 1, 1.0, 56), ("b", 52, 1, 4.0, 52)]

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import quality

SCHEMA = "id int, amount double, rating int"
DATA = [(1, 10.0, 5), (2, -1.0, 3), (3, None, 2), (4, 5.0, 9), (5, 0.0, None)]
RULES = {"valid_rating": ("rating BETWEEN 1 AND 5", "warn"), "valid_amount": ("amount > 0", "drop")}


def frame(spark, data=DATA):
    return spark.createDataFrame(data, SCHEMA)


def test_warn_keeps_drop_removes_and_null_is_a_violation(spark, rows):
    assert rows(quality.expect(frame(spark), RULES), "id") == [(1,), (4,)]
    assert rows(quality.expectation_metrics(frame(spark), "t", RULES)) == [
        ("t", "valid_amount", "drop", 2, 3, 40.0), ("t", "valid_rating", "warn", 3, 2, 60.0)]


def test_metrics_of_an_empty_table(spark, rows):
    got = rows(quality.expectation_metrics(frame(spark).limit(0), "t", RULES), "passed", "failed", "passed_pct")
    assert got == [(0, 0, None), (0, 0, None)]


def test_fail_aborts_the_write(spark, path):
    rules = {"has_amount": ("amount IS NOT NULL", "fail")}
    with pytest.raises(Exception, match="has_amount"):
        quality.expect(frame(spark), rules).write.parquet(path + "/out")
    with pytest.raises(Exception):
        spark.read.parquet(path + "/out").count()
    assert quality.expect(frame(spark).filter("amount IS NOT NULL"), rules).count() == 4
    with pytest.raises(ValueError):
        quality.expect(frame(spark), {"x": ("true", "explode")})


def test_a_dropped_row_still_trips_a_fail_rule(spark, path):
    """Written sorted and in small row groups, so a pushed drop filter could skip the bad row."""
    spark.range(100_000).selectExpr("id", "id - 50000 AS amount").coalesce(1).write.option(
        "parquet.block.size", 4096).parquet(path + "/t")
    rules = {"has_id": ("id <> 10", "fail"), "positive": ("amount > 0", "drop")}
    with pytest.raises(Exception, match="has_id"):
        quality.expect(spark.read.parquet(path + "/t"), rules).count()
    fine = {**rules, "has_id": ("id >= 0", "fail")}
    assert quality.expect(spark.read.parquet(path + "/t"), fine).count() == 49_999


def test_observed_metrics_come_with_the_write(spark, rows, path):
    seen = Observation()
    quality.expect(frame(spark), RULES, seen).write.parquet(path + "/out")
    assert rows(quality.observed_metrics(spark, seen, "t", RULES)) == [
        ("t", "valid_amount", "drop", 2, 3), ("t", "valid_rating", "warn", 3, 2)]


def test_event_log_round_trip(spark, rows):
    metrics = quality.expectation_metrics(frame(spark), "t", RULES)
    log = quality.event_log_row(metrics)
    assert rows(quality.read_event_log(log)) == [("t", "valid_amount", 2, 3), ("t", "valid_rating", 3, 2)]


def test_quarantine_names_the_broken_rules(spark, rows):
    assert [(r[0], r[1]) for r in rows(quality.quarantine(frame(spark), RULES), "id", "failed_rules")] == [
        (2, ["valid_amount"]), (3, ["valid_amount"]), (4, ["valid_rating"]), (5, ["valid_rating", "valid_amount"])]


def test_labelled_issue(spark, rows):
    labelled = quality.labelled_issue(frame(spark), [
        (F.col("amount").isNull(), "NULL amount"),
        (F.col("amount") <= 0, F.concat(F.lit("Invalid amount: "), F.col("amount").cast("string")))])
    assert rows(labelled, "id", "data_quality_issue") == [
        (1, "Valid"), (2, "Invalid amount: -1.0"), (3, "NULL amount"), (4, "Valid"), (5, "Invalid amount: 0.0")]


def test_reconciliation(spark, rows):
    silver = quality.expect(frame(spark), RULES)
    assert rows(quality.layer_counts({"bronze": frame(spark), "silver": silver})) == [("bronze", 5), ("silver", 2)]
    assert rows(quality.rows_dropped(frame(spark), RULES)) == [(5, 2, 3, 60.0)]
    dirty = frame(spark).filter("id IN (2, 4)")
    assert rows(quality.absence_check(silver, "id", dirty)) == [(2, "FILTERED (correct)"), (4, "PRESENT (bug!)")]


def test_assertions(spark):
    check = lambda df: quality.assert_rows(df, F.col("amount") < 0, "empty table", "negative amount")
    assert check(frame(spark).filter("id = 1")).first()[0] == "PASS"
    with pytest.raises(Exception, match="negative amount"):
        check(frame(spark)).collect()
    with pytest.raises(Exception, match="empty table"):
        check(frame(spark).limit(0)).collect()


def test_null_profile_and_imputation(spark, rows):
    got = rows(quality.null_profile(frame(spark), ["id", "amount", "rating"], {"bad": F.col("amount") <= 0}))
    assert got == [(5, 0, 1, 1, 2)]
    assert rows(quality.impute(frame(spark), {"amount": 0.5, "rating": 3}).filter("id IN (3, 5)")) == [
        (3, 0.5, 2), (5, 0.0, 3)]

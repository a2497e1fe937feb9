from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import dates, masks, money
from tidemark.operators import metadata, policy

PEOPLE = "id int, email string, ssn string, region string, salary double, is_active boolean"
DATA = [(1, "alice@co.com", "123-45-6789", "Mid_West", 120000.0, True),
        (2, "bo@co.com", "987-65-4321", "west_division", 90000.0, True),
        (3, None, None, None, None, True),
        (4, "dan@co.com", "111-22-3333", "mid_west", 80000.0, False)]
MASKS = {"email": masks.mask_email, "ssn": masks.mask_ssn, "salary": masks.hide}
POLICY = policy.Policy(row_group="region", masks=MASKS, row_condition="is_active")


def people(spark):
    return spark.createDataFrame(DATA, PEOPLE)


def test_masks(spark, rows):
    masked = people(spark).select("id", masks.mask_email(F.col("email")), masks.mask_ssn(F.col("ssn")),
                                  masks.mask_email_keep_domain(F.col("email")), masks.hide(F.col("salary")))
    assert rows(masked)[0] == (1, "al***@***", "***-**-6789", "al***@co.com", None)
    assert rows(masked)[2] == (3, None, None, None, None)
    assert masked.schema.fields[4].dataType.simpleString() == "double"


def test_row_filter(spark, rows):
    assert rows(policy.visible_rows(people(spark), "region", ["admin"]), "id") == [(1,), (2,), (3,), (4,)]
    assert rows(policy.visible_rows(people(spark), "region", ["mid_west"]), "id") == [(1,), (4,)]
    assert rows(policy.visible_rows(people(spark), "region", ["west_division", "x"]), "id") == [(2,)]
    assert rows(policy.visible_rows(people(spark), "region", []), "id") == []


def test_policy_filters_on_unmasked_values(spark, rows):
    hidden_region = policy.Policy(row_group="region", masks={"region": masks.hide})
    assert rows(policy.apply_policy(people(spark), hidden_region, ["mid_west"]), "id", "region") == [(1, None), (4, None)]
    got = rows(policy.apply_policy(people(spark), POLICY, ["mid_west"]))
    assert got == [(1, "al***@***", "***-**-6789", "Mid_West", None, True)]
    assert len(rows(policy.apply_policy(people(spark), POLICY, ["admin"]))) == 3


def test_sql_functions_follow_the_session_groups(spark, rows):
    masks.register_sql_functions(spark)
    people(spark).createOrReplaceTempView("people")
    text = """SELECT id, mask_email(email), mask_email_domain(email), mask_ssn(ssn),
              hide_amount(salary, in_group('admin', user_groups))
              FROM people WHERE in_group('admin', user_groups) OR in_group(region, user_groups)"""
    masks.set_groups(spark, ["mid_west"])
    assert rows(spark.sql(text)) == [(1, "al***@***", "al***@co.com", "***-**-6789", None),
                                     (4, "da***@***", "da***@co.com", "***-**-3333", None)]
    masks.set_groups(spark, [])
    assert rows(spark.sql(text)) == []
    masks.set_groups(spark, ["admin"])
    assert len(rows(spark.sql(text))) == 4


def test_division_views(spark, rows):
    views = policy.division_views(people(spark), "region", ["mid_west", "west_division"])
    assert {k: rows(v, "id") for k, v in views.items()} == {"mid_west": [(4,)], "west_division": [(2,)]}


def test_calendar(spark, rows):
    days = dates.calendar(spark, "2024-01-01", "2024-12-31")
    assert days.count() == 366
    assert rows(days.filter("is_us_holiday"), F.col("calendar_date").cast("string"), "holiday_name") == [
        ("2024-01-01", "New Year's Day"), ("2024-07-04", "Independence Day"),
        ("2024-11-28", "Thanksgiving"), ("2024-12-25", "Christmas Day")]
    sunday = days.filter("calendar_date = DATE '2024-02-04'").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.is_weekday, sunday.day_type, sunday.day_name) == (
        1, True, False, "Weekend", "Sunday")
    assert (sunday.quarter, sunday.month_name, sunday.week_of_year, sunday.holiday_name) == (1, "February", 5, None)


def test_thanksgiving_is_the_fourth_thursday(spark, rows):
    days = dates.calendar(spark, "2018-11-01", "2030-11-30").filter("holiday_name = 'Thanksgiving'")
    got = rows(days, F.year("calendar_date"), F.dayofmonth("calendar_date"))
    assert len(got) == 13 and all(22 <= d <= 28 for _, d in got)


def test_time_functions(spark):
    row = spark.range(1).select(
        dates.epoch_to_timestamp(F.lit(1_700_000_000)).cast("timestamp_ntz").alias("epoch"),
        dates.to_utc(F.lit("2024-07-01 12:00:00").cast("timestamp_ntz"), "America/New_York").alias("utc"),
        dates.minutes_between(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
                              F.lit("2024-01-01 01:30:59").cast("timestamp_ntz")).alias("minutes")).first()
    assert row.epoch == datetime(2023, 11, 14, 22, 13, 20)
    assert row.utc == datetime(2024, 7, 1, 16, 0)
    assert row.minutes == 90


def test_rounded_ratio_is_half_up_and_null_on_zero(spark):
    d = lambda v: F.lit(v).cast("decimal(18,2)")
    row = spark.range(1).select(money.rounded_ratio(d("2.67"), F.lit(2)), money.rounded_ratio(d("1.00"), F.lit(0)),
                                money.rounded_ratio(F.lit(1), F.lit(3), 2, 100), money.ratio(F.lit(1), F.lit(0))).first()
    assert tuple(row) == (1.34, None, 33.33, None)


def test_rounded_ratio_rounds_once(spark):
    """A quotient just below a half must not be lifted over it by an earlier rounding."""
    below = money.rounded_ratio(F.lit(1072208), F.lit(27178911), 2, 100)
    exact_half = money.rounded_ratio(F.lit(1), F.lit(800), 2, 100)
    negative = money.rounded_ratio(F.lit(-1), F.lit(800), 2, 100)
    assert spark.range(1).select(below, exact_half, negative).first() == (3.94, 0.13, -0.13)


def test_rounded_ratio_equals_exact_fractions(spark):
    import random
    from decimal import Decimal
    from fractions import Fraction

    random.seed(11)
    pairs = [(random.randint(0, 10**10), random.choice([1, 3, 7, 8, 40, 800, random.randint(1, 10**10)]))
             for _ in range(3000)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint").select(
        "n", "d", money.rounded_ratio(F.col("n"), F.col("d"), 2, 100).alias("r"))
    for r in df.collect():
        hundredths = Fraction(r.n * 10_000, r.d)
        assert r.r == float(Decimal(int(hundredths + Fraction(1, 2))) / 100)


def test_cents_are_exact_and_shares_round_half_away_from_zero(spark, rows):
    df = spark.createDataFrame([(i / 100,) for i in range(-20_000, 20_000, 7)], "v double")
    wrong = df.filter(money.cents("v") != F.round(F.col("v").cast("decimal(18,2)") * 100).cast("bigint"))
    assert wrong.count() == 0
    share = money.share_of(F.col("c"), F.lit(5_000))
    assert rows(spark.createDataFrame([(3,), (-3,), (1,), (0,)], "c bigint").select("c", share)) == [
        (-3, -2), (0, 0), (1, 1), (3, 2)]
    net = money.share_of(money.cents(F.lit(10.1)), 10_000 - money.basis_points(F.lit(0.125)))
    assert spark.range(1).select(net, money.amount(F.lit(1010))).first() == (884, 10.1)


def test_lineage(spark, rows):
    edges = spark.createDataFrame(
        [("raw.a", "silver.b", "ann", 1, "x", "y"), ("raw.a", "silver.c", "bob", 2, "x", "z"),
         ("silver.b", "gold.d", "ann", 3, "y", "w"), ("raw.a", "silver.b", "ann", 4, "q", "y"),
         ("raw.e", "gold.d", "cy", 5, "k", "w")],
        "source_table_full_name string, target_table_full_name string, created_by string, event_time int, "
        "source_column_name string, target_column_name string")
    assert [r.event_time for r in metadata.upstream(edges, "gold.%").collect()] == [5, 3]
    assert [r.event_time for r in metadata.downstream(edges, "raw.a%").collect()] == [4, 2, 1]
    assert rows(metadata.impact(edges, "raw.a")) == [("silver.b", "ann"), ("silver.c", "bob")]
    assert len(rows(metadata.column_lineage(edges, "raw.e", "silver.b"))) == 3


def test_pii_columns(spark, rows):
    spark.sql("CREATE OR REPLACE TEMP VIEW staff (id COMMENT 'key', ssn COMMENT 'PII: number') AS SELECT 1, 'x'")
    found = metadata.tagged_columns(metadata.column_metadata(spark, ["staff"]))
    assert rows(found, "table_name", "column_name") == [("staff", "ssn")]


def test_audit_over_nested_rows(spark, rows):
    log = spark.sql("""SELECT * FROM VALUES
        (1, timestamp_ntz'2024-01-01', 'getTable', named_struct('email', 'a@x'), named_struct('full_name_arg', 'c.s.t')),
        (2, timestamp_ntz'2024-01-03', 'getTable', named_struct('email', 'b@x'), named_struct('full_name_arg', 'c.s.t')),
        (3, timestamp_ntz'2024-01-02', 'drop', named_struct('email', 'b@x'), named_struct('full_name_arg', 'c.s.u'))
        AS t(event_id, event_time, action_name, user_identity, request_params)""")
    touched = (F.col("action_name") == "getTable") & F.col("request_params.full_name_arg").like("c.s.%")
    assert [r[0] for r in metadata.audit(log, touched, 1).select("user_identity.email").collect()] == ["b@x"]

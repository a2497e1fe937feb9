"""Column masks, as Column functions and as SQL functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The visible texts of masked e-mail addresses and social security numbers.
EMAIL_MASK = "***@***"
EMAIL_LOCAL_MASK = "***@"
SSN_MASK = "***-**-"
EMAIL_VISIBLE, SSN_VISIBLE = 2, 4


def mask_email(email: Column) -> Column:
    """The first two characters, then the mask; NULL stays NULL."""
    return F.concat(F.left(email, F.lit(EMAIL_VISIBLE)), F.lit(EMAIL_MASK))


def mask_email_keep_domain(email: Column) -> Column:
    """The first two characters, the mask of the local part, and the domain."""
    return F.concat(F.left(email, F.lit(EMAIL_VISIBLE)), F.lit(EMAIL_LOCAL_MASK), F.split_part(email, F.lit("@"), F.lit(2)))


def mask_ssn(ssn: Column) -> Column:
    """The mask and the last four characters."""
    return F.concat(F.lit(SSN_MASK), F.right(ssn, F.lit(SSN_VISIBLE)))


def hide(value: Column) -> Column:
    """NULL of the same type."""
    return F.when(F.lit(False), value)


def register_sql_functions(spark: SparkSession) -> None:
    """SQL versions for use in views: ``mask_email``, ``mask_email_domain``, ``mask_ssn``, ``hide_amount``,
    and ``in_group`` over the session variable ``user_groups``."""
    spark.sql("DECLARE OR REPLACE VARIABLE user_groups ARRAY<STRING> DEFAULT array()")
    bodies = {
        "mask_email(v STRING) RETURNS STRING": f"concat(left(v, {EMAIL_VISIBLE}), '{EMAIL_MASK}')",
        "mask_email_domain(v STRING) RETURNS STRING":
            f"concat(left(v, {EMAIL_VISIBLE}), '{EMAIL_LOCAL_MASK}', split_part(v, '@', 2))",
        "mask_ssn(v STRING) RETURNS STRING": f"concat('{SSN_MASK}', right(v, {SSN_VISIBLE}))",
        "hide_amount(v DOUBLE, show BOOLEAN) RETURNS DOUBLE": "CASE WHEN show THEN v END",
        "in_group(g STRING, groups ARRAY<STRING>) RETURNS BOOLEAN": "coalesce(array_contains(groups, lower(g)), false)",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def set_groups(spark: SparkSession, groups: list[str]) -> None:
    """Set the groups of the session's user (values are passed as parameters)."""
    spark.sql("SET VARIABLE user_groups = :groups", args={"groups": F.array(*[F.lit(g) for g in groups])})

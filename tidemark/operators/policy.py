"""Row filters and column masks applied to a read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADMIN = "admin"


@dataclass(frozen=True)
class Policy:
    """``row_group``: the column whose lower-cased value names the group that may see the row.

    ``masks``: per column, the mask that everybody but an administrator sees.
    ``row_condition``: a condition that holds for every reader, such as only active rows.
    """

    row_group: str | None = None
    masks: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    row_condition: str | None = None


def is_admin(groups: Sequence[str]) -> bool:
    return ADMIN in groups


def visible_rows(df: DataFrame, column: str, groups: Sequence[str]) -> DataFrame:
    """Rows whose group the reader belongs to; NULL or unknown values are hidden from all but administrators."""
    if is_admin(groups):
        return df
    return df.filter(F.lower(column).isin([g for g in groups]))


def apply_policy(df: DataFrame, policy: Policy, groups: Sequence[str]) -> DataFrame:
    """The rows and values a member of ``groups`` may see.

    Rows are filtered on the unmasked values; masks come last. Publish only the
    result: whoever holds ``df`` itself is not restricted.
    """
    if policy.row_condition:
        df = df.filter(policy.row_condition)
    if policy.row_group:
        df = visible_rows(df, policy.row_group, groups)
    if is_admin(groups):
        return df
    return df.select(*[
        policy.masks[c](F.col(c)).alias(c) if c in policy.masks else F.col(c) for c in df.columns])


def division_views(df: DataFrame, column: str, divisions: Sequence[str]) -> dict[str, DataFrame]:
    """One filtered frame per division."""
    return {d: df.filter(F.col(column) == d) for d in divisions}

"""Expectations, quarantine and reconciliation.

A rule is ``name -> (predicate SQL, action)`` with the action warn, drop or
fail. A predicate that is NULL counts as violated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.money import rounded_ratio

Rules = Mapping[str, tuple[str, str]]
ACTIONS = ("warn", "drop", "fail")


def _passes(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def _check(rules: Rules) -> None:
    for name, (_, action) in rules.items():
        if action not in ACTIONS:
            raise ValueError(f"rule {name}: unknown action {action}")


def expect(df: DataFrame, rules: Rules, observation: Observation | None = None) -> DataFrame:
    """Apply stacked expectations in one pass.

    Rows that break a drop rule are removed; a row that breaks a fail rule
    aborts the job, so nothing is committed; warn rules keep every row. With an
    ``observation`` the counts are collected by the job that consumes the result;
    they are exact when no shuffle lies between this step and the write (stages
    that are run again after a lost executor would count twice).
    """
    _check(rules)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"),
                        *[F.count_if(_passes(p)).alias(name) for name, (p, _) in rules.items()])
    dropping = [_passes(p) for p, action in rules.values() if action == "drop"]
    failing = [(name, p) for name, (p, action) in rules.items() if action == "fail"]
    if not failing:
        for condition in dropping:
            df = df.filter(condition)
        return df
    # One expression, so that no drop rule can be pushed into the scan and hide a row from a fail rule.
    verdict = reduce(lambda a, b: a & b, dropping, F.lit(True))
    for name, predicate in reversed(failing):
        error = F.raise_error(F.lit(f"expectation {name} violated: {predicate}")).cast("boolean")
        verdict = F.when(_passes(predicate), verdict).otherwise(error)
    return df.filter(verdict)


def expectation_metrics(df: DataFrame, dataset: str, rules: Rules) -> DataFrame:
    """Rows passed and failed per rule, from one aggregate over the data."""
    _check(rules)
    counted = df.agg(F.count(F.lit(1)).alias("__rows"),
                     *[F.count_if(_passes(p)).alias(f"__pass_{i}") for i, (p, _) in enumerate(rules.values())])
    rows = F.array(*[
        F.struct(F.lit(dataset).alias("dataset"), F.lit(name).alias("expectation"), F.lit(action).alias("action"),
                 F.col(f"__pass_{i}").alias("passed"), (F.col("__rows") - F.col(f"__pass_{i}")).alias("failed"))
        for i, (name, (_, action)) in enumerate(rules.items())])
    return counted.select(F.inline(rows)).withColumn(
        "passed_pct", rounded_ratio(F.col("passed"), F.col("passed") + F.col("failed"), 2, 100))


def observed_metrics(spark, observation: Observation, dataset: str, rules: Rules) -> DataFrame:
    """The metrics rows of a run from its finished observation (one small row per rule)."""
    seen = observation.get
    rows = [(dataset, name, action, seen[name], seen["rows"] - seen[name])
            for name, (_, action) in rules.items()]
    return spark.createDataFrame(rows, "dataset string, expectation string, action string, passed long, failed long")


def event_log_row(metrics: DataFrame) -> DataFrame:
    """Pack metrics rows of one dataset into one JSON event of the run log (a row per rule, so small)."""
    rule = F.struct("expectation", "passed", "failed")
    return metrics.groupBy("dataset").agg(F.sort_array(F.collect_list(rule)).alias("expectations")).select(
        F.to_json(F.struct(F.struct(F.struct(F.struct(F.col("expectations")).alias("data_quality"))
                                    .alias("flow_progress")).alias("details"), "dataset")).alias("event"))


def read_event_log(events: DataFrame) -> DataFrame:
    """The metrics rows stored in JSON events, by path."""
    schema = "array<struct<expectation string, passed bigint, failed bigint>>"
    path = "$.details.flow_progress.data_quality.expectations"
    return events.select(
        F.get_json_object("event", "$.dataset").alias("dataset"),
        F.inline(F.from_json(F.get_json_object("event", path), schema)))


def quarantine(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows that break at least one rule, with the names of the rules they break."""
    failed = F.array_compact(F.array(*[F.when(~_passes(p), F.lit(name)) for name, (p, _) in rules.items()]))
    return df.withColumn("failed_rules", failed).filter(F.size("failed_rules") > 0)


def labelled_issue(df: DataFrame, cases: Sequence[tuple[Column, Column | str]], name: str = "data_quality_issue",
                   valid: str = "Valid") -> DataFrame:
    """Label every row with the text of the first case it matches."""
    label = None
    for condition, text in cases:
        text = F.lit(text) if isinstance(text, str) else text
        label = F.when(condition, text) if label is None else label.when(condition, text)
    return df.withColumn(name, label.otherwise(F.lit(valid)))


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several layers, one row per layer."""
    counts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("layer"), "records")
              for name, df in layers.items()]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def rows_dropped(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows in, rows out, rows dropped and dropped percent under the drop rules, from one aggregate."""
    _check(rules)
    kept = reduce(lambda a, b: a & b, [_passes(p) for p, action in rules.values() if action == "drop"], F.lit(True))
    counted = df.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(kept).alias("rows_out"))
    dropped = F.col("rows_in") - F.col("rows_out")
    return counted.withColumn("dropped", dropped).withColumn(
        "dropped_pct", rounded_ratio(dropped, F.col("rows_in"), 1, 100))


def absence_check(df: DataFrame, key: str, dirty: DataFrame) -> DataFrame:
    """For every key of ``dirty``: FILTERED (correct) when ``df`` lacks it, PRESENT (bug!) otherwise."""
    present = df.select(F.col(key).alias("__present")).distinct()
    return dirty.select(key).distinct().join(present, F.col(key) == F.col("__present"), "left").select(
        key, F.when(F.col("__present").isNull(), "FILTERED (correct)").otherwise("PRESENT (bug!)").alias("status"))


def assert_rows(df: DataFrame, violation: Column, empty_message: str, violation_message: str) -> DataFrame:
    """One row with PASS and the counts behind it; raises when the table is empty or a row violates the condition."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(violation).alias("bad"))
    return counted.select(
        F.when(F.col("n") == 0, F.raise_error(F.lit(empty_message)).cast("string"))
        .when(F.col("bad") > 0, F.raise_error(F.lit(violation_message)).cast("string"))
        .otherwise(F.lit("PASS")).alias("check_result"), F.col("n").alias("rows"), F.col("bad").alias("violations"))


def null_profile(df: DataFrame, columns: Sequence[str], invalid: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: total rows, NULLs per column and rows per invalid condition, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        *[F.count_if(condition).alias(name) for name, condition in (invalid or {}).items()])


def impute(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by per-column defaults."""
    return df.fillna(dict(defaults))

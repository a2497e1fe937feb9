"""Personal data in texts: candidates by pattern, decided by arithmetic (check digits, number ranges), all in expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def luhn_valid(digits: Column) -> Column:
    """The last digit of a string of digits is the check digit of a card number: every second digit from the right is
    doubled, and the digits of all add up to a multiple of ten. An empty string has none."""
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        return total + F.when((size - i) % 2 == 0, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    return (size > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), F.lit(0), add) % 10 == 0)


def iban_valid(code: Column) -> Column:
    """An account number whose check digits are right: with the first four characters at the end and letters as 10 to 35,
    the number is 1 modulo 97. Taken digit by digit, so no long number is formed."""
    moved = F.concat(F.substring(code, 5, 34), F.substring(code, 1, 4))

    def onward(rest: Column, i: Column) -> Column:
        char = F.substring(moved, i, F.lit(1))
        return F.when(char <= "9", rest * 10 + F.ascii(char) - 48).otherwise(rest * 100 + F.ascii(char) - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(moved), F.lit(1))), F.lit(0), onward) == 1


def address_valid(address: Column) -> Column:
    """Four numbers of at most 255, none written with a leading zero."""
    parts = F.split(address, "[.]")
    return (F.size(parts) == 4) & F.forall(parts, lambda p: (p.try_cast("int") <= 255) & ((F.length(p) == 1) | ~p.startswith("0")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[ -]", "")


def _card(value: Column) -> Column:
    plain = _digits(value)
    return F.length(plain).between(13, 19) & luhn_valid(plain)


#: Rule: pattern of candidates, and what makes one valid.
RULES: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "card": ("[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{8,}", _card),
    "iban": ("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", iban_valid),
    "ipv4": ("[0-9]{1,3}(?:[.][0-9]{1,3}){3}", address_valid),
}


def candidates(docs: DataFrame, keep: Sequence[str], text: str = "text", rules: Sequence[str] = tuple(RULES)) -> DataFrame:
    """One row per candidate: the ``keep`` columns, rule, value and valid. NULL and empty texts have none."""
    found = F.array(*[F.struct(F.lit(rule).alias("rule"), F.regexp_extract_all(
        F.coalesce(F.col(text), F.lit("")), F.lit(RULES[rule][0]), F.lit(0)).alias("values")) for rule in rules])
    rows = docs.select(*keep, F.explode(found).alias("__f")).select(
        *keep, F.col("__f.rule").alias("rule"), F.explode("__f.values").alias("value"))
    valid = F.lit(False)
    for rule in rules:
        valid = F.when(F.col("rule") == rule, RULES[rule][1](F.col("value"))).otherwise(valid)
    return rows.withColumn("valid", F.coalesce(valid, F.lit(False)))


def counts(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """By rule: candidates, valid ones and the documents with a valid one."""
    by_document = candidates(docs, [key], text).groupBy("rule", key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("v"))
    return by_document.groupBy("rule").agg(
        F.sum("n").alias("candidates"), F.sum("v").alias("valid"), F.count_if(F.col("v") > 0).alias("documents"))


def redacted(text: Column, rules: Sequence[str] = tuple(RULES)) -> Column:
    """The text with each valid value replaced by its rule's name in brackets; NULL stays NULL."""
    for rule in rules:
        pattern, valid = RULES[rule]
        values = F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), valid))
        # longest first: a shorter value may be a part of a longer one
        ordered = F.transform(F.array_sort(F.transform(values, lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v")))),
                              lambda s: s["v"])
        mark = F.lit(f"[{rule}]")
        text = F.aggregate(ordered, text, lambda done, v: F.replace(done, v, mark))  # noqa: B023, called at once
    return text

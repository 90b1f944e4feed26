"""Rule checks. A rule is a boolean column that is true where a row passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import imatches
from .joins import keys_present, lookup_join
from .profile import string_columns, unfold
from .repair import NUMERIC_SENTINEL, SHIFTED_VALUES

# The 17 characters of a vehicle number exclude I, O and Q.
VIN_PATTERN = "^[A-HJ-NPR-Z0-9]{17}$"


def check_regex(c: str, pattern: str = VIN_PATTERN) -> Column:
    """Null fails."""
    return imatches(c, pattern)


def check_domain(c: str, length: int = 2, domain: list[str] | None = None) -> Column:
    """Length fits and, if a list is given, the value is on it. Null fails."""
    test = F.length(c) == length
    if domain:
        test &= F.col(c).isin(domain)
    return F.coalesce(test, F.lit(False))


def check_enum(c: str, values: list[str]) -> Column:
    """Null passes."""
    return F.col(c).isNull() | F.col(c).isin(values)


def check_range(
    c: str, above: float | None = None, below: float | None = None, at_least: float | None = None,
    never: float | None = None, null_ok: bool = False,
) -> Column:
    test = F.lit(True)
    if above is not None:
        test &= F.col(c) > above
    if below is not None:
        test &= F.col(c) < below
    if at_least is not None:
        test &= F.col(c) >= at_least
    if never is not None:
        test &= F.col(c) != never
    return F.coalesce(test, F.lit(null_ok))


def check_required(c: str, unless: Column) -> Column:
    """The value must be there except where `unless` holds."""
    return F.coalesce(unless, F.lit(False)) | F.col(c).isNotNull()


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows checked and rows that fail, per rule, from one pass."""
    names = list(rules)
    row = df.agg(
        F.count(F.lit(1)).alias("checked"), *[F.count_if(~rules[n]).alias(f"r{i}") for i, n in enumerate(names)]
    )
    cells = [F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, n in enumerate(names)]
    return row.select("checked", F.inline(F.array(*cells)))


def defect_rules(df: DataFrame) -> dict[str, Column]:
    """True where a structural defect of the sales table is still there."""
    dash = [F.coalesce(F.col(c) == "—", F.lit(False)).cast("bigint") for c in string_columns(df)]
    return {
        "garbled body": F.col("Body") == "Navitgation",
        "sedan in transmission": F.col("Transmission").isin(SHIFTED_VALUES),
        "body type in make": imatches("Make", "truck| tk$"),
        "make alias": F.lower("Make").isin("vw", "dot"),
        "model fragment": F.lower("Model") == "range",
        "dash placeholder": sum(dash, F.lit(0).cast("bigint")),
        "odometer sentinel": F.col("Odometer") == NUMERIC_SENTINEL,
    }


def verify_report(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Residual defects per rule; all should be 0. Number-valued rules are summed, others counted."""
    rules = rules or defect_rules(df)
    names = list(rules)
    aggs = [F.coalesce(F.sum(rules[n].cast("bigint")), F.lit(0).cast("bigint")).alias(n) for n in names]
    return unfold(df.agg(*aggs), names, "rule", "defects")


def quality_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Defects per rule before and after."""
    old = verify_report(before).withColumnRenamed("defects", "before")
    new = verify_report(after).withColumnRenamed("defects", "after")
    return old.join(new, "rule")


def soft_checks(df: DataFrame, key: str = "VIN", price: str = "SellingPrice", limit: float = 100_000) -> DataFrame:
    """Warnings: keys that occur more than once, and prices above a limit."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    first = repeated.agg(F.count(F.lit(1)).alias("count")).select(F.lit("duplicate keys").alias("check"), "count")
    high = df.agg(F.count_if(F.col(price) > limit).alias("count"))
    return first.unionByName(high.select(F.lit("price above limit").alias("check"), "count"))


def check_combination(df: DataFrame, keys: list[str], support: int) -> DataFrame:
    """Rows whose combination of keys occurs fewer than `support` times, with that number."""
    present = df.where(keys_present(keys))
    rare = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("support")).where(F.col("support") < support)
    return lookup_join(present, rare, keys).where(F.col("support").isNotNull())

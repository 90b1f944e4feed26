"""Profiling: what is in a table, and what is missing from it."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.text import strip
from .filters import split_repeated
from .quantile import group_quantiles


def unfold(row: DataFrame, cols: list[str], label: str, value: str) -> DataFrame:
    """One row with many columns turned into (label, value) rows."""
    cells = [F.struct(F.lit(c).alias(label), F.col(f"`{c}`").alias(value)) for c in cols]
    return row.select(F.inline(F.array(*cells)))


def melt(df: DataFrame, cols: list[str], label: str = "column", value: str = "value") -> DataFrame:
    """All cells of the numeric columns as (label, value) rows."""
    return df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, label, value)


def missing(c: str) -> Column:
    return F.col(c).isNull()


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def dtypes(df: DataFrame) -> DataFrame:
    """Column, type and number of values present."""
    present = df.agg(*[F.count(c).alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("type"),
            F.col(name).alias("non_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return present.select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Nulls per column, from one pass over the table."""
    cols = cols or df.columns
    row = df.agg(*[F.count_if(missing(c)).alias(c) for c in cols])
    return unfold(row, cols, "column", "nulls")


def null_pct(df: DataFrame) -> DataFrame:
    """Share of nulls in percent, columns with nulls only, largest first."""
    row = df.agg(*[(F.avg(missing(c).cast("double")) * 100).alias(c) for c in df.columns])
    return (
        unfold(row, df.columns, "column", "pct")
        .where("pct > 0")
        .orderBy(F.desc("pct"), "column")
    )


def total_missing(df: DataFrame) -> DataFrame:
    cells = sum((missing(c).cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).alias("missing"))


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    cols = cols or [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    cells = melt(df, cols)
    base = cells.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = group_quantiles(
        cells, ["column"], "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"]
    )
    return base.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns. Only rows that may have an equal are compared in full."""
    parts = split_repeated(df)
    df = df if parts is None else parts[1]
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def count_placeholders(df: DataFrame, tokens: list[str]) -> DataFrame:
    """Cells of all text columns that hold one of the tokens."""
    cells = sum(
        (F.coalesce(F.col(c).isin(tokens), F.lit(False)).cast("bigint") for c in string_columns(df)),
        F.lit(0).cast("bigint"),
    )
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).alias("placeholders"))


def null_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Nulls before, after and fixed, per column that had nulls."""
    cols = [c for c in before.columns if c in after.columns]
    old = null_counts(before, cols).withColumnRenamed("nulls", "null_before")
    new = null_counts(after, cols).withColumnRenamed("nulls", "null_after")
    return (
        old.join(new, "column")
        .where("null_before > 0")
        .withColumn("fixed", F.col("null_before") - F.col("null_after"))
        .orderBy(F.desc("fixed"), "column")
    )


def missing_rate_by(df: DataFrame, col: str, key: str) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(missing(col)).alias("missing"),
            (F.avg(missing(col).cast("double")) * 100).alias("missing_pct"),
        )
    )


def clean_corr(a: Column, b: Column) -> Column:
    """Pearson correlation; null, not NaN, when one side does not vary."""
    r = F.corr(a, b)
    return F.when(~F.isnan(r), r)


def missing_corr(df: DataFrame, col: str, x: str) -> DataFrame:
    return df.agg(clean_corr(missing(col).cast("double"), F.col(x).cast("double")).alias("r"))


def sentinel_distribution(df: DataFrame, col: str, sentinel, key: str) -> DataFrame:
    return (
        df.where((F.col(col) == F.lit(sentinel)) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), key)
    )


def case_variants(df: DataFrame, col: str) -> DataFrame:
    """Values that occur in more than one spelling once case and outer blanks are ignored."""
    spellings = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return (
        spellings.groupBy(F.lower(strip(col)).alias("value"))
        .agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("rows"))
        .where("spellings > 1")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("count"))
        .where("count > 1")
    )


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each named stage."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(i).alias("position"), F.lit(name).alias("stage"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        out = row if out is None else out.unionByName(row)
    return out


def missingness_corr(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of the missing indicators of every two columns."""
    pairs = list(combinations(cols, 2))
    row = df.agg(
        *[clean_corr(missing(a).cast("double"), missing(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs]
    )
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs
    ]
    return row.select(F.inline(F.array(*cells)))

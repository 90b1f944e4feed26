"""Correlation, slopes, distributions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import n_rows, rows_of_top
from .joins import lookup_join
from .profile import clean_corr
from ..sources.staging import stage
from .quantile import group_quantiles


def pair_corr(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation over rows where both values are there."""
    return df.agg(clean_corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """r, number of pairs and the t statistic of r."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    row = both.agg(clean_corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"), n_rows().alias("n"))
    r, n = F.col("r"), F.col("n")
    t = F.when((n > 2) & (F.abs(r) < 1), r * F.sqrt((n - 2) / (1 - r * r)))
    return row.withColumn("t", t)


def corr_matrix(df: DataFrame, cols: list[str], how: str = "pairwise", full: bool = False) -> DataFrame:
    """Correlations as (a, b, r) rows.

    `listwise` leaves out rows with any null, `pairwise` only those with a null in the
    pair. The strict lower triangle, or all cells if `full`.
    """
    source = df.select([F.col(c).cast("double").alias(c) for c in cols])
    if how == "listwise":
        source = source.na.drop()
    pairs = list(combinations(range(len(cols)), 2))
    row = source.agg(*[clean_corr(F.col(cols[i]), F.col(cols[j])).alias(f"r{i}_{j}") for i, j in pairs])
    wanted = [(j, i) for i, j in pairs]
    if full:
        wanted = [(a, b) for a in range(len(cols)) for b in range(len(cols))]
    cells = [
        F.struct(
            F.lit(cols[a]).alias("a"), F.lit(cols[b]).alias("b"),
            (F.lit(1.0) if a == b else F.col(f"r{min(a, b)}_{max(a, b)}")).alias("r"),
        )
        for a, b in wanted
    ]
    return row.select(F.inline(F.array(*cells)))


def slope_effect(df: DataFrame, y: str, x: str, step: float = 10_000) -> DataFrame:
    """Change of y per `step` of x by regression, next to the plain correlation times -1000."""
    a, b = F.col(y).cast("double"), F.col(x).cast("double")
    return df.agg(
        (F.regr_slope(a, b) * step).alias("slope_per_step"), (clean_corr(a, b) * -1000).alias("corr_times_minus_1000")
    )


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram between minimum and maximum; the last bin is closed, empty bins are kept."""
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / bins
    number = F.least(F.floor((x - lo) / width), F.lit(bins - 1)) if hi > lo else F.lit(0)
    counts = df.where(x.isNotNull()).groupBy(number.alias("bin")).agg(n_rows().alias("count"))
    all_bins = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return all_bins.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + width * F.col("bin")).alias("lower"), F.coalesce("count", F.lit(0)).alias("count")
    )


def box_stats(df: DataFrame, key: str, col: str, top: int | None = None) -> DataFrame:
    """Quartiles and whiskers (the extreme values within 1.5 interquartile ranges) by group."""
    source = df.where(F.col(key).isNotNull() & F.col(col).isNotNull())
    if top:
        source = rows_of_top(df, key, top).where(F.col(col).isNotNull())
    source = stage(source.select(key, col), "box")
    quartiles = group_quantiles(source, [key], col, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    joined = lookup_join(source.select(key, col), quartiles, [key])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col(col) >= F.col("q1") - reach) & (F.col(col) <= F.col("q3") + reach)
    return joined.groupBy(key).agg(
        F.min("q1").alias("q1"), F.min("median").alias("median"), F.min("q3").alias("q3"),
        F.min(F.when(inside, F.col(col))).alias("lower_whisker"),
        F.max(F.when(inside, F.col(col))).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"), n_rows().alias("count"),
    )


def density_grid(df: DataFrame, x: str, y: str, cells: int = 55) -> DataFrame:
    """Rows per cell of a rectangular grid and the decimal logarithm; empty cells are absent."""
    source = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    x0, x1, y0, y1 = source.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()

    def cell(c: str, lo: float | None, hi: float | None) -> Column:
        if lo is None or hi <= lo:
            return F.lit(0)
        return F.least(F.floor((F.col(c) - lo) / ((hi - lo) / cells)), F.lit(cells - 1))

    return (
        source.groupBy(cell(x, x0, x1).alias("cell_x"), cell(y, y0, y1).alias("cell_y"))
        .agg(n_rows().alias("count"))
        .withColumn("log_count", F.log10("count"))
    )

"""Group summaries, rankings and pivots.

Rows with a null group key are left out. Medians are exact and never gather a group
in one task, see `quantile`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numeric import tier
from .features import is_above_market
from .filters import FLAG_IMPUTED, FLAG_NON_IMPUTABLE, isin
from .impute import quality_label
from .joins import keys_present
from ..sources.staging import stage
from .quantile import group_median, group_quantiles, median_value


def n_rows() -> Column:
    return F.count(F.lit(1))


def pct(test: Column) -> Column:
    """Share in percent of the rows that meet a test; null on empty input."""
    return F.avg(test.cast("double")) * 100


def summarise(
    df: DataFrame, keys: list[str], aggs: list[Column], medians: dict[str, str] | None = None,
) -> DataFrame:
    """One row per group: plain aggregates plus medians `{name: column}`."""
    out = df.where(keys_present(keys)).groupBy(*keys).agg(*aggs)
    for name, value in (medians or {}).items():
        out = out.join(group_median(df, keys, value, name), keys, "left")
    return out


def literal_table(spark: SparkSession, column: str, values: list[str]) -> DataFrame:
    """A short list as a relation with its position."""
    rows = ", ".join("({}, '{}')".format(i, v.replace("'", "\\'")) for i, v in enumerate(values))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(position, value)").withColumnRenamed("value", column)


# --- key figures --------------------------------------------------------------------


def sales_kpis(df: DataFrame) -> DataFrame:
    """Count, median price, mean odometer, percent above market, mean age; null but for the count when empty."""
    return df.agg(
        n_rows().alias("records"), F.avg("Odometer").alias("avg_odometer"),
        pct(is_above_market()).alias("above_pct"), F.avg("VehicleAge").alias("avg_age"),
    ).withColumn("median_price", median_value(df, "SellingPrice"))


def hr_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        n_rows().alias("headcount"), F.avg("Monthly_Salary").alias("avg_salary"),
        (F.avg("Monthly_Salary") * 12).alias("avg_annual"), F.avg("Tenure_Years").alias("avg_tenure"),
        pct(F.col("Has_Sick_Leave")).alias("sick_pct"), pct(F.col("Has_Unpaid_Leave")).alias("unpaid_pct"),
        pct(F.col("High_Overtime")).alias("overtime_pct"),
    )


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(c) for c in cols])


def price_overview(df: DataFrame, col: str = "SellingPrice") -> DataFrame:
    return df.agg(F.avg(col).alias("mean"), F.max(col).alias("max")).withColumn("median", median_value(df, col))


def market_overview(df: DataFrame) -> DataFrame:
    price = "SellingPrice"
    return df.agg(
        n_rows().alias("records"), F.avg(price).alias("mean_price"), F.stddev_samp(price).alias("std_price"),
        F.min(price).alias("min_price"), F.max(price).alias("max_price"), F.avg("Odometer").alias("avg_odometer"),
        pct(isin("Transmission", ["automatic"])).alias("automatic_pct"),
        F.count_distinct("State").alias("states"),
    ).withColumn("median_price", median_value(df, price))


def predicate_share(df: DataFrame, test: Column) -> DataFrame:
    """Share of rows meeting a test; null counts as not meeting it."""
    return df.agg(F.avg(F.coalesce(test, F.lit(False)).cast("double")).alias("share"))


def filtered_mean(df: DataFrame, test: Column, col: str) -> DataFrame:
    return df.agg(F.avg(F.when(test, F.col(col))).alias("mean"))


def group_gap(df: DataFrame, group: str, value: str, first: str, second: str) -> DataFrame:
    """Distance between two group means, absolute and in percent of the overall mean."""
    def mean_of(name: str) -> Column:
        return F.coalesce(F.avg(F.when(F.col(group) == name, F.col(value))), F.lit(0.0))

    gap = F.abs(mean_of(first) - mean_of(second))
    return df.agg(gap.alias("gap"), (F.try_divide(gap, F.avg(value)) * 100).alias("gap_pct"))


# --- group summaries ----------------------------------------------------------------


def monthly_summary(df: DataFrame) -> DataFrame:
    out = summarise(
        df, ["SaleMonth"],
        [
            F.count("Id").alias("Volume"), F.coalesce(F.sum("SellingPrice"), F.lit(0.0)).alias("Total_Revenue"),
            F.avg("SellingPrice").alias("Avg_Price"), F.avg("MMR").alias("Avg_MMR"),
            F.count_if(F.col("AboveMMR")).alias("Above_MMR_Count"),
        ],
        {"Median_Price": "SellingPrice"},
    )
    share = F.bround(F.try_divide(F.col("Above_MMR_Count"), F.col("Volume")) * 100, 1)
    return out.withColumn("Above_MMR_Pct", share)


def make_summary(df: DataFrame) -> DataFrame:
    return summarise(
        df, ["Make"],
        [F.count("Id").alias("Volume"), F.avg("ConditionValue").alias("Avg_Condition"),
         F.avg("VehicleAge").alias("Avg_Age")],
        {"Median_Price": "SellingPrice"},
    )


def dept_stats(df: DataFrame) -> DataFrame:
    def mean1(c: str) -> Column:
        return F.bround(F.avg(F.col(c).cast("double")), 1)

    return summarise(
        df, ["Department"],
        [F.count("No").alias("Count"), mean1("Monthly_Salary").alias("Avg_Salary"),
         mean1("Overtime_Hours").alias("Avg_OT"), mean1("Has_Sick_Leave").alias("Sick_Pct"),
         mean1("High_Overtime").alias("HighOT_Pct")],
    ).orderBy(F.desc("Count"), "Department")


def dept_summary(df: DataFrame) -> DataFrame:
    return summarise(
        df, ["Department"],
        [F.count("No").alias("Employees"), F.bround(F.avg("Monthly_Salary"), 0).alias("Avg_Monthly_Salary"),
         F.coalesce(F.sum("Annual_Salary"), F.lit(0.0)).alias("Total_Annual_Cost"),
         F.bround(F.avg("Overtime_Hours"), 1).alias("Avg_OT_Hours"),
         F.count_if("Has_Sick_Leave").alias("Sick_Leave_Count"), F.count_if("High_Overtime").alias("High_OT_Count")],
    )


def staff_summary(df: DataFrame, key: str) -> DataFrame:
    """Headcount, mean salary and mean overtime by country, centre or the like."""
    return summarise(
        df, [key],
        [F.count("No").alias("Employees"), F.bround(F.avg("Monthly_Salary"), 0).alias("Avg_Salary"),
         F.bround(F.avg("Overtime_Hours"), 1).alias("Avg_OT")],
    )


def gender_level_summary(df: DataFrame) -> DataFrame:
    return summarise(
        df, ["Gender", "Job_Level"],
        [F.count("No").alias("Count"), F.bround(F.avg("Monthly_Salary"), 0).alias("Avg_Salary")],
    )


def group_mean(df: DataFrame, key: str, value: str, name: str = "mean") -> DataFrame:
    return summarise(df, [key], [F.avg(value).alias(name)])


def group_mean_sorted(df: DataFrame, key: str, value: str, n: int | None = None, digits: int | None = None):
    """Group means, largest first, optionally rounded (halves to even) and cut to the top n."""
    out = group_mean(df, key, value)
    out = out.orderBy(F.desc("mean"), key)
    if n is not None:
        out = out.limit(n)
    return out if digits is None else out.withColumn("mean", F.bround("mean", digits))


def overtime_tiers(df: DataFrame, n: int = 10) -> DataFrame:
    """Departments with the most overtime and their traffic-light class."""
    top = group_mean_sorted(df, "Department", "Overtime_Hours", n)
    return top.withColumn("tier", tier("mean", [(20, "high"), (10, "medium")], "low"))


def top_k_by_mean(df: DataFrame, key: str, value: str, k: int = 10) -> DataFrame:
    return group_mean_sorted(df, key, value, k)


# --- counts -------------------------------------------------------------------------


def value_counts(
    df: DataFrame, col: str, keep_null: bool = False, normalize: bool = False, by: str = "count"
) -> DataFrame:
    """Rows per value, most frequent first (ties by value) or sorted by value."""
    source = df if keep_null else df.where(F.col(col).isNotNull())
    out = source.groupBy(col).agg(n_rows().alias("count"))
    if normalize:
        total = source.agg(n_rows()).scalar()
        out = out.withColumn("share", F.col("count") / total)
    return out.orderBy(col) if by == "value" else out.orderBy(F.desc("count"), F.asc_nulls_first(col))


def stacked_distribution(df: DataFrame, cols: list[str]) -> DataFrame:
    """Counts and percentages of several columns in one table."""
    total = df.agg(n_rows()).scalar()
    out = None
    for c in cols:
        part = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("group")).agg(n_rows().alias("count"))
        part = part.select(
            F.lit(c).alias("category"), "group", "count",
            F.bround(F.col("count") / total * 100, 1).alias("pct"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def reindex_counts(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """Counts in a given order; a value that does not occur has a null count."""
    counts = df.where(isin(col, order)).groupBy(col).agg(n_rows().alias("count"))
    return literal_table(df.sparkSession, col, order).join(counts, col, "left").orderBy("position")


def state_ranking(df: DataFrame, col: str = "State", n: int = 5) -> DataFrame:
    return value_counts(df, col).limit(n)


# --- medians by group ---------------------------------------------------------------


def median_by(df: DataFrame, key: str, value: str = "SellingPrice") -> DataFrame:
    return group_median(df, [key], value, "median")


def median_by_band(df: DataFrame, band: Column, value: str = "SellingPrice") -> DataFrame:
    """Median per band; the number of bands is known from their definition."""
    return group_median(df.withColumn("band", band), ["band"], value, "median")


def median_by_year(df: DataFrame, since: int | None = None, value: str = "SellingPrice") -> DataFrame:
    source = df if since is None else df.where(F.col("Year") >= since)
    return median_by(source, "Year", value)


def yoy_median(df: DataFrame, value: str = "SellingPrice") -> DataFrame:
    """Median by model year and its change to the year before, if that year occurs."""
    along = Window.orderBy("Year")  # one row per year
    now = median_by_year(df, value=value)
    before = F.when(F.lag("Year").over(along) == F.col("Year") - 1, F.lag("median").over(along))
    return now.withColumn("previous", before).withColumn("change", F.col("median") - F.col("previous"))


def band_effect(df: DataFrame, band: Column, high: str, low: str, value: str = "SellingPrice") -> DataFrame:
    """Difference of the medians of two bands."""
    source = df.withColumn("band", band).where(F.col("band").isin(high, low))
    medians = group_median(source, ["band"], value, "median")
    pick = lambda label: F.max(F.when(F.col("band") == label, F.col("median")))
    return medians.agg(pick(high).alias("high"), pick(low).alias("low"), (pick(high) - pick(low)).alias("effect"))


def group_quartiles(df: DataFrame, key: str, value: str) -> DataFrame:
    return group_quantiles(df, [key], value, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])


# --- top groups, then a measure -----------------------------------------------------


def top_groups(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values and their counts."""
    return value_counts(df, key).limit(k)


def rows_of_top(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of the k most frequent groups. The list has at most k rows, so it is broadcast."""
    return df.join(F.broadcast(top_groups(df, key, k).select(key)), key, "left_semi")


def topk_then_median(df: DataFrame, key: str, k: int, value: str) -> DataFrame:
    medians = group_median(rows_of_top(df, key, k), [key], value, "median")
    return medians.orderBy("median", key)


def topk_volume_price(df: DataFrame, key: str = "Make", k: int = 10, value: str = "SellingPrice") -> DataFrame:
    df = stage(df.select(key, value), "volumes")
    top = stage(top_groups(df, key, k), "top")
    rows = df.join(F.broadcast(top.select(key)), key, "left_semi")
    medians = group_median(rows, [key], value, "median")
    return top.withColumnRenamed("count", "volume").join(medians, key, "left")


def heatmap(
    df: DataFrame, rows: str = "Make", cols: str = "Body", n_rows_: int = 8, n_cols: int = 6,
    value: str = "SellingPrice", scale: float = 1000.0, wide: bool = False,
) -> DataFrame:
    """Median of the top rows × top columns in thousands, 0 for empty cells.

    Long form (row, column, value), or a pivot whose columns are the at most `n_cols`
    top values.
    """
    df = stage(df.select(rows, cols, value), "cells")
    top_cols = top_groups(df, cols, n_cols).select(cols)
    cells = rows_of_top(df, rows, n_rows_).join(F.broadcast(top_cols), cols, "left_semi")
    medians = group_median(cells, [rows, cols], value, "median")
    # Only rows and columns that occur together with each other appear.
    seen = cells.groupBy(rows, cols).agg(n_rows().alias("__n"))
    listed = seen.agg(F.sort_array(F.collect_set(cols))).scalar()
    grid = seen.select(rows).distinct().withColumn(cols, F.explode(listed))
    scaled = F.coalesce(F.col("median"), F.lit(0.0)) / scale
    long = grid.join(medians, [rows, cols], "left").select(rows, cols, scaled.alias("value"))
    if not wide:
        return long
    labels = [r[0] for r in top_cols.collect()]
    return long.groupBy(rows).pivot(cols, labels).agg(F.first("value")).na.fill(0.0)


def pivot_gender_gap(df: DataFrame, k: int = 8) -> DataFrame:
    """Mean salary by department and gender for the k largest departments; 0 for an absent gender."""
    top = rows_of_top(df, "Department", k)
    return top.groupBy("Department").pivot("Gender", ["Male", "Female"]).agg(F.avg("Monthly_Salary")).na.fill(0.0)


def quality_median(df: DataFrame, k: int = 6, value: str = "SellingPrice") -> DataFrame:
    df = stage(df.select(*dict.fromkeys(["Body", value, FLAG_IMPUTED, FLAG_NON_IMPUTABLE])), "labelled")
    top = quality_label(rows_of_top(df, "Body", k))
    return group_median(top, ["Body", "DataQuality"], value, "median")


# --- time ---------------------------------------------------------------------------


def monthly_volume_revenue(df: DataFrame) -> DataFrame:
    revenue = F.coalesce(F.sum("SellingPrice"), F.lit(0.0)) / 1e6
    return summarise(df, ["SaleMonth"], [n_rows().alias("volume"), revenue.alias("revenue_m")])


def arg_max(groups: DataFrame, key: str, measure: str) -> Column:
    """Key of the largest measure, the smallest key on ties; an aggregate over group rows."""
    return F.min(F.struct((-F.col(measure)).alias("m"), F.col(key).alias("k")))["k"]


def peak_month(df: DataFrame) -> DataFrame:
    months = monthly_volume_revenue(df)
    return months.agg(
        arg_max(months, "SaleMonth", "revenue_m").alias("revenue_peak"), F.max("revenue_m").alias("revenue_m"),
        arg_max(months, "SaleMonth", "volume").alias("volume_peak"), F.max("volume").alias("volume"),
    )


def arg_max_groups(df: DataFrame, key: str = "Make", value: str = "SellingPrice") -> DataFrame:
    """The group with most rows and the group with the highest median."""
    by_count = value_counts(df, key)
    by_median = median_by(df, key, value)
    first = by_count.agg(
        F.lit("most rows").alias("what"), arg_max(by_count, key, "count").alias(key),
        F.max("count").cast("double").alias("value"),
    )
    second = by_median.agg(
        F.lit("highest median").alias("what"), arg_max(by_median, key, "median").alias(key),
        F.max("median").alias("value"),
    )
    return first.unionByName(second)


def mark_groups(groups: DataFrame, value: str) -> DataFrame:
    """Mark the groups that reach the largest value, and those at or above the median group."""
    groups = stage(groups, "groups")
    top = groups.agg(F.max(value)).scalar()
    return groups.withColumns(
        {
            "is_max": F.coalesce(F.col(value) == top, F.lit(False)),
            "at_least_median": F.coalesce(F.col(value) >= median_value(groups, value), F.lit(False)),
        }
    )

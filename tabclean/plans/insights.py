"""Key findings as (metric, value) text rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fmt_int, fmt_money, fmt_pct, fmt_fixed
from ..operators import aggregate as agg
from ..operators.quantile import median_value


def _rows(row: DataFrame, cells: list[tuple[str, object]]) -> DataFrame:
    structs = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("metric"), value.alias("value"))
        for i, (name, value) in enumerate(cells)
    ]
    return row.select(F.inline(F.array(*structs)))


def format_kpis(df: DataFrame) -> DataFrame:
    """The headline figures of the sales table as they are shown; dashes on empty input."""
    row = agg.sales_kpis(df)
    odometer = F.when(F.col("avg_odometer").isNull(), "—").otherwise(
        F.concat(fmt_int(F.bround("avg_odometer", 0)), F.lit(" mi"))
    )
    return row.select(
        fmt_int("records").alias("records"), fmt_money(F.bround("median_price", 0)).alias("median_price"),
        odometer.alias("avg_odometer"), fmt_pct("above_pct").alias("above_pct"),
        fmt_fixed("avg_age", 1, " yrs").alias("avg_age"),
    )


def sales_insights(df: DataFrame, since: int = 2015) -> DataFrame:
    """Findings about the prepared sales table; `since` is the first model year that counts as newer."""
    makes = agg.value_counts(df, "Make")
    colors = agg.value_counts(df, "Color")
    row = df.agg(
        agg.n_rows().alias("n"), F.min("SaleDate").alias("first"), F.max("SaleDate").alias("last"),
        F.avg("VehicleAge").alias("age"), agg.pct(F.coalesce(F.col("Transmission") == "automatic", F.lit(False)))
        .alias("automatic"), agg.pct(agg.is_above_market()).alias("above"),
        F.avg(F.when(F.col("Year") >= since, F.col("SellingPrice"))).alias("newer"),
    )
    top_make = makes.agg(agg.arg_max(makes, "Make", "count")).scalar()
    top_color = colors.agg(agg.arg_max(colors, "Color", "count")).scalar()
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return _rows(
        row,
        [
            ("Total records", fmt_int("n")),
            ("Sale period", F.concat(day("first"), F.lit(" to "), day("last"))),
            ("Median selling price", fmt_money(F.bround(median_value(df, "SellingPrice"), 0))),
            ("Average price of newer cars", fmt_money(F.bround("newer", 0))),
            ("Average age", fmt_fixed("age", 1, " years")),
            ("Top make", top_make),
            ("Most common color", top_color),
            ("Automatic share", fmt_pct("automatic")),
            ("Sold above market", fmt_pct("above")),
        ],
    )


def hr_insights(df: DataFrame) -> DataFrame:
    """Findings about the cleaned employee table."""
    kpis = agg.hr_kpis(df)
    depts = agg.dept_stats(df)
    countries = agg.value_counts(df, "Country")
    gap = agg.group_gap(df, "Gender", "Monthly_Salary", "Male", "Female").select(F.struct("gap", "gap_pct")).scalar()
    best = lambda groups, key, m: groups.agg(agg.arg_max(groups, key, m)).scalar()
    return _rows(
        kpis,
        [
            ("Employees", fmt_int("headcount")),
            ("Average monthly salary", fmt_money(F.bround("avg_salary", 0))),
            ("Gender pay gap", F.concat(fmt_money(F.bround(gap["gap"], 0)), F.lit(" / "), fmt_pct(gap["gap_pct"]))),
            ("Largest department", best(depts, "Department", "Count")),
            ("Highest paying department", best(depts, "Department", "Avg_Salary")),
            ("Most overtime", best(depts, "Department", "Avg_OT")),
            ("Largest country", best(countries, "Country", "count")),
            ("Average tenure", fmt_fixed("avg_tenure", 1, " years")),
            ("Sick leave rate", fmt_pct("sick_pct")),
            ("High overtime", fmt_pct("overtime_pct")),
        ],
    )

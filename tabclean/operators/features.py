"""Derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cut, month_of, pct_diff, quarter_of

# Band edges and labels.
PRICE_EDGES = [0, 5000, 10000, 15000, 20000, 30000, 50000, 999999]
PRICE_LABELS = ["<$5k", "$5-10k", "$10-15k", "$15-20k", "$20-30k", "$30-50k", ">$50k"]
CONDITION_EDGES = [0, 10, 20, 30, 40, 50]
CONDITION_LABELS = ["1-10", "11-20", "21-30", "31-40", "41-50"]
SALARY_EDGES = [0, 1000, 1500, 2000, 2500, 9999]
SALARY_LABELS = ["<1K", "1K-1.5K", "1.5K-2K", "2K-2.5K", ">2.5K"]
ODOMETER_EDGES = [0, 50000, 150000, 10**9]
ODOMETER_LABELS = ["<50k", "50-150k", ">150k"]
JOB_LEVELS = {1.0: "Junior", 2.0: "Mid", 3.0: "Senior", 4.5: "Lead", 5.0: "Principal"}


def add_calendar_parts(df: DataFrame, date: str = "SaleDate") -> DataFrame:
    return df.withColumns(
        {"SaleYear": F.year(date), "SaleMonth": month_of(date), "SaleQuarter": quarter_of(date)}
    )


def add_vehicle_age(df: DataFrame) -> DataFrame:
    return df.withColumn("VehicleAge", F.col("SaleYear") - F.col("Year"))


def add_price_diff(df: DataFrame) -> DataFrame:
    """Difference to the market value, absolute and in percent (null where the market value is 0)."""
    return df.withColumns(
        {
            "PriceDiff": F.col("SellingPrice") - F.col("MMR"),
            "PriceDiffPct": pct_diff("SellingPrice", "MMR"),
        }
    )


def is_above_market() -> Column:
    return F.coalesce(F.col("PriceDiff") > 0, F.lit(False))


def add_above_market(df: DataFrame) -> DataFrame:
    return df.withColumn("AboveMMR", is_above_market())


def price_band(c: str = "SellingPrice") -> Column:
    return cut(c, PRICE_EDGES, PRICE_LABELS)


def condition_band(c: str = "ConditionValue") -> Column:
    return cut(c, CONDITION_EDGES, CONDITION_LABELS)


def salary_band(c: str = "Monthly_Salary") -> Column:
    """Outside all bands the text `nan`, as a cast to text gives."""
    return cut(c, SALARY_EDGES, SALARY_LABELS, missing_label="nan")


def odometer_band(c: str = "Odometer") -> Column:
    return cut(c, ODOMETER_EDGES, ODOMETER_LABELS)


def add_threshold_flags(df: DataFrame) -> DataFrame:
    tests = {
        "Has_Sick_Leave": F.col("Sick_Leaves") > 0,
        "Has_Unpaid_Leave": F.col("Unpaid_Leaves") > 0,
        "High_Overtime": F.col("Overtime_Hours") > 50,
    }
    return df.withColumns({name: F.coalesce(test, F.lit(False)) for name, test in tests.items()})

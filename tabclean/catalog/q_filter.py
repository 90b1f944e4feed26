"""Filters, row selection and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric, text
from ..operators import features, filters
from ..operators.repair import SHIFTED_VALUES
from ..plans.employees import clean_employees
from ..plans.sales import first_clean, prepare_sales
from .registry import query
from .views import CONDITION_BAND, LEVEL, PRICE_BAND, SALARY_BAND, TENURE_DATE, Views, draw, title

KEYS = ["Id", "Make", "Body", "Transmission"]
_KEYS = ", ".join(KEYS)


def keep(key: str, sql_test: str, test):
    @query(key, f"SELECT {_KEYS} FROM sales WHERE {sql_test}")
    def _(v: Views):
        return v.sales.where(test()).select(*KEYS)


keep("filter_isin", "Transmission IN ('sedan', 'Sedan')", lambda: filters.isin("Transmission", SHIFTED_VALUES))
keep("filter_range", "Odometer BETWEEN 0 AND 30000", lambda: F.col("Odometer").between(0, 30000))
keep("filter_threshold", "SellingPrice > 90000 AND Year >= 1990",
     lambda: (F.col("SellingPrice") > 90000) & (F.col("Year") >= 1990))
keep("filter_icontains", "contains(lower(Trim), 'rover')", lambda: text.icontains("Trim", "ROVER"))
keep("filter_not_icontains", "NOT coalesce(contains(lower(Trim), 'rover'), false) AND Year < 1988",
     lambda: ~text.icontains("Trim", "rover") & (F.col("Year") < 1988))
keep("filter_regex", "regexp_matches(Make, '(?i) truck$| tk$')", lambda: text.imatches("Make", " TRUCK$| tk$"))
keep("filter_blank", "VIN IS NULL OR trim(VIN) = ''", lambda: text.is_blank("VIN"))
keep("filter_all_null", "Make IS NULL AND Model IS NULL AND Trim IS NULL AND Body IS NULL",
     lambda: text.all_null(["Make", "Model", "Trim", "Body"]))


@query(
    "facet_filter",
    f"""SELECT {_KEYS} FROM prepared WHERE Make IN ('Brand#1', 'Brand#2', 'Ford Truck') AND Body IN ('Economy', 'Small')
        AND Year BETWEEN 1988 AND 1998""",
    ("prepared",),
)
def _(v: Views):
    return filters.facet_filter(
        v.prepared, ["Brand#1", "Brand#2", "Ford Truck"], ["Economy", "Small"], [], None, (1988, 1998)
    ).select(*KEYS)


@query(
    "quality_filter",
    "SELECT Id, Make, _flag_imputed FROM cleaned WHERE (NOT _flag_imputed AND NOT _flag_non_imputable) "
    "OR _flag_non_imputable",
    ("cleaned",),
)
def _(v: Views):
    return filters.quality_filter(v.cleaned, ["clean", "non_imputable"]).select("Id", "Make", "_flag_imputed")


@query("drop_null", f"SELECT {_KEYS} FROM sales WHERE SaleDate IS NOT NULL AND SellingPrice IS NOT NULL AND MMR IS NOT NULL")
def _(v: Views):
    return filters.drop_null(v.sales, ["SaleDate", "SellingPrice", "MMR"]).select(*KEYS)


@query("drop_duplicates", "SELECT DISTINCT Make, Model, Body, Year, State FROM sales")
def _(v: Views):
    return filters.drop_duplicates(v.sales.select("Make", "Model", "Body", "Year", "State"))


@query(
    "quantile_trim",
    """SELECT Id, SellingPrice FROM sales WHERE SellingPrice BETWEEN
       (SELECT quantile_cont(SellingPrice, 0.01) FROM sales) AND (SELECT quantile_cont(SellingPrice, 0.99) FROM sales)""",
)
def _(v: Views):
    return filters.quantile_trim(v.sales.select("Id", "SellingPrice"), "SellingPrice")


@query("sample_n", f"SELECT Id, MMR, SellingPrice FROM sales WHERE MMR IS NOT NULL ORDER BY {draw('sample')}, Id LIMIT 6000")
def _(v: Views):
    return filters.sample_n(v.sales.where("MMR IS NOT NULL").select("Id", "MMR", "SellingPrice"), 6000, "Id")


@query("facet_values", "SELECT DISTINCT Make FROM sales WHERE Make IS NOT NULL")
def _(v: Views):
    return filters.facet_values(v.sales, "Make")


@query("bounds", "SELECT min(Year) AS lo, max(Year) AS hi FROM sales")
def _(v: Views):
    return filters.bounds(v.sales, "Year")


# --- derived columns ----------------------------------------------------------------


def derive(key: str, exprs: dict[str, str], build, cols: list[str], table: str = "sales"):
    out = [*cols, *exprs]
    listed = ", ".join([*cols, *[f"{x} AS {n}" for n, x in exprs.items()]])

    @query(key, f"SELECT {listed} FROM {table}", (table,))
    def _(v: Views):
        return build(getattr(v, table)).select(*out)


derive(
    "calendar_parts",
    {
        "SaleYear": "cast(year(SaleDate) AS int)", "SaleMonth": "strftime(SaleDate, '%Y-%m')",
        "SaleQuarter": "year(SaleDate) || 'Q' || quarter(SaleDate)",
    },
    features.add_calendar_parts, ["Id"],
)
derive(
    "vehicle_age", {"VehicleAge": "cast(year(SaleDate) - Year AS int)"},
    lambda df: features.add_vehicle_age(features.add_calendar_parts(df)), ["Id"],
)
derive(
    "price_diff",
    {"PriceDiff": "SellingPrice - MMR", "PriceDiffPct": "(SellingPrice - MMR) / nullif(MMR, 0) * 100"},
    features.add_price_diff, ["Id"],
)
derive(
    "above_market", {"AboveMMR": "coalesce(SellingPrice - MMR > 0, false)"},
    lambda df: features.add_above_market(features.add_price_diff(df)), ["Id"],
)
derive("cut_price_band", {"PriceBand": PRICE_BAND}, lambda df: df.withColumn("PriceBand", features.price_band()), ["Id"])
derive("cut_condition", {"Band": CONDITION_BAND}, lambda df: df.withColumn("Band", features.condition_band()), ["Id"])
derive(
    "sign_class", {"Side": "CASE WHEN SellingPrice - MMR > 0 THEN 'above' ELSE 'below' END"},
    lambda df: df.withColumn("Side", numeric.sign_class(F.col("SellingPrice") - F.col("MMR"))), ["Id"],
)
derive("cut_salary", {"Salary_Band": SALARY_BAND},
       lambda df: df.withColumn("Salary_Band", features.salary_band()), ["No"], "employees")
derive(
    "tenure_years",
    {"Tenure": f"cast(round_even(date_diff('day', cast(Start_Date AS date), DATE '{TENURE_DATE}') / 365.25e0, 0) AS int)"},
    lambda df: df.withColumn("Tenure", numeric.tenure_years("Start_Date", TENURE_DATE)), ["No"], "employees",
)
derive("map_level", {"Job_Level": LEVEL},
       lambda df: df.withColumn("Job_Level", text.map_values("Job_Rate", features.JOB_LEVELS, keep_others=False)),
       ["No"], "employees")
derive(
    "threshold_flags",
    {"Has_Sick_Leave": "Sick_Leaves > 0", "Has_Unpaid_Leave": "Unpaid_Leaves > 0", "High_Overtime": "Overtime_Hours > 50"},
    features.add_threshold_flags, ["No"], "employees",
)
derive(
    "full_name", {"Full_Name": "CASE WHEN No % 13 = 0 THEN NULL ELSE First_Name || ' ' || Last_Name END"},
    lambda df: df.withColumn("Last", F.when(F.col("No") % 13 != 0, F.col("Last_Name"))).withColumn(
        "Full_Name", text.full_name("First_Name", "Last")), ["No"], "employees",
)
derive(
    "tier",
    {"Tier": "CASE WHEN Overtime_Hours > 20 THEN 'high' WHEN Overtime_Hours > 10 THEN 'medium' ELSE 'low' END"},
    lambda df: df.withColumn("Tier", numeric.tier("Overtime_Hours", [(20, "high"), (10, "medium")], "low")),
    ["No"], "employees",
)


@query("clean_employees", "SELECT * FROM staff", ("staff",))
def _(v: Views):
    return clean_employees(v.employees, TENURE_DATE)


@query("prepare_sales", "SELECT * FROM prepared", ("prepared",))
def _(v: Views):
    return v.prepared


def _prepared_replaced() -> str:
    from .views import prepared_sql

    return prepared_sql("replaced").strip()


@query("prepare_sales_replace", _prepared_replaced(), ("replaced",))
def _(v: Views):
    return prepare_sales(v.sales, shift="replace")


@query(
    "first_clean",
    f"""WITH f AS (SELECT DISTINCT * REPLACE (
          {", ".join(f"{title(c)} AS {c}" for c in ["Make", "Model", "Trim", "Body", "Color", "Interior", "Seller"])},
          upper(trim(State)) AS State) FROM sales),
        g AS (SELECT * FROM f WHERE Odometer BETWEEN 0 AND 300000 AND SellingPrice > 100)
        SELECT * REPLACE (coalesce(Odometer, (SELECT median(Odometer) FROM g)) AS Odometer,
          coalesce(Color, 'Unknown') AS Color, coalesce(Interior, 'Unknown') AS Interior,
          coalesce(Trim, 'Base') AS Trim, coalesce(Body, 'Other') AS Body) FROM g""",
)
def _(v: Views):
    return first_clean(v.sales)

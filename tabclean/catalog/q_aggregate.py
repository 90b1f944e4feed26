"""Aggregates, rankings, pivots and statistics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import aggregate as agg
from ..operators import features, stats
from ..plans import cube, dashboard, insights
from ..plans.employees import LEVEL_ORDER, NUMERIC
from .registry import query
from .views import CONDITION_BAND, Views, case_band, text as quoted

PREP, STAFF = ("prepared",), ("staff",)


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def top(table: str, col: str, k: int) -> str:
    return f"(SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {col} LIMIT {k})"


# --- key figures --------------------------------------------------------------------

_KPI = """SELECT count(*) AS records, avg(Odometer) AS avg_odometer, avg(cast(AboveMMR AS int)) * 100 AS above_pct,
          avg(VehicleAge) AS avg_age, median(SellingPrice) AS median_price FROM prepared"""
_KPI_DIGITS = {"avg_odometer": 4, "above_pct": 6, "avg_age": 6, "median_price": 6}


@query("sales_kpis", _KPI, PREP, _KPI_DIGITS)
def _(v: Views):
    return agg.sales_kpis(v.prepared_for("Odometer", "PriceDiff", "VehicleAge", "SellingPrice"))


@query(
    "hr_kpis",
    """SELECT count(*) AS headcount, avg(Monthly_Salary) AS avg_salary, avg(Monthly_Salary) * 12 AS avg_annual,
       avg(Tenure_Years) AS avg_tenure, avg(cast(Has_Sick_Leave AS int)) * 100 AS sick_pct,
       avg(cast(Has_Unpaid_Leave AS int)) * 100 AS unpaid_pct, avg(cast(High_Overtime AS int)) * 100 AS overtime_pct
       FROM staff""",
    STAFF,
    {"avg_salary": 4, "avg_annual": 4, "avg_tenure": 6, "sick_pct": 6, "unpaid_pct": 6, "overtime_pct": 6},
)
def _(v: Views):
    return agg.hr_kpis(v.staff)


@query("distinct_counts", "SELECT count(DISTINCT Department) AS Department, count(DISTINCT Country) AS Country FROM staff",
       STAFF)
def _(v: Views):
    return agg.distinct_counts(v.staff, ["Department", "Country"])


@query("price_overview", "SELECT avg(SellingPrice) AS mean, max(SellingPrice) AS max, median(SellingPrice) AS median FROM sales",
       digits={"mean": 4, "median": 6})
def _(v: Views):
    return agg.price_overview(v.sales)


@query(
    "market_overview",
    """SELECT count(*) AS records, avg(SellingPrice) AS mean_price, stddev_samp(SellingPrice) AS std_price,
       min(SellingPrice) AS min_price, max(SellingPrice) AS max_price, avg(Odometer) AS avg_odometer,
       avg(cast(coalesce(Transmission = 'automatic', false) AS int)) * 100 AS automatic_pct,
       count(DISTINCT State) AS states, median(SellingPrice) AS median_price FROM prepared""",
    PREP, {"mean_price": 4, "std_price": 4, "avg_odometer": 4, "automatic_pct": 6, "median_price": 6},
)
def _(v: Views):
    return agg.market_overview(v.prepared)


@query("predicate_share", "SELECT avg(cast(coalesce(Transmission = 'automatic', false) AS int)) AS share FROM sales",
       digits={"share": 8})
def _(v: Views):
    return agg.predicate_share(v.sales, F.col("Transmission") == "automatic")


@query("filtered_mean", "SELECT avg(SellingPrice) FILTER (WHERE Year >= 1995) AS mean FROM sales", digits={"mean": 4})
def _(v: Views):
    return agg.filtered_mean(v.sales, F.col("Year") >= 1995, "SellingPrice")


@query(
    "gender_gap",
    """SELECT abs(m - f) AS gap, abs(m - f) / a * 100 AS gap_pct FROM (SELECT
       avg(Monthly_Salary) FILTER (WHERE Gender = 'Male') AS m, avg(Monthly_Salary) FILTER (WHERE Gender = 'Female') AS f,
       avg(Monthly_Salary) AS a FROM staff)""",
    STAFF, {"gap": 4, "gap_pct": 6},
)
def _(v: Views):
    return agg.group_gap(v.staff, "Gender", "Monthly_Salary", "Male", "Female")


# --- group summaries ----------------------------------------------------------------


@query(
    "monthly_summary",
    """SELECT SaleMonth, count(Id) AS Volume, sum(SellingPrice) AS Total_Revenue, avg(SellingPrice) AS Avg_Price,
       median(SellingPrice) AS Median_Price, avg(MMR) AS Avg_MMR, count(*) FILTER (WHERE AboveMMR) AS Above_MMR_Count,
       round_even(count(*) FILTER (WHERE AboveMMR) / count(Id) * 100, 1) AS Above_MMR_Pct FROM prepared GROUP BY 1""",
    PREP, {"Total_Revenue": 2, "Avg_Price": 4, "Median_Price": 6, "Avg_MMR": 4},
)
def _(v: Views):
    return agg.monthly_summary(v.prepared_for("SaleMonth", "SellingPrice", "MMR", "AboveMMR", counted=("Id",)))


@query(
    "make_summary",
    """SELECT Make, count(Id) AS Volume, median(SellingPrice) AS Median_Price, avg(ConditionValue) AS Avg_Condition,
       avg(VehicleAge) AS Avg_Age FROM prepared WHERE Make IS NOT NULL GROUP BY 1""",
    PREP, {"Median_Price": 6, "Avg_Condition": 4, "Avg_Age": 4},
)
def _(v: Views):
    return agg.make_summary(v.prepared_for("Make", "ConditionValue", "VehicleAge", "SellingPrice", counted=("Id",)))


@query(
    "dept_stats",
    """SELECT Department, count(No) AS "Count", round_even(avg(Monthly_Salary), 1) AS Avg_Salary,
       round_even(avg(Overtime_Hours), 1) AS Avg_OT, round_even(avg(cast(Has_Sick_Leave AS int)), 1) AS Sick_Pct,
       round_even(avg(cast(High_Overtime AS int)), 1) AS HighOT_Pct FROM staff GROUP BY 1""",
    STAFF,
)
def _(v: Views):
    return agg.dept_stats(v.staff)


@query(
    "dept_summary",
    """SELECT Department, count(No) AS Employees, round_even(avg(Monthly_Salary), 0) AS Avg_Monthly_Salary,
       sum(Annual_Salary) AS Total_Annual_Cost, round_even(avg(Overtime_Hours), 1) AS Avg_OT_Hours,
       count(*) FILTER (WHERE Has_Sick_Leave) AS Sick_Leave_Count,
       count(*) FILTER (WHERE High_Overtime) AS High_OT_Count FROM staff GROUP BY 1""",
    STAFF, {"Total_Annual_Cost": 2},
)
def _(v: Views):
    return agg.dept_summary(v.staff)


for _key, _col in [("country_summary", "Country"), ("center_summary", "Center")]:
    query(
        _key,
        f"""SELECT {_col}, count(No) AS Employees, round_even(avg(Monthly_Salary), 0) AS Avg_Salary,
            round_even(avg(Overtime_Hours), 1) AS Avg_OT FROM staff GROUP BY 1""",
        STAFF,
    )(lambda v, col=_col: agg.staff_summary(v.staff, col))


@query(
    "gender_level_summary",
    """SELECT Gender, Job_Level, count(No) AS "Count", round_even(avg(Monthly_Salary), 0) AS Avg_Salary
       FROM staff WHERE Job_Level IS NOT NULL GROUP BY 1, 2""",
    STAFF,
)
def _(v: Views):
    return agg.gender_level_summary(v.staff)


@query(
    "group_mean_top10",
    """SELECT Department, avg(Overtime_Hours) AS mean, CASE WHEN avg(Overtime_Hours) > 20 THEN 'high'
       WHEN avg(Overtime_Hours) > 10 THEN 'medium' ELSE 'low' END AS tier
       FROM staff GROUP BY 1 ORDER BY avg(Overtime_Hours) DESC, 1 LIMIT 10""",
    STAFF, {"mean": 4},
)
def _(v: Views):
    return agg.overtime_tiers(v.staff, 10)


@query("group_mean_sorted", "SELECT Department, round_even(avg(Monthly_Salary), 0) AS mean FROM staff GROUP BY 1", STAFF)
def _(v: Views):
    return agg.group_mean_sorted(v.staff, "Department", "Monthly_Salary", digits=0)


@query("mean_by_group", "SELECT Year, avg(SellingPrice) AS mean FROM sales WHERE Year IS NOT NULL GROUP BY 1",
       digits={"mean": 4})
def _(v: Views):
    return agg.group_mean(v.sales, "Year", "SellingPrice")


@query("mean_by_tenure", "SELECT Tenure_Years, avg(Monthly_Salary) AS mean FROM staff GROUP BY 1", STAFF, {"mean": 4})
def _(v: Views):
    return agg.group_mean(v.staff, "Tenure_Years", "Monthly_Salary")


@query(
    "top_k_by_mean",
    """SELECT Make, avg(SellingPrice) AS mean FROM sales WHERE Make IS NOT NULL GROUP BY 1
       ORDER BY avg(SellingPrice) DESC, 1 LIMIT 10""",
    digits={"mean": 4},
)
def _(v: Views):
    return agg.top_k_by_mean(v.sales, "Make", "SellingPrice", 10)


# --- counts -------------------------------------------------------------------------


@query("value_counts", 'SELECT Color, count(*) AS "count" FROM sales WHERE Color IS NOT NULL GROUP BY 1')
def _(v: Views):
    return agg.value_counts(v.sales, "Color")


@query("value_counts_null", 'SELECT Transmission, count(*) AS "count" FROM sales GROUP BY 1')
def _(v: Views):
    return agg.value_counts(v.sales, "Transmission", keep_null=True)


@query(
    "value_share",
    """SELECT Color, count(*) AS "count", count(*) / (SELECT count(*) FROM sales WHERE Color IS NOT NULL) AS share
       FROM sales WHERE Color IS NOT NULL GROUP BY 1""",
    digits={"share": 8},
)
def _(v: Views):
    return agg.value_counts(v.sales, "Color", normalize=True)


@query("value_counts_sorted", 'SELECT Tenure_Years, count(*) AS "count" FROM staff GROUP BY 1', STAFF)
def _(v: Views):
    return agg.value_counts(v.staff, "Tenure_Years", by="value")


_BANDS = ["<1K", "1K-1.5K", "1.5K-2K", "2K-2.5K", ">2.5K"]


@query(
    "band_counts_reindexed",
    f"""SELECT b.position, b.Salary_Band, c.n AS "count" FROM (VALUES
        {", ".join(f"({i}, {quoted(x)})" for i, x in enumerate(_BANDS))}) b(position, Salary_Band)
        LEFT JOIN (SELECT Salary_Band, count(*) AS n FROM staff GROUP BY 1) c USING (Salary_Band)""",
    STAFF,
)
def _(v: Views):
    return agg.reindex_counts(v.staff, "Salary_Band", _BANDS)


@query(
    "stacked_distribution",
    union(
        f"""SELECT '{c}' AS category, {c} AS "group", count(*) AS "count",
            round_even(count(*) / (SELECT count(*) FROM staff) * 100, 1) AS pct FROM staff GROUP BY 2"""
        for c in ["Gender", "Country"]
    ),
    STAFF,
)
def _(v: Views):
    return agg.stacked_distribution(v.staff, ["Gender", "Country"])


@query("state_ranking", 'SELECT State, count(*) AS "count" FROM prepared WHERE State IS NOT NULL GROUP BY 1 '
       'ORDER BY count(*) DESC, 1 LIMIT 5', PREP)
def _(v: Views):
    return agg.state_ranking(v.prepared)


# --- medians ------------------------------------------------------------------------


@query("median_by_band", f"SELECT * FROM (SELECT {CONDITION_BAND} AS band, median(SellingPrice) AS median FROM sales GROUP BY 1) "
       "WHERE band IS NOT NULL", digits={"median": 6})
def _(v: Views):
    return agg.median_by_band(v.sales, features.condition_band())


_ODO = case_band("Odometer", [0, 50000, 150000, 10**9], ["<50k", "50-150k", ">150k"])


@query("median_by_odometer_band", f"SELECT * FROM (SELECT {_ODO} AS band, median(SellingPrice) AS median FROM sales GROUP BY 1) "
       "WHERE band IS NOT NULL", digits={"median": 6})
def _(v: Views):
    return agg.median_by_band(v.sales, features.odometer_band())


@query("median_by_year", "SELECT Year, median(SellingPrice) AS median FROM sales WHERE Year >= 1990 GROUP BY 1",
       digits={"median": 6})
def _(v: Views):
    return agg.median_by_year(v.sales, since=1990)


@query("median_by_body", "SELECT Body, median(SellingPrice) AS median FROM sales WHERE Body IS NOT NULL GROUP BY 1",
       digits={"median": 6})
def _(v: Views):
    return agg.median_by(v.sales, "Body")


@query(
    "yoy_median",
    """SELECT Year, median, lag(median) OVER (ORDER BY Year) AS previous,
       median - lag(median) OVER (ORDER BY Year) AS change
       FROM (SELECT Year, median(SellingPrice) AS median FROM sales GROUP BY 1)""",
    digits={"median": 6, "previous": 6, "change": 6},
)
def _(v: Views):
    return agg.yoy_median(v.sales)


@query(
    "band_effect",
    f"""SELECT h AS high, l AS low, h - l AS effect FROM (SELECT median(SellingPrice) FILTER (WHERE b = '41-50') AS h,
        median(SellingPrice) FILTER (WHERE b = '1-10') AS l FROM (SELECT {CONDITION_BAND} AS b, SellingPrice FROM sales))""",
    digits={"high": 6, "low": 6, "effect": 6},
)
def _(v: Views):
    return agg.band_effect(v.sales, features.condition_band(), "41-50", "1-10")


@query(
    "group_quartiles",
    f"""SELECT Body, quantile_cont(SellingPrice, 0.25) AS q25, quantile_cont(SellingPrice, 0.5) AS q50,
        quantile_cont(SellingPrice, 0.75) AS q75 FROM prepared WHERE Body IN {top('prepared', 'Body', 6)} GROUP BY 1""",
    PREP, {"q25": 6, "q50": 6, "q75": 6},
)
def _(v: Views):
    return agg.group_quartiles(agg.rows_of_top(v.prepared_for("Body", "SellingPrice"), "Body", 6), "Body", "SellingPrice")


# --- top groups ---------------------------------------------------------------------


@query(
    "topk_then_median",
    f"""SELECT Make, median(PriceDiffPct) AS median FROM prepared WHERE Make IN {top('prepared', 'Make', 12)} GROUP BY 1""",
    PREP, {"median": 6},
)
def _(v: Views):
    return agg.topk_then_median(v.prepared_for("Make", "PriceDiffPct"), "Make", 12, "PriceDiffPct")


@query(
    "topk_volume_price",
    f"""SELECT Make, count(*) AS volume, median(SellingPrice) AS median FROM prepared
        WHERE Make IN {top('prepared', 'Make', 10)} GROUP BY 1""",
    PREP, {"median": 6},
)
def _(v: Views):
    return agg.topk_volume_price(v.prepared_for("Make", "SellingPrice"))


def heatmap_sql(table: str) -> str:
    return f"""WITH cells AS (SELECT Make, Body, SellingPrice FROM {table} WHERE Make IN {top(table, 'Make', 8)}
          AND Body IN {top(table, 'Body', 6)})
        SELECT r.Make, c.Body, coalesce(m.median, 0) / 1000 AS value
        FROM (SELECT DISTINCT Make FROM cells) r CROSS JOIN (SELECT DISTINCT Body FROM cells) c
        LEFT JOIN (SELECT Make, Body, median(SellingPrice) AS median FROM cells GROUP BY 1, 2) m USING (Make, Body)"""


def quality_sql(table: str) -> str:
    return f"""SELECT Body, CASE WHEN _flag_non_imputable THEN 'Non-imputable' WHEN _flag_imputed THEN 'Imputed' ELSE 'Clean' END
        AS DataQuality, median(SellingPrice) AS median FROM {table} WHERE Body IN {top(table, 'Body', 6)}
        GROUP BY 1, 2 HAVING median(SellingPrice) IS NOT NULL"""


@query("dashboard_kpis", _KPI.replace("FROM prepared", "FROM dashboard"), ("dashboard",), _KPI_DIGITS)
def _(v: Views):
    return dashboard.kpis(v.dashboard)


@query("dashboard_heatmap", heatmap_sql("dashboard"), ("dashboard",), {"value": 8})
def _(v: Views):
    return dashboard.heatmap(v.dashboard)


@query("dashboard_quality", quality_sql("dashboard"), ("dashboard",), {"median": 6})
def _(v: Views):
    return dashboard.quality(v.dashboard)


_CHOSEN = {"kinds": ["clean", "imputed"], "transmissions": ["automatic"], "years": (1984, 1996)}


@query("cube_kpis", _KPI.replace("FROM prepared", "FROM dashboard"), ("dashboard",), _KPI_DIGITS)
def _(v: Views):
    return cube.kpis(v.cube, **_CHOSEN)


@query("cube_heatmap", heatmap_sql("dashboard"), ("dashboard",), {"value": 8})
def _(v: Views):
    return cube.heatmap(v.cube, **_CHOSEN)


@query("cube_quality", quality_sql("dashboard"), ("dashboard",), {"median": 6})
def _(v: Views):
    return cube.quality(v.cube, **_CHOSEN)


@query("pivot_heatmap", heatmap_sql("prepared"), PREP, {"value": 8})
def _(v: Views):
    return agg.heatmap(v.prepared_for("Make", "Body", "SellingPrice"))


@query(
    "pivot_gender_gap",
    f"""SELECT Department, coalesce(avg(Monthly_Salary) FILTER (WHERE Gender = 'Male'), 0) AS Male,
        coalesce(avg(Monthly_Salary) FILTER (WHERE Gender = 'Female'), 0) AS Female FROM staff
        WHERE Department IN {top('staff', 'Department', 8)} GROUP BY 1""",
    STAFF, {"Male": 4, "Female": 4},
)
def _(v: Views):
    return agg.pivot_gender_gap(v.staff)


@query("quality_median", quality_sql("cleaned"), ("cleaned",), {"median": 6})
def _(v: Views):
    return agg.quality_median(v.cleaned)


# --- time ---------------------------------------------------------------------------

_MONTHS = "SELECT SaleMonth, count(*) AS volume, sum(SellingPrice) / 1e6 AS revenue_m FROM prepared GROUP BY 1"


@query("monthly_volume_revenue", _MONTHS, PREP, {"revenue_m": 8})
def _(v: Views):
    return agg.monthly_volume_revenue(v.prepared)


@query(
    "peak_month",
    f"""WITH m AS ({_MONTHS}) SELECT (SELECT SaleMonth FROM m ORDER BY revenue_m DESC, 1 LIMIT 1) AS revenue_peak,
        max(revenue_m) AS revenue_m, (SELECT SaleMonth FROM m ORDER BY volume DESC, 1 LIMIT 1) AS volume_peak,
        max(volume) AS volume FROM m""",
    PREP, {"revenue_m": 8},
)
def _(v: Views):
    return agg.peak_month(v.prepared)


@query(
    "arg_max",
    """SELECT * FROM (SELECT 'most rows' AS what, Make, cast(count(*) AS double) AS value FROM sales
         WHERE Make IS NOT NULL GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 1)
       UNION ALL SELECT * FROM (SELECT 'highest median', Make, median(SellingPrice) FROM sales
         WHERE Make IS NOT NULL GROUP BY 2 ORDER BY median(SellingPrice) DESC, 2 LIMIT 1)""",
    digits={"value": 6},
)
def _(v: Views):
    return agg.arg_max_groups(v.sales)


@query(
    "mark_groups",
    """WITH g AS (SELECT Department, avg(Monthly_Salary) AS mean FROM staff GROUP BY 1)
       SELECT *, mean = (SELECT max(mean) FROM g) AS is_max, mean >= (SELECT median(mean) FROM g) AS at_least_median FROM g""",
    STAFF, {"mean": 4},
)
def _(v: Views):
    return agg.mark_groups(agg.group_mean(v.staff, "Department", "Monthly_Salary"), "mean")


# --- statistics ---------------------------------------------------------------------


@query("pair_corr", "SELECT corr(SellingPrice, MMR) AS r FROM sales", digits={"r": 8})
def _(v: Views):
    return stats.pair_corr(v.sales, "SellingPrice", "MMR")


@query(
    "pearson",
    """SELECT r, n, r * sqrt((n - 2) / (1 - r * r)) AS t FROM (SELECT corr(MMR, SellingPrice) AS r, count(*) AS n
       FROM sales WHERE MMR IS NOT NULL AND SellingPrice IS NOT NULL)""",
    digits={"r": 8, "t": 4},
)
def _(v: Views):
    return stats.pearson(v.sales, "MMR", "SellingPrice")


_CORR = ["SellingPrice", "MMR", "Odometer", "ConditionValue", "Year", "VehicleAge"]
_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in _CORR)


@query(
    "corr_matrix_listwise",
    union(
        f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0e0" if a == b else f"corr({a}, {b})")
        + f" AS r FROM prepared WHERE {_PRESENT}" + (" LIMIT 1" if a == b else "")
        for a in _CORR for b in _CORR
    ).replace("SELECT", "(SELECT").replace("\nUNION", ")\nUNION") + ")",
    PREP, {"r": 6},
)
def _(v: Views):
    return stats.corr_matrix(v.prepared_for(*_CORR), _CORR, how="listwise", full=True)


@query(
    "corr_matrix_pairwise",
    union(f"SELECT '{b}' AS a, '{a}' AS b, corr({a}, {b}) AS r FROM staff" for a, b in combinations(NUMERIC, 2)),
    STAFF, {"r": 6},
)
def _(v: Views):
    return stats.corr_matrix(v.staff, NUMERIC, how="pairwise")


@query(
    "price_slope",
    """SELECT regr_slope(SellingPrice, Odometer) * 10000 AS slope_per_step,
       corr(SellingPrice, Odometer) * -1000 AS corr_times_minus_1000 FROM sales""",
    digits={"slope_per_step": 6, "corr_times_minus_1000": 6},
)
def _(v: Views):
    return stats.slope_effect(v.sales, "SellingPrice", "Odometer")


def bins_sql(table: str, col: str, n: int) -> str:
    return f"""WITH b AS (SELECT min({col})::double AS lo, max({col})::double AS hi, (hi - lo) / {n} AS w FROM {table})
      SELECT i.bin, b.lo + b.w * i.bin AS lower, coalesce(c.n, 0) AS "count"
      FROM (SELECT range AS bin FROM range({n})) i, b LEFT JOIN (
        SELECT cast(least(floor(({col} - lo) / w), {n - 1}) AS bigint) AS bin, count(*) AS n FROM {table}, b
        WHERE {col} IS NOT NULL GROUP BY 1) c ON i.bin = c.bin"""


@query("histogram", bins_sql("sales", "SellingPrice", 80), digits={"lower": 6})
def _(v: Views):
    return stats.histogram(v.sales, "SellingPrice", 80)


@query("histogram_salary", bins_sql("staff", "Monthly_Salary", 30), STAFF, {"lower": 6})
def _(v: Views):
    return stats.histogram(v.staff, "Monthly_Salary", 30)


_BOX = """WITH s AS (SELECT {key} AS k, {col} AS x FROM {table} WHERE {col} IS NOT NULL AND {test}),
  q AS (SELECT k, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
        FROM s GROUP BY 1)
  SELECT k AS {key}, q1, median, q3,
    min(x) FILTER (WHERE x BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS lower_whisker,
    max(x) FILTER (WHERE x BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS upper_whisker,
    count(*) FILTER (WHERE x NOT BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS outliers,
    count(*) AS "count" FROM s JOIN q USING (k) GROUP BY 1, 2, 3, 4"""
_BOX_DIGITS = {"q1": 6, "median": 6, "q3": 6}


@query(
    "box_stats",
    _BOX.format(key="Body", col="SellingPrice", table="prepared", test=f"Body IN {top('prepared', 'Body', 6)}"),
    PREP, _BOX_DIGITS,
)
def _(v: Views):
    return stats.box_stats(v.prepared_for("Body", "SellingPrice"), "Body", "SellingPrice", top=6)


@query(
    "box_stats_level",
    _BOX.format(key="Job_Level", col="Monthly_Salary", table="staff", test="Job_Level IS NOT NULL"),
    STAFF, {"q1": 8, "median": 8, "q3": 8},
)
def _(v: Views):
    return stats.box_stats(v.staff.where(F.col("Job_Level").isin(LEVEL_ORDER)), "Job_Level", "Monthly_Salary")


@query(
    "density_grid",
    """WITH s AS (SELECT Odometer AS x, SellingPrice AS y FROM sales WHERE Odometer IS NOT NULL AND SellingPrice IS NOT NULL),
       b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM s)
       SELECT cast(least(floor((x - x0) / ((x1 - x0) / 55)), 54) AS bigint) AS cell_x,
         cast(least(floor((y - y0) / ((y1 - y0) / 55)), 54) AS bigint) AS cell_y,
         count(*) AS "count", log10(count(*)) AS log_count FROM s, b GROUP BY 1, 2""",
    digits={"log_count": 8},
)
def _(v: Views):
    return stats.density_grid(v.sales, "Odometer", "SellingPrice")


# --- findings -----------------------------------------------------------------------


def _money(x: str) -> str:
    return f"'$' || format('{{:,}}', cast(round_even({x}, 0) AS bigint))"


def _fixed(x: str) -> str:
    return f"format('{{:.1f}}', round_even({x}, 1))"


@query(
    "insight_rows",
    union(
        f"SELECT {i} AS position, '{m}' AS metric, {x} AS value FROM prepared"
        for i, (m, x) in enumerate(
            [
                ("Total records", "format('{:,}', count(*))"),
                ("Sale period", "strftime(min(SaleDate), '%Y-%m-%d') || ' to ' || strftime(max(SaleDate), '%Y-%m-%d')"),
                ("Median selling price", _money("median(SellingPrice)")),
                ("Average price of newer cars", _money("avg(SellingPrice) FILTER (WHERE Year >= 1995)")),
                ("Average age", _fixed("avg(VehicleAge)") + " || ' years'"),
                ("Top make", f"any_value({top('prepared', 'Make', 1)})"),
                ("Most common color", f"any_value({top('prepared', 'Color', 1)})"),
                ("Automatic share",
                 _fixed("avg(cast(coalesce(Transmission = 'automatic', false) AS int)) * 100") + " || '%'"),
                ("Sold above market", _fixed("avg(cast(AboveMMR AS int)) * 100") + " || '%'"),
            ]
        )
    ),
    PREP,
)
def _(v: Views):
    return insights.sales_insights(
        v.prepared_for("SaleDate", "VehicleAge", "Transmission", "PriceDiff", "Year", "SellingPrice", "Make", "Color"), since=1995
    )


def _best(measure: str) -> str:
    return f"any_value((SELECT Department FROM staff GROUP BY 1 ORDER BY {measure} DESC, 1 LIMIT 1))"


@query(
    "insight_rows_hr",
    union(
        f"SELECT {i} AS position, '{m}' AS metric, {x} AS value FROM staff"
        for i, (m, x) in enumerate(
            [
                ("Employees", "format('{:,}', count(*))"),
                ("Average monthly salary", _money("avg(Monthly_Salary)")),
                ("Gender pay gap",
                 _money("abs(avg(Monthly_Salary) FILTER (WHERE Gender = 'Male') - avg(Monthly_Salary) "
                        "FILTER (WHERE Gender = 'Female'))") + " || ' / ' || "
                 + _fixed("abs(avg(Monthly_Salary) FILTER (WHERE Gender = 'Male') - avg(Monthly_Salary) "
                          "FILTER (WHERE Gender = 'Female')) / avg(Monthly_Salary) * 100") + " || '%'"),
                ("Largest department", _best("count(*)")),
                ("Highest paying department", _best("round_even(avg(Monthly_Salary), 1)")),
                ("Most overtime", _best("round_even(avg(Overtime_Hours), 1)")),
                ("Largest country", f"any_value({top('staff', 'Country', 1)})"),
                ("Average tenure", _fixed("avg(Tenure_Years)") + " || ' years'"),
                ("Sick leave rate", _fixed("avg(cast(Has_Sick_Leave AS int)) * 100") + " || '%'"),
                ("High overtime", _fixed("avg(cast(High_Overtime AS int)) * 100") + " || '%'"),
            ]
        )
    ),
    STAFF,
)
def _(v: Views):
    return insights.hr_insights(v.staff)

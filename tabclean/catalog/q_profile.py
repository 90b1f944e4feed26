"""Profiling and validation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import filters, profile, validate
from ..operators.filters import FLAG_NON_IMPUTABLE
from .registry import query
from .views import SALES_COLUMNS, Views

NUMBERS = ["Year", "ConditionValue", "Odometer", "MMR", "SellingPrice"]
STRINGS = ["Make", "Model", "Trim", "Body", "Transmission", "VIN", "State", "Color", "Interior", "Seller"]


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def nulls_of(table: str, name: str = "nulls", cols=SALES_COLUMNS) -> str:
    return union(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS {name} FROM {table}" for c in cols
    )


@query("profile_shape", 'SELECT count(*) AS "rows", 17 AS "columns" FROM sales')
def _(v: Views):
    return profile.shape(v.sales)


_KINDS = {"Year": "int", "SaleDate": "timestamp_ntz"} | {
    c: "double" for c in ["ConditionValue", "Odometer", "MMR", "SellingPrice"]
}


@query(
    "profile_dtypes",
    union(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{_KINDS.get(c, 'string')}' AS type, count({c}) AS non_null "
        "FROM sales" for i, c in enumerate(SALES_COLUMNS)
    ),
)
def _(v: Views):
    return profile.dtypes(v.sales)


@query("null_counts", nulls_of("sales"))
def _(v: Views):
    return profile.null_counts(v.sales)


@query(
    "null_pct",
    f"""SELECT "column", nulls * 100.0e0 / (SELECT count(*) FROM sales) AS pct
        FROM ({nulls_of("sales")}) WHERE nulls > 0""",
    digits={"pct": 6},
)
def _(v: Views):
    return profile.null_pct(v.sales)


@query("total_missing", f"SELECT cast(sum(nulls) AS bigint) AS missing FROM ({nulls_of('sales')})")
def _(v: Views):
    return profile.total_missing(v.sales)


@query(
    "describe_numeric",
    union(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std,
        cast(min({c}) AS double) AS min, quantile_cont(cast({c} AS double), 0.25) AS q25,
        quantile_cont(cast({c} AS double), 0.5) AS q50, quantile_cont(cast({c} AS double), 0.75) AS q75,
        cast(max({c}) AS double) AS max FROM sales""" for c in NUMBERS
    ),
    digits={"mean": 4, "std": 4, "q25": 6, "q50": 6, "q75": 6},
)
def _(v: Views):
    return profile.describe_numeric(v.sales, NUMBERS)


@query(
    "duplicate_count",
    f"""SELECT (SELECT count(*) FROM employees) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (No, Start_Date,
        Monthly_Salary, Annual_Salary) FROM employees)) AS duplicates""",
    ("employees",),
)
def _(v: Views):
    return profile.duplicate_count(v.employees.drop("No", "Start_Date", "Monthly_Salary", "Annual_Salary"))


@query("head_n", "SELECT * FROM sales ORDER BY Id, SellingPrice LIMIT 10")
def _(v: Views):
    return profile.head(v.sales, 10, ["Id", "SellingPrice"])


@query(
    "count_placeholders",
    "SELECT cast(sum(" + " + ".join(f"coalesce(cast({c} IN ('—', '---') AS int), 0)" for c in STRINGS)
    + ") AS bigint) AS placeholders FROM sales",
)
def _(v: Views):
    return profile.count_placeholders(v.sales, ["—", "---"])


@query(
    "null_comparison",
    f"""SELECT "column", null_before, null_after, null_before - null_after AS fixed
        FROM ({nulls_of("sales", "null_before")}) JOIN ({nulls_of("cleaned", "null_after")}) USING ("column")
        WHERE null_before > 0""",
    ("cleaned",),
)
def _(v: Views):
    return profile.null_comparison(v.sales, v.cleaned)


@query(
    "missing_rate_by",
    """SELECT Year, count(*) AS "rows", count(*) FILTER (WHERE Color IS NULL) AS missing,
       avg(cast(Color IS NULL AS int)) * 100 AS missing_pct FROM sales WHERE Year IS NOT NULL GROUP BY 1""",
    digits={"missing_pct": 6},
)
def _(v: Views):
    return profile.missing_rate_by(v.sales, "Color", "Year")


@query(
    "missing_rate_by_make",
    """SELECT Make, count(*) AS "rows", count(*) FILTER (WHERE Color IS NULL) AS missing,
       avg(cast(Color IS NULL AS int)) * 100 AS missing_pct FROM sales WHERE Make IS NOT NULL GROUP BY 1""",
    digits={"missing_pct": 6},
)
def _(v: Views):
    return profile.missing_rate_by(v.sales, "Color", "Make")


@query(
    "missing_corr",
    "SELECT corr(cast(Color IS NULL AS double), cast(year(SaleDate) - Year AS double)) AS r FROM sales",
    digits={"r": 6},
)
def _(v: Views):
    return profile.missing_corr(v.sales.withColumn("Age", F.year("SaleDate") - F.col("Year")), "Color", "Age")


@query(
    "sentinel_by_group",
    'SELECT Make, count(*) AS "count" FROM sales WHERE Odometer = 999999 AND Make IS NOT NULL GROUP BY 1',
)
def _(v: Views):
    return profile.sentinel_distribution(v.sales, "Odometer", 999999, "Make")


@query(
    "case_variants",
    """SELECT lower(trim(t)) AS value, count(DISTINCT t) AS spellings, count(*) AS "rows"
       FROM (SELECT Transmission AS t FROM sales UNION ALL SELECT upper(Transmission) FROM sales)
       WHERE t IS NOT NULL GROUP BY 1 HAVING count(DISTINCT t) > 1""",
)
def _(v: Views):
    raw = v.sales.select("Transmission")
    return profile.case_variants(raw.unionByName(raw.select(F.upper("Transmission").alias("Transmission"))), "Transmission")


@query("duplicate_keys", 'SELECT VIN, count(*) AS "count" FROM sales WHERE VIN IS NOT NULL GROUP BY 1 HAVING count(*) > 1')
def _(v: Views):
    return profile.duplicate_keys(v.sales, "VIN")


@query(
    "stage_counts",
    """SELECT 0 AS position, 'raw' AS stage, count(*) AS "rows", 17 AS "columns" FROM sales
       UNION ALL SELECT 1, 'dated and priced', count(*), 17 FROM sales
         WHERE SaleDate IS NOT NULL AND SellingPrice IS NOT NULL AND MMR IS NOT NULL
       UNION ALL SELECT 2, 'prepared', count(*), 25 FROM prepared""",
    ("prepared",),
)
def _(v: Views):
    priced = filters.drop_null(v.sales, ["SaleDate", "SellingPrice", "MMR"])
    return profile.stage_counts({"raw": v.sales, "dated and priced": priced, "prepared": v.prepared})


_MISS = ["Transmission", "Color", "Interior", "Odometer"]


@query(
    "missingness_corr",
    union(
        f"SELECT '{a}' AS a, '{b}' AS b, corr(cast({a} IS NULL AS double), cast({b} IS NULL AS double)) AS r FROM sales"
        for a, b in combinations(_MISS, 2)
    ),
    digits={"r": 6},
)
def _(v: Views):
    return profile.missingness_corr(v.sales, _MISS)


# --- validation ---------------------------------------------------------------------


def failing(rule: str, passes: str, table: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, count(*) AS checked, "
        f"count(*) FILTER (WHERE NOT coalesce({passes}, false)) AS violations FROM {table}"
    )


@query("check_vin", failing("vin", "regexp_matches(VIN, '(?i)^[A-HJ-NPR-Z0-9]{17}$')", "sales"))
def _(v: Views):
    return validate.violations(v.sales, {"vin": validate.check_regex("VIN")})


@query("check_state", failing("state", "length(State) = 2 AND State IN ('ca', 'fl', 'pa', 'tx')", "sales"))
def _(v: Views):
    return validate.violations(v.sales, {"state": validate.check_domain("State", 2, ["ca", "fl", "pa", "tx"])})


@query(
    "check_enum",
    failing("transmission", "Transmission IS NULL OR Transmission IN ('automatic', 'manual')", "cleaned"),
    ("cleaned",),
)
def _(v: Views):
    rule = validate.check_enum("Transmission", ["automatic", "manual"])
    return validate.violations(v.cleaned, {"transmission": rule})


@query(
    "check_range",
    failing("price", "SellingPrice > 0 AND SellingPrice < 500000", "sales") + " UNION ALL "
    + failing("odometer", "Odometer IS NULL OR (Odometer >= 0 AND Odometer <> 999999)", "sales"),
)
def _(v: Views):
    rules = {
        "price": validate.check_range("SellingPrice", above=0, below=500_000),
        "odometer": validate.check_range("Odometer", at_least=0, never=999999, null_ok=True),
    }
    return validate.violations(v.sales, rules)


@query("check_required", failing("make", "_flag_non_imputable OR Make IS NOT NULL", "cleaned"), ("cleaned",))
def _(v: Views):
    return validate.violations(v.cleaned, {"make": validate.check_required("Make", F.col(FLAG_NON_IMPUTABLE))})


def defects(table: str, name: str = "defects") -> str:
    dash = " + ".join(f"coalesce(cast({c} = '—' AS int), 0)" for c in STRINGS)
    rules = {
        "garbled body": "cast(Body = 'Navitgation' AS int)",
        "sedan in transmission": "cast(Transmission IN ('sedan', 'Sedan') AS int)",
        "body type in make": "cast(regexp_matches(lower(Make), 'truck| tk$') AS int)",
        "make alias": "cast(lower(Make) IN ('vw', 'dot') AS int)",
        "model fragment": "cast(lower(Model) = 'range' AS int)",
        "dash placeholder": f"({dash})",
        "odometer sentinel": "cast(Odometer = 999999 AS int)",
    }
    return union(
        f"SELECT '{k}' AS rule, cast(coalesce(sum({x}), 0) AS bigint) AS {name} FROM {table}" for k, x in rules.items()
    )


@query("verify_report", defects("sales"))
def _(v: Views):
    return validate.verify_report(v.sales)


@query("verify_cleaned", defects("cleaned"), ("cleaned",))
def _(v: Views):
    return validate.verify_report(v.cleaned)


@query(
    "quality_delta",
    f'SELECT rule, before, "after" FROM ({defects("sales", "before")}) '
    f'JOIN ({defects("cleaned", chr(34) + "after" + chr(34))}) USING (rule)',
    ("cleaned",),
)
def _(v: Views):
    return validate.quality_delta(v.sales, v.cleaned)


@query(
    "soft_checks",
    """SELECT 'duplicate keys' AS "check", count(*) AS "count" FROM (
         SELECT VIN FROM sales WHERE VIN IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
       UNION ALL SELECT 'price above limit', count(*) FILTER (WHERE SellingPrice > 100000) FROM sales""",
)
def _(v: Views):
    return validate.soft_checks(v.sales)


@query(
    "check_combination",
    """SELECT * EXCLUDE (s), s AS support FROM (SELECT Id, Make, Model, Year,
         count(*) OVER (PARTITION BY Make, Model, Year) AS s
       FROM sales WHERE Make IS NOT NULL AND Model IS NOT NULL AND Year IS NOT NULL) WHERE s < 20""",
)
def _(v: Views):
    return validate.check_combination(v.sales.select("Id", "Make", "Model", "Year"), ["Make", "Model", "Year"], 20)

"""The test tables seen as a sales table and an employee table.

The given tables hold no cars, no staff and no nulls. Two SQL texts, valid in Spark
and in DuckDB, derive both tables from them and put in nulls, placeholders, shifted
rows, aliases and fragments by rules on the keys. The further texts are the oracles'
own account of each cleaning step.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.impute import PREFIXES
from ..operators.repair import MAKE_ALIASES, MAKE_BODY, MODEL_ALIASES
from ..plans.cube import Cube
from ..plans.cube import build as build_cube
from ..plans.dashboard import dashboard_table
from ..plans.employees import clean_employees
from ..plans.sales import CleanConfig, clean_sales, prepare_sales

TENURE_DATE = "2003-01-01"

SALES = """
SELECT
  concat_ws('-', cast(l_orderkey AS string), cast(l_linenumber AS string), cast(l_partkey AS string),
            cast(l_suppkey AS string)) AS Id,
  cast(year(o_orderdate) - l_partkey % 12 AS int) AS Year,
  CASE WHEN l_partkey % 53 = 0 THEN NULL
       WHEN l_partkey % 47 = 0 THEN 'ford truck'
       WHEN l_partkey % 43 = 0 THEN 'vw'
       ELSE lower(p_brand) END AS Make,
  CASE WHEN l_partkey % 53 = 0 THEN NULL
       WHEN l_partkey % 37 = 0 THEN 'range'
       WHEN l_partkey % 31 = 0 THEN 'rangerover'
       ELSE p_name END AS Model,
  CASE WHEN l_partkey % 53 = 0 THEN NULL
       WHEN l_partkey % 37 = 0 THEN 'rover sport'
       ELSE concat('lx-', cast(p_size AS string)) END AS Trim,
  CASE WHEN l_partkey % 53 = 0 THEN NULL
       WHEN l_orderkey % 97 = 5 THEN 'Navitgation'
       ELSE p_type END AS Body,
  CASE WHEN l_orderkey % 97 = 5 THEN 'sedan'
       WHEN l_orderkey % 9 = 0 THEN NULL
       WHEN l_linenumber = 7 THEN ' Manual'
       WHEN l_linenumber = 6 THEN 'AUTO'
       ELSE 'automatic' END AS Transmission,
  CASE WHEN l_orderkey % 97 = 5 THEN 'automatic'
       WHEN l_partkey % 106 = 0 THEN NULL
       ELSE concat(CASE l_suppkey % 4 WHEN 0 THEN '3vw' WHEN 1 THEN '1ft'
                                      WHEN 2 THEN 'jtd' ELSE 'zzz' END,
                   lpad(cast(l_orderkey AS string), cast(greatest(7, length(cast(l_orderkey AS string))) AS int), '0'),
                   lpad(cast(l_partkey AS string), cast(greatest(7, length(cast(l_partkey AS string))) AS int), '0')) END AS VIN,
  CASE WHEN l_orderkey % 97 = 5
       THEN concat('3vw', lpad(cast(l_orderkey AS string), cast(greatest(7, length(cast(l_orderkey AS string))) AS int), '0'),
                   lpad(cast(l_partkey AS string), cast(greatest(7, length(cast(l_partkey AS string))) AS int), '0'))
       ELSE substr('caflpatxga', cast((s_nationkey % 5) * 2 + 1 AS int), 2) END AS State,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity END AS ConditionValue,
  CASE WHEN l_orderkey % 101 = 7 THEN cast(999999 AS double)
       WHEN l_orderkey % 103 = 7 THEN NULL
       ELSE cast((l_partkey * 97 + l_orderkey * 31) % 250000 AS double) END AS Odometer,
  CASE WHEN l_orderkey % 23 = 1 THEN '—'
       WHEN l_orderkey % 29 = 1 THEN '---'
       WHEN l_orderkey % 31 = 1 THEN NULL
       ELSE CASE l_returnflag WHEN 'A' THEN 'black' WHEN 'N' THEN 'white' ELSE 'gray' END
  END AS Color,
  CASE WHEN l_orderkey % 19 = 1 THEN '—'
       WHEN l_orderkey % 41 = 1 THEN NULL
       ELSE CASE l_linestatus WHEN 'F' THEN 'beige' ELSE 'tan' END
  END AS Interior,
  s_name AS Seller,
  CASE WHEN l_orderkey % 89 = 3 THEN NULL
       ELSE l_extendedprice * (0.95 + l_discount) END AS MMR,
  CASE WHEN l_orderkey % 199 = 3 THEN NULL ELSE l_extendedprice END AS SellingPrice,
  CASE WHEN l_orderkey % 211 = 3 THEN NULL ELSE l_shipdate END AS SaleDate
FROM {lineitem}
JOIN {orders}   ON l_orderkey = o_orderkey
JOIN {part}     ON l_partkey  = p_partkey
JOIN {supplier} ON l_suppkey  = s_suppkey
"""

EMPLOYEES = """
SELECT
  o_orderkey AS No,
  CASE o_orderkey % 4 WHEN 0 THEN ' ada' WHEN 1 THEN 'JEAN-luc'
                      WHEN 2 THEN 'o''neil ' ELSE 'mary ann' END AS First_Name,
  lower(c_name) AS Last_Name,
  CASE WHEN o_custkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
  o_orderdate AS Start_Date,
  concat('dept ', cast(o_custkey % 20 AS string)) AS Department,
  concat('country ', cast(c_nationkey % 5 AS string)) AS Country,
  c_mktsegment AS Center,
  600 + o_totalprice / 200 AS Monthly_Salary,
  (600 + o_totalprice / 200) * 12 AS Annual_Salary,
  CASE o_orderkey % 6 WHEN 0 THEN 1.0e0 WHEN 1 THEN 2.0e0 WHEN 2 THEN 3.0e0
                      WHEN 3 THEN 4.5e0 WHEN 4 THEN 5.0e0 ELSE 2.5e0 END AS Job_Rate,
  cast(o_orderkey % 7 AS int) AS Sick_Leaves,
  cast(o_orderkey % 11 % 4 AS int) AS Unpaid_Leaves,
  cast((o_orderkey * 37) % 120 AS int) AS Overtime_Hours
FROM {orders}
JOIN {customer} ON o_custkey = c_custkey
"""

SALES_COLUMNS = [
    "Id", "Year", "Make", "Model", "Trim", "Body", "Transmission", "VIN", "State", "ConditionValue",
    "Odometer", "Color", "Interior", "Seller", "MMR", "SellingPrice", "SaleDate",
]


# Declared, so that no job is run to look at the files first.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


class Views:
    """The tables of one folder, as the queries use them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def _view(self, text: str, names: list[str]) -> DataFrame:
        return self.spark.sql(text, **{n: self.table(n) for n in names})

    @cached_property
    def sales(self) -> DataFrame:
        return self._view(SALES, ["lineitem", "orders", "part", "supplier"])

    @cached_property
    def employees(self) -> DataFrame:
        return self._view(EMPLOYEES, ["orders", "customer"])

    @cached_property
    def prepared(self) -> DataFrame:
        return prepare_sales(self.sales)

    def prepared_for(self, *columns: str, counted: tuple[str, ...] = ()) -> DataFrame:
        """The columns of `prepared` that a report reads, written once; of those only counted, whether they are null."""
        present = {c: F.when(F.col(c).isNotNull(), F.lit(1)) for c in counted}
        return prepare_sales(self.sales.withColumns(present), columns=[*columns, *counted])

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean_sales(self.sales)

    @cached_property
    def marked(self) -> DataFrame:
        return clean_sales(self.sales, CleanConfig(keep_marks=True))

    @cached_property
    def dashboard(self) -> DataFrame:
        return dashboard_table(self.cleaned, ["clean", "imputed"], transmissions=["automatic"], years=(1984, 1996))

    @cached_property
    def cube(self) -> Cube:
        return build_cube(self.cleaned)

    @cached_property
    def staff(self) -> DataFrame:
        return clean_employees(self.employees, TENURE_DATE)


# --- oracle texts -------------------------------------------------------------------


def title(expr: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(trim({expr}), '[A-Za-z]+|[^A-Za-z]+'), "
        "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')"
    )


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def values(rows, name: str, cols: str) -> str:
    body = ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS {name}({cols})"


def draw(purpose: str, key: str = "Id") -> str:
    return f"('0x' || substr(md5('42|{purpose}|' || {key}), 1, 15))::HUGEINT"


DASH_LIST = "('---', '—', '–', '———')"
IMPUTED = ["Make", "Model", "Trim", "Body", "Color", "Interior", "Transmission", "Odometer", "ConditionValue"]


def case_band(expr: str, edges: list, labels: list[str], missing: str | None = None) -> str:
    arms = " ".join(f"WHEN {expr} <= {hi} THEN {text(label)}" for hi, label in zip(edges[1:], labels))
    return f"CASE WHEN {expr} <= {edges[0]} THEN {text(missing)} {arms} ELSE {text(missing)} END"


PRICE_BAND = case_band(
    "SellingPrice", [0, 5000, 10000, 15000, 20000, 30000, 50000, 999999],
    ["<$5k", "$5-10k", "$10-15k", "$15-20k", "$20-30k", "$30-50k", ">$50k"],
)
CONDITION_BAND = case_band("ConditionValue", [0, 10, 20, 30, 40, 50], ["1-10", "11-20", "21-30", "31-40", "41-50"])
SALARY_BAND = case_band(
    "Monthly_Salary", [0, 1000, 1500, 2000, 2500, 9999], ["<1K", "1K-1.5K", "1.5K-2K", "2K-2.5K", ">2.5K"], "nan"
)
LEVEL = (
    "CASE Job_Rate WHEN 1.0 THEN 'Junior' WHEN 2.0 THEN 'Mid' WHEN 3.0 THEN 'Senior' "
    "WHEN 4.5 THEN 'Lead' WHEN 5.0 THEN 'Principal' END"
)

SHIFT_KEEP = """
SELECT * EXCLUDE (sh) REPLACE (
  CASE WHEN sh THEN 'Sedan' ELSE Body END AS Body,
  CASE WHEN sh THEN VIN ELSE Transmission END AS Transmission,
  CASE WHEN sh THEN State ELSE VIN END AS VIN,
  CASE WHEN sh THEN NULL ELSE State END AS State)
FROM (SELECT *, coalesce(Transmission IN ('sedan', 'Sedan'), false) AS sh FROM {source})
"""


def features_sql(source: str) -> str:
    return f"""
SELECT *, SaleYear - Year AS VehicleAge, SellingPrice - MMR AS PriceDiff,
  (SellingPrice - MMR) / nullif(MMR, 0) * 100 AS PriceDiffPct,
  coalesce(SellingPrice - MMR > 0, false) AS AboveMMR, {PRICE_BAND} AS PriceBand
FROM (SELECT *, cast(year(SaleDate) AS int) AS SaleYear, strftime(SaleDate, '%Y-%m') AS SaleMonth,
        year(SaleDate) || 'Q' || quarter(SaleDate) AS SaleQuarter FROM {source})
"""


def prepared_sql(source: str) -> str:
    cased = ", ".join(f"{title(c)} AS {c}" for c in ["Make", "Model", "Body", "Color", "Interior", "State"])
    return features_sql(f"""(
  SELECT * REPLACE ({cased}, lower(trim(Transmission)) AS Transmission)
  FROM (SELECT * FROM {source} WHERE SaleDate IS NOT NULL AND SellingPrice IS NOT NULL AND MMR IS NOT NULL) d
  WHERE SellingPrice BETWEEN
    (SELECT quantile_cont(SellingPrice, 0.01) FROM {source}
     WHERE SaleDate IS NOT NULL AND SellingPrice IS NOT NULL AND MMR IS NOT NULL)
    AND (SELECT quantile_cont(SellingPrice, 0.99) FROM {source}
     WHERE SaleDate IS NOT NULL AND SellingPrice IS NOT NULL AND MMR IS NOT NULL))""")


def mode_sql(col: str) -> str:
    """Most frequent value per make and body, smallest on ties."""
    return f"""
SELECT Make, Body, {col} AS m FROM (
  SELECT Make, Body, {col}, row_number() OVER (PARTITION BY Make, Body ORDER BY count(*) DESC, {col}) AS r
  FROM c6 WHERE Make IS NOT NULL AND Body IS NOT NULL AND {col} IS NOT NULL GROUP BY Make, Body, {col}) WHERE r = 1"""


def top_value_sql(col: str, source: str) -> str:
    return f"SELECT {col} AS v FROM {source} WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1"


_plain = {n: n for n in ["lineitem", "orders", "part", "supplier", "customer"]}
_make_map = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in MAKE_ALIASES.items())
_model_map = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in MODEL_ALIASES.items())
_was = ", ".join(f"{c} IS NULL AS w_{c}" for c in IMPUTED)
_flag = " OR ".join(f"(w_{c} AND {c} IS NOT NULL)" for c in IMPUTED)
_cased = ", ".join(f"{title(c)} AS {c}" for c in ["Model", "Body", "Color", "Interior", "State", "Trim"])

# Named steps; each may use the ones before it.
CTES: dict[str, str] = {
    "sales": SALES.format(**_plain),
    "employees": EMPLOYEES.format(**_plain),
    "shifted": SHIFT_KEEP.format(source="sales"),
    "prepared": prepared_sql("shifted"),
    "replaced": "SELECT * REPLACE (CASE WHEN Transmission IN ('sedan', 'Sedan') THEN 'automatic' "
                "ELSE Transmission END AS Transmission) FROM sales",
    "mb": values([(k, *v) for k, v in MAKE_BODY.items()], "t", "raw, mb_make, mb_body"),
    "wmi": f"SELECT code, {title('make')} AS wmi_make, body AS wmi_body FROM ("
           + values([(k, *v) for k, v in PREFIXES.items()], "t", "code, make, body") + ")",
    "own": f"""SELECT code, r.m AS m, r.b AS b FROM (
        SELECT upper(substr(VIN, 1, 3)) AS code, min(struct_pack(m := {title('lower(Make)')}, b := Body)) AS r FROM sales
        WHERE VIN IS NOT NULL AND Make IS NOT NULL AND Body IS NOT NULL GROUP BY 1)""",
    "r1": r"""SELECT * REPLACE (regexp_replace(Make, ' (truck|tk)$', '', 'i') AS Make,
        CASE WHEN regexp_matches(Make, '(?i) (truck|tk)$') THEN 'Truck' ELSE Body END AS Body) FROM shifted""",
    "r2": rf"""SELECT * REPLACE (CASE lower(Make) {_make_map} ELSE Make END AS Make,
        CASE WHEN lower(Model) = 'range' THEN 'Range Rover' ELSE Model END AS Model,
        CASE WHEN lower(Model) = 'range' THEN trim(regexp_replace(Trim, '^rover\s*', '', 'i')) ELSE Trim END AS Trim)
      FROM r1""",
    "r3": f"""SELECT * REPLACE (CASE lower(Model) {_model_map} ELSE Model END AS Model) FROM r2""",
    "r4": "SELECT * REPLACE (nullif(Odometer, 999999) AS Odometer, " + ", ".join(
        f"CASE WHEN {c} IN {DASH_LIST} THEN NULL ELSE {c} END AS {c}"
        for c in ["Make", "Model", "Trim", "Body", "Transmission", "VIN", "State", "Color", "Interior", "Seller"]
    ) + ") FROM r3",
    "r5": SHIFT_KEEP.format(source="r4"),
    "repaired_prepared": prepared_sql("r5"),
    "c0": f"SELECT *, {_was} FROM sales",
    "c1": """SELECT * REPLACE (
        CASE WHEN h_shift THEN 'Sedan' ELSE Body END AS Body,
        CASE WHEN h_shift THEN VIN ELSE Transmission END AS Transmission,
        CASE WHEN h_shift THEN State ELSE VIN END AS VIN,
        CASE WHEN h_shift THEN NULL ELSE State END AS State,
        CASE WHEN h_shift THEN NULL ELSE ConditionValue END AS ConditionValue)
      FROM (SELECT *, coalesce(Transmission IN ('sedan', 'Sedan'), false) AS h_shift FROM c0)""",
    "c2": """SELECT * EXCLUDE (raw, mb_make, mb_body) REPLACE (coalesce(mb_make, Make) AS Make,
        CASE WHEN raw IS NOT NULL THEN mb_body ELSE Body END AS Body), raw IS NOT NULL AS h_split
      FROM c1 LEFT JOIN mb ON lower(Make) = raw""",
    "c3": """SELECT * REPLACE (CASE WHEN h_merge THEN 'Range Rover' ELSE Model END AS Model)
      FROM (SELECT *, coalesce((lower(Model) = 'range' AND contains(lower(Trim), 'rover'))
              OR lower(Model) = 'rangerover' OR Model IN ('rr', 'RR', 'rrs', 'RRS'), false) AS h_merge FROM c2)""",
    "c4": f"""SELECT * REPLACE ({title(f"CASE lower(Make) {_make_map} ELSE lower(Make) END")} AS Make, {_cased},
        CASE lower(trim(Transmission)) WHEN 'auto' THEN 'automatic' WHEN 'man' THEN 'manual'
             ELSE lower(trim(Transmission)) END AS Transmission),
        coalesce(lower(Make) IN ('vw', 'dot', 'mercedes-b', 'chev', 'chevy'), false) AS h_alias FROM c3""",
    "c5": f"""SELECT * REPLACE (
        CASE WHEN Odometer = 999999 THEN NULL ELSE Odometer END AS Odometer,
        CASE WHEN MMR = 999999 THEN NULL ELSE MMR END AS MMR,
        CASE WHEN trim(Color) IN {DASH_LIST} THEN NULL ELSE Color END AS Color,
        CASE WHEN trim(Interior) IN {DASH_LIST} THEN NULL ELSE Interior END AS Interior),
        coalesce(Odometer = 999999, false) AS h_odo, coalesce(MMR = 999999, false) AS h_mmr,
        coalesce(trim(Color) IN {DASH_LIST}, false) AS h_color,
        coalesce(trim(Interior) IN {DASH_LIST}, false) AS h_interior FROM c4""",
    "c6": """SELECT * EXCLUDE (code, wmi_make, wmi_body) REPLACE (coalesce(Make, wmi_make) AS Make,
        coalesce(Body, wmi_body) AS Body), wmi_make IS NOT NULL AS h_vin
      FROM c5 LEFT JOIN wmi ON Make IS NULL AND upper(substr(VIN, 1, 3)) = code""",
    "mc": mode_sql("Color"),
    "mi": mode_sql("Interior"),
    "c7": """SELECT c6.* REPLACE (coalesce(Color, mc.m) AS Color, coalesce(Interior, mi.m) AS Interior),
        Color IS NULL AS g_color, Interior IS NULL AS g_interior
      FROM c6 LEFT JOIN mc ON c6.Make = mc.Make AND c6.Body = mc.Body
              LEFT JOIN mi ON c6.Make = mi.Make AND c6.Body = mi.Body""",
    "oc": top_value_sql("Color", "c7"),
    "oi": top_value_sql("Interior", "c7"),
    "c8": """SELECT * REPLACE (coalesce(Color, (SELECT v FROM oc)) AS Color,
        coalesce(Interior, (SELECT v FROM oi)) AS Interior) FROM c7""",
    "marked": f"""SELECT *, ({_flag}) AS _flag_imputed, (Make IS NULL AND Model IS NULL AND Trim IS NULL
        AND Body IS NULL AND (VIN IS NULL OR trim(VIN) = '')) AS _flag_non_imputable FROM c8""",
    "cleaned": f"SELECT {', '.join(SALES_COLUMNS)}, _flag_imputed, _flag_non_imputable FROM marked",
    "cleaned_shifted": SHIFT_KEEP.format(source="cleaned"),
    "cleaned_prepared": prepared_sql("cleaned_shifted"),
    "dashboard": "SELECT * FROM cleaned_prepared WHERE Transmission = 'automatic' AND Year BETWEEN 1984 AND 1996 "
                 "AND (_flag_imputed OR NOT _flag_non_imputable)",
    "staff": f"""SELECT No, First_Name || ' ' || Last_Name AS Full_Name, First_Name, Last_Name, Gender, Start_Date,
        cast(round_even(date_diff('day', cast(Start_Date AS date), DATE '{TENURE_DATE}') / 365.25e0, 0) AS int)
          AS Tenure_Years, Department, Country, Center, Monthly_Salary, Annual_Salary,
        {SALARY_BAND} AS Salary_Band, Job_Rate, {LEVEL} AS Job_Level, Sick_Leaves, Unpaid_Leaves, Overtime_Hours,
        Sick_Leaves > 0 AS Has_Sick_Leave, Unpaid_Leaves > 0 AS Has_Unpaid_Leave, Overtime_Hours > 50 AS High_Overtime
      FROM (SELECT * REPLACE ({title('First_Name')} AS First_Name, {title('Last_Name')} AS Last_Name)
            FROM employees)""",
}

_NEEDS = {
    "sales": [], "employees": [], "shifted": ["sales"], "prepared": ["shifted"], "replaced": ["sales"], "mb": [],
    "wmi": [], "own": ["sales"], "r1": ["shifted"], "r2": ["r1"], "r3": ["r2"], "r4": ["r3"], "r5": ["r4"],
    "repaired_prepared": ["r5"], "c0": ["sales"], "c1": ["c0"], "c2": ["c1", "mb"], "c3": ["c2"], "c4": ["c3"], "c5": ["c4"],
    "c6": ["c5", "wmi"], "mc": ["c6"], "mi": ["c6"], "c7": ["c6", "mc", "mi"], "oc": ["c7"], "oi": ["c7"], "c8": ["c7", "oc", "oi"], "marked": ["c8"],
    "cleaned": ["marked"], "cleaned_shifted": ["cleaned"], "cleaned_prepared": ["cleaned_shifted"],
    "dashboard": ["cleaned_prepared"], "staff": ["employees"],
}


def with_steps(wanted: tuple[str, ...], body: str) -> str:
    """`body` preceded by the steps it needs."""
    needed: set[str] = set()

    def add(name: str) -> None:
        for other in _NEEDS[name]:
            add(other)
        needed.add(name)

    for name in wanted:
        add(name)
    steps = [f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed]
    return ("WITH " + ",\n".join(steps) + "\n" if steps else "") + body

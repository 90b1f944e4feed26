"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..operators import aggregate as agg
from ..plans.job import run as run_job
from ..plans.sales import DESCRIPTIONS, EXPORT_COLUMNS
from ..sources import bundle, files
from ..sources.staging import scratch_path
from .registry import query
from .views import Views

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

CUSTOMER = StructType(
    [
        StructField("c_custkey", LongType()), StructField("c_name", StringType()),
        StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
        StructField("c_mktsegment", StringType()),
    ]
)
_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity > 45", ())
def _(v: Views):
    df = files.read_table(v.spark, f"{v.folder}/lineitem.parquet")
    return df.where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("scan_csv", _CUSTOMER_SQL, ())
def _(v: Views):
    path = scratch_path(v.spark, "customer") + ".csv"
    files.write_csv(v.table("customer"), path)
    return files.read_csv(v.spark, path, CUSTOMER)


@query(
    "list_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS \"rows\", (SELECT count(*) FROM (DESCRIBE {t})) AS \"columns\" FROM {t}"
        for t in TABLES
    ),
    (),
)
def _(v: Views):
    return files.list_path_tables(v.spark, files.folder_tables(v.spark, v.folder))


@query("roundtrip_parquet", "SELECT * FROM sales")
def _(v: Views):
    path = scratch_path(v.spark, "sales")
    files.write_table(v.sales, path)
    return files.read_table(v.spark, path, v.sales.schema)


@query("roundtrip_csv", "SELECT * FROM staff", ("staff",))
def _(v: Views):
    path = scratch_path(v.spark, "staff") + ".csv"
    files.write_csv(v.staff, path)
    return files.read_csv(v.spark, path, v.staff.schema)


@query("write_auto", "SELECT SaleMonth, count(*) AS volume FROM prepared GROUP BY 1", ("prepared",))
def _(v: Views):
    months = v.prepared.groupBy("SaleMonth").agg(agg.n_rows().alias("volume"))
    path = scratch_path(v.spark, "months") + ".csv"
    files.write_auto(months, path)
    return files.read_auto(v.spark, path, months.schema)


@query(
    "export_bundle",
    """SELECT 'departments' AS "table", count(DISTINCT Department) AS "rows" FROM staff
       UNION ALL SELECT 'countries', count(DISTINCT Country) FROM staff
       UNION ALL SELECT 'staff', count(*) FROM staff""",
    ("staff",),
)
def _(v: Views):
    tables, folder = _bundle(v)
    return files.list_path_tables(v.spark, {t: f"{folder}/{t}" for t in tables}).select("table", "rows")


def _bundle(v: Views):
    """The tables of the bundle, and the folder they are exported to."""
    tables = {
        "staff": v.staff,
        "departments": agg.dept_summary(v.staff),
        "countries": agg.staff_summary(v.staff, "Country"),
    }
    folder = scratch_path(v.spark, "bundle")
    files.export_bundle(tables, folder)
    return tables, folder


@query("export_bundle_staff", "SELECT * FROM staff", ("staff",))
def _(v: Views):
    tables, folder = _bundle(v)
    return files.read_table(v.spark, f"{folder}/staff", tables["staff"].schema)


def _published(v: Views):
    """The tables of the bundle as a reader of its second version sees them."""
    folder = scratch_path(v.spark, "published")
    tables = {"departments": agg.dept_summary(v.staff), "countries": agg.staff_summary(v.staff, "Country"), "staff": v.staff}
    bundle.publish({n: df.limit(1) for n, df in tables.items()}, folder)
    bundle.publish(tables, folder)
    return bundle.read_bundle(v.spark, folder)


query(
    "publish_bundle_departments",
    """SELECT Department, count(No) AS Employees, round_even(avg(Monthly_Salary), 0) AS Avg_Monthly_Salary,
       sum(Annual_Salary) AS Total_Annual_Cost, round_even(avg(Overtime_Hours), 1) AS Avg_OT_Hours,
       count(*) FILTER (WHERE Has_Sick_Leave) AS Sick_Leave_Count,
       count(*) FILTER (WHERE High_Overtime) AS High_OT_Count FROM staff GROUP BY 1""",
    ("staff",), {"Total_Annual_Cost": 2},
)(lambda v: _published(v)["departments"])
query(
    "publish_bundle_countries",
    """SELECT Country, count(No) AS Employees, round_even(avg(Monthly_Salary), 0) AS Avg_Salary,
       round_even(avg(Overtime_Hours), 1) AS Avg_OT FROM staff GROUP BY 1""",
    ("staff",),
)(lambda v: _published(v)["countries"])
query("publish_bundle_staff", "SELECT * FROM staff", ("staff",))(lambda v: _published(v)["staff"])


_TYPES = {
    "Year": "Integer", "ConditionValue": "Decimal", "Odometer": "Decimal", "MMR": "Decimal",
    "SellingPrice": "Decimal", "SaleDate": "DateTime", "SaleYear": "Integer", "VehicleAge": "Integer",
    "PriceDiff": "Decimal", "PriceDiffPct": "Decimal", "AboveMMR": "Boolean",
}


@query(
    "data_dictionary",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{_TYPES.get(c, 'Text')}' AS type, "
        f"'{DESCRIPTIONS[c]}' AS description, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM prepared"
        for i, c in enumerate(EXPORT_COLUMNS)
    ),
    ("prepared",),
)
def _(v: Views):
    return files.data_dictionary(v.prepared.select(*EXPORT_COLUMNS), DESCRIPTIONS)


@query("job_entry", "SELECT * FROM cleaned", ("cleaned",))
def _(v: Views):
    source, target = scratch_path(v.spark, "raw"), scratch_path(v.spark, "cleaned")
    files.write_table(v.sales, source)
    run_job(v.spark, source, target)
    return files.read_table(v.spark, target)

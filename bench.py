"""Times the headline operators on one machine and prints one JSON line.

The sales table is derived from the given tables and written once, unmeasured, as the
published numbers also start from a finished table in Parquet. Every measured run reads
that table from disk. Each query runs once to warm up and then `BENCH_REPEATS` times;
the fastest run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tabclean.catalog.views import TENURE_DATE, Views  # noqa: E402
from tabclean.functions.text import normalise_enum, title_case  # noqa: E402
from tabclean.operators import aggregate as agg  # noqa: E402
from tabclean.operators import impute, repair, stats  # noqa: E402
from tabclean.operators.quantile import group_quantiles  # noqa: E402
from tabclean.plans import dashboard  # noqa: E402
from tabclean.plans import sales as plan  # noqa: E402
from tabclean.plans.employees import clean_employees  # noqa: E402
from tabclean.session import build_session  # noqa: E402
from tabclean.sources.staging import scratch_path  # noqa: E402


def run(df: DataFrame) -> None:
    """Compute every row and column without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "tabclean-bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus, spark__ui__showConsoleProgress="false",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_path(spark, "bench")
    views = Views(spark, folder)
    views.sales.repartition(int(cpus)).write.parquet(f"{base}/sales")
    views.employees.repartition(int(cpus)).write.parquet(f"{base}/employees")
    sales, staff = spark.read.parquet(f"{base}/sales"), spark.read.parquet(f"{base}/employees")
    plan.prepare_sales(sales).write.parquet(f"{base}/prepared")
    plan.before_imputation(sales).write.parquet(f"{base}/repaired")
    plan.clean_sales(sales).write.parquet(f"{base}/cleaned")
    cleaned = spark.read.parquet(f"{base}/cleaned")
    # Four values a row, and one row whose odometer lies far from all others.
    four = F.explode(F.array(*[F.col("SellingPrice") * x for x in (1.0, 1.37, 2.11, 3.59)]))
    sales.select("State", four.alias("v")).write.parquet(f"{base}/many")
    many = spark.read.parquet(f"{base}/many")
    prepared, repaired = spark.read.parquet(f"{base}/prepared"), spark.read.parquet(f"{base}/repaired")

    far = F.when(F.col("Odometer") == repaired.agg(F.max("Odometer")).first()[0], 1e9).otherwise(F.col("Odometer"))
    outlier = repaired.withColumn("Odometer", far)

    def standardise() -> DataFrame:
        cased = {c: title_case(c) for c in plan.TITLE_COLUMNS}
        return sales.withColumns(
            cased | {"Transmission": normalise_enum("Transmission", repair.TRANSMISSION_ALIASES)}
        )

    queries = {
        "parquet_load": lambda: sales,
        "realign_shift": lambda: repair.realign_shift(sales),
        "split_by_lookup": lambda: repair.split_by_lookup(sales),
        "merge_fragments": lambda: repair.merge_fragments(sales),
        "apply_aliases": lambda: repair.apply_aliases(sales, "Make", repair.MAKE_ALIASES),
        "standardise": standardise,
        "sentinel_to_null": lambda: plan.null_sentinels(sales),
        "impute_from_prefix": lambda: impute.impute_from_prefix(sales),
        "impute_conditional": lambda: impute.impute_conditional(repaired, "Color", plan.DRAW_KEYS),
        "impute_group_mode": lambda: impute.impute_group_mode(repaired, ["Color", "Interior"], plan.GROUP_KEYS),
        "impute_knn": lambda: impute.impute_knn(repaired, "Color"),
        "impute_knn_outlier": lambda: impute.impute_knn(outlier, "Color"),
        "clean_sales": lambda: plan.clean_sales(sales),
        "clean_sales_knn": lambda: plan.clean_sales(sales, plan.CleanConfig(strategy="knn+conditional")),
        "prepare_sales": lambda: plan.prepare_sales(sales),
        "sales_kpis": lambda: agg.sales_kpis(prepared),
        "monthly_summary": lambda: agg.monthly_summary(prepared),
        "make_summary": lambda: agg.make_summary(prepared),
        "pivot_heatmap": lambda: agg.heatmap(prepared),
        "box_stats": lambda: stats.box_stats(prepared, "Body", "SellingPrice", top=6),
        "corr_matrix": lambda: stats.corr_matrix(prepared, ["SellingPrice", "MMR", "Odometer", "Year"], "listwise"),
        "quantiles_over_2m": lambda: group_quantiles(many, ["State"], "v", [0.25, 0.5, 0.75], ["q25", "q50", "q75"]),
        "dashboard_kpis": lambda: dashboard.kpis(dashboard.dashboard_table(cleaned, ["clean", "imputed"])),
        "clean_employees": lambda: clean_employees(staff, TENURE_DATE),
    }
    only = sys.argv[1:]
    seconds = {}
    for name, build in queries.items():
        if only and name not in only:
            continue
        times = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            run(build())
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries, fastest run each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "rows": sales.count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

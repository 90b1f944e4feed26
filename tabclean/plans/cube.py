"""Reports under changing facets without reading the table again.

A cube holds counts, sums and price histograms for every combination of the facets and the
quality flags, and coarser sets of the same. A report with any facets chosen adds up cells
of the smallest set that has them. Medians stay exact: the histogram tells which price
buckets hold the middle ranks, and only the slices of the rows with these buckets are read.
Cells and rows of another delivery are added by `merge`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import is_above_market
from ..operators.filters import FLAG_IMPUTED, FLAG_NON_IMPUTABLE, facet_filter, quality_filter
from ..operators.impute import quality_label
from ..operators.quantile import bucketed, quantiles_from
from ..operators.repair import ensure_columns
from ..sources.staging import scratch_path, stage
from .sales import prepare_sales

FACETS = ["Make", "Body", "State", "Transmission", "Year"]
FLAGS = [FLAG_IMPUTED, FLAG_NON_IMPUTABLE]
#: Facets of the sets, smallest set first.
SETS = {"total": [], "market": ["Make", "Body"], "all": FACETS}
_FACET_OF = {"makes": "Make", "bodies": "Body", "states": "State", "transmissions": "Transmission", "years": "Year"}
_MEASURES = ["n", "priced", "odometer", "odometers", "above", "aboves", "age", "ages"]
#: Buckets of a slice of the rows.
_SLICE = 8


@dataclass(frozen=True)
class Cube:
    """Cells by set, and the rows that medians come from, in folders by slice of the price."""

    sets: dict[str, DataFrame]
    rows: DataFrame


def _added(cells: DataFrame, facets: list[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in _MEASURES]
    return cells.groupBy(*facets, *FLAGS, "__b").agg(*sums, F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))


def _sets(cells: DataFrame) -> dict[str, DataFrame]:
    """Every set from the finest, which is written first."""
    finest = stage(_added(cells, FACETS), "cells")
    return {name: finest if facets == FACETS else stage(_added(finest, facets), "cells") for name, facets in SETS.items()}


def _written(rows: DataFrame, path: str) -> DataFrame:
    """The rows in folders by slice; ranges of prices, so that a crowded slice has many files."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, "slice", "__x").write.partitionBy("slice").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def build(cleaned: DataFrame) -> Cube:
    """The cube of a cleaned sales table. A table without quality flags counts as clean."""
    prepared = ensure_columns(prepare_sales(cleaned), {FLAG_IMPUTED: False, FLAG_NON_IMPUTABLE: False})
    rows = bucketed(prepared.withColumn("__above", is_above_market().cast("double")), "SellingPrice")
    rows = stage(rows.select(*FACETS, *FLAGS, "Odometer", "VehicleAge", "__above", "__x", "__b"), "rows")
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0))
    cells = rows.groupBy(*FACETS, *FLAGS, "__b").agg(
        F.count(F.lit(1)).alias("n"), F.count("__x").alias("priced"), total("Odometer").alias("odometer"),
        F.count("Odometer").alias("odometers"), total("__above").alias("above"), F.count("__above").alias("aboves"),
        total("VehicleAge").alias("age"), F.count("VehicleAge").alias("ages"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi"),
    )
    narrow = rows.where("__b IS NOT NULL").select(*FACETS, *FLAGS, "__x", "__b", F.floor(F.col("__b") / _SLICE).alias("slice"))
    return Cube(_sets(cells), _written(narrow, scratch_path(rows.sparkSession, "slices")))


def merge(*cubes: Cube) -> Cube:
    """The cube of all their tables together; their rows are not written again."""
    cells = reduce(DataFrame.unionByName, [c.sets["all"] for c in cubes])
    return Cube(_sets(cells), reduce(DataFrame.unionByName, [c.rows for c in cubes]))


def save(cube: Cube, path: str) -> None:
    """Writes the cube below `path`, which must be new."""
    for name, cells in cube.sets.items():
        cells.write.parquet(f"{path}/{name}")
    _written(cube.rows, f"{path}/rows")


def load(spark: SparkSession, path: str) -> Cube:
    return Cube({name: spark.read.parquet(f"{path}/{name}") for name in SETS}, spark.read.parquet(f"{path}/rows"))


def cells_for(cube: Cube, dims: list[str], kinds: list[str] | None, facets: dict) -> DataFrame:
    """The chosen cells of the smallest set that has the facets in use and `dims`."""
    used = {_FACET_OF[f] for f, wanted in facets.items() if wanted} | set(dims)
    name = next(n for n, columns in SETS.items() if used <= set(columns))
    return quality_filter(facet_filter(cube.sets[name], **facets), kinds)


def _medians(
    cube: Cube, cells: DataFrame, keys: list[str], kinds: list[str] | None, facets: dict, label: bool = False
) -> DataFrame:
    """(keys, median) over the chosen rows of the groups in `cells`."""
    hist = cells.where("__b IS NOT NULL").groupBy(*keys, "__b").agg(
        F.sum("priced").alias("__n"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))

    def rows(wanted: DataFrame) -> DataFrame:
        # As many numbers as there are slices at most, a few hundred for any doubles of one sign.
        slices = [r[0] for r in wanted.select(F.floor(F.col("__b") / _SLICE)).distinct().collect()]
        chosen = quality_filter(facet_filter(cube.rows.where(F.col("slice").isin(slices)), **facets), kinds)
        return (quality_label(chosen) if label else chosen).select(*keys, "__x", "__b")

    return quantiles_from(stage(hist, "hist"), rows, keys, [0.5], ["median"])


def _top(cells: DataFrame, key: str, k: int) -> list[str]:
    """The k most frequent values, ties to the smallest."""
    counts = cells.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n").alias("n"))
    return [r[0] for r in counts.orderBy(F.desc("n"), key).limit(k).collect()]


def kpis(cube: Cube, kinds: list[str] | None = None, **facets) -> DataFrame:
    """As `aggregate.sales_kpis` of the chosen rows."""
    cells = cells_for(cube, [], kinds, facets)
    median = _medians(cube, cells, [], kinds, facets).first()[0]
    mean = lambda total, n: F.try_divide(F.sum(total), F.sum(n))
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"), mean("odometer", "odometers").alias("avg_odometer"),
        (mean("above", "aboves") * 100).alias("above_pct"), mean("age", "ages").alias("avg_age"),
    ).withColumn("median_price", F.lit(median).cast("double"))


def heatmap(cube: Cube, kinds: list[str] | None = None, n_rows: int = 8, n_cols: int = 6, scale: float = 1000.0, **facets) -> DataFrame:
    """As `aggregate.heatmap` of the chosen rows, in long form."""
    cells = cells_for(cube, ["Make", "Body"], kinds, facets)
    makes, bodies = _top(cells, "Make", n_rows), _top(cells, "Body", n_cols)
    cells = cells.where(F.col("Make").isin(makes) & F.col("Body").isin(bodies))
    medians = _medians(cube, cells, ["Make", "Body"], kinds, facets)
    seen = cells.select("Make", "Body").distinct()
    grid = seen.select("Make").distinct().crossJoin(F.broadcast(seen.select("Body").distinct()))
    return grid.join(medians, ["Make", "Body"], "left").select("Make", "Body", (F.coalesce("median", F.lit(0.0)) / scale).alias("value"))


def quality(cube: Cube, kinds: list[str] | None = None, k: int = 6, **facets) -> DataFrame:
    """As `aggregate.quality_median` of the chosen rows."""
    cells = cells_for(cube, ["Body"], kinds, facets)
    cells = quality_label(cells.where(F.col("Body").isin(_top(cells, "Body", k))))
    return _medians(cube, cells, ["Body", "DataQuality"], kinds, facets, label=True)

"""Reports from the cube equal those from the table, and read only the slices they need."""

import pytest
from pyspark.sql import functions as F

from tabclean.catalog.views import Views
from tabclean.operators.impute import quality_label
from tabclean.plans import cube as cubes
from tabclean.plans import dashboard
from tabclean.plans.sales import clean_sales

FOLDER = "/root/testdata/sf0.001"
CHOICES = [
    ({}, None), ({"makes": 2, "years": (1980, 2000)}, ["clean"]), ({"transmissions": ["manual"]}, ["imputed", "non_imputable"]),
    ({"states": ["No Such State"]}, None),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    return clean_sales(Views(spark, FOLDER).sales).cache()


@pytest.fixture(scope="module")
def cube(cleaned):
    return cubes.build(cleaned)


def rows(df):
    number = lambda x: round(x, 6) if isinstance(x, float) else x
    return sorted((tuple(number(x) for x in r) for r in df.collect()), key=repr)


def same(cube, table, kinds, facets):
    assert rows(cubes.kpis(cube, kinds, **facets)) == rows(dashboard.kpis(table).select(cubes.kpis(cube, kinds, **facets).columns))
    assert rows(cubes.heatmap(cube, kinds, **facets)) == rows(dashboard.heatmap(table).select("Make", "Body", "value"))
    assert rows(cubes.quality(cube, kinds, **facets)) == rows(dashboard.quality(table).select("Body", "DataQuality", "median"))


@pytest.mark.parametrize("facets, kinds", CHOICES)
def test_reports(cube, cleaned, facets, kinds):
    if "makes" in facets:  # the most frequent ones
        counts = cleaned.where("Make IS NOT NULL").groupBy("Make").count().orderBy(F.desc("count"), "Make")
        facets = {**facets, "makes": [r[0] for r in counts.limit(facets["makes"]).collect()]}
        assert cubes.kpis(cube, kinds, **facets).first()["records"] > 0
    same(cube, dashboard.dashboard_table(cleaned, kinds, **facets), kinds, facets)


def test_smallest_set_and_slices(cube):
    total, market, every = (cubes.cells_for(cube, d, None, f) for d, f in (([], {}), (["Body"], {"makes": ["x"]}), ([], {"states": ["x"]})))
    assert "Make" not in total.columns and "State" not in market.columns and "State" in every.columns
    asked = []
    pruned = cubes.Cube(cube.sets, Recorded(cube.rows, asked))
    cubes.kpis(pruned).collect()
    slices = cube.rows.select("slice").distinct().count()
    plan = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert asked[0].select("slice").distinct().count() <= 2 < slices and "PartitionFilters: [slice" in plan.replace("isnotnull(slice", "slice")


class Recorded:
    """A table that notes what is asked of it."""

    def __init__(self, df, asked):
        self.df, self.asked = df, asked

    def where(self, test):
        self.asked.append(self.df.where(test))
        return self.asked[-1]


def test_two_deliveries(spark, cleaned, cube, tmp_path):
    """Price limits are part of preparing a table, so the deliveries are prepared ones of one table."""
    first = F.pmod(F.xxhash64("Id"), F.lit(2)) == 0
    whole = cubes.merge(cubes.build(cleaned.where(first)), cubes.build(cleaned.where(~first)))
    cubes.save(whole, f"{tmp_path}/cube")
    again = cubes.load(spark, f"{tmp_path}/cube")
    parts = [dashboard.dashboard_table(cleaned.where(t)) for t in (first, ~first)]
    same(again, parts[0].unionByName(parts[1]), None, {})
    assert quality_label(again.rows).count() == whole.rows.count()

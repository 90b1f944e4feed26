"""Literal rows per operator, and properties that must hold on any data."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabclean.functions import numeric, text
from tabclean.operators import aggregate, features, filters, impute, joins, profile, repair, stats, validate
from tabclean.plans.sales import CleanConfig, clean_sales, prepare_sales
from tabclean.sources import files, jdbc
from tabclean.catalog.views import Views

FOLDER = "/root/testdata/sf0.001"


def values(df):
    return [tuple(r) for r in df.collect()]


def one(spark, kind, value, expr):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr("v")).first()[0]


@pytest.fixture(scope="module")
def sales(spark):
    return Views(spark, FOLDER).sales.cache()


# --- expressions --------------------------------------------------------------------


@pytest.mark.parametrize(
    "raw",
    ["mercedes-benz", " o'brien", "SUV", "2wd cab", "rover  sport", "élan-école", "a\tb c", "x1y", "--—", "", "  ",
     "ma2B c.d", "lx-12", "brand#12", "—", " two words ", "ÀB éC", "a--b", "-x", "'quoted' word", None],
)
def test_title_case(spark, raw):
    assert one(spark, "string", raw, text.title_case) == (None if raw is None else raw.strip().title())


def test_title_case_random(spark):
    rng = random.Random(3)
    raw = ["".join(rng.choice("abXY é-'#1 \t.") for _ in range(rng.randint(0, 9))) for _ in range(500)]
    df = spark.createDataFrame([(r,) for r in raw], "v string").select("v", text.title_case("v"))
    assert [r for r in df.collect() if r[1] != r[0].strip().title()] == []


@pytest.mark.parametrize(
    "price, band",
    [(0, None), (-1, None), (5000, "<$5k"), (5000.01, "$5-10k"), (999999, ">$50k"), (1e6, None), (None, None)],
)
def test_price_band(spark, price, band):
    value = None if price is None else float(price)
    assert one(spark, "double", value, features.price_band) == band


def test_salary_outside_is_text(spark):
    assert one(spark, "double", 10000.0, features.salary_band) == "nan"
    assert one(spark, "double", None, features.salary_band) == "nan"


@pytest.mark.parametrize("start, years", [("2016-07-02", 5), ("2020-07-02", 1), ("2021-01-01", 0), (None, None)])
def test_tenure(spark, start, years):
    assert one(spark, "string", start, lambda c: numeric.tenure_years(F.to_date(c), "2021-01-01")) == years


def test_numbers(spark):
    assert one(spark, "string", "12.5", numeric.to_number) == 12.5
    assert one(spark, "string", "x", numeric.to_number) is None
    assert one(spark, "string", "NaN", numeric.to_number) is None
    assert one(spark, "string", "no date", numeric.to_ts) is None
    assert one(spark, "int", None, lambda c: numeric.clip_upper(c, 5)) is None
    assert one(spark, "int", 9, lambda c: numeric.clip_upper(c, 5)) == 5
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "string", "x", numeric.cast_int)


def test_formats(spark):
    assert one(spark, "double", 1234567.5, text.fmt_money) == "$1,234,568"
    assert one(spark, "double", 12.25, text.fmt_pct) == "12.2%"
    assert one(spark, "double", None, text.fmt_pct) == "—"
    assert one(spark, "bigint", None, text.fmt_int) == "—"


def test_full_name_and_price_diff(spark):
    df = spark.createDataFrame([("Ada", None), ("Ada", "Lo")], "a string, b string")
    assert [r[0] for r in df.select(text.full_name("a", "b")).collect()] == [None, "Ada Lo"]
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (6.0, 4.0)], "SellingPrice double, MMR double")
    assert [r.PriceDiffPct for r in features.add_price_diff(df).collect()] == [None, None, 50.0]


def test_map_values_quotes(spark):
    assert one(spark, "string", "a'b", lambda c: text.map_values(c, {"a'b": "c\\d"})) == "c\\d"
    assert one(spark, "string", "z", lambda c: text.map_values(c, {"a": "b"})) == "z"
    assert one(spark, "string", "z", lambda c: text.map_values(c, {"a": "b"}, keep_others=False)) is None


# --- repair -------------------------------------------------------------------------


def test_realign(spark):
    schema = "Body string, Transmission string, VIN string, State string, ConditionValue double"
    rows = [("Navitgation", "Sedan", "automatic", "3vwd17aj0", 5.0), ("Navitgation", "sedan", None, "3vw", 5.0),
            ("Suv", None, "v", "ca", 1.0)]
    df = spark.createDataFrame(rows, schema)
    assert values(repair.realign_shift(df)) == [
        ("Sedan", "automatic", "3vwd17aj0", None, None), ("Sedan", None, "3vw", None, None),
        ("Suv", None, "v", "ca", 1.0)]
    assert values(repair.realign_shift_keep(df))[0] == ("Sedan", "automatic", "3vwd17aj0", None, 5.0)


def test_split_and_merge(spark):
    df = spark.createDataFrame([("GMC Truck", None), ("Ford TK", "x"), (None, "y"), ("Kia", "z")], "Make string, Body string")
    assert values(repair.split_by_lookup(df)) == [("GMC", "Truck"), ("Ford", "Truck"), (None, "y"), ("Kia", "z")]
    assert values(repair.split_by_regex(df)) == [("GMC", "Truck"), ("Ford", "Truck"), (None, "y"), ("Kia", "z")]
    df = spark.createDataFrame(
        [("range", "rover sport"), ("range", None), ("rrs", "x"), ("RangeRover", None), ("Rr", None)], "Model string, Trim string")
    assert [r.Model for r in repair.merge_fragments(df).collect()] == ["Range Rover", "range", "Range Rover", "Range Rover", "Rr"]
    df = spark.createDataFrame([("range", "rover sport"), ("Range", "rover")], "Model string, Trim string")
    assert values(repair.merge_fragments_trim(df)) == [("Range Rover", "sport"), ("Range Rover", "")]


def test_alias_needs_prefix(spark):
    df = spark.createDataFrame([("vw", "3VWx"), ("vw", "1FTx"), ("vw", None), ("Kia", "3VWx")], "Make string, VIN string")
    out = repair.apply_aliases_validated(df, impute.prefix_dimension(spark), mark="hit")
    assert sorted(values(out.select("Make", "hit"))) == [("Kia", False), ("Volkswagen", True), ("vw", False), ("vw", False)]


def test_sentinels(spark):
    df = spark.createDataFrame([("—",), ("–",), ("———",), (" --- ",), ("-",), (None,)], "c string")
    assert [r[0] for r in repair.sentinel_to_null(df, {"c": repair.DASHES}).collect()] == [None] * 4 + ["-", None]
    df = spark.createDataFrame([(999999.0,), (1.0,), (None,)], "c double")
    assert [r[0] for r in repair.sentinel_to_null(df, {"c": [999999]}).collect()] == [None, 1.0, None]


def test_repairs_are_idempotent(spark, sales):
    for fix in (repair.realign_shift, repair.split_by_lookup, repair.merge_fragments):
        once = fix(sales)
        assert once.exceptAll(fix(once)).count() == 0


# --- imputation ---------------------------------------------------------------------


def test_prefix(spark):
    df = spark.createDataFrame(
        [(None, "1ftx", None), (None, "zzz1", None), ("Kia", "1ft", None), (None, None, None)], "Make string, VIN string, Body string")
    assert values(impute.impute_from_prefix(df).select("Make", "Body")) == [
        ("Ford", "Truck"), (None, None), ("Kia", None), (None, None)]


def test_prefix_keys_of_other_lengths_are_dropped(spark):
    dim = impute.prefix_dimension(spark, {"JK": ("Kawasaki", None), "5XYP": ("Hyundai", None), "SAR": ("Rover", None)})
    assert [r.code for r in dim.collect()] == ["SAR"]


def test_group_mode(spark):
    rows = [("a", "x", "red"), ("a", "x", "blue"), ("a", "x", None), ("b", "x", None), (None, "x", None), ("c", "x", "red"),
            ("c", "x", "red")]
    df = spark.createDataFrame(rows, "m string, b string, c string")
    out = values(impute.impute_group_mode(df, ["c"], ["m", "b"]).select("m", "c"))
    # Tie in group a goes to blue; the rest gets the mode of the filled column (red 3, blue 2).
    assert sorted(out, key=str) == sorted(
        [("a", "red"), ("a", "blue"), ("a", "blue"), ("b", "red"), (None, "red"), ("c", "red"), ("c", "red")], key=str)


def test_conditional(spark):
    rows = [(i, "a", "r" if i % 4 else "g") for i in range(4000)] + [(10**6 + 17 * i, "a", None) for i in range(4000)]
    rows += [(-5, "only", "w"), (-6, "only", None), (-7, "unseen", None)]
    df = spark.createDataFrame(rows, "Id bigint, k string, c string")
    out = impute.impute_conditional(df, "c", ["k"])
    got = dict(values(out.select("Id", "c")))
    assert len(got) == out.count() == len(rows)
    assert got[-6] == "w" and got[-7] is None
    drawn = [got[10**6 + 17 * i] for i in range(4000)]
    assert abs(drawn.count("g") / 4000 - 0.25) < 0.03
    again = dict(values(impute.impute_conditional(df.repartition(3), "c", ["k"]).select("Id", "c")))
    assert again == got
    other = dict(values(impute.impute_conditional(df, "c", ["k"], seed=7).select("Id", "c")))
    assert other != got


def brute_force_knn(rows, k):
    """rows: (id, year, odo, label or None); features without categories."""
    train = [r for r in rows if r[3] is not None]
    out = {}
    for i, y, o, label in rows:
        if label is not None:
            out[i] = label
            continue
        near = sorted((math.sqrt((y - t[1]) ** 2 + (o - t[2]) ** 2), t[0], t[3]) for t in train)[:k]
        exact = any(d == 0 for d, _, _ in near)
        votes = {}
        for d, _, name in near:
            votes[name] = votes.get(name, 0.0) + ((1.0 if d == 0 else 0.0) if exact else 1.0 / d)
        out[i] = min(votes, key=lambda n: (-votes[n], n))
    return out


@pytest.mark.parametrize("shape", ["even", "hot", "gaps"])
def test_knn_against_brute_force(spark, shape):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        odo = {"even": rng.uniform(0, 1e5), "hot": 500.0 if rng.random() < 0.4 else rng.uniform(0, 1e5),
               "gaps": rng.choice([0, 4e4, 9e4]) + rng.random() * (1 if i % 2 else 3000)}[shape]
        rows.append((i, 2000 + rng.randint(0, 9), float(round(odo, 1)), rng.choice(["b", "g", "w"]) if i % 3 else None))
    df = spark.createDataFrame(rows, "Id bigint, Year int, Odometer double, c string").repartition(4)
    got = dict(values(impute.impute_knn(df, "c", categorical=[]).select("Id", "c")))
    assert got == brute_force_knn(rows, 5)


def test_knn_blocks_and_ties(spark):
    rows = [(1, 2000, 10.0, "a", "z"), (2, 2000, 10.0, "b", "y"), (3, 2000, 10.0, "a", None), (4, 2000, 10.0, "c", None)]
    df = spark.createDataFrame(rows, "Id bigint, Year int, Odometer double, m string, c string")
    got = dict(values(impute.impute_knn(df, "c", categorical=[], block_on=["m"]).select("Id", "c")))
    assert got[3] == "z" and got[4] is None
    got = dict(values(impute.impute_knn(df, "c", categorical=[]).select("Id", "c")))
    assert got[3] == got[4] == "y"


def test_flags(spark, sales):
    raw, late = clean_sales(sales), clean_sales(sales, CleanConfig(baseline="post_sentinel"))
    assert raw.where("_flag_imputed").count() < late.where("_flag_imputed").count()
    df = spark.createDataFrame([(None, None, None, None, " "), (None, None, None, None, "v")],
                               "Make string, Model string, Trim string, Body string, VIN string")
    assert [r[0] for r in impute.flag_non_imputable(df).select("_flag_non_imputable").collect()] == [True, False]


def test_imputation_changes_no_value(spark, sales):
    before = sales.select("Id", "Color", "Interior", "Make", "Body").dropDuplicates(["Id"])
    after = impute.impute_group_mode(before, ["Color", "Interior"], ["Make", "Body"])
    joined = before.alias("b").join(after.alias("a"), "Id")
    assert joined.where("b.Color IS NOT NULL AND NOT (a.Color <=> b.Color)").count() == 0
    assert after.where("Color IS NULL OR Interior IS NULL").count() == 0


def test_labels(spark):
    df = spark.createDataFrame([(c,) for c in ["d", "a", None, "c", "a", "b", "e", "f", "g"]], "v string").repartition(4)
    got = dict(values(impute.label_encode(df, "v")))
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "f": 5, "g": 6, None: None}


# --- joins, filters, reports --------------------------------------------------------


def test_salted_join_gives_the_same(spark):
    fact = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE id % 50 END AS k")
    dim = spark.range(40).selectExpr("id AS k", "id * 10 AS v")
    small = joins.lookup_join(fact, dim, ["k"])
    salted = joins.lookup_join(fact, dim, ["k"], max_broadcast_bytes=0, salts=5)
    assert salted.columns == small.columns
    assert sorted(values(small), key=str) == sorted(values(salted), key=str)
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 50, 1999, 2000, 5000])
def test_sample_size_and_partitioning(spark, n):
    df = spark.range(2000).selectExpr("id * 31 AS Id")
    got = sorted(r[0] for r in filters.sample_n(df.repartition(8), n, "Id").collect())
    assert len(got) == min(n, 2000)
    assert got == sorted(r[0] for r in filters.sample_n(df.coalesce(1), n, "Id").collect())


def test_facets(spark, sales):
    assert filters.facet_filter(sales, [], [], [], [], (0, 9999)).count() == sales.where("Year IS NOT NULL").count()
    some = filters.facet_filter(sales, bodies=["SMALL"])
    assert some.where("Body IS NULL").count() == 0 and some.count() > 0
    cleaned = clean_sales(sales)
    assert filters.quality_filter(cleaned, []).count() == cleaned.count()


def test_kpis_of_nothing(spark, sales):
    row = aggregate.sales_kpis(prepare_sales(sales).where("1 = 0")).first().asDict()
    assert row.pop("records") == 0 and set(row.values()) == {None}


def test_reindex_keeps_order(spark):
    df = spark.createDataFrame([("b",), ("b",), ("x",)], "c string")
    assert values(aggregate.reindex_counts(df, "c", ["a", "b"]).select("c", "count")) == [("a", None), ("b", 2)]


def test_wide_heatmap(spark, sales):
    wide = aggregate.heatmap(prepare_sales(sales), wide=True)
    assert len(wide.columns) <= 7 and wide.count() <= 8


def test_vin(spark):
    df = spark.createDataFrame([("5xyktca69fg566472",), ("5xyktca69fg56647o",), ("5xyktca69fg56647",), (None,)], "VIN string")
    assert [r[0] for r in df.select(validate.check_regex("VIN")).collect()] == [True, False, False, False]


def test_cut_covers_every_value_once(spark):
    df = spark.range(0, 60).selectExpr("cast(id AS double) AS x")
    counts = aggregate.value_counts(df.withColumn("b", features.condition_band("x")), "b")
    assert sum(r["count"] for r in counts.collect()) == 50


def test_histogram_counts_all(spark, sales):
    assert sum(r["count"] for r in stats.histogram(sales, "SellingPrice", 80).collect()) == sales.where(
        "SellingPrice IS NOT NULL").count()


def test_duplicates_and_missing(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "—")], "a int, b string")
    assert profile.duplicate_count(df).first()[0] == 1
    assert profile.total_missing(df).first()[0] == 2
    assert profile.count_placeholders(df, ["—"]).first()[0] == 1


# --- sources ------------------------------------------------------------------------


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1.5), ("two\nlines", None), (None, 2.0), ('q"q', -0.5)], "s string, x double")
    files.write_csv(df, str(tmp_path / "t.csv"))
    assert sorted(values(files.read_csv(spark, str(tmp_path / "t.csv"), df.schema, multi_line=True)), key=str) == sorted(values(df), key=str)


def test_jdbc_options():
    part = jdbc.Partition("Id", 0, 100, 4)
    options = jdbc.jdbc_options("jdbc:x:y", "some_table", partition=part)
    assert options["dbtable"] == "some_table" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x:y", "a", "b")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x:y", query="q", partition=part)


def test_filters_reach_the_scan(spark):
    df = Views(spark, FOLDER).table("lineitem").where("l_quantity > 45").select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,45.0)" in plan and "l_extendedprice" not in plan


def test_cleaning_before_imputation_does_not_shuffle(spark, tmp_path, sales):
    from tabclean.plans.sales import before_imputation

    files.write_table(sales, str(tmp_path / "s"))
    plan = before_imputation(files.read_table(spark, str(tmp_path / "s")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


# --- draws, samples, lookups and neighbours under skew ---------------------------------


def test_columns_are_drawn_independently(spark):
    rows = [(f"a{i}", "k", "rb"[i % 2], "xy"[i % 2]) for i in range(400)] + [(f"key {i}", "k", None, None) for i in range(6000)]
    df = spark.createDataFrame(rows, "Id string, k string, c string, d string")
    for c in ("c", "d"):
        df = impute.impute_conditional(df, c, ["k"])
    got = values(df.where("Id LIKE 'key%'").groupBy("c", "d").count())
    assert len(got) == 4 and all(abs(n / 6000 - 0.25) < 0.03 for _, _, n in got)


def test_rare_values_are_drawn_from_whole_numbers(spark):
    df = spark.range(200_000).selectExpr("id AS Id", "'k' AS k", "CASE WHEN id >= 100000 THEN NULL WHEN id = 7 THEN 'rare' ELSE 'usual' END AS c")
    out = impute.impute_conditional(df, "c", ["k"])
    assert out.where("c IS NULL").count() == 0


def test_sample_is_spread_evenly(spark):
    got = [r[0] for r in filters.sample_n(spark.range(200_000).selectExpr("id AS Id"), 2000, "Id").collect()]
    tenths = [sum(i // 20_000 == t for i in got) for t in range(10)]
    assert len(got) == len(set(got)) == 2000 and min(tenths) > 140 and max(tenths) < 260
    assert len({i % 97 for i in got}) == 97


@pytest.mark.parametrize("n", [3, 50, 190, 200, 300])
def test_sample_with_null_and_text_keys(spark, n):
    df = spark.range(200).selectExpr("CASE WHEN id < 5 THEN NULL ELSE concat('key ', id) END AS Id")
    assert filters.sample_n(df, n, "Id").count() == min(n, 200)


@pytest.mark.parametrize("n", [1, 40, 100, 101, 160, 300])
def test_sample_cuts_among_equal_keys(spark, n):
    df = spark.range(300).selectExpr("CASE WHEN id < 100 THEN NULL WHEN id < 200 THEN 'same' ELSE concat('k', id) END AS Id", "id AS x")
    out = filters.sample_n(df, n, "Id")
    assert out.count() == n == out.select("x").distinct().count()
    drawn = df.withColumn("d", numeric.draw("Id", "sample", 42)).orderBy("d", "Id").limit(n)
    assert sorted(values(out.select("Id")), key=str) == sorted(values(drawn.select("Id")), key=str)


def test_repeated_rows_by_fingerprint(spark, monkeypatch):
    nan = float("nan")
    rows = [(1, "a", nan), (1, "a", nan), (1, "a", 0.0), (1, "a", -0.0), (1, None, 2.0), (1, None, 2.0), (None, "1", 2.0), (2, "", None), (3, "b", 1.0)]
    rows += [(i, "x" * 200, float(i)) for i in range(10, 2000)]
    df = spark.createDataFrame(rows, "i int, __a string, `x.y` double")
    want = sorted(map(repr, values(df.dropDuplicates())))
    alone, again = filters.split_repeated(df)
    assert again.count() == 6 and alone.count() == len(rows) - 6
    # Rows without an equal are not shuffled.
    assert "hashpartitioning" not in alone._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, values(filters.drop_duplicates(df)))) == want
    assert values(profile.duplicate_count(df)) == [(3,)]
    monkeypatch.setattr(filters, "bounded", lambda table: False)
    assert sorted(map(repr, values(filters.drop_duplicates(df)))) == want and values(profile.duplicate_count(df)) == [(3,)]
    assert values(profile.duplicate_count(df.limit(0))) == [(0,)] and filters.drop_duplicates(df.limit(0)).count() == 0


def test_lookup_tables_with_repeated_keys(spark):
    df = spark.createDataFrame([(1, "VW", None, "3VWa"), (2, "kia", None, "zzz1"), (3, None, None, "3vwb")], "Id int, Make string, Body string, VIN string")
    table = spark.createDataFrame([("vw", "Volkswagen", "Wagon"), ("VW", "Volkswagen", "Sedan"), ("Kia", "Kia", None)], "raw string, make string, body string")
    out = repair.split_by_lookup(df, table=table)
    assert sorted(values(out.select("Id", "Make", "Body")), key=str) == [(1, "Volkswagen", "Sedan"), (2, "Kia", None), (3, None, None)]
    out = repair.apply_aliases(df, "Make", table.select("raw", "make"))
    assert sorted(values(out.select("Id", "Make")), key=str) == [(1, "Volkswagen"), (2, "Kia"), (3, None)]
    codes = spark.createDataFrame([("3vw", "volkswagen", "Sedan"), ("3VW", "volkswagen", "Van"), ("3vwb", "no", "no")], "code string, make string, body string")
    assert sorted(values(impute.impute_from_prefix(df, codes).where("Id = 3").select("Make", "Body"))) == [("Volkswagen", "Sedan")]
    named = codes.selectExpr("code", "'Volkswagen' AS make", "body")
    assert values(repair.apply_aliases_validated(df, named).where("Id = 1").select("Make")) == [("Volkswagen",)]


@pytest.mark.parametrize("case", ["outlier", "ties"])
def test_knn_under_skew(spark, case):
    rng = np.random.default_rng(5)
    odometer = rng.integers(0, 40_000, 1500) * 2
    if case == "outlier":
        odometer[7] = 10**9
    else:
        odometer[:600] = 5000
    rows = [(i, int(rng.integers(1990, 2015)), float(odometer[i]), None if i % 4 == 0 else "abc"[rng.integers(3)]) for i in range(1500)]
    df = spark.createDataFrame(rows, "Id int, Year int, Odometer double, c string")
    got = dict(values(impute.impute_knn(df, "c", categorical=[]).select("Id", "c")))
    assert got == brute_force_knn(rows, 5)


def test_knn_meets_few_rows_under_ties(spark):
    """Two fifths of the sample share a value of the widest feature; the other features tell them apart."""
    rng = np.random.default_rng(6)
    n = 20_000
    odometer = np.where(rng.random(n) < 0.4, 5000, rng.integers(0, 200_000, n))
    feats = ["f0", "f1", "f2"]
    odometer[:3000] = 9000
    rows = [(i, "x", float(odometer[i]), float(rng.integers(0, 400)), float(rng.integers(0, 300))) for i in range(n)]
    train = spark.createDataFrame(rows, "__id int, __label string, __tf0 double, __tf1 double, __tf2 double")
    asked = [(i, [5000.0, 5001.5, 8999.0, 9000.5, float(rng.integers(0, 200_000))][i % 5], float(rng.integers(0, 400)), float(rng.integers(0, 300))) for i in range(200)]
    ask = spark.createDataFrame(asked, "__q int, f0 double, f1 double, f2 double")
    met = dict(values(impute._candidates(ask, train, feats, [], 5).groupBy("__q").count()))
    assert len(met) == 200 and max(met.values()) <= 2000 and sum(met.values()) / 200 <= 600
    points = np.array([r[2:] for r in rows])
    found = {}
    for q, i, d in values(impute._nearest(ask, train, feats, [], 5).select("__q", "__id", "__d")):
        found.setdefault(q, []).append((d, i))
    for q, *x in asked:
        d = np.sqrt(((points - np.array(x)) ** 2).sum(axis=1))
        assert [i for _, i in sorted(found[q])] == np.lexsort((np.arange(n), d))[:5].tolist()


def test_keys_of_the_sales_view_stay_apart(spark):
    from tabclean.catalog.views import SALES

    names = {"lineitem": "li", "orders": "od", "part": "pt", "supplier": "sp"}
    line = "CAST({} AS BIGINT) AS l_orderkey, {} AS l_partkey, 7L AS l_suppkey, 1 AS l_linenumber, 1D AS l_quantity, 1D AS l_extendedprice, 0D AS l_discount, 'A' AS l_returnflag, 'F' AS l_linestatus, timestamp_ntz'2000-01-01' AS l_shipdate"
    keys = [(10**12 + 2, 3), (10**12 + 3, 3), (10**12 + 2, 10**9)]
    spark.sql(" UNION ALL ".join("SELECT " + line.format(*k) for k in keys)).createOrReplaceTempView("li")
    spark.sql("SELECT DISTINCT l_orderkey AS o_orderkey, timestamp_ntz'2000-01-01' AS o_orderdate FROM li").createOrReplaceTempView("od")
    spark.sql("SELECT DISTINCT l_partkey AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size FROM li").createOrReplaceTempView("pt")
    spark.sql("SELECT 7L AS s_suppkey, 's' AS s_name, 1 AS s_nationkey").createOrReplaceTempView("sp")
    got = values(spark.sql(SALES.format(**names)).select("Id", "VIN"))
    assert len({r[0] for r in got}) == 3 and len({r[1] for r in got}) == 3

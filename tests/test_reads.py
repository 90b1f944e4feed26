"""What is read once is not computed again, and a search in batches finds what joins find."""

import time

import numpy as np
from pyspark.sql import functions as F

from tabclean.operators import filters, impute, quantile
from tabclean.operators.joins import keys_present
from tabclean.plans import sales as plan
from tabclean.sources import staging

FEATS = ["f0", "f1"]


def test_knn_search_of_a_small_sample_has_no_join(spark):
    rng = np.random.default_rng(8)
    rows = [(f"k{i}", "xyz"[i % 3], float(rng.integers(0, 60)), float(rng.integers(0, 9)), None if i % 50 == 0 else "ab"[i % 2]) for i in range(900)]
    rows += [("alone", "x", 5.0, 5.0, "c")]
    train = spark.createDataFrame(rows, "__id string, __label string, __tf0 double, __tf1 double, __t_b string")
    asked = [(i, float(rng.integers(-5, 70)), float(rng.integers(0, 9)), "abcd"[i % 4]) for i in range(300)]
    ask = spark.createDataFrame(asked, "__q bigint, f0 double, f1 double, b string")
    pairs = impute._candidates(ask, train, FEATS, ["b"], 5, nearest_only=True)
    assert "Join" not in pairs._jdf.queryExecution().executedPlan().toString()
    cells = impute._cut_into_cells(train.where(keys_present(["__t_b"])), FEATS, ["b"], 5)
    joined = impute._joined_candidates(ask, cells, FEATS, ["b"], 5).where("__d <= __reach")
    want = {}
    for q, d, i in sorted((r["__q"], r["__d"], r["__id"]) for r in joined.collect()):
        if len(want.setdefault(q, [])) < 5:
            want[q].append((d, i))
    got = {}
    for r in impute._nearest(ask, train, FEATS, ["b"], 5).collect():
        got.setdefault(r["__q"], []).append((r["__d"], r["__id"]))
    assert {q: sorted(near) for q, near in got.items()} == want


def sales_rows(spark):
    days = F.expr("timestamp_ntz'2014-01-01 00:00:00' + make_dt_interval(cast(id % 90 AS int))")
    return spark.range(500).select(
        F.col("id").alias("Id"), F.lit(2010).alias("Year"), F.expr("if(id % 9 = 0, null, 'ford')").alias("Make"), F.lit("f").alias("Model"),
        F.lit("t").alias("Trim"), F.lit("SUV").alias("Body"), F.lit("automatic").alias("Transmission"), F.lit("v").alias("VIN"),
        F.lit("ca").alias("State"), F.lit(3.0).alias("ConditionValue"), F.col("id").cast("double").alias("Odometer"), F.lit("red").alias("Color"),
        F.lit("tan").alias("Interior"), F.lit("s").alias("Seller"), F.expr("if(id % 7 = 0, null, cast(id * 3 AS double))").alias("MMR"),
        (F.col("id") * 2.5).alias("SellingPrice"), days.alias("SaleDate"),
    )


def test_prepared_columns_are_written_once(spark):
    columns = ["SaleMonth", "Id", "Make", "AboveMMR"]
    narrow = plan.prepare_sales(sales_rows(spark), columns=columns)
    assert narrow.columns == columns and all("/prepared-" in f for f in narrow.inputFiles()) and narrow.inputFiles()
    whole = plan.prepare_sales(sales_rows(spark)).select(*columns)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.collect())) and narrow.count() > 400


def test_quantile_reads_its_source_once(spark, tmp_path):
    spark.range(1000).withColumn("k", F.col("id") % 3).write.parquet(str(tmp_path / "t"))
    written, stage = [], quantile.stage
    quantile.stage = lambda df, name="stage": written.append((name, "/t/" in str(df.inputFiles()))) or stage(df, name)
    try:
        found = dict(quantile.group_median(spark.read.parquet(str(tmp_path / "t")), ["k"], "id", "m").collect())
    finally:
        quantile.stage = stage
    assert found == {0: 499.5, 1: 499.0, 2: 500.0}
    assert [name for name, from_source in written if from_source] == ["fact"]


def test_several_steps_of_imputation_read_what_is_written(spark):
    out = plan.clean_sales(sales_rows(spark), plan.CleanConfig(strategy="conditional"))
    assert any("/repaired-" in f for f in out.inputFiles()) and out.count() == 500


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_clean_moves_no_whole_rows(spark, monkeypatch):
    rows = sales_rows(spark)
    odd = rows.where("id < 30").withColumns({"Odometer": F.lit(None).cast("double"), "Make": F.lit(None).cast("string")})
    rows = rows.unionByName(rows.where("id % 5 = 0")).unionByName(odd)
    written, stage = {}, plan.stage
    monkeypatch.setattr(plan, "stage", lambda df, name="stage": written.setdefault(name, df) and stage(df, name))
    out = plan.first_clean(rows)
    # What is written comes straight from its source; only fingerprints are shuffled afterwards, and rows that may have an equal.
    assert "hashpartitioning" not in _plan(written["typed"]) and set(written) == {"typed"}
    want = rows.where("SellingPrice > 100 AND Odometer IS NOT NULL").select("Id", F.initcap("Make").alias("Make"), "Odometer", "SellingPrice").distinct()
    assert sorted(map(str, out.select(*want.columns).collect())) == sorted(map(str, want.collect())) and out.count() == 459


def test_wide_title_case_is_compiled(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = plan.before_imputation(sales_rows(spark))._jdf.queryExecution().debug().codegenToSeq()
        sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Java compiles methods up to 8,000 bytes.
    assert sizes and max(sizes) < 8000


def knn_rows(spark):
    """Sales with gaps in color and interior, odometers that tie, labels that tie, repeated keys and null features."""
    return sales_rows(spark).withColumns({
        "Id": F.expr("if(id % 40 = 0, null, concat('k', cast(id % 450 AS string)))"), "Year": F.expr("if(id % 31 = 0, null, cast(2000 + id % 6 AS int))"),
        "Odometer": F.expr("if(id % 37 = 0, null, cast(id * 7 % 60 AS double))"), "Body": F.expr("if(id % 4 = 0, 'SUV', 'sedan')"),
        "Color": F.expr("if(id % 3 = 0, null, element_at(array('red', 'blue', 'black'), cast(id % 7 % 3 + 1 AS int)))"),
        "Interior": F.expr("if(id % 5 = 1, null, if(id % 2 = 0, 'tan', 'beige'))"),
    })


def test_neighbours_move_only_rows_with_a_gap(spark, monkeypatch):
    rows = knn_rows(spark)
    joined, staged, lookup, stage = [], [], impute.lookup_join, impute.stage
    monkeypatch.setattr(impute, "lookup_join", lambda fact, dim, on, **more: joined.append((on, fact)) or lookup(fact, dim, on, **more))
    monkeypatch.setattr(impute, "stage", lambda df, name="stage": staged.append(name) or stage(df, name))
    got = plan.clean_sales(rows, plan.CleanConfig(strategy="knn+conditional")).select("Id", "Color", "Interior", "Odometer", "SaleDate")
    # The votes are joined to rows with a gap alone; what both columns share is learnt once.
    gaps = [rows.where(F.col(c).isNull()).count() for c in ["Color", "Interior"]]
    assert [fact.count() for on, fact in joined if on[0] == "__key_0"] == gaps
    assert staged.count("narrow") == 0 and staged.count("labels") == 2 * staged.count("codes")  # label_codes writes its values, too
    want = plan.before_imputation(rows)
    for c in ["Color", "Interior"]:
        want = impute.impute_knn(want, c)
    assert got.where("Color IS NULL OR Interior IS NULL").count() == 0
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_votes_of_a_search_in_batches_are_those_of_joins(spark, monkeypatch):
    rows = knn_rows(spark)
    for more in ({}, {"block_on": ["Body"]}, {"block_on": ["Body"], "staged": True, "mark": "hit"}):
        with monkeypatch.context() as patch:
            got = impute.impute_knn(rows, "Color", **more)
            patch.setattr(impute, "bounded", lambda table: False)
            want = impute.impute_knn(rows, "Color", **more)
            assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_pass_holds_the_samples_of_several_columns(spark):
    rows = spark.range(3000).selectExpr("id * 7 AS Id", "if(id % 3 = 0, null, id) AS a", "if(id % 100 = 0, id, null) AS b", "id AS c")
    for n, cols in ((0, ["a"]), (40, ["a", "c"]), (40, ["a", "b", "c"]), (29, ["b"]), (5000, ["a", "b"])):
        pool = filters.sample_pool(rows, n, "Id", cols)
        assert any("/pool-" in f for f in pool.inputFiles())
        for c in cols:
            some = lambda df: sorted(map(str, filters.sample_n(df.where(F.col(c).isNotNull()), n, "Id").collect()))
            assert some(pool) == some(rows)
    assert filters.sample_pool(rows, 40, "Id", ["a", "c"]).count() < 200


def test_staging_leaves_no_shuffle_files(spark):
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|").count("/shuffle_")
    set_before, before = spark.conf.get(staging._CLEAN_SHUFFLES), held()
    counts = staging.stage(spark.range(50_000).groupBy((F.col("id") * 7 % 49_999).alias("k")).count(), "counts")
    until = time.time() + 20
    while held() > before and time.time() < until:
        time.sleep(0.5)
    assert held() <= before and counts.count() == 49_999 and spark.conf.get(staging._CLEAN_SHUFFLES) == set_before

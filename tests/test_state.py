"""Cleaning deliveries one by one equals one run over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from tabclean.catalog.views import Views
from tabclean.operators import impute
from tabclean.plans import state
from tabclean.plans.job import run
from tabclean.plans.sales import CleanConfig, clean_sales

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sales(spark):
    return Views(spark, FOLDER).sales.limit(1500).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("strategy", ["mode", "conditional", "knn", "none"])
def test_deliveries_equal_one_run(spark, sales, tmp_path, strategy):
    config = CleanConfig(strategy=strategy, knn_sample=120)
    parts = [sales.where(F.pmod(F.xxhash64("Id"), F.lit(3)) == i) for i in range(3)] + [sales.limit(0)]
    for i, part in enumerate(parts):
        state.save(state.fit(part, config), f"{tmp_path}/{i}")
    known = [state.load(spark, f"{tmp_path}/{i}", config) for i in range(4)]
    merged = state.merge(state.merge(known[3], known[2]), state.merge(known[1], known[0]))
    want = rows(clean_sales(sales, config))
    got = [r for part in (parts[0], parts[1].unionByName(parts[2])) for r in rows(state.apply(part, merged))]
    assert sorted(got, key=repr) == want
    whole = state.fit(sales, config)
    for name, table in whole.tables.items():
        assert rows(table) == rows(merged.tables[name].select(table.columns))


def test_job_over_two_deliveries(spark, sales, tmp_path):
    first = F.pmod(F.xxhash64("Id"), F.lit(2)) == 0
    for i, part in enumerate([sales.where(first), sales.where(~first)]):
        part.write.parquet(f"{tmp_path}/in{i}.parquet")
    run(spark, f"{tmp_path}/in0.parquet", f"{tmp_path}/out0.parquet", state_to=f"{tmp_path}/state0")
    run(spark, f"{tmp_path}/in1.parquet", f"{tmp_path}/out1.parquet", state_from=f"{tmp_path}/state0", state_to=f"{tmp_path}/state1")
    run(spark, f"{tmp_path}/in0.parquet", f"{tmp_path}/again.parquet", state_from=f"{tmp_path}/state1")
    got = [r for n in ("again", "out1") for r in rows(spark.read.parquet(f"{tmp_path}/{n}.parquet"))]
    assert sorted(got, key=repr) == rows(clean_sales(sales))


def test_states_that_do_not_fit(spark, sales, tmp_path):
    made = state.fit(sales.limit(50))
    state.save(made, f"{tmp_path}/a")
    with pytest.raises(ValueError, match="other choices"):
        state.load(spark, f"{tmp_path}/a", CleanConfig(seed=1))
    with pytest.raises(ValueError, match="don't add up"):
        state.merge(made, state.fit(sales.limit(50), CleanConfig(baseline="post_sentinel")))
    with pytest.raises(ValueError, match="no state"):
        state.fit(sales, CleanConfig(strategy="knn+conditional"))
    # A state that was never finished has no `about` and can't be read.
    made.tables["groups"].write.parquet(f"{tmp_path}/b/groups")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        state.load(spark, f"{tmp_path}/b")


def test_running_counts_of_a_hot_group(spark):
    rng = random.Random(4)
    counts = [("hot", f"v{i:06}", rng.randrange(1, 9)) for i in range(20_000)] + [("small", "a", 2), ("small", "b", 3)]
    rng.shuffle(counts)
    out = impute.running_counts(spark.createDataFrame(counts, "g string, v string, n long"), ["g"], "v")
    got, sums = {(r.g, r.v): (r.upto, r.total) for r in out.collect()}, {}
    total = {g: sum(n for h, _, n in counts if h == g) for g in ("hot", "small")}
    for g, v, n in sorted(counts):
        sums[g] = sums.get(g, 0) + n
        assert got[g, v] == (sums[g], total[g])
    # The hot group's values lie in many partitions.
    spread = out.groupBy("g", F.spark_partition_id().alias("p")).count().where("g = 'hot'")
    assert spread.count() >= 4 and spread.agg(F.max("count")).first()[0] <= 10_000


def test_scopes_of_two_threads_are_apart(spark):
    import threading

    from tabclean.sources.staging import stage, staged_until_end

    open_, done, kept = threading.Event(), threading.Event(), {}

    def other():
        with staged_until_end(spark):
            kept["df"] = stage(spark.range(5))
            open_.set()
            done.wait(60)
            kept["rows"] = kept["df"].count()

    thread = threading.Thread(target=other)
    with staged_until_end(spark):
        thread.start()
        assert open_.wait(60)
        gone = stage(spark.range(3))
    done.set()
    thread.join()
    assert kept["rows"] == 5
    with pytest.raises(Exception):
        gone.count()

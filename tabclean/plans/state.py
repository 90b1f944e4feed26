"""What the sales cleaning learns, kept in tables that add up, so that a new delivery is cleaned alone.

    state = fit(first)                                  # read the first delivery once
    save(state, "/data/state")
    state = merge(load(spark, "/data/state"), fit(second))
    apply(second, state)                                # only the second is read

Cleaning the deliveries one by one with the state of all of them gives the rows that one run
over all of them gives. The tables hold counts, which are added, and samples, of which the
rows with the smallest draws stay; so neither the order of deliveries nor their sizes matter.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import impute
from ..operators.filters import sample_n
from ..sources.staging import stage
from .sales import DRAW_KEYS, GROUP_KEYS, MODE_COLUMNS, CleanConfig, Learnt, before_imputation, clean_sales

NUMERIC, CATEGORICAL = ["Year", "Odometer"], ["Make", "Body"]
STRATEGIES = ["mode", "conditional", "knn", "none"]


@dataclass(frozen=True)
class SalesState:
    """Tables by name, and the choices they were made with.

    `mode` has `groups`; `conditional` has `values_<column>`; `knn` has `train_<column>` and
    `features`, a count for every value of every feature. With `knn+conditional` the second step
    counts what the first has filled, which does not add up over deliveries, so it has no state.
    """

    tables: dict[str, DataFrame]
    config: CleanConfig


def _about(config: CleanConfig) -> dict:
    """The choices that a state depends on."""
    return {
        "strategy": config.strategy, "baseline": config.baseline, "seed": config.seed, "knn_sample": config.knn_sample,
        "row_key": config.row_key, "make_aliases": dict(sorted(config.make_aliases.items())),
        "prefixes": config.prefixes is not None, "validate_aliases": config.validate_aliases,
    }


def fit(df: DataFrame, config: CleanConfig = CleanConfig()) -> SalesState:
    """The state of one table. Its tables are written; a state may be of any number of rows, none included."""
    if config.strategy not in STRATEGIES:
        raise ValueError(f"no state for strategy {config.strategy!r}: one of {STRATEGIES}")
    ready, tables = before_imputation(df, config), {}
    if config.strategy == "mode":
        tables["groups"] = impute.group_counts(ready, MODE_COLUMNS, GROUP_KEYS)
    elif config.strategy == "conditional":
        tables = {f"values_{c}": impute.value_counts_by(ready, c, DRAW_KEYS) for c in MODE_COLUMNS}
    elif config.strategy == "knn":
        ready = stage(ready.select(config.row_key, *NUMERIC, *CATEGORICAL, *MODE_COLUMNS), "ready")
        tables["features"] = impute.feature_counts(ready, NUMERIC, CATEGORICAL)
        for c in MODE_COLUMNS:
            known = ready.where(F.col(c).isNotNull()).select(config.row_key, c, *NUMERIC, *CATEGORICAL)
            tables[f"train_{c}"] = sample_n(known, config.knn_sample, config.row_key, config.seed)
    return SalesState({name: stage(table, name) for name, table in tables.items()}, config)


def merge(*states: SalesState) -> SalesState:
    """The state of all their tables together."""
    config = states[0].config
    if any(_about(s.config) != _about(config) for s in states):
        raise ValueError("states made with different choices don't add up")

    def together(name: str) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [s.tables[name] for s in states])
        if name.startswith("train_"):
            return sample_n(rows, config.knn_sample, config.row_key, config.seed)
        return rows.groupBy(*[c for c in rows.columns if c != "n"]).agg(F.sum("n").alias("n"))

    return SalesState({name: stage(together(name), name) for name in states[0].tables}, config)


def save(state: SalesState, path: str) -> None:
    """Writes the tables below `path`, which must be new, and last of all what makes them a state."""
    spark = SparkSession.active()
    for name, table in state.tables.items():
        table.write.parquet(f"{path}/{name}")
    about = json.dumps({"tables": sorted(state.tables), "choices": _about(state.config)})
    spark.range(1).select(F.lit(about).alias("value")).coalesce(1).write.text(f"{path}/about")


def load(spark: SparkSession, path: str, config: CleanConfig = CleanConfig()) -> SalesState:
    """The state saved at `path`; an error if it was made with other choices or never finished."""
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    if about["choices"] != json.loads(json.dumps(_about(config))):
        raise ValueError("the state was made with other choices")
    return SalesState({name: spark.read.parquet(f"{path}/{name}") for name in about["tables"]}, config)


def learnt(state: SalesState) -> Learnt:
    """What `clean_sales` needs to know, from a state."""
    tables = state.tables
    if state.config.strategy == "mode":
        return Learnt(groups=tables["groups"])
    if state.config.strategy == "conditional":
        return Learnt(values={c: tables[f"values_{c}"] for c in MODE_COLUMNS})
    if state.config.strategy == "knn":
        return Learnt(neighbours={c: impute.knn_model(tables[f"train_{c}"], tables["features"], CATEGORICAL) for c in MODE_COLUMNS})
    return Learnt()


def apply(df: DataFrame, state: SalesState) -> DataFrame:
    """The cleaned rows of `df` alone, by what `state` knows of all tables in it."""
    return clean_sales(df, state.config, learnt(state))

"""Imputation of missing values, quality flags and the audit of both."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import DRAW_BITS, draw
from ..functions.text import all_null, any_of, is_blank, title_case
from ..sources.staging import stage
from .filters import FLAG_IMPUTED, FLAG_NON_IMPUTABLE, is_clean, sample_n
from .joins import bounded, keys_present, lookup_join, prefix_rows
from .profile import unfold
from .quantile import quantile_values

WAS_NULL = "_was_null_"
# The columns that may be filled, and those filled from codes.
IMPUTABLE = ["Make", "Model", "Trim", "Body", "Color", "Interior", "Transmission", "Odometer", "ConditionValue"]
CATEGORICAL = ["Make", "Model", "Trim", "Body"]
# The features by which neighbours are near if no others are given.
KNN_NUMERIC, KNN_CATEGORICAL = ["Year", "Odometer"], ["Make", "Body"]

# Manufacturer prefix of the vehicle number -> make, body type if implied.
PREFIXES = {
    "1FT": ("Ford", "Truck"), "1G1": ("Chevrolet", None), "1GC": ("Chevrolet", "Truck"),
    "1GT": ("GMC", "Truck"), "1HG": ("Honda", None), "1J4": ("Jeep", None),
    "1J8": ("Jeep", None), "1N4": ("Nissan", None), "1N6": ("Nissan", "Truck"),
    "1VW": ("Volkswagen", None), "1YV": ("Mazda", None), "19U": ("Acura", None),
    "2G1": ("Chevrolet", None), "2T1": ("Toyota", None), "2T3": ("Toyota", "Suv"),
    "3VW": ("Volkswagen", None), "4S3": ("Subaru", None), "4S4": ("Subaru", None),
    "5J6": ("Honda", "Suv"), "5N1": ("Hyundai", "Suv"), "5UX": ("BMW", None),
    "5XX": ("Kia", None), "JM1": ("Mazda", None), "JTD": ("Toyota", None),
    "JTH": ("Lexus", None), "JTJ": ("Lexus", "Suv"), "KNA": ("Kia", None),
    "KNB": ("Kia", None), "KND": ("Kia", None), "KMH": ("Hyundai", None),
    "SAL": ("Land Rover", None), "SAJ": ("Jaguar", None), "SCA": ("Rolls Royce", None),
    "SCB": ("Bentley", None), "SCF": ("Aston Martin", None), "WA1": ("Audi", "Suv"),
    "WAU": ("Audi", None), "WBA": ("BMW", None), "WBS": ("BMW", None),
    "WBX": ("BMW", "Suv"), "WDC": ("Mercedes-Benz", "Suv"), "WDD": ("Mercedes-Benz", None),
    "WP0": ("Porsche", None), "WP1": ("Porsche", "Suv"), "WVW": ("Volkswagen", None),
    "YV1": ("Volvo", None), "YV4": ("Volvo", "Suv"), "ZFF": ("Ferrari", None),
    "1FA": ("Ford", None), "1FM": ("Ford", "Suv"), "1LN": ("Lincoln", None),
    "1B4": ("Dodge", None), "1C3": ("Chrysler", None), "1C4": ("Chrysler", None),
    "3N1": ("Nissan", None), "4T1": ("Toyota", None), "2HG": ("Honda", None),
    "2HK": ("Honda", "Suv"), "JN1": ("Nissan", None), "JF1": ("Subaru", None),
    "JF2": ("Subaru", None), "JH4": ("Acura", None), "1GK": ("GMC", "Suv"),
    "ZAM": ("Maserati", None), "ZAR": ("Alfa Romeo", None), "ZFA": ("Fiat", None),
}


# --- what was missing ---------------------------------------------------------------


def snapshot_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Carry along which cells are null now, as columns `_was_null_<c>`."""
    cols = [c for c in (cols or IMPUTABLE) if c in df.columns]
    return df.withColumns({WAS_NULL + c: F.col(c).isNull() for c in cols})


def snapshot_columns(df: DataFrame) -> list[str]:
    return [c[len(WAS_NULL):] for c in df.columns if c.startswith(WAS_NULL)]


def extend_snapshot(df: DataFrame) -> DataFrame:
    """Count cells that became null since the snapshot as missing, too."""
    return df.withColumns({WAS_NULL + c: F.col(WAS_NULL + c) | F.col(c).isNull() for c in snapshot_columns(df)})


def drop_snapshot(df: DataFrame) -> DataFrame:
    return df.drop(*[WAS_NULL + c for c in snapshot_columns(df)])


# --- from a prefix table ------------------------------------------------------------


def prefix_dimension(
    spark: SparkSession, table: dict[str, tuple[str, str | None]] | None = None, canonical: bool = True
) -> DataFrame:
    """The prefix table (code, make, body) as a literal relation.

    Keys of any other length than 3 can never match and are left out. `canonical`
    spells makes as the cleaned table does. A long table of your own is better given
    to the operators as a DataFrame of the same three columns.
    """
    rows = [(k, m, b) for k, (m, b) in (table or PREFIXES).items() if len(k) == 3]
    quote = lambda v: "cast(NULL AS string)" if v is None else "'" + v.replace("'", "\\'") + "'"
    values = ", ".join(f"({quote(k)}, {quote(m)}, {quote(b)})" for k, m, b in rows)
    dim = spark.sql(f"SELECT * FROM VALUES {values} AS t(code, make, body)")
    return dim.withColumn("make", title_case("make")) if canonical else dim


def impute_from_prefix(
    df: DataFrame,
    dim: DataFrame | None = None,
    code: str = "VIN",
    first: str = "Make",
    second: str = "Body",
    mark: str | None = None,
) -> DataFrame:
    """Fill `first` from the prefix of the code, and `second` where both are missing.

    `dim` is a table (code, make, body) of your own. It is treated as the literal one is:
    codes of three characters, makes spelled as the cleaned table spells them; of rows with
    the same code the smallest counts.
    """
    literal = dim is None
    if literal:
        dim = prefix_dimension(df.sparkSession)
    else:
        dim = prefix_rows(dim.withColumn("make", title_case("make")))
    dim = dim.select(
        F.col("code").alias("__code"), F.col("make").alias("__first"), F.col("body").alias("__second")
    )
    prefix = F.when(F.col(first).isNull(), F.upper(F.substring(code, 1, 3)))
    out = lookup_join(df.withColumn("__code", prefix), dim, ["__code"], literal=literal)
    cols = {
        first: F.coalesce(F.col(first), F.col("__first")),
        second: F.coalesce(F.col(second), F.col("__second")),
    }
    if mark:
        cols[mark] = F.col("__first").isNotNull()
    return out.withColumns(cols).drop("__code", "__first", "__second")


# --- from the group -----------------------------------------------------------------


def _most_frequent(value: str, n: str = "n") -> Column:
    """Value with the largest count, the smallest on ties."""
    return F.min(F.struct((-F.col(n)).alias("n"), F.col(value).alias("v")))["v"]


def impute_group_mode(
    df: DataFrame, cols: list[str], keys: list[str], marks: dict[str, str] | None = None
) -> DataFrame:
    """Fill with the most frequent value of the group, then with that of the filled column.

    One aggregation over the table serves all columns: group modes and the counts of
    the filled column both follow from the counts per (keys, values).
    """
    return fill_group_mode(df, stage(group_counts(df, cols, keys), "counts"), cols, keys, marks)


def group_counts(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """Rows per (keys, columns) as `n`: all that group modes need to know. Counts of two tables add up."""
    return df.groupBy(*keys, *cols).agg(F.count(F.lit(1)).alias("n"))


def fill_group_mode(
    df: DataFrame, counts: DataFrame, cols: list[str], keys: list[str], marks: dict[str, str] | None = None
) -> DataFrame:
    """`impute_group_mode` by the `group_counts` of this or another table, which should be written already."""
    dim = counts.where(keys_present(keys)).select(*keys).distinct()
    filled = None
    for c in cols:
        per_value = counts.groupBy(*keys, c).agg(F.sum("n").alias("n"))
        modes = (
            per_value.where(keys_present([*keys, c])).groupBy(*keys).agg(_most_frequent(c).alias(f"__mode_{c}"))
        )
        dim = dim.join(modes, keys, "left")
        after = per_value.join(modes, keys, "left").select(
            F.lit(c).alias("__c"), F.coalesce(F.col(c), F.col(f"__mode_{c}")).alias("__v"), "n"
        )
        filled = after if filled is None else filled.unionByName(after)
    totals = filled.where("__v IS NOT NULL").groupBy("__c", "__v").agg(F.sum("n").alias("n"))
    # One row per column.
    found = dict(totals.groupBy("__c").agg(_most_frequent("__v")).collect())
    overall = {c: F.lit(found.get(c)) for c in cols}
    out = lookup_join(df, dim, keys)
    new = {c: F.coalesce(F.col(c), F.col(f"__mode_{c}"), overall[c]) for c in cols}
    for c in cols:
        if marks and c in marks:
            new[marks[c]] = F.col(c).isNull() & new[c].isNotNull()
    return out.withColumns(new).drop(*[f"__mode_{c}" for c in cols])


def value_counts_by(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """Rows per group and value as `n`, nulls left out. Counts of two tables add up."""
    return df.where(keys_present([*keys, col])).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("n"))


def running_counts(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """`counts` (keys, value, n) with `upto`, the sum of `n` in the group up to this value, and `total`.

    Groups are spread over range partitions: a sum is what earlier partitions hold of the
    group plus what comes before in its own, so a group of any size is no single task.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = counts.repartitionByRange(parts, *keys, value).withColumn("__part", F.spark_partition_id())
    placed = stage(placed, "placed")
    sizes = placed.groupBy(*keys, "__part").agg(F.sum("n").alias("__size"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    starts = sizes.select(
        *keys, "__part", (F.sum("__size").over(before) - F.col("__size")).alias("__before"),
        F.sum("__size").over(Window.partitionBy(*keys)).alias("total"),
    )
    within = Window.partitionBy(*keys, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.withColumn("__within", F.sum("n").over(within)).join(starts, [*keys, "__part"])
    return out.select(*keys, value, "n", (F.col("__before") + F.col("__within")).alias("upto"), "total")


def conditional_distribution(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """Count and share of each value within its group; nulls left out."""
    ranked = running_counts(value_counts_by(df, col, keys), keys, col)
    return ranked.select(*keys, col, F.col("n").alias("count"), (F.col("n") / F.col("total")).alias("share"))


_SLICES = 16


def impute_conditional(
    df: DataFrame, col: str, keys: list[str], row_key: str = "Id", seed: int = 42, mark: str | None = None
) -> DataFrame:
    """Draw missing values from their distribution within the group; unseen groups stay null.

    The draw is a function of the row's key and the column, so columns are drawn
    independently. Values of a group own consecutive ranges of draws. The range of draws is cut into slices that join along with the keys, so
    a hot group is spread over the slices and a row meets few candidates.
    """
    return draw_from_counts(df, value_counts_by(df, col, keys), col, keys, row_key, seed, mark)


def draw_from_counts(
    df: DataFrame, counts: DataFrame, col: str, keys: list[str], row_key: str = "Id", seed: int = 42, mark: str | None = None,
    staged: bool = False,
) -> DataFrame:
    """`impute_conditional` by the `value_counts_by` of this or another table.

    `staged` is for a table that is cheap to read: only the ranges of groups with a gap are then handed to the join.
    """
    hi, n, total = F.col("__hi"), F.col("__n"), F.col("__total")
    ranges = running_counts(counts, keys, col).select(
        *keys, F.col(col).alias("__value"), F.col("n").alias("__n"), F.col("upto").alias("__hi"), F.col("total").alias("__total"),
    ).withColumn(
        "__slice",
        F.explode(
            F.sequence(
                F.floor((hi - n) * _SLICES / total).cast("bigint"),
                F.least(F.floor(hi * _SLICES / total).cast("bigint"), F.lit(_SLICES - 1).cast("bigint")),
            )
        ),
    )
    if staged:
        gaps = df.where(F.col(col).isNull() & keys_present(keys)).select(*keys).distinct()
        ranges = ranges.join(gaps, keys, "left_semi")
    drawn = df.withColumn("__draw", F.when(F.col(col).isNull(), draw(row_key, col, seed)))
    drawn = drawn.withColumn("__slice", F.shiftright("__draw", DRAW_BITS - _SLICES.bit_length() + 1))
    # Whole numbers of 38 digits on both sides: no draw can fall between two ranges, none overflows.
    whole = lambda c: c.cast("decimal(19,0)")
    scaled, slots = whole(F.col("__draw")) * whole(total), F.lit(1 << DRAW_BITS).cast("decimal(19,0)")
    hit = (scaled >= whole(hi - n) * slots) & (scaled < whole(hi) * slots)
    out = lookup_join(drawn, ranges, [*keys, "__slice"], extra=hit)
    cols = {col: F.coalesce(F.col(col), F.col("__value"))}
    if mark:
        cols[mark] = F.col("__value").isNotNull()
    return out.withColumns(cols).drop("__draw", "__slice", "__value", "__n", "__hi", "__total")


# --- label codes --------------------------------------------------------------------


def label_codes(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """Distinct values and their alphabetical codes 0, 1, 2, ...

    Values are range-partitioned and written once; a code is the number of values in
    earlier partitions plus the rank within its own, so no task sees all of them.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    values = stage(values.repartitionByRange(parts, col).withColumn("__part", F.spark_partition_id()), "labels")
    sizes = values.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select("__part", (F.sum("__n").over(upto) - F.col("__n")).alias("__offset"))
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(col))
    return (
        values.withColumn("__rank", rank)
        .join(F.broadcast(offsets), "__part")
        .select(col, (F.col("__offset") + F.col("__rank") - 1).cast("bigint").alias("code"))
    )


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Add the alphabetical code of a column; null stays null."""
    codes = label_codes(df, col).withColumnRenamed("code", out or f"{col}_code")
    return lookup_join(df, codes, [col])


# --- nearest neighbours -------------------------------------------------------------

# A cell of the training sample with more rows than this is cut along its widest feature into even tiles, so many at most.
_CELL_ROWS, _TILES, _LEVELS = 64, 32, 9
# A value that fills a tile is a part of its own, so there are twice as many parts.
_PARTS = 2 * _TILES


@dataclass(frozen=True)
class KnnModel:
    """What a neighbour search learns: training rows with their raw features, written; label codes; medians, by column.

    Without training rows it is what several targets share; a sample is then drawn for each.
    """

    train: DataFrame | None
    codes: dict[str, DataFrame]
    medians: dict[str, float | None]


def feature_counts(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(column, label, number, n): rows per value of every feature, nulls left out. Counts of two tables add up."""
    kind = {**dict.fromkeys(numeric, "number"), **dict.fromkeys(categorical, "label")}
    cells = [
        F.struct(
            F.lit(c).alias("column"), (F.col(c) if k == "label" else F.lit(None)).cast("string").alias("label"),
            (F.col(c) if k == "number" else F.lit(None)).cast("double").alias("number"),
        )
        for c, k in kind.items()
    ]
    rows = df.select(F.inline(F.array(*cells))).where("label IS NOT NULL OR number IS NOT NULL")
    return rows.groupBy("column", "label", "number").agg(F.count(F.lit(1)).alias("n"))


def knn_model(train: DataFrame, features: DataFrame, categorical: list[str]) -> KnnModel:
    """A model from training rows and the `feature_counts` of the whole table, both written already."""
    codes = {c: stage(label_codes(features.where(F.col("column") == c).select(F.col("label").alias(c)), c), "codes") for c in categorical}
    every = [codes[c].select(F.lit(c).alias("column"), F.col(c).alias("label"), "code") for c in categorical]
    numbers = features.select("column", F.col("number").alias("x"), "n").where("x IS NOT NULL")
    if every:
        coded = features.join(reduce(DataFrame.unionByName, every), ["column", "label"])
        numbers = numbers.unionByName(coded.select("column", F.col("code").cast("double").alias("x"), "n"))
    return KnnModel(train, codes, _medians(numbers))


def knn_features(df: DataFrame, numeric: list[str], categorical: list[str]) -> KnnModel:
    """What the targets of a written table share, a model without training rows: codes and their medians
    from the counts of labels, the medians of numbers by quantiles."""
    codes, coded = {}, []
    for c in categorical:
        counts = stage(df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n")), "labels")
        codes[c] = stage(label_codes(counts, c), "codes")
        coded.append(counts.join(codes[c], c).select(F.lit(c).alias("column"), F.col("code").cast("double").alias("x"), F.col("__n").alias("n")))
    medians = _medians(reduce(DataFrame.unionByName, coded)) if coded else {}
    return KnnModel(None, codes, medians | {c: quantile_values(df, c, [0.5])[0] for c in numeric})


def _medians(numbers: DataFrame) -> dict[str, float]:
    """By column, of (column, x, n)."""
    ranked = running_counts(numbers, ["column"], "x")
    holds = lambda at: (at >= F.col("upto") - F.col("n")) & (at < F.col("upto"))
    low, high = F.floor((F.col("total") - 1) / 2), F.ceil((F.col("total") - 1) / 2)
    picks = ranked.groupBy("column").agg(F.max(F.when(holds(low), F.col("x"))).alias("a"), F.max(F.when(holds(high), F.col("x"))).alias("b"))
    return {r["column"]: (r["a"] + r["b"]) / 2 for r in picks.collect()}


def impute_knn(
    df: DataFrame,
    target: str,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    row_key: str = "Id",
    k: int = 5,
    sample: int = 50_000,
    seed: int = 42,
    block_on: list[str] | None = None,
    mark: str | None = None,
    model: KnnModel | None = None,
    staged: bool = False,
) -> DataFrame:
    """Fill missing values by a vote of the k nearest training rows, weighted by 1/distance.

    Features are unscaled; categories count by alphabetical code, missing features by
    the median. Exact matches outvote everything else; ties go to the smallest label.

    The training sample is cut into cells, again and again into even tiles of the feature
    in which a cell is widest, so ties in one feature are told apart by the others. A row
    goes level by level through the cells whose tight boxes are no farther than the far side
    of the nearest cell of k rows; numpy does so for a batch of rows at a time. The k-th row of the nearest bounds it anew,
    and only the rows of cells within that are compared. Exact. Equal feature vectors are searched only once, and rows whose target is known
    take no part in the join of the votes. A `model` learnt before takes the place of what
    the table itself would give. `staged` is for a table written already, which is cheap to read
    in parts: only rows with a gap are encoded and joined, and these are written, so that the
    result is as cheap to read.
    """
    numeric = numeric or KNN_NUMERIC
    categorical = KNN_CATEGORICAL if categorical is None else categorical
    block_on = block_on or []

    # The few columns needed, written once: what follows passes over them several times.
    narrow = df.select(row_key, target, *dict.fromkeys([*numeric, *categorical, *block_on]))
    narrow = narrow if staged else stage(narrow, "narrow")
    feats = [f"__f_{c}" for c in [*numeric, *categorical]]
    model = model or knn_features(narrow, numeric, categorical)
    train = model.train
    if train is None:
        train = sample_n(narrow.where(F.col(target).isNotNull()), sample, row_key, seed)
    codes = {c: model.codes[c].withColumnRenamed("code", f"__f_{c}") for c in categorical}
    medians = {c: m for c, m in model.medians.items() if m is not None}

    def encode(frame: DataFrame) -> DataFrame:
        for c in categorical:
            frame = lookup_join(frame, codes[c], [c], staged=True)
        return frame.withColumns({f"__f_{c}": F.col(c) for c in numeric})

    def complete(frame: DataFrame) -> DataFrame:
        return frame.withColumns(
            {f"__f_{c}": F.coalesce(F.col(f"__f_{c}").cast("double"), F.lit(medians.get(c, 0.0))) for c in [*numeric, *categorical]}
        )

    train = stage(complete(encode(train)).select(row_key, target, *feats, *block_on), "train")
    # Beyond the first k keys, rows equal in all features can never be among the k nearest.
    same = Window.partitionBy(*feats, *block_on).orderBy(row_key)
    train = train.withColumn("__r", F.row_number().over(same)).where(F.col("__r") <= k)
    train = train.select(
        F.col(row_key).alias("__id"), F.col(target).alias("__label"),
        *[F.col(f).alias(f"__t{f}") for f in feats], *[F.col(b).alias(f"__t_{b}") for b in block_on],
    )
    ask = complete(encode(narrow.where(F.col(target).isNull())))
    if block_on:
        ask = ask.where(keys_present(block_on))
    vector = [*feats, *block_on]
    # A number per vector, fixed by writing it, keeps the sort of the candidates narrow.
    ask = ask.select(*vector).distinct().withColumn("__q", F.monotonically_increasing_id())
    ask = stage(ask, "ask")

    votes = _nearest_votes(ask, train, vector, feats, block_on, k)
    # Features are never null here, so the vector itself is the key; null for rows that need no vote.
    keys = [f"__key_{i}" for i in range(len(vector))]
    asking = complete(encode(df.where(F.col(target).isNull()) if staged else df))
    asking = asking.withColumns({k: F.when(F.col(target).isNull(), F.col(c)) for k, c in zip(keys, vector)}).drop(*feats)
    out = lookup_join(asking, votes.select(*[F.col(c).alias(k) for k, c in zip(keys, vector)], F.col("label").alias("__vote")), keys)
    cols = {target: F.coalesce(F.col(target), F.col("__vote"))}
    if mark:
        cols[mark] = F.col(target).isNull() & F.col("__vote").isNotNull()
    out = out.withColumns(cols).drop("__vote", *keys)
    if not staged:
        return out
    known = df.where(F.col(target).isNotNull())
    return (known.withColumn(mark, F.lit(False)) if mark else known).unionByName(stage(out, "filled"))


def _part(x: Column, edges: Column) -> Column:
    """The part of a cell that x lies in; `edges` are the smallest values of its tiles."""
    tile = F.greatest(F.size(F.filter(edges, lambda e: e <= x)) - 1, F.lit(0))
    edge = F.get(edges, tile)
    above = (tile > 0) & (edge == F.get(edges, F.greatest(tile - 1, F.lit(0)))) & (x > edge)
    return tile * 2 + above.cast("int")


def _cells_of(feats: list[str], blocks: list[str], least: int):
    """Cuts the training rows of a block into cells; a row for each cell, the last ones with their training rows."""

    def cut(own: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        x = own[:, axis]
        tiles = min(_TILES, -(-len(x) * 4 // (3 * least)))
        edges = np.sort(x)[np.arange(tiles) * len(x) // tiles]
        tile = np.searchsorted(edges, x, "right") - 1
        above = (tile > 0) & (edges[tile] == edges[np.maximum(tile - 1, 0)]) & (x > edges[tile])
        return axis, edges, tile * 2 + above

    def cells(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("__id")
        points = np.column_stack([rows[f"__t{f}"].to_numpy() for f in feats])
        found, waiting = [], [(1, None, 0, np.arange(len(points)))]
        while waiting:
            cell, parent, level, at = waiting.pop()
            own = points[at]
            low, high = own.min(axis=0), own.max(axis=0)
            node = {"__cell": cell, "__parent": parent, "__level": level, "__n": len(at), "__lo": low.tolist(), "__hi": high.tolist()}
            if len(at) > least and (high > low).any() and level < _LEVELS:
                axis, edges, part = cut(own)
                node |= {"__axis": axis, "__edges": edges.tolist()}
                waiting += [(cell * _PARTS + int(p), cell, level + 1, at[part == p]) for p in np.unique(part)]
            else:
                held = rows.take(at)
                node["__rows"] = [
                    {"id": i, "label": n, "at": x} for i, n, x in zip(held["__id"].to_pylist(), held["__label"].to_pylist(), own.tolist())]
            found.append(node)
        kinds = [
            ("__cell", pa.int64()), ("__parent", pa.int64()), ("__level", pa.int32()), ("__n", pa.int64()), ("__axis", pa.int32()),
            ("__edges", pa.list_(pa.float64())), ("__lo", pa.list_(pa.float64())), ("__hi", pa.list_(pa.float64())),
            ("__rows", pa.list_(pa.struct([("id", rows["__id"].type), ("label", rows["__label"].type), ("at", pa.list_(pa.float64()))]))),
        ]
        block = [pa.chunked_array([pa.repeat(rows[b][0], len(found))]) for b in blocks]
        columns = [pa.array([n.get(name) for n in found], kind) for name, kind in kinds]
        return pa.Table.from_arrays([*block, *columns], [*blocks, *[name for name, _ in kinds]])

    return cells


def _cut_into_cells(train: DataFrame, feats: list[str], block_on: list[str], k: int) -> DataFrame:
    """The cells of the sample, a tree for each block. The sample is bounded by its parameter, and so is a block."""
    blocks, kinds = [f"__t_{b}" for b in block_on], dict(train.dtypes)
    own = "".join(f"`{b}` {kinds[b]}, " for b in blocks)
    row = f"array<struct<id:{kinds['__id']},label:{kinds['__label']},at:array<double>>>"
    schema = (
        f"{own}__cell bigint, __parent bigint, __level int, __n bigint, __axis int, __edges array<double>, "
        f"__lo array<double>, __hi array<double>, __rows {row}"
    )
    return stage(train.groupBy(*blocks).applyInArrow(_cells_of(feats, blocks, max(_CELL_ROWS, 4 * k)), schema), "cells")


def _nearest_votes(
    ask: DataFrame, train: DataFrame, vector: list[str], feats: list[str], block_on: list[str], k: int
) -> DataFrame:
    """`ask` with the label that the k nearest training rows of a vector vote for, as `label`."""
    found = _candidates(ask, train, feats, block_on, k, voted=True)
    if "label" in found.columns:
        return found
    near = _k_nearest(found, k)
    best = F.min("__d").over(Window.partitionBy("__q")).alias("__best")
    near = near.select("__q", best, F.struct("__d", "__label").alias("__x"))
    weight = F.when(F.col("__best") == 0, F.when(F.col("__x.__d") == 0, 1.0).otherwise(0.0)).otherwise(
        1.0 / F.when(F.col("__x.__d") != 0, F.col("__x.__d"))
    )
    scores = near.groupBy("__q", F.col("__x.__label").alias("label")).agg(F.sum(weight).alias("__score"))
    best = F.min(F.struct((-F.col("__score")).alias("s"), F.col("label").alias("v")))["v"]
    return ask.join(scores.groupBy("__q").agg(best.alias("label")), "__q").drop("__q")


def _k_nearest(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("__q").orderBy("__d", "__id")
    near = pairs.where("__d <= __reach").select("__q", "__id", "__label", "__d")
    return near.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= k).drop("__r")


def _nearest(ask: DataFrame, train: DataFrame, feats: list[str], block_on: list[str], k: int) -> DataFrame:
    """(__q, __id, __label, __d): the k nearest training rows of every vector in `ask`, ties to the smallest id."""
    return _k_nearest(_candidates(ask, train, feats, block_on, k, nearest_only=True), k)


def _candidates(
    ask: DataFrame, train: DataFrame, feats: list[str], block_on: list[str], k: int, nearest_only: bool = False, voted: bool = False
) -> DataFrame:
    """The pairs of vectors and training rows that are looked at, with their distance and its bound.

    With `nearest_only` just the k nearest of each vector are handed on. A sample within the bytes
    of a broadcast goes to the tasks as a tree of cells; the cells of a larger one are joined.
    With `voted` the tasks of the first kind hand on each vector with the label voted for, as `label`.
    """
    blocks = [f"__t_{b}" for b in block_on]
    if blocks:
        train = train.where(keys_present(blocks))
    fits, cells = bounded(train), _cut_into_cells(train, feats, block_on, k)
    if not fits:
        return _joined_candidates(ask, cells, feats, block_on, k)
    held = ask.sparkSession.sparkContext.broadcast(cells.toArrow())
    kinds = dict(train.dtypes) | {"__q": dict(ask.dtypes)["__q"]}
    schema = f"__q {kinds['__q']}, __reach double, __id {kinds['__id']}, __label {kinds['__label']}, __d double"
    # Few narrow rows with much work each, so they are dealt out first.
    ask = ask.repartition(int(ask.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__q")
    if voted:
        schema = ", ".join(f"`{c}` {kind}" for c, kind in ask.select(*feats, *block_on).dtypes) + f", label {kinds['__label']}"
    return ask.select("__q", *feats, *block_on).mapInArrow(_search_of(held, feats, block_on, k, nearest_only, voted), schema)


def _search_of(held, feats: list[str], block_on: list[str], k: int, nearest_only: bool, voted: bool = False):
    """Searches the cells of the sample for a batch of vectors at a time; `held` is the broadcast table of cells."""
    # Vectors searched together, and pairs held at once where there is more than one of them.
    chunk, most = 512, 1 << 20

    def trees(table: pa.Table) -> dict:
        """The cells of each block as arrays: boxes, children and rows by the place of their cell."""
        places = {}
        for i, key in enumerate(zip(*[table[f"__t_{b}"].to_pylist() for b in block_on]) if block_on else [()] * len(table)):
            places.setdefault(key, []).append(i)
        found = {}
        for key, at in places.items():
            own = table.take(at)
            number = {c: i for i, c in enumerate(own["__cell"].to_pylist())}
            parent = np.array([number.get(p, -1) for p in own["__parent"].to_pylist()])
            rows = own["__rows"].combine_chunks()
            flat = rows.flatten()
            ids = flat.field("id")
            rank = np.empty(len(ids), np.int64)
            rank[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
            names = flat.field("label").unique()
            names = names.take(pc.sort_indices(names))
            children, sizes = np.argsort(parent, kind="stable"), np.bincount(parent + 1, minlength=len(own) + 1)
            held_rows = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            box = lambda name: np.array(own[name].to_pylist(), float).reshape(len(own), len(feats))
            found[key] = {
                "lo": box("__lo"), "hi": box("__hi"), "n": own["__n"].to_numpy(), "children": children, "child_n": sizes[1:],
                "child_at": np.cumsum(sizes)[:-1], "rows_n": held_rows, "rows_at": np.cumsum(held_rows) - held_rows,
                "points": np.array(flat.field("at").flatten()).reshape(-1, len(feats)), "rank": rank, "ids": ids,
                "labels": flat.field("label"), "names": names, "code": pc.index_in(flat.field("label"), names).to_numpy(), "depth": max(own["__level"].to_pylist()), "root": number[1],
            }
        return found

    def length(difference) -> np.ndarray:
        """Euclidean, added up in the order of the features."""
        total = 0.0
        for i in range(len(feats)):
            d = difference(i)
            total = total + d * d
        return np.sqrt(total)

    def spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every place of the runs that begin at `starts`, and the number of its run."""
        run = np.repeat(np.arange(len(sizes)), sizes)
        return np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes), run

    def kept(q: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
        """Of `order`, which sorts by `q`, the first n of each."""
        sorted_q = q[order]
        first = np.searchsorted(sorted_q, sorted_q, "left")
        return order[np.arange(len(order)) - first < n]

    def search(tree: dict, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """(number of the vector, place of the row, distance, reach) of the pairs looked at."""

        def halves() -> tuple[np.ndarray, ...]:
            cut = len(x) // 2
            a, b = search(tree, x[:cut]), search(tree, x[cut:])
            return tuple(np.concatenate([u, v + cut if i == 0 else v]) for i, (u, v) in enumerate(zip(a, b)))

        def rows_of(q: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, ...]:
            row, run = spread(tree["rows_at"][cell], tree["rows_n"][cell])
            q = q[run]
            return q, row, length(lambda i: x[q, i] - tree["points"][row, i])

        q, cell, near = np.arange(len(x)), np.full(len(x), tree["root"]), np.zeros(len(x))
        reach = np.full(len(x), np.inf)
        for _ in range(tree["depth"]):
            below = tree["child_n"][cell]
            if len(x) > 1 and np.maximum(below, 1).sum() > most:
                return halves()
            last = below == 0
            place, run = spread(tree["child_at"][cell], below)
            child, asked = tree["children"][place], q[run]
            lo, hi = tree["lo"][child], tree["hi"][child]
            outside = length(lambda i: np.maximum(np.maximum(lo[:, i] - x[asked, i], x[asked, i] - hi[:, i]), 0.0))
            far = length(lambda i: np.maximum(x[asked, i] - lo[:, i], hi[:, i] - x[asked, i]))
            enough = tree["n"][child] >= k
            np.minimum.at(reach, asked[enough], far[enough])
            q, cell, near = np.concatenate([q[last], asked]), np.concatenate([cell[last], child]), np.concatenate([near[last], outside])
            within = near <= reach[q]
            q, cell, near = q[within], cell[within], near[within]

        # No farther than the k-th row of the nearest cell of k.
        full = np.flatnonzero(tree["n"][cell] >= k)
        full = full[kept(q[full], np.lexsort((cell[full], near[full], q[full])), 1)]
        if len(x) > 1 and tree["rows_n"][cell[full]].sum() > most:
            return halves()
        asked, _, d = rows_of(q[full], cell[full])
        order = np.lexsort((d, asked))
        first = np.searchsorted(asked[order], q[full], "left")
        reach[q[full]] = np.minimum(reach[q[full]], d[order][first + k - 1])
        within = near <= reach[q]
        q, cell = q[within], cell[within]
        if len(x) > 1 and tree["rows_n"][cell].sum() > most:
            return halves()
        q, row, d = rows_of(q, cell)
        if nearest_only or voted:
            close = d <= reach[q]
            q, row, d = q[close], row[close], d[close]
            best = kept(q, np.lexsort((tree["rank"][row], d, q)), k)
            q, row, d = q[best], row[best], d[best]
        return q, row, d, reach[q]

    def vote(tree: dict, q: np.ndarray, row: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the vectors and of their labels; pairs come by vector and from near to far."""
        exact = d[np.searchsorted(q, q, "left")] == 0
        weight = np.where(exact, d == 0, 1.0 / np.where(d == 0, 1.0, d))
        each, at = np.unique(q * len(tree["names"]) + tree["code"][row], return_inverse=True)
        owner, name = np.divmod(each, len(tree["names"]))
        best = kept(owner, np.lexsort((name, -np.bincount(at, weight), owner)), 1)
        return owner[best], name[best]

    def batches(asked: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trees(held.value)
        for batch in asked:
            points = np.column_stack([batch[f].to_numpy(zero_copy_only=False).astype(float) for f in feats])
            places = {}
            for i, key in enumerate(zip(*[batch[b].to_pylist() for b in block_on]) if block_on else [()] * len(points)):
                places.setdefault(key, []).append(i)
            for key in places.keys() & known.keys():
                own, tree = np.array(places[key]), known[key]
                for start in range(0, len(own), chunk):
                    part = own[start:start + chunk]
                    q, row, d, reach = search(tree, points[part])
                    if voted:
                        q, name = vote(tree, q, row, d) if len(q) else (q, q)
                        asked_at, vector = pa.array(part[q]), [*feats, *block_on]
                        yield pa.RecordBatch.from_arrays([*[batch[c].take(asked_at) for c in vector], tree["names"].take(pa.array(name))], [*vector, "label"])
                        continue
                    columns = [batch["__q"].take(pa.array(part[q])), pa.array(reach), tree["ids"].take(pa.array(row)), tree["labels"].take(pa.array(row)), pa.array(d)]
                    yield pa.RecordBatch.from_arrays(columns, ["__q", "__reach", "__id", "__label", "__d"])

    return batches


def _joined_candidates(ask: DataFrame, cells: DataFrame, feats: list[str], block_on: list[str], k: int) -> DataFrame:
    """`_candidates` by joins with cells that are too large for one task."""
    blocks = [f"__t_{b}" for b in block_on]
    depth = cells.agg(F.max("__level")).first()[0] or 0
    x = F.array(*[F.col(f).cast("double") for f in feats])
    own = [*blocks, "__cell", "__n", "__axis", "__edges", "__lo", "__hi"]

    def meet(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        """Join with what belongs to the cell that a vector is at, within its block."""
        right = right.withColumnRenamed("__cell" if "__cell" in right.columns else "__parent", "__key")
        tests = [F.col("__at_cell") == F.col("__key"), *[F.col(b) == F.col(f"__t_{b}") for b in block_on]]
        return left.join(right, reduce(lambda a, b: a & b, tests), how).drop("__key", *blocks)

    def distance(difference) -> Column:
        """Euclidean; `difference` gives the difference in a feature by its number."""
        return F.sqrt(reduce(lambda a, b: a + b, [difference(i) * difference(i) for i in range(len(feats))]))

    here = lambda i: F.col(feats[i])
    low, high = lambda i: F.get("__lo", F.lit(i)), lambda i: F.get("__hi", F.lit(i))
    below = cells.select(*blocks, "__parent", F.col("__cell").alias("__next"), "__n", "__lo", "__hi").where("__parent IS NOT NULL")

    def within(asked: DataFrame) -> DataFrame:
        """The last cells within reach of each vector, found level by level, with their distance and rows."""
        asked = asked.withColumns({"__at_cell": F.lit(1).cast("bigint"), "__near": F.lit(0.0), "__rows_there": F.lit(None).cast("bigint")})
        for _ in range(depth):
            met = meet(asked, below, "left")
            outside = distance(lambda i: F.greatest(low(i) - here(i), here(i) - high(i), F.lit(0.0)))
            asked = met.withColumns({
                "__near": F.when(F.col("__next").isNull(), F.col("__near")).otherwise(outside),
                "__at_cell": F.coalesce("__next", "__at_cell"), "__rows_there": F.coalesce("__n", "__rows_there"),
            }).where("__near <= __reach").drop("__next", "__n", "__lo", "__hi")
        return asked

    # Few narrow rows with much work each, so they are dealt out first; what follows keeps them in place.
    ask = ask.repartition(int(ask.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__q")

    # Down to the vector's own cell, which may be one without rows: no neighbour is farther than the far side of a cell of k.
    asked = ask.withColumns({"__at_cell": F.lit(1).cast("bigint"), "__reach": F.lit(float("inf"))})
    for _ in range(depth + 1):
        asked = meet(asked, cells.select(*own), "left")
        far = distance(lambda i: F.greatest(here(i) - low(i), high(i) - here(i)))
        down = F.col("__at_cell") * _PARTS + _part(F.get(x, F.col("__axis")), F.col("__edges"))
        reach = F.when(F.col("__n") >= k, F.least("__reach", far)).otherwise(F.col("__reach"))
        asked = asked.withColumns({"__reach": reach, "__at_cell": F.when(F.col("__axis").isNotNull(), down)})
        asked = asked.drop("__n", "__axis", "__edges", "__lo", "__hi")

    # Nor farther than the k-th row of the nearest cell of k.
    nearest = F.min(F.when(F.col("__rows_there") >= k, F.struct("__near", "__at_cell")))["__at_cell"].alias("__at_cell")
    asked = within(asked.drop("__at_cell")).groupBy("__q", *feats, *block_on, "__reach").agg(nearest)
    held = cells.where("__rows IS NOT NULL").select(*blocks, "__cell", "__rows")
    away = F.array_sort(F.transform("__rows", lambda t: distance(lambda i: here(i) - F.get(t["at"], F.lit(i)))))
    asked = meet(asked, held, "left").withColumn("__reach", F.least("__reach", F.get(away, F.lit(k - 1))))

    pairs = meet(within(asked.drop("__rows", "__at_cell")), held).withColumn("__row", F.explode("__rows"))
    apart = distance(lambda i: here(i) - F.get("__row.at", F.lit(i)))
    return pairs.select("__q", "__reach", F.col("__row.id").alias("__id"), F.col("__row.label").alias("__label"), apart.alias("__d"))


# --- flags and audit ----------------------------------------------------------------


def flag_imputed(df: DataFrame) -> DataFrame:
    """True where a cell was null at the snapshot and holds a value now."""
    tests = [F.col(WAS_NULL + c) & F.col(c).isNotNull() for c in snapshot_columns(df)]
    return df.withColumn(FLAG_IMPUTED, any_of(tests) if tests else F.lit(False))


def flag_non_imputable(df: DataFrame, cols: list[str] | None = None, code: str = "VIN") -> DataFrame:
    """True where all categories are null and there is no code to fill them from."""
    cols = [c for c in (cols or CATEGORICAL) if c in df.columns]
    return df.withColumn(FLAG_NON_IMPUTABLE, all_null(cols) & is_blank(code))


def flag_overlap(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col(FLAG_IMPUTED) & F.col(FLAG_NON_IMPUTABLE)).alias("overlap"))


def flag_breakdown(df: DataFrame) -> DataFrame:
    """Rows and share in percent of the three quality classes."""
    row = df.agg(
        F.count_if(is_clean()).alias("clean"),
        F.count_if(F.col(FLAG_IMPUTED)).alias("imputed"),
        F.count_if(F.col(FLAG_NON_IMPUTABLE)).alias("non_imputable"),
        F.count(F.lit(1)).alias("total"),
    )
    cells = [F.struct(F.lit(c).alias("category"), F.col(c).alias("rows")) for c in row.columns[:3]]
    share = F.bround(F.try_divide(F.col("rows"), F.col("total")) * 100, 2)
    return row.select("total", F.inline(F.array(*cells))).select("category", "rows", share.alias("share_pct"))


def quality_label(df: DataFrame, name: str = "DataQuality") -> DataFrame:
    label = F.when(F.col(FLAG_NON_IMPUTABLE), "Non-imputable").when(F.col(FLAG_IMPUTED), "Imputed").otherwise("Clean")
    return df.withColumn(name, label)


def filled_counts(df: DataFrame) -> DataFrame:
    """Cells filled since the snapshot, per column."""
    cols = snapshot_columns(df)
    row = df.agg(*[F.count_if(F.col(WAS_NULL + c) & F.col(c).isNotNull()).alias(c) for c in cols])
    return unfold(row, cols, "column", "filled")


def audit_log(df: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rows changed per rule. `rules` holds (step, rule, marker column); one pass for all."""
    row = df.agg(*[F.count_if(F.col(f"`{mark}`")).alias(f"r{i}") for i, (_, _, mark) in enumerate(rules)])
    cells = [
        F.struct(
            F.lit(i).alias("position"), F.lit(step).alias("step"), F.lit(rule).alias("rule"),
            F.col(f"r{i}").alias("rows"),
        )
        for i, (step, rule, _) in enumerate(rules)
    ]
    return row.select(F.inline(F.array(*cells)))

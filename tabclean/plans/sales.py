"""Plans for the sales table: cleaning, features, and the first simple clean."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cast_int, to_number, to_ts
from ..functions.text import map_values, normalise_enum, title_case
from ..operators import features as feat
from ..operators import impute, repair
from ..operators.filters import FLAG_IMPUTED, FLAG_NON_IMPUTABLE, drop_duplicates, drop_null, quantile_trim, sample_n, sample_pool
from ..sources.staging import stage

TITLE_COLUMNS = ["Make", "Model", "Body", "Color", "Interior", "State", "Trim"]
GROUP_KEYS = ["Make", "Body"]
DRAW_KEYS = ["Make", "Body", "Year"]
MODE_COLUMNS = ["Color", "Interior"]
_MARK = "_hit_"

# Step, rule and marker of the audit, in the order of the plan.
AUDIT_RULES = [
    ("CS-001", "column shift realigned", _MARK + "CS-001"),
    ("CS-002", "make and body split", _MARK + "CS-002"),
    ("MF-001", "model fragments merged", _MARK + "MF-001"),
    ("MK-001", "make alias replaced", _MARK + "MK-001"),
    ("PH-001", "odometer sentinel to null", _MARK + "PH-001"),
    ("PH-002", "color placeholder to null", _MARK + "PH-002-Color"),
    ("PH-002", "interior placeholder to null", _MARK + "PH-002-Interior"),
    ("PH-003", "market value sentinel to null", _MARK + "PH-003"),
    ("IMP-VIN", "make filled from prefix", _MARK + "IMP-VIN"),
    ("IMP-STAT", "color filled", _MARK + "IMP-Color"),
    ("IMP-STAT", "interior filled", _MARK + "IMP-Interior"),
    ("FLAG-IMP", "row flagged as imputed", FLAG_IMPUTED),
    ("FLAG-NONIMP", "row flagged as non-imputable", FLAG_NON_IMPUTABLE),
]


@dataclass(frozen=True)
class CleanConfig:
    """Choices of the cleaning plan.

    strategy: `mode`, `knn`, `conditional`, `knn+conditional` or `none`.
    baseline: `raw` counts only cells null in the raw table as missing before,
    `post_sentinel` also those that held a placeholder.
    prefixes: a table (code, make, body) of your own in place of the built-in one.
    validate_aliases: replace a make's alias only where the prefix of the VIN confirms it.
    """

    strategy: str = "mode"
    baseline: str = "raw"
    keep_marks: bool = False
    seed: int = 42
    knn_sample: int = 50_000
    row_key: str = "Id"
    make_aliases: dict = field(default_factory=lambda: dict(repair.MAKE_ALIASES))
    prefixes: DataFrame | None = None
    validate_aliases: bool = False


@dataclass(frozen=True)
class Learnt:
    """What imputation knows of a table: group counts, value counts and neighbour models by filled column."""

    groups: DataFrame | None = None
    values: dict[str, DataFrame] = field(default_factory=dict)
    neighbours: dict[str, impute.KnnModel] = field(default_factory=dict)


def repair_structure(df: DataFrame) -> DataFrame:
    """Phase 1: shifted rows, joined values, split names."""
    df = repair.realign_shift(df, mark=_MARK + "CS-001")
    df = repair.split_by_lookup(df, mark=_MARK + "CS-002")
    return repair.merge_fragments(df, mark=_MARK + "MF-001")


def standardise(df: DataFrame, aliases: dict[str, str] | None = None, confirm: DataFrame | None = None) -> DataFrame:
    """Phase 2: aliases, case, blanks. With a prefix table `confirm`, only aliases that it confirms."""
    aliases = repair.MAKE_ALIASES if aliases is None else aliases
    if confirm is not None:
        df = repair.apply_aliases_validated(df, confirm, mapping=aliases, mark=_MARK + "MK-001")
    else:
        lowered = F.lower("Make")
        named = {k: v for k, v in aliases.items() if k != v.lower()}
        df = df.withColumns(
            {
                "Make": map_values(lowered, aliases),
                _MARK + "MK-001": F.coalesce(lowered.isin(list(named)), F.lit(False)),
            }
        )
    cols = {c: title_case(c) for c in TITLE_COLUMNS if c in df.columns}
    cols["Transmission"] = normalise_enum("Transmission", repair.TRANSMISSION_ALIASES)
    return df.withColumns(cols)


def null_sentinels(df: DataFrame) -> DataFrame:
    """Phase 3: placeholders become null."""
    sentinels = {
        "Odometer": [repair.NUMERIC_SENTINEL],
        "Color": repair.DASHES,
        "Interior": repair.DASHES,
        "MMR": [repair.NUMERIC_SENTINEL],
    }
    marks = {
        "Odometer": _MARK + "PH-001",
        "Color": _MARK + "PH-002-Color",
        "Interior": _MARK + "PH-002-Interior",
        "MMR": _MARK + "PH-003",
    }
    return repair.sentinel_to_null(df, sentinels, marks)


def before_imputation(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Snapshot and phases 1 to 4: everything up to the statistical imputation. One narrow plan, no shuffle."""
    df = impute.snapshot_missing(df)
    confirm = None
    if config.validate_aliases:
        confirm = impute.prefix_dimension(df.sparkSession) if config.prefixes is None else config.prefixes
    df = null_sentinels(standardise(repair_structure(df), config.make_aliases, confirm))
    if config.baseline == "post_sentinel":
        df = impute.extend_snapshot(df)
    return impute.impute_from_prefix(df, config.prefixes, mark=_MARK + "IMP-VIN")


def clean_sales(df: DataFrame, config: CleanConfig = CleanConfig(), learnt: Learnt | None = None) -> DataFrame:
    """The cleaning plan: repair, standardise, null out, impute, flag.

    What imputation has to know of the whole table comes from `learnt`, else from `df` itself.
    """
    df, learnt = before_imputation(df, config), learnt or Learnt()
    marks = {c: f"{_MARK}IMP-{c}" for c in MODE_COLUMNS}
    missing = {c: F.col(c).isNull() for c in MODE_COLUMNS}
    if config.strategy == "mode" and learnt.groups is not None:
        df = impute.fill_group_mode(df, learnt.groups, MODE_COLUMNS, GROUP_KEYS, marks)
    elif config.strategy == "mode":
        df = impute.impute_group_mode(df, MODE_COLUMNS, GROUP_KEYS, marks)
    else:
        written = "knn" in config.strategy or ("conditional" in config.strategy and not set(MODE_COLUMNS) <= set(learnt.values))
        if written:
            df = stage(df, "repaired")  # learning and searching pass over it several times
        df = df.withColumns({f"__gap_{c}": test for c, test in missing.items()})
        if "knn" in config.strategy:
            models = learnt.neighbours or _neighbours(df, config)
            for c in MODE_COLUMNS:
                df = impute.impute_knn(
                    df, c, row_key=config.row_key, sample=config.knn_sample, seed=config.seed, model=models.get(c), staged=True)
        if "conditional" in config.strategy:
            for c in MODE_COLUMNS:
                counts = learnt.values.get(c)
                if counts is None:
                    counts = impute.value_counts_by(df, c, DRAW_KEYS)
                df = impute.draw_from_counts(df, counts, c, DRAW_KEYS, config.row_key, config.seed, staged=written)
        df = df.withColumns({marks[c]: F.col(f"__gap_{c}") & F.col(c).isNotNull() for c in MODE_COLUMNS})
        df = df.drop(*[f"__gap_{c}" for c in MODE_COLUMNS])
    df = impute.flag_non_imputable(impute.flag_imputed(df))
    if config.keep_marks:
        return df
    return drop_marks(impute.drop_snapshot(df))


def _neighbours(df: DataFrame, config: CleanConfig) -> dict[str, impute.KnnModel]:
    """A neighbour model for each column to fill: they share all but the sample, and the samples are drawn in one pass."""
    numeric, categorical = impute.KNN_NUMERIC, impute.KNN_CATEGORICAL
    narrow = df.select(config.row_key, *numeric, *categorical, *MODE_COLUMNS)
    shared = impute.knn_features(narrow, numeric, categorical)
    pool = sample_pool(narrow, config.knn_sample, config.row_key, MODE_COLUMNS, config.seed)
    return {
        c: replace(shared, train=sample_n(pool.where(F.col(c).isNotNull()), config.knn_sample, config.row_key, config.seed))
        for c in MODE_COLUMNS
    }


def drop_marks(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_MARK)])


def audit(marked: DataFrame) -> DataFrame:
    """Rows changed per rule; `marked` comes from `clean_sales` with `keep_marks`."""
    return impute.audit_log(marked, AUDIT_RULES)


def add_features(df: DataFrame) -> DataFrame:
    df = feat.add_vehicle_age(feat.add_calendar_parts(df))
    return feat.add_above_market(feat.add_price_diff(df)).withColumn("PriceBand", feat.price_band())


def prepare_sales(df: DataFrame, shift: str = "realign", trim: bool = True, columns: list[str] | None = None) -> DataFrame:
    """The table the reports read: dated and priced rows, price outliers cut, case fixed, features added.

    shift: `realign` moves shifted values back, `replace` only patches the transmission.
    columns: those that a report reads. They are written once, and the cut and the report's own
    passes read what is written; the sources are read once.
    """
    if shift == "realign":
        df = repair.realign_shift_keep(df)
    else:
        df = repair.replace_values(df, "Transmission", {v: "automatic" for v in repair.SHIFTED_VALUES})
    df = drop_null(df.withColumn("SaleDate", to_ts("SaleDate")), ["SaleDate", "SellingPrice", "MMR"])
    cased = {c: title_case(c) for c in ["Make", "Model", "Body", "Color", "Interior", "State"] if c in df.columns}
    df = df.withColumns(cased | {"Transmission": normalise_enum("Transmission")})
    df = add_features(df)
    if columns is not None:
        df = stage(df.select(*dict.fromkeys([*columns, "SellingPrice"])), "prepared")
    if trim:
        df = quantile_trim(df, "SellingPrice", 0.01, 0.99)
    return df if columns is None else df.select(*dict.fromkeys(columns))


def repair_complete(df: DataFrame) -> DataFrame:
    """The repair script as one plan: shift, suffix, makes, fragments with trim, models, dashes, sentinel, features."""
    df = repair.split_by_regex(repair.realign_shift_keep(df))
    df = repair.merge_fragments_trim(repair.apply_aliases(df, "Make", repair.MAKE_ALIASES))
    df = repair.apply_aliases(df, "Model", repair.MODEL_ALIASES)
    df = repair.null_placeholder_all(df, repair.DASHES)
    return prepare_sales(repair.sentinel_to_null(df, {"Odometer": [repair.NUMERIC_SENTINEL]}))


# Columns of the exported main table, in order.
EXPORT_COLUMNS = [
    "Id", "Year", "Make", "Model", "Trim", "Body", "Transmission", "State", "ConditionValue", "Odometer",
    "Color", "Interior", "MMR", "SellingPrice", "SaleDate", "SaleYear", "SaleMonth", "SaleQuarter",
    "VehicleAge", "PriceDiff", "PriceDiffPct", "AboveMMR", "PriceBand",
]

DESCRIPTIONS = {
    "Id": "Key of the sale",
    "Year": "Model year",
    "Make": "Manufacturer",
    "Model": "Model name",
    "Trim": "Trim level",
    "Body": "Body type",
    "Transmission": "automatic or manual",
    "State": "State code",
    "ConditionValue": "Condition score, 1 to 50",
    "Odometer": "Mileage when sold",
    "Color": "Outer color",
    "Interior": "Inner color",
    "MMR": "Market value",
    "SellingPrice": "Price paid",
    "SaleDate": "Time of sale",
    "SaleYear": "Year of sale",
    "SaleMonth": "Month of sale, YYYY-MM",
    "SaleQuarter": "Quarter of sale, YYYYQn",
    "VehicleAge": "Years from model year to sale",
    "PriceDiff": "Price minus market value",
    "PriceDiffPct": "Price difference in percent of the market value",
    "AboveMMR": "Sold above the market value",
    "PriceBand": "Price class",
}


def first_clean(df: DataFrame) -> DataFrame:
    """The earliest and simplest plan: types, case, duplicates, ranges, constant and median fills."""
    numbers = ["Odometer", "SellingPrice", "MMR", "ConditionValue"]
    cased = ["Make", "Model", "Trim", "Body", "Color", "Interior", "Seller"]
    df = df.withColumns(
        {"Year": cast_int("Year"), "SaleDate": to_ts("SaleDate")}
        | {c: to_number(c) for c in numbers}
        | {c: title_case(c) for c in cased}
        | {"State": F.upper(title_case("State"))}
    )
    # Equal rows pass the same tests, so these come first; written once, since telling repeats apart and the
    # median pass over the rows.
    df = stage(df.where(F.col("Odometer").between(0, 300_000) & (F.col("SellingPrice") > 100)), "typed")
    df = repair.fill_median(drop_duplicates(df), ["Odometer"])
    return repair.fill_const(df, {"Color": "Unknown", "Interior": "Unknown", "Trim": "Base", "Body": "Other"})

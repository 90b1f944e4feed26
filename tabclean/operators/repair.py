"""Repair of structural errors and standardisation.

Every function returns a new DataFrame. `mark` names a boolean column that records
for each row whether the rule changed it, so an audit needs no second pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_of, icontains, imatches, map_values, strip
from .joins import lookup_join, one_per_key, prefix_rows
from .profile import melt, string_columns
from .quantile import group_quantiles, median_value

# Fixed values of the sales data.
SHIFTED_VALUES = ["sedan", "Sedan"]
MAKE_BODY = {
    "ford truck": ("Ford", "Truck"),
    "gmc truck": ("GMC", "Truck"),
    "chev truck": ("Chevrolet", "Truck"),
    "chev tk": ("Chevrolet", "Truck"),
    "ford tk": ("Ford", "Truck"),
    "dodge tk": ("Dodge", "Truck"),
    "mazda tk": ("Mazda", "Truck"),
    "hyundai tk": ("Hyundai", "Truck"),
}
MAKE_ALIASES = {
    "vw": "Volkswagen",
    "dot": "Dodge",
    "mercedes-b": "Mercedes-Benz",
    "mercedes-benz": "Mercedes-Benz",
    "chev": "Chevrolet",
    "chevy": "Chevrolet",
}
MODEL_ALIASES = {
    "rangerover": "Range Rover",
    "rr": "Range Rover",
    "rrs": "Range Rover Sport",
    "lr3": "LR3",
}
TRANSMISSION_ALIASES = {"auto": "automatic", "man": "manual"}
DASHES = ["---", "—", "–", "———"]
NUMERIC_SENTINEL = 999999


def _marked(df: DataFrame, mark: str | None, hit: Column) -> dict[str, Column]:
    return {mark: F.coalesce(hit, F.lit(False))} if mark else {}


def realign_shift(
    df: DataFrame,
    when: Column | None = None,
    moves: dict[str, str] | None = None,
    literals: dict[str, str] | None = None,
    clear: list[str] | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Move values back to their columns where a row was shifted. All reads see the old row."""
    hit = F.col("Transmission").isin(SHIFTED_VALUES) if when is None else when
    moves = {"Transmission": "VIN", "VIN": "State"} if moves is None else moves
    literals = {"Body": "Sedan"} if literals is None else literals
    clear = ["State", "ConditionValue"] if clear is None else clear
    new = {target: F.col(source) for target, source in moves.items()}
    new |= {target: F.lit(value) for target, value in literals.items()}
    new |= {c: F.lit(None) for c in clear}
    cols = {c: F.when(hit, value).otherwise(F.col(c)) for c, value in new.items()}
    return df.withColumns(cols | _marked(df, mark, hit))


def realign_shift_keep(df: DataFrame, mark: str | None = None) -> DataFrame:
    """As `realign_shift`, with the condition score kept."""
    return realign_shift(df, clear=["State"], mark=mark)


def replace_values(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    return df.withColumn(col, map_values(col, mapping))


def split_by_lookup(
    df: DataFrame,
    col: str = "Make",
    second: str = "Body",
    table: dict[str, tuple[str, str]] | DataFrame | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Split a concatenated value with a table of its lower-cased spelling.

    `table` is a short mapping, or a DataFrame (raw, first, second) for a long one; of rows
    with the same lower-cased `raw` the smallest counts.
    """
    if isinstance(table, DataFrame):
        dim = one_per_key(table.toDF("__raw", "__first", "__second").withColumn("__raw", F.lower("__raw")), ["__raw"])
        out = lookup_join(df.withColumn("__raw", F.lower(F.col(col))), dim, ["__raw"])
        hit = F.col("__first").isNotNull()
        cols = {
            col: F.coalesce(F.col("__first"), F.col(col)),
            second: F.when(hit, F.col("__second")).otherwise(F.col(second)),
        }
        return out.withColumns(cols | _marked(df, mark, hit)).drop("__raw", "__first", "__second")
    table = table or MAKE_BODY
    raw = F.lower(F.col(col))
    hit = raw.isin(list(table))
    first = map_values(raw, {k: v[0] for k, v in table.items()}, keep_others=False)
    rest = map_values(raw, {k: v[1] for k, v in table.items()}, keep_others=False)
    cols = {
        col: F.coalesce(first, F.col(col)),
        second: F.when(hit, rest).otherwise(F.col(second)),
    }
    return df.withColumns(cols | _marked(df, mark, hit))


def split_by_regex(
    df: DataFrame, col: str = "Make", second: str = "Body", suffix: str = " (truck|tk)$", value: str = "Truck",
    mark: str | None = None,
) -> DataFrame:
    """Cut a suffix off and set the second column to `value`; case is ignored."""
    hit = imatches(col, suffix)
    cols = {
        col: F.regexp_replace(col, "(?iu)" + suffix, ""),
        second: F.when(hit, value).otherwise(F.col(second)),
    }
    return df.withColumns(cols | _marked(df, mark, hit))


def merge_fragments(
    df: DataFrame,
    col: str = "Model",
    rest: str = "Trim",
    first_part: str = "range",
    rest_part: str = "rover",
    joined: str = "rangerover",
    short: tuple[str, ...] = ("rr", "RR", "rrs", "RRS"),
    merged: str = "Range Rover",
    mark: str | None = None,
) -> DataFrame:
    """Give one spelling to a name that was split over two columns, joined or abbreviated."""
    lowered = F.lower(F.col(col))
    hit = any_of(
        [(lowered == first_part) & icontains(rest, rest_part), lowered == joined, F.col(col).isin(list(short))]
    )
    return df.withColumns({col: F.when(hit, merged).otherwise(F.col(col))} | _marked(df, mark, hit))


def merge_fragments_trim(
    df: DataFrame,
    col: str = "Model",
    rest: str = "Trim",
    first_part: str = "range",
    rest_part: str = "rover",
    merged: str = "Range Rover",
    mark: str | None = None,
) -> DataFrame:
    """Merge on the first part alone and take the second part out of the other column."""
    hit = F.lower(F.col(col)) == first_part
    left_over = strip(F.regexp_replace(rest, rf"(?iu)^{rest_part}\s*", ""))
    cols = {
        col: F.when(hit, merged).otherwise(F.col(col)),
        rest: F.when(hit, left_over).otherwise(F.col(rest)),
    }
    return df.withColumns(cols | _marked(df, mark, hit))


def apply_aliases(df: DataFrame, col: str, mapping: dict[str, str] | DataFrame, mark: str | None = None) -> DataFrame:
    """Replace a value whose lower-cased form is listed.

    A long list comes as DataFrame (raw, value); of rows with the same lower-cased `raw` the
    smallest counts.
    """
    raw = F.lower(F.col(col))
    if isinstance(mapping, DataFrame):
        dim = one_per_key(mapping.toDF("__raw", "__alias").withColumn("__raw", F.lower("__raw")), ["__raw"])
        df = lookup_join(df.withColumn("__raw", raw), dim, ["__raw"])
        new = F.col("__alias")
    else:
        new = map_values(raw, mapping, keep_others=False)
    hit = new.isNotNull() & ~new.eqNullSafe(F.col(col))
    cols = {col: F.coalesce(new, F.col(col))} | _marked(df, mark, hit)
    return df.withColumns(cols).drop("__raw", "__alias")


def apply_aliases_validated(
    df: DataFrame, dim: DataFrame, col: str = "Make", code: str = "VIN", mapping: dict[str, str] | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Replace an alias only where the prefix of the code leads to the same name.

    `dim` holds rows (code, make, body); of rows with the same code the smallest counts.
    """
    new = map_values(F.lower(F.col(col)), mapping or MAKE_ALIASES, keep_others=False)
    prefix = F.when(new.isNotNull() & (F.length(code) >= 3), F.upper(F.substring(code, 1, 3)))
    dim = prefix_rows(dim).select(F.col("code").alias("__code"), F.col("make").alias("__expected"))
    out = lookup_join(df.withColumn("__code", prefix), dim, ["__code"])
    hit = F.lower("__expected") == F.lower(new)
    cols = {col: F.when(hit, new).otherwise(F.col(col))} | _marked(df, mark, hit)
    return out.withColumns(cols).drop("__code", "__expected")


def sentinel_to_null(df: DataFrame, sentinels: dict[str, list], marks: dict[str, str] | None = None) -> DataFrame:
    """Null out placeholder values; text is compared as it is and without outer blanks."""
    text = set(string_columns(df))
    cols = {}
    for c, values in sentinels.items():
        hit = F.col(c).isin(values)
        if c in text:
            hit = hit | strip(c).isin(values)
        cols[c] = F.when(~F.coalesce(hit, F.lit(False)), F.col(c))
        cols |= _marked(df, (marks or {}).get(c), hit)
    return df.withColumns(cols)


def null_placeholder_all(df: DataFrame, tokens: list[str]) -> DataFrame:
    return df.withColumns(
        {c: F.when(~F.coalesce(F.col(c).isin(tokens), F.lit(False)), F.col(c)) for c in string_columns(df)}
    )


def repair_null_text(df: DataFrame, cols: list[str], texts: tuple[str, ...] = ("Nan", "nan", "None")) -> DataFrame:
    """Null again where a cast to text had turned null into a word."""
    return df.withColumns({c: F.when(~F.col(c).isin(list(texts)), F.col(c)) for c in cols})


def fill_const(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def fill_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill nulls with the exact median of the column. The medians of all columns take one pass."""
    if len(cols) == 1:
        return df.withColumn(cols[0], F.coalesce(F.col(cols[0]), median_value(df, cols[0])))
    cells = group_quantiles(melt(df, cols), ["column"], "value", [0.5], ["m"])
    medians = dict(cells.collect())  # one row per column
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians.get(c)).cast("double")) for c in cols})


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add absent columns with a default value."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})

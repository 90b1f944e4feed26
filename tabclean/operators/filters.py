"""Row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import DRAW_BITS, draw
from ..functions.text import any_of
from ..sources.staging import stage
from .joins import bounded
from .quantile import approx_quantiles, quantile_values

FLAG_IMPUTED = "_flag_imputed"
FLAG_NON_IMPUTABLE = "_flag_non_imputable"


def isin(c: str, values: list) -> Column:
    """Membership; null counts as false."""
    return F.coalesce(F.col(c).isin(values), F.lit(False))


def facet_filter(
    df: DataFrame,
    makes: list[str] | None = None,
    bodies: list[str] | None = None,
    states: list[str] | None = None,
    transmissions: list[str] | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Keep rows that pass every facet in use; an empty facet does not filter."""
    facets = {"Make": makes, "Body": bodies, "State": states, "Transmission": transmissions}
    for name, wanted in facets.items():
        if wanted:
            df = df.where(F.col(name).isin(list(wanted)))
    if years:
        df = df.where(F.col("Year").between(*years))
    return df


def is_clean() -> Column:
    return ~F.col(FLAG_IMPUTED) & ~F.col(FLAG_NON_IMPUTABLE)


def quality_filter(df: DataFrame, kinds: list[str] | None) -> DataFrame:
    """Rows of the given quality classes (`clean`, `imputed`, `non_imputable`); none given keeps all."""
    tests = {
        "clean": is_clean(),
        "imputed": F.col(FLAG_IMPUTED),
        "non_imputable": F.col(FLAG_NON_IMPUTABLE),
    }
    chosen = [test for kind, test in tests.items() if kind in (kinds or [])]
    return df.where(any_of(chosen)) if chosen else df


def drop_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def split_repeated(df: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The rows that certainly have no equal, and the others; None where the others are too many to tell apart so.

    Only fingerprints of 64 bits are shuffled; those that come more than once go out to all
    tasks if their table is small. Different rows that share one are compared with the others, no
    more: among 10 billion rows there are about three such pairs. `df` is read three times, so it
    should be written or cheap.
    """
    a = next(n for n in ("__a" + "_" * i for i in range(99)) if n not in df.columns)
    marked = df.withColumn(a, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    counts = marked.groupBy(a).agg(F.count(F.lit(1)).alias("n"))
    again = stage(counts.where("n > 1").select(F.col(a).alias("same_a")), "repeats")
    if not bounded(again):
        return None
    same = F.col(a) == F.col("same_a")
    return tuple(marked.join(F.broadcast(again), same, how).drop(a) for how in ("left_anti", "left_semi"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of equal rows. Rows without an equal are not moved where repeats are few."""
    parts = split_repeated(df)
    return df.dropDuplicates() if parts is None else parts[0].unionByName(parts[1].dropDuplicates())


def quantile_trim(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99, approximate: bool = False) -> DataFrame:
    """Keep rows between two quantiles, both included. Exact unless `approximate`."""
    if approximate:
        low, high = approx_quantiles(df, [], col, [lo, hi], ["q0", "q1"]).first()
    else:
        low, high = quantile_values(df, col, [lo, hi])
    return df.where(F.col(col).between(F.lit(low), F.lit(high)))


_BIN_BITS = 10


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """min(n, count) rows, the same for every partitioning; rows with a null key are drawn alike.

    Rows are ranked by a number drawn from their key. Two histograms of the leading bits
    of the draws, of 1,024 bins and of as many within one of them, give a bound that
    leaves n rows and at most a millionth of the table besides; only these last rows are
    sorted, to find the draw and key at which the sample ends. The rest is a filter.
    """
    drawn = df.withColumn("__draw", draw(key, "sample", seed))
    low, shift, before = 0, DRAW_BITS, 0
    for _ in range(2):
        shift -= _BIN_BITS
        inside = drawn.where(F.col("__draw").between(low, low + (1 << (shift + _BIN_BITS)) - 1))
        at = F.shiftright("__draw", shift)
        before, found = _reaches(inside.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")), n, before)
        if found is None:
            return drawn.drop("__draw")  # no more than n rows in all
        low = found << shift
    last = drawn.where(F.col("__draw").between(low, low + (1 << shift) - 1))
    place = F.struct(F.col("__draw").alias("d"), F.col(key).isNotNull().alias("k"), F.col(key).alias("key"))
    ends = last.select(place.alias("at")).orderBy("at").limit(n - before).groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    end = ends.agg(F.max(F.struct("at", "n")).alias("end")).first()["end"]
    if end is None:
        return drawn.where(F.col("__draw") < low).drop("__draw")
    kind = drawn.schema[key].dataType
    is_null = F.col(key).isNull()
    value = F.lit(end["at"]["key"]).cast(kind)
    here = F.col("__draw") == end["at"]["d"]
    equal = here & (is_null if end["at"]["key"] is None else F.coalesce(F.col(key) == value, F.lit(False)))
    smaller = F.lit(False) if end["at"]["key"] is None else (is_null | (F.col(key) < value))
    sure = drawn.where((F.col("__draw") < end["at"]["d"]) | (here & smaller))
    # Rows equal in key are as good as each other.
    return sure.unionByName(drawn.where(equal).limit(end["n"])).drop("__draw")


def sample_pool(df: DataFrame, n: int, key: str, cols: list[str], seed: int = 42) -> DataFrame:
    """Rows of `df`, written, among which is every row that `sample_n` draws of those with a value in one of `cols`.

    All rows up to a draw are kept, the whole table if it takes that for n values of each column. So several
    samples of a large table take one pass over it, or another if a column has few values.
    """
    slots, total = 1 << DRAW_BITS, df.count()
    upto = slots if total <= 4 * n else slots * 2 * n // total
    while True:
        pool = stage(df if upto >= slots else df.where(draw(key, "sample", seed) < upto), "pool")
        if upto >= slots or min(pool.agg(*[F.count(c) for c in cols]).first()) >= n:
            return pool
        upto *= 8


def _reaches(hist: DataFrame, n: int, seen: int) -> tuple[int, int | None]:
    """Rows before the bin in which a running count from `seen` on reaches n, and that bin. At most 1,024 bins."""
    for row in hist.orderBy("at").collect():
        if seen + row["n"] >= n:
            return seen, row["at"]
        seen += row["n"]
    return seen, None


def facet_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def bounds(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))

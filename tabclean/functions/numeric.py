"""Number and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def to_number(c: Column | str) -> Column:
    """Double, or null when the text is no number; NaN becomes null as well."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_ts(c: Column | str, fmt: str | None = None) -> Column:
    """Timestamp, or null when the text is no date."""
    return F.try_to_timestamp(col(c), F.lit(fmt)) if fmt else col(c).try_cast("timestamp_ntz")


def cast_int(c: Column | str) -> Column:
    """Strict: a value that is no integer stops the query."""
    return col(c).cast("int")


def clip_upper(c: Column | str, hi: float) -> Column:
    """At most `hi`; null stays null (`least` alone would turn it into `hi`)."""
    return F.when(col(c) > hi, F.lit(hi)).otherwise(col(c))


def cut(c: Column | str, edges: list[float], labels: list[str], missing_label: str | None = None) -> Column:
    """Label of the band `(lo, hi]` holding the value; outside all bands null or `missing_label`."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    x = col(c)
    out = F.when(x <= edges[0], F.lit(missing_label))
    for hi, label in zip(edges[1:], labels):
        out = out.when(x <= hi, F.lit(label))
    return out.otherwise(F.lit(missing_label))


def tier(c: Column | str, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose threshold the value exceeds; thresholds go from high to low."""
    x = col(c)
    out = None
    for threshold, label in cuts:
        out = F.when(x > threshold, label) if out is None else out.when(x > threshold, label)
    return F.when(x.isNotNull(), out.otherwise(otherwise))


def sign_class(c: Column | str, above: str = "above", below: str = "below") -> Column:
    """`above` when positive, else `below`; null compares as not positive."""
    return F.when(col(c) > 0, above).otherwise(below)


def rescale_dual(c: Column | str, small_max: float = 5, factor: float = 10) -> Column:
    """Bring values given on a short scale up to the long one."""
    return F.when(col(c) <= small_max, col(c) * factor).otherwise(col(c))


def pct_diff(value: Column | str, base: Column | str) -> Column:
    """Difference in percent of the base; null when the base is 0."""
    return F.try_divide(col(value) - col(base), col(base)) * 100


def month_of(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def quarter_of(c: Column | str) -> Column:
    return F.concat(F.year(col(c)).cast("string"), F.lit("Q"), F.quarter(col(c)).cast("string"))


def tenure_years(c: Column | str, ref: str) -> Column:
    """Whole years up to `ref`, halves to even."""
    return F.bround(F.datediff(F.to_date(F.lit(ref)), col(c)) / F.lit(365.25), 0).cast("int")


DRAW_BITS = 60


def draw(key: Column | str, purpose: str, seed: int = 42) -> Column:
    """A repeatable pseudo-random integer of `DRAW_BITS` bits from key, purpose and seed.

    The leading digits of an MD5 hash of their texts: any type of key will do, draws of
    different purposes are independent, and near keys are as far apart as others. A null
    key draws like an empty text.
    """
    text = F.concat(F.lit(f"{seed}|{purpose}|"), F.coalesce(col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def unit_draw(key: Column | str, purpose: str, seed: int = 42) -> Column:
    """`draw` scaled to [0, 1). Does not depend on the partitioning."""
    return draw(key, purpose, seed) / F.lit(float(1 << DRAW_BITS))

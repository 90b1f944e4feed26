"""Exact quantiles that never gather a group in one task.

`percentile` keeps every distinct value of a group in one buffer. Here the value
range is narrowed first: a histogram on logarithmic buckets (a small table after
map-side combining) tells which bucket holds each wanted rank; only rows of those
buckets are looked at again, on a finer grid, and only the values of single grid
cells are finally ranked, after as many further grids as it takes until no cell holds
many different values. Results are exact for doubles: linear interpolation between the
two neighbouring ranks. Other numbers are taken as doubles, so whole numbers beyond 2**53
and long decimals count as the nearest double.

So a quantile reads the table once, writes keys and value, reads those twice and shuffles
next to nothing. The passes run when the plan is built; what they write is in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .joins import MAX_BROADCAST_BYTES, bounded, keys_present

_PER_OCTAVE = 64
_CELLS = 4096
# Different values of a cell that are ranked in one task.
CELL_VALUES = 100_000
# Lifts the smallest exponent of a double above zero, so that buckets keep their sign.
_LIFT = 1075 * _PER_OCTAVE + 1


def _log_bucket(x: str) -> str:
    """A bucket number that never decreases as x grows; buckets are about 1 % wide."""
    step = f"(floor(least(log2(abs({x})), 1025.0e0) * {_PER_OCTAVE}) + {_LIFT})"
    return f"CASE WHEN {x} > 0 THEN {step} WHEN {x} < 0 THEN -{step} ELSE 0L END"


def _cell(x: str, lo: str, hi: str) -> str:
    at = f"least(floor(({x} - {lo}) / ({hi} - {lo}) * {_CELLS}), {_CELLS - 1}L)"
    return f"CASE WHEN {hi} > {lo} THEN {at} ELSE 0L END"


def _position(p: float) -> str:
    return f"({float(p)!r}D * (__total - 1))"


def _holds(rank: str) -> str:
    return f"({rank} >= __start AND {rank} < __start + __n)"


def _wanted(probs: list[float]) -> str:
    """Whether the ranks from `__start` on, `__n` of them, include one that is asked for."""
    return " OR ".join(_holds(f"{side}{_position(p)}") for p in probs for side in ("floor", "ceil"))


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: Column | str,
    probs: list[float],
    names: list[str],
) -> DataFrame:
    """One row per group with the exact quantiles of the non-null values.

    Rows with a null key are left out. Without keys the result is one row, null on
    empty input. The bytes of the histogram decide whether buckets are broadcast.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    fact = df.select(*keys, x.alias("__x")).where("__x IS NOT NULL AND NOT isnan(__x)")
    if keys:
        fact = fact.where(keys_present(keys))
    # Written narrow: both passes read it, and not what `df` is computed from.
    fact = stage(fact, "fact").selectExpr("*", f"{_log_bucket('__x')} AS __b")

    counts = [F.expr("count(1) AS __n"), F.expr("min(__x) AS __lo"), F.expr("max(__x) AS __hi")]
    hist = stage(fact.groupBy(*keys, "__b").agg(*counts), "hist")
    return quantiles_from(hist, lambda wanted: fact, keys, probs, names)


def bucketed(df: DataFrame, value: str) -> DataFrame:
    """`df` with the value as `__x` and its bucket as `__b`, both null where there is no number."""
    x = F.col(value).cast("double")
    df = df.withColumn("__x", F.when(~F.isnan(x), x))
    return df.selectExpr("*", f"CASE WHEN __x IS NOT NULL THEN {_log_bucket('__x')} END AS __b")


def quantiles_from(
    hist: DataFrame, rows: Callable[[DataFrame], DataFrame], keys: list[str], probs: list[float], names: list[str]
) -> DataFrame:
    """`group_quantiles` by a histogram (keys, __b, __n, __lo, __hi) known before, written already.

    `rows` gives the rows (keys, __x, __b), with those of the wanted (keys, __b) among them.
    """
    # At most two buckets or cells per quantile and group are wanted, and the histogram has a row for each group.
    small = bounded(hist, MAX_BROADCAST_BYTES // (2 * len(probs)))
    quoted = [f"`{k}`" for k in keys]

    def hint(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if small else frame

    def over(*part: str) -> str:
        return "PARTITION BY " + ", ".join([*quoted, *part] or ["0"])

    # A cell is named by the number of values of its group below it.
    start = "__start + sum(__n) OVER ({} ORDER BY {} ROWS UNBOUNDED PRECEDING) - __n AS __start"
    wanted = (
        hist.withColumn("__start", F.lit(0))
        .selectExpr(*quoted, "__b", "__lo", "__hi", "__n", start.format(over(), "__b"), f"sum(__n) OVER ({over()}) AS __total")
        .where(_wanted(probs))
        .drop("__n")
    )
    found = rows(wanted).withColumn("__k", F.lit(1).cast("bigint"))
    if not small:  # a frequent value is one row before it is shuffled to its bucket
        found = found.groupBy(*keys, "__b", "__x").agg(F.sum("__k").alias("__k"))
    counts = [F.expr("sum(__k) AS __n"), F.expr("min(__total) AS __total")]
    values = found.join(hint(wanted.drop("__lo", "__hi")), [*keys, "__b"]).groupBy(*keys, "__start", "__x").agg(*counts)
    values = stage(values, "values")
    wanted = wanted.select(*keys, "__start", "__lo", "__hi")
    while True:
        most = values.groupBy(*keys, "__start").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0]
        if (most or 0) <= CELL_VALUES:
            break
        celled = values.join(hint(wanted), [*keys, "__start"]).selectExpr("*", f"{_cell('__x', '__lo', '__hi')} AS __c")
        sizes = [F.expr("sum(__n) AS __n"), F.expr("min(__total) AS __total"), F.expr("min(__x) AS __lo"), F.expr("max(__x) AS __hi")]
        cells = (
            celled.groupBy(*keys, "__start", "__c")
            .agg(*sizes)
            .selectExpr(*quoted, "__start AS __above", "__c", "__n", "__total", "__lo", "__hi", start.format(over("__start"), "__c"))
            .where(_wanted(probs))
        )
        cells = stage(cells.select(*keys, "__above", "__c", "__start", "__lo", "__hi"), "cells")
        celled = celled.drop("__lo", "__hi").withColumnRenamed("__start", "__above")
        values = stage(celled.join(hint(cells.drop("__lo", "__hi")), [*keys, "__above", "__c"]).drop("__above", "__c"), "values")
        wanted = cells.drop("__above", "__c")

    ranked = values.selectExpr(*quoted, "__x", "__n", "__total", start.format(over("__start"), "__x"))
    picks = [
        F.expr(f"max(CASE WHEN {_holds(f'{side}{_position(p)}')} THEN __x END) AS __{side}{i}")
        for i, p in enumerate(probs) for side in ("floor", "ceil")
    ]
    found = ranked.groupBy(*keys).agg(F.expr("max(__total) AS __total"), *picks)
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        part = f"({_position(p)} - floor{_position(p)})"
        out.append(f"CASE WHEN __floor{i} = __ceil{i} THEN __floor{i} ELSE __floor{i} * (1 - {part}) + __ceil{i} * {part} END AS `{name}`")
    return found.selectExpr(*quoted, *out)


def group_median(
    df: DataFrame, keys: list[str], value: Column | str, name: str
) -> DataFrame:
    return group_quantiles(df, keys, value, [0.5], [name])


def quantile_values(df: DataFrame, value: Column | str, probs: list[float]) -> list[float | None]:
    """The quantiles of a whole column as numbers, so that filters on them reach the scan."""
    names = [f"q{i}" for i in range(len(probs))]
    return list(group_quantiles(df, [], value, probs, names).first())


def median_value(df: DataFrame, value: Column | str) -> Column:
    """The median of a whole column as a literal."""
    return F.lit(quantile_values(df, value, [0.5])[0]).cast("double")


def approx_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float], names: list[str], accuracy: int = 10_000
) -> DataFrame:
    """One pass over the data, ranks off by at most 1/accuracy. Offered where exactness is not needed."""
    cols = [F.percentile_approx(value, p, accuracy).alias(n) for p, n in zip(probs, names)]
    source = df.where(keys_present(keys)) if keys else df
    return source.groupBy(*keys).agg(*cols)

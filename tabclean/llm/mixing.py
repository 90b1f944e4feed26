"""Mixing sources to target weights by Sainte-Laguë quotas of equal-token blocks.

The mix is counted in blocks of equally many words. Sources get blocks by the highest
quotients of their targets (1, 3, 5, ... as divisors), and the shards of a source get the
source's blocks by the highest quotients of their sizes. A shard's documents lie on a line
in a seeded order; the line is cut into blocks, and blocks are chosen in a seeded order
until the shard's quota is met, after as many full passes as fit. Only DataFrame functions
are used; sources and shards are spread by document, so a hot source is no hot task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.staging import stage
from .words import WORD

#: No document and no source is taken more often than this.
MOST_PASSES = 3
#: The mix is cut into at most so many blocks, so quotas are right to a millionth of it.
BLOCKS = 1 << 20
#: Documents a shard holds on average; there are at least `LEAST_SHARDS` of each source.
SHARD_DOCS, LEAST_SHARDS = 65_536, 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _drawn(seed: int, *parts: Column) -> Column:
    """A text that orders rows at random, alike in every run."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))


def targets(sources: DataFrame, pattern: tuple[int, ...] = (1, 2, 3), most: int = MOST_PASSES) -> DataFrame:
    """`sources` (name, words), one row each, with `rank`, `weight` and `target`.

    Weights repeat `pattern` in code-point order of the names, null last. All words are
    shared by weight; what exceeds `most` times a source's words is shared among the rest.
    With sources in order of words per weight, the first that keeps its share sets the
    level for all after it.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("name").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in pattern]), F.pmod(F.col("rank") - 1, F.lit(len(pattern))) + 1)
    cap = F.col("words") * most
    ranked = ranked.withColumn("weight", weight)
    order = Window.orderBy(F.col("words") / F.col("weight"), "rank")
    everything, rest = Window.partitionBy(), order.rowsBetween(0, Window.unboundedFollowing)
    below = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (F.sum("words").over(everything) - below) / F.sum("weight").over(rest)
    keeps = F.when(level <= cap / F.col("weight"), level)
    out = ranked.withColumn("level", keeps)  # falls from the first that keeps its share on
    out = out.withColumn("level", F.max("level").over(everything))
    return out.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.coalesce("level", F.lit(0.0)))).drop("level")


def sainte_lague(parts: DataFrame, group: list[str], part: str, weight: str, seats: str) -> DataFrame:
    """`parts` with `quota`: the `seats` of each group go to the highest quotients weight / (2k + 1).

    Rounding the exact shares gives all but a few seats; the missing or excess ones are
    settled by the quotients next in line. With S parts and H seats a part can gain or lose
    at most share * (difference + S) / H + 1 of these, so few quotients are listed. Ties go
    to the smaller `part`. Groups without weight get no seats.
    """
    all_of = Window.partitionBy(*group)
    share = F.coalesce(F.try_divide(F.col(weight) * F.col(seats), F.sum(weight).over(all_of)), F.lit(0.0))
    base = parts.withColumn("__share", share).withColumn("__base", F.floor(F.col("__share") + 0.5))
    base = base.withColumn("__left", F.when(F.sum(weight).over(all_of) > 0, F.col(seats) - F.sum("__base").over(all_of)).otherwise(0))
    few = F.col("__share") * (F.abs("__left") + F.count(F.lit(1)).over(all_of)) / F.greatest(F.col(seats), F.lit(1))
    base = stage(base.withColumn("__few", F.ceil(few) + 2), "seats")
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__few"))).alias("__j")
    listed = base.where("__left <> 0").select(*group, part, weight, "__base", "__left", step)
    turn = F.when(F.col("__left") > 0, F.col("__base") + F.col("__j")).otherwise(F.col("__base") - 1 - F.col("__j"))
    listed = listed.withColumn("__turn", turn).where("__turn >= 0").withColumn("__q", F.col(weight) / (2 * F.col("__turn") + 1))
    sign = F.signum("__left")
    place = F.row_number().over(all_of.orderBy((sign * F.col("__q")).desc(), (sign * F.col(part)).asc(), "__turn"))
    moved = listed.withColumn("__place", place).where("__place <= abs(__left)")
    moved = moved.groupBy(*group, part).agg(F.sum(F.signum("__left")).cast("long").alias("__moved"))
    out = base.join(moved, [*group, part], "left")
    return out.withColumn("quota", F.col("__base") + F.coalesce("__moved", F.lit(0))).drop(
        "__share", "__base", "__left", "__few", "__moved"
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1,
    pattern: tuple[int, ...] = (1, 2, 3), blocks: int = BLOCKS,
) -> DataFrame:
    """One row per row of `docs`: `id_col`, size, source_size, target, taken.

    A size is the number of runs without ASCII white space (null: 0); `targets` gives each
    source's target, and `taken` the words of the document in the mix, repeats counted, at
    most three times its size. The taken words of a source are within about two blocks (a
    millionth of the mix each, or a word) of its target.

    Null sources are one source, last in order. Empty texts take part with size 0. Rows
    without an id are ordered as one id; rows that repeat an id count anew. Equal tables and
    seeds give equal results in every run. Other columns are not looked at. An empty table
    gives an empty table.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("null"))
    sized = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("name"), key.alias("source"),
        word_count(F.col(text_col)).alias("size"), _drawn(seed, F.col(id_col)).alias("draw"),
    )
    sized = stage(sized, "sizes")
    n, total = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(1, math.ceil(total / blocks))
    shards = max(LEAST_SHARDS, math.ceil(n / SHARD_DOCS))
    shard = F.pmod(F.conv(F.substring("draw", 25, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")
    sized = sized.withColumn("shard", shard)

    by_shard = stage(sized.groupBy("source", "shard").agg(F.min("name").alias("name"), F.sum("size").alias("shard_size")), "shards")
    by_source = targets(by_shard.groupBy("source").agg(F.min("name").alias("name"), F.sum("shard_size").alias("words")))
    by_source = by_source.withColumn("seats", F.lit((total + block // 2) // block)).withColumn("all", F.lit(0))
    by_source = sainte_lague(by_source, ["all"], "rank", "target", "seats")
    by_source = by_source.select("source", F.col("words").alias("source_size"), "target", F.col("quota").alias("seats"))
    quotas = by_shard.drop("name").join(by_source, "source")
    quotas = sainte_lague(quotas, ["source"], "shard", "shard_size", "seats")
    due = F.least(F.col("quota") * block, F.col("shard_size") * MOST_PASSES)
    passes = F.coalesce(F.try_divide(due, F.col("shard_size")).cast("long"), F.lit(0))
    quotas = quotas.withColumn("passes", passes).withColumn("due", due - passes * F.col("shard_size"))
    quotas = stage(quotas.select("source", "shard", "shard_size", "source_size", "target", "passes", "due"), "quotas")

    here = ["source", "shard"]
    cut = F.floor((F.col("shard_size") - 1) / block).cast("long")
    lines = quotas.where("due > 0").select(*here, "due", "shard_size", F.explode(F.sequence(F.lit(0).cast("long"), cut)).alias("block"))
    length = F.least(F.lit(block), F.col("shard_size") - F.col("block") * block)
    lines = lines.withColumn("length", length).withColumn("draw", _drawn(seed, F.col("source"), F.col("shard"), F.col("block")))
    chosen = Window.partitionBy(*here).orderBy("draw", "block").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("length").over(chosen) - F.col("length")
    lines = lines.withColumn("part", F.least(F.col("length"), F.col("due") - before)).where("part > 0").select(*here, "block", "part")

    along = Window.partitionBy(*here).orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = sized.drop("name").withColumn("end", F.sum("size").over(along)).withColumn("row", F.row_number().over(along))
    laid = stage(laid.drop("draw"), "laid")
    first, last = F.floor((F.col("end") - F.col("size")) / block), F.floor((F.col("end") - 1) / block)
    pieces = laid.where("size > 0").withColumn("block", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    start = F.greatest(F.col("end") - F.col("size") - F.col("block") * block, F.lit(0))
    stop = F.least(F.col("end") - F.col("block") * block, F.col("part"))
    pieces = pieces.join(lines, [*here, "block"]).withColumn("words", stop - start).where("words > 0")
    extra = pieces.groupBy(*here, "row").agg(F.sum("words").alias("extra"))

    out = laid.join(quotas, here).join(extra, [*here, "row"], "left")
    taken = F.col("passes") * F.col("size") + F.coalesce("extra", F.lit(0))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.cast("long").alias("taken"))


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{folder}/documents.parquet"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, source AS name, coalesce('s' || source, 'null') AS src, md5('1|' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS draw,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
sums AS (
  SELECT coalesce(sum(size), 0)::BIGINT AS total, greatest(1, (coalesce(sum(size), 0)::BIGINT + 1048575) // 1048576) AS block,
    greatest(16, (count(*) + 65535) // 65536) AS shards FROM docs),
dealt AS (SELECT docs.*, ('0x' || substr(draw, 25, 8))::BIGINT % shards AS shard FROM docs, sums),
shards AS (SELECT src, shard, min(name) AS name, sum(size)::BIGINT AS shard_size FROM dealt GROUP BY 1, 2),
ranked AS (
  SELECT src, min(name) AS name, sum(shard_size)::BIGINT AS words, row_number() OVER (ORDER BY min(name) NULLS LAST) AS rank
  FROM shards GROUP BY src),
weighed AS (SELECT *, [1, 2, 3][(rank - 1) % 3 + 1] AS weight FROM ranked),
levels AS (
  SELECT *, (sum(words) OVER () - coalesce(sum(3 * words) OVER (ORDER BY words / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER (ORDER BY words / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM weighed),
targets AS (
  SELECT src, rank, words, least(3.0::DOUBLE * words, weight * coalesce(max(level) FILTER (level <= 3 * words / weight) OVER (), 0.0)::DOUBLE) AS target
  FROM levels),
seats AS (SELECT (total + block // 2) // block AS n, block, total, (SELECT count(*) FROM targets) AS parts FROM sums),
source_seats AS (
  SELECT rank, count(*) AS seats FROM (
    SELECT rank, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank) AS place, n
    FROM (SELECT rank, target, n, unnest(range(0, CAST(target / total * n AS BIGINT) + parts + 2)) AS k FROM targets, seats WHERE total > 0 AND target > 0))
  WHERE place <= n GROUP BY rank),
sources AS (SELECT src, words, target, coalesce(seats, 0) AS seats FROM targets LEFT JOIN source_seats USING (rank)),
shard_seats AS (
  SELECT src, shard, count(*) AS quota FROM (
    SELECT src, shard, seats, row_number() OVER (PARTITION BY src ORDER BY shard_size / (2 * k + 1) DESC, shard) AS place
    FROM (SELECT src, shard, shard_size, seats,
        unnest(range(0, CAST(shard_size / words * seats AS BIGINT) + (SELECT max(shards) FROM sums) + 2)) AS k
      FROM shards JOIN sources USING (src) WHERE words > 0 AND shard_size > 0))
  WHERE place <= seats GROUP BY 1, 2),
quotas AS (
  SELECT src, shard, shard_size, words, target, least(coalesce(quota, 0) * block, 3 * shard_size) AS due
  FROM shards JOIN sources USING (src) LEFT JOIN shard_seats USING (src, shard), seats),
passes AS (SELECT *, CASE WHEN shard_size > 0 THEN due // shard_size ELSE 0 END AS whole FROM quotas),
lines AS (
  SELECT src, shard, shard_size, due - whole * shard_size AS rest, unnest(range(0, (shard_size - 1) // block + 1)) AS b, block
  FROM passes, seats WHERE due > whole * shard_size),
chosen AS (
  SELECT src, shard, b, block, least(length, rest - (upto - length)) AS part FROM (
    SELECT *, sum(length) OVER (PARTITION BY src, shard ORDER BY md5('1|' || src || '|' || shard || '|' || b), b ROWS UNBOUNDED PRECEDING) AS upto
    FROM (SELECT *, least(block, shard_size - b * block) AS length FROM lines))),
laid AS (
  SELECT *, CAST(sum(size) OVER here AS BIGINT) AS stop, row_number() OVER here AS row FROM dealt
  WINDOW here AS (PARTITION BY src, shard ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING)),
pieces AS (
  SELECT src, shard, row, stop, size, unnest(range((stop - size) // block, (stop - 1) // block + 1)) AS b FROM laid, seats WHERE size > 0),
extra AS (
  SELECT src, shard, row, sum(greatest(0, least(stop - b * block, part) - greatest(stop - size - b * block, 0))) AS words
  FROM pieces JOIN chosen USING (src, shard, b) GROUP BY 1, 2, 3)
SELECT doc_id, CAST(size AS BIGINT) AS size, p.words AS source_size, target, CAST(whole * size + coalesce(extra.words, 0) AS BIGINT) AS taken
FROM laid JOIN passes p USING (src, shard) LEFT JOIN extra USING (src, shard, row)
"""

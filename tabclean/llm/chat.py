"""Logged conversations, without those that are a beginning of a longer one, as chat text.

Systems that log the whole conversation at every turn leave a snapshot for each. A rolling
hash of the turns so far names every beginning of a conversation. A conversation whose last
hash is a beginning of one with more turns is left out by an anti-join; of equal ones the
smallest id stays. Both sides of the joins have one row for each hash, so neither a common
first turn nor thousands of copies make a hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.staging import stage

#: Turn numbers of a piece of a conversation; hashes roll within pieces and over pieces.
PIECE = 1024


def _lane(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "turn", F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def _added(column: str) -> Column:
    """Sum of hashes modulo 2**62, which neither order nor grouping changes."""
    return F.pmod(F.sum(F.pmod(F.col(column), F.lit(1 << 62)).cast("decimal(20,0)")), F.lit(1 << 62).cast("decimal(20,0)")).cast("long")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv, turn, n, h1, h2): for each turn number of a conversation, rows so far and their hash.

    A turn's hash takes in its number, so hashes may be added up in any order: first by
    turn, then over pieces of `PIECE` turn numbers, then within pieces. No task needs the
    whole of a conversation.
    """
    hashed = turns.select("conv", "turn", _lane(1).alias("h1"), _lane(2).alias("h2"))
    by_turn = hashed.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n"), _added("h1").alias("h1"), _added("h2").alias("h2"))
    by_turn = stage(by_turn.withColumn("piece", F.coalesce(F.floor(F.col("turn") / PIECE), F.lit(1 << 60))), "turns")
    sums = [F.sum("n").alias("n"), _added("h1").alias("h1"), _added("h2").alias("h2")]
    pieces = by_turn.groupBy("conv", "piece").agg(*sums)
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    start = pieces.select(
        "conv", "piece", *[F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")).over(before), F.lit(0)).alias(f"{c}_0") for c in ("n", "h1", "h2")]
    )
    along = Window.partitionBy("conv", "piece").orderBy(F.col("turn").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    rolled = by_turn.join(start, ["conv", "piece"])
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).over(along) + F.col(f"{c}_0")
    fold = lambda c: F.pmod(total(c), F.lit(1 << 62).cast("decimal(38,0)")).cast("long").alias(c)
    return rolled.select("conv", "turn", total("n").cast("long").alias("n"), fold("h1"), fold("h2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv, n): conversations that begin no longer one; of equal ones the smallest id."""
    rolled = stage(prefix_hashes(turns), "prefixes")
    order = F.struct(F.col("turn").isNull().alias("last"), "turn", "n", "h1", "h2")
    whole = stage(rolled.groupBy("conv").agg(F.max(order).alias("w")).select("conv", "w.n", "w.h1", "w.h2"), "wholes")
    least = whole.groupBy("h1", "h2", "n").agg(F.min("conv").alias("conv"))
    ends = whole.select("conv", F.col("n").alias("whole_n"))
    inner = rolled.join(ends, "conv").where("n < whole_n").select("h1", "h2", "n").distinct()
    return least.join(inner, ["h1", "h2", "n"], "left_anti").select("conv", "n")


def render(turns: DataFrame) -> DataFrame:
    """(conv, chat): the turns of each conversation in order, each as <|im_start|>role, text, <|im_end|>.

    Start and end marks inside texts are taken apart by a space, so that no text ends its turn.
    """
    inert = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"<\|(im_start|im_end)\|>", "< |$1| >")
    said = F.concat(
        F.lit("<|im_start|>"), inert(F.coalesce(F.col("role"), F.lit("unknown"))), F.lit("\n"), inert(F.col("text")), F.lit("<|im_end|>\n")
    )
    lines = F.struct(F.col("turn").isNull().alias("last"), "turn", F.col("role").isNull().alias("no_role"), "role", said.alias("said"))
    parts = turns.select("conv", lines.alias("line")).groupBy("conv").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return parts.select("conv", F.array_join(F.transform("lines", lambda x: x["said"]), "").alias("chat"))


def format_chats(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row for each conversation that stays: `id_col`, n_turns, chat.

    A conversation is all rows of an id, in order of turn (null last), role and text. It is
    left out if its rows are all those of another one up to some turn number, and the other
    goes on; of conversations with equal rows the smallest id stays. Null and empty roles
    and texts differ; a null role is shown as `unknown`, a null text as an empty one. Rows
    that repeat a turn belong to it; equal rows count as often as they are there. Rows
    without an id belong to no conversation and are left out. Other columns are not looked
    at. An empty table gives an empty table. A rendered conversation is one value, so its
    text must fit into one.
    """
    turns = conversations.select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).alias("role"), F.col(text_col).alias("text"),
    ).where("conv IS NOT NULL")
    kept = stage(maximal_conversations(turns), "maximal")
    chats = render(turns.join(kept.select("conv"), "conv", "left_semi"))
    return kept.join(chats, "conv").select(F.col("conv").alias(id_col), F.col("n").alias("n_turns"), "chat")


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{folder}/conversations.parquet"))


ORACLE = r"""
WITH convs AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS FIRST) AS said,
    string_agg('<|im_start|>' || regexp_replace(coalesce(role, 'unknown'), '<\|(im_start|im_end)\|>', '< |\1| >', 'g') || chr(10) ||
      regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '< |\1| >', 'g') || '<|im_end|>' || chr(10), ''
      ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS FIRST) AS chat
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id)
SELECT conv_id, len(said) AS n_turns, chat FROM convs a
WHERE NOT EXISTS (
  SELECT 1 FROM convs b WHERE b.said[1] IS NOT DISTINCT FROM a.said[1] AND b.said[1:len(a.said)] IS NOT DISTINCT FROM a.said
    AND (len(b.said) > len(a.said) AND b.said[len(a.said) + 1].turn IS DISTINCT FROM a.said[len(a.said)].turn
      OR len(b.said) = len(a.said) AND b.conv_id < a.conv_id))
"""

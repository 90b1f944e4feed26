"""Lines that several documents share, kept only in the first of them.

Line hashes live in levelled sorted runs, each a table bucketed and sorted by hash. A new
batch of documents is joined with the runs bucket by bucket (no shuffle of the runs),
learns which of its lines have an owner already, and adds the rest as a run of its own;
`fan_in` runs of a level are compacted into one of the next. Batches go in order of
doc_id, so the owner of a line is the smallest doc_id that holds it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from ..sources.staging import scratch_path, staged_until_end
from .skew import spread_join, stage_bucketed

_BLANK = b" \t\n\v\f\r"


def _key(line: bytes, min_points: int) -> bytes | None:
    """128-bit hash of the stripped line with A-Z lowered; None if it has too few code points."""
    line = line.strip(_BLANK)
    if len(line) < 4 * min_points and len(line.decode("utf-8", "replace")) < min_points:
        return None
    return xxh3_128_digest(line.lower())


def line_keys(docs: DataFrame, min_points: int = 10) -> DataFrame:
    """(doc, key): the distinct line keys of each document, one pass over (doc, text)."""

    def keyed(batches):
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = {_key(x, min_points) for x in text.as_py().split(b"\n")} - {None}
                ids += [doc] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc", "key"])

    rows = docs.where("doc IS NOT NULL AND text IS NOT NULL").select("doc", F.col("text").cast("binary"))
    return rows.mapInArrow(keyed, "doc long, key binary")


class LineRuns:
    """Levelled runs of (key, owner). All runs have equally many buckets, so joins with them need no shuffle."""

    def __init__(self, spark: SparkSession, fan_in: int = 4):
        self.spark, self.fan_in = spark, fan_in
        self.levels: list[list[str]] = [[]]

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def owners(self, keys: DataFrame) -> DataFrame:
        """`keys` with the column `owner`, null for keys in no run. A key is in one run at most."""
        out, found = keys, []
        for i, name in enumerate(self.tables()):
            out = out.join(self.spark.table(name).withColumnRenamed("owner", f"__o{i}"), "key", "left")
            found.append(f"__o{i}")
        owner = F.coalesce(*found) if found else F.lit(None).cast("long")
        return out.withColumn("owner", owner).drop(*found)

    def add(self, rows: DataFrame) -> None:
        """Adds keys that no run holds, then compacts full levels."""
        self.levels[0].append(stage_bucketed(rows.select("key", "owner"), "key", "run"))
        for i in range(len(self.levels) + 1):
            if i == len(self.levels) or len(self.levels[i]) < self.fan_in:
                break
            merged = None
            for name in self.levels[i]:
                part = self.spark.table(name)
                merged = part if merged is None else merged.unionByName(part)
            name = stage_bucketed(merged, "key", "run")
            for old in self.levels[i]:
                self.spark.sql(f"DROP TABLE {old}")
            self.levels[i] = []
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(name)

    def drop(self) -> None:
        for name in self.tables():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = [[]]


def repeated_lines(docs: DataFrame, min_points: int = 10, batches: int = 4, fan_in: int = 3) -> DataFrame:
    """(doc, keys): for each document with lines to lose, their key hashes.

    `docs` has the columns doc and text. A batch is a range of doc ids; the number of
    batches changes the work done at once, never the result.
    """
    spark = docs.sparkSession
    cuts = docs.where("doc IS NOT NULL").approxQuantile("doc", [i / batches for i in range(1, batches)], 0.01)
    number = sum((F.when(F.col("doc") > int(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    drops = scratch_path(spark, "drops")
    spark.createDataFrame([], "doc long, key binary").write.parquet(drops)
    with staged_until_end(spark):
        lines_at = scratch_path(spark, "lines")
        line_keys(docs, min_points).withColumn("batch", number.cast("int")).write.partitionBy("batch").parquet(lines_at)
        lines = spark.read.schema("doc long, key binary, batch int").parquet(lines_at)
        runs = LineRuns(spark, fan_in)
        for i in range(len(set(cuts)) + 1):
            own = lines.where(F.col("batch") == i).select("doc", "key")
            first = own.groupBy("key").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"))
            known_at = scratch_path(spark, "known")
            runs.owners(first).write.parquet(known_at)
            known = spark.read.schema("key binary, doc long, last long, owner long").parquet(known_at)
            runs.add(known.where("owner IS NULL").select("key", F.col("doc").alias("owner")))
            again = known.where("owner IS NOT NULL OR doc < last")
            again = again.select("key", F.coalesce("owner", "doc").alias("owner"))
            spread_join(own, again, "key", spread_by="doc").where("doc <> owner").select("doc", "key").write.mode(
                "append"
            ).parquet(drops)
        runs.drop()
    lost = spark.read.schema("doc long, key binary").parquet(drops)
    return lost.groupBy("doc").agg(F.collect_list("key").alias("keys"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = 10, batches: int = 4
) -> DataFrame:
    """`docs` with shared lines removed from `text_col`, and the columns `n_lines` and `n_dropped`.

    Texts are split at line feeds. A line's key is the line stripped of ASCII white space
    with A-Z lowered. Keys of at least `min_points` code points that two documents or more
    hold lose all their lines except in the smallest id that holds them.

    Null and empty texts count as one empty line and become empty texts. Rows without an
    id keep all their lines and own none. Rows that repeat an id count as one document:
    each keeps and loses the same lines. Columns of `docs` named like the two new ones
    are replaced; all other columns stay. An empty table gives an empty table.
    """

    @F.arrow_udf("text binary, dropped long")
    def without(text: pa.Array, keys: pa.Array) -> pa.Array:
        texts, counts = [], np.zeros(len(text), np.int64)
        for i, (own, lost) in enumerate(zip(text, keys)):
            if not lost.is_valid:
                texts.append(None)
                continue
            gone = set(lost.as_py())
            lines = own.as_py().split(b"\n")
            kept = [x for x in lines if _key(x, min_points) not in gone]
            texts.append(b"\n".join(kept))
            counts[i] = len(lines) - len(kept)
        return pa.StructArray.from_arrays([pa.array(texts, pa.binary()), pa.array(counts)], ["text", "dropped"])

    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    lost = repeated_lines(source, min_points, batches).select(F.col("doc").alias("__doc"), F.col("keys").alias("__keys"))
    out = docs.join(lost, F.col(id_col) == F.col("__doc"), "left").drop("__doc")
    text = F.coalesce(F.col(text_col), F.lit(""))
    shown = F.when(F.col("__keys").isNotNull(), text.cast("binary"))
    out = out.withColumn("__cut", without(shown, F.col("__keys")))
    n_lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    out = out.withColumn("n_lines", n_lines).withColumn("n_dropped", F.coalesce("__cut.dropped", F.lit(0)).cast("long"))
    cut = F.when(F.col("__keys").isNotNull(), F.col("__cut.text").cast("string")).otherwise(text)
    return out.withColumn(text_col, cut).drop("__keys", "__cut")


def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH lines AS (
  SELECT doc_id, ord, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS ord
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN owners USING (key) GROUP BY doc_id
"""

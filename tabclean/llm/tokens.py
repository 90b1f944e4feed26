"""Token counts of whole texts by table lookup, without moving any pre-token.

The tokenizer works pre-token by pre-token, so a text's count is the sum of its pre-tokens'
counts. A compact table of the most frequent pre-tokens and their counts goes to every
task; the others are encoded once and kept in a cache that lives as long as the worker.
Texts with anything the split here can't be sure of (special strings, letters outside the
Latin blocks) are given to the library whole, so counts are always the library's.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of the table that goes to every task; with their keys at most 64 bytes each, under 2 MB.
TABLE_ENTRIES, ENTRY_BYTES = 20_000, 64
#: The table is drawn from about so many rows. It only saves time: no count depends on it.
SAMPLE_ROWS = 2_000
#: Entries of a worker's cache; it starts anew when full.
CACHE_ENTRIES = 400_000
OVER_LIMIT = 2048

# Fixed value: how word_bpe_49k.json splits a normalized text, for letters of the first Latin blocks.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|[^\sA-Za-z0-9À-ÖØ-öø-ſªµº²³¹¼½¾]+|[²³¹¼½¾]")
# Characters this module may split itself: ASCII and Latin letters whose small form is one letter.
_SURE = re.compile(r"[\t\n\v\f\r -~¡-©«-±´¶-¹»-įı-ſ–-”…]*")


def _worker() -> types.ModuleType:
    """State of the Python worker, kept between tasks."""
    name = "_token_count_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].tokenizers, sys.modules[name].caches = {}, {}
    return sys.modules[name]


class _Known(dict):
    """Token counts by pre-token: the table, and what this worker has encoded since."""

    def __init__(self, table: dict[str, int], tokenizer):
        super().__init__(table)
        self.table, self.tokenizer = table, tokenizer

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
            self.update(self.table)
        if len(piece) <= 1000:
            self[piece] = n
        return n


class WordCounter:
    """Counts tokens of whole texts as `Tokenizer.encode(text, add_special_tokens=False)` does."""

    def __init__(self, path: str, table: dict[str, int] | None = None):
        self.path, self.table = path, table or {}

    def _library(self):
        worker = _worker()
        if self.path not in worker.tokenizers:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(self.path)
            tokenizer.no_padding()
            tokenizer.no_truncation()
            worker.tokenizers[self.path] = tokenizer
        return worker.tokenizers[self.path]

    def pieces(self, text: str) -> list[str] | None:
        """The pre-tokens of a text; None if only the library can tell."""
        if "<|" in text or not _SURE.fullmatch(text):
            return None
        return _PIECES.findall(unicodedata.normalize("NFC", text).lower())

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        found = self.pieces(text)
        if found is None:
            return len(self._library().encode(text, add_special_tokens=False).ids)
        caches = _worker().caches
        if self.path not in caches:
            caches[self.path] = _Known({}, self._library())
        known = caches[self.path]
        if self.table and known.table is not self.table:
            known.table = self.table
            known.update(self.table)
        return sum(map(known.__getitem__, found))


def frequent_pieces(docs: DataFrame, text_col: str, path: str, entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """The table: pre-tokens most frequent in a sample of the rows, with their token counts.

    Each task of the sample counts its own pre-tokens and passes on the most frequent ones.
    """
    rows = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    n = rows.count()
    counter = WordCounter(path)

    def counted(batches):
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(counter.pieces(text.as_py()) or ())
        top = [(p, c) for p, c in found.most_common(2 * entries) if len(p.encode()) <= ENTRY_BYTES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([c for _, c in top], pa.int64())], ["piece", "n"]
        )

    drawn = rows if n <= SAMPLE_ROWS else rows.sample(SAMPLE_ROWS / n, seed=1)
    top = drawn.mapInArrow(counted, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = [r["piece"] for r in top.orderBy(F.desc("n"), "piece").limit(entries).collect()]
    return {p: counter.count(p) for p in pieces}


def token_count(text: Column, path: str, table: dict[str, int] | None = None) -> Column:
    """The number of tokens of a text (null: 0) by the tokenizer file at `path`."""
    counter = WordCounter(path, table)

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array([counter.count(t.as_py()) for t in texts], pa.int64())

    return counted(text)


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = OVER_LIMIT
) -> DataFrame:
    """`id_col`, n_bytes, n_tokens and over_limit for every row of `docs`.

    Null and empty texts have 0 bytes and tokens. Texts are counted whole, however long.
    Special strings inside texts count as the library's default does: as one token each.
    Rows without an id or with a repeated one are counted like others; other columns are not
    looked at. An empty table gives an empty table. `path` must be there on every worker.
    """
    table = frequent_pieces(docs, text_col, path)
    out = docs.select(
        F.col(id_col), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
        token_count(F.col(text_col), path, table).alias("n_tokens"),
    )
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op4(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))

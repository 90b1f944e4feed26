"""Benchmark items inside documents, up to a share of edited words.

An item with d edits allowed is cut into d + 1 pieces of neighbouring words. An edit changes
one piece at most, so a run that is at most d edits away holds one piece unchanged, at most
d words from where the item has it. Documents are searched for pieces; each one found gives a
window that holds every such run around it, and a bit-parallel edit distance over words
decides. A window with too few words of the item is passed over before. All of this is exact
for items of any length and edits of any kind: nothing is drawn and nothing missed.

Everything happens where the document is: no shuffle. Items are sent out in blocks of
proven size; more items make more blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import mixed, odd_constants, word_hashes, words

#: Edits allowed in a hundred words of an item.
PERCENT_EDITS = 20
#: At most so many items and bytes of items go out at once.
BLOCK_ITEMS, BLOCK_BYTES = 10_000, 16 << 20
_AT_ONCE, _CELLS = 400_000, 1 << 22


def edits_allowed(n_words: int, percent: int = PERCENT_EDITS) -> int:
    return n_words * percent // 100


def least_edits(item: list, text: list, at_most: int) -> tuple[int, int] | None:
    """Fewest edits between `item` and any run of `text`, and where that run ends; None if over `at_most`.

    Bit-parallel: the bits of two integers hold the differences down a column of the usual table.
    """
    where: dict = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | (1 << i)
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best = (score, 0)
    for j, w in enumerate(text):
        match = where.get(w, 0)
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & full
        up, down = (minus | ~(zero | plus)) & full, plus & zero
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = (down | ~(zero | up)) & full, up & zero
        if score < best[0]:
            best = (score, j + 1)
    return best if best[0] <= at_most else None


def pieces(n_words: int, edits: int) -> list[tuple[int, int]]:
    """(begin, end) of `edits` + 1 pieces of an item, as even as can be."""
    cuts = [n_words * i // (edits + 1) for i in range(edits + 2)]
    return list(zip(cuts, cuts[1:]))


def run_keys(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The keys of the runs of `width` words that begin at `at`."""
    weights = odd_constants(width, 31 + width)
    sums = np.zeros(len(at), np.uint64)
    for i in range(width):
        sums += hashes[at + i] * weights[i]
    return mixed(sums)


class Index:
    """The pieces of a block of items, by their number of words."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], percent: int = PERCENT_EDITS):
        if not 0 <= percent < 100:
            raise ValueError("percent must be from 0 to 99")
        hashed = [(i, word_hashes(words(t))) for i, t in items]
        self.items = [(i, w) for i, w in hashed if len(w)]
        self.lengths = np.array([len(w) for _, w in self.items], np.int64)
        self.edits = np.array([edits_allowed(len(w), percent) for _, w in self.items], np.int64)
        self.vocabulary = np.unique(np.concatenate([w for _, w in self.items])) if self.items else np.array([], np.uint64)
        by_width: dict[int, list] = {}
        for k, (_, w) in enumerate(self.items):
            for begin, end in pieces(len(w), int(self.edits[k])):
                by_width.setdefault(end - begin, []).append((k, begin))
        flat = np.concatenate([w for _, w in self.items]) if self.items else self.vocabulary
        firsts = np.cumsum(self.lengths) - self.lengths
        self.tables = []
        for width, listed in sorted(by_width.items()):
            of, begins = np.array(listed, np.int64).T
            keys = run_keys(flat, firsts[of] + begins, width)
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << 16, bool)
            seen[(keys >> np.uint64(48)).astype(np.int64)] = True
            self.tables.append((width, keys[order], of[order], begins[order], seen))

    def search(self, texts: list[bytes | None]) -> list[dict[int | None, tuple[int, int]]]:
        """For each text: {item id: (edits, word after the match)}; the first of the nearest matches."""
        found: list[dict] = [{} for _ in texts]
        first = 0
        while first < len(texts):
            parts, size, last = [], 0, first
            while last < len(texts) and size < _AT_ONCE:
                parts.append(word_hashes(words(texts[last])))
                size += len(parts[-1])
                last += 1
            if size and self.items:
                self._search(parts, found[first:last])
            first = last
        return found

    def _search(self, parts: list[np.ndarray], found: list[dict]) -> None:
        hashes = np.concatenate(parts)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        of_items = self.vocabulary[place] == hashes
        # The last number is that of all words no item has.
        place[~of_items] = len(self.vocabulary)
        before = np.concatenate([[0], np.cumsum(of_items)])
        at_all = np.flatnonzero(of_items)
        stop_of = bounds[np.searchsorted(bounds, at_all, "right")]
        met = [np.empty((0, 3), np.int64)]
        for width, known, of, begins, seen in self.tables:
            inside = at_all + width <= stop_of
            at = at_all[inside]
            at = at[before[at + width] - before[at] == width]
            keys = run_keys(hashes, at, width)
            maybe = np.flatnonzero(seen[(keys >> np.uint64(48)).astype(np.int64)])
            lo, hi = (np.searchsorted(known, keys[maybe], side) for side in ("left", "right"))
            # Pieces that many items share are met in portions.
            ends = np.cumsum(hi - lo)
            for portion in np.split(np.arange(len(maybe)), np.flatnonzero(np.diff(ends // _CELLS)) + 1):
                n = (hi - lo)[portion]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                piece = np.repeat(lo[portion], n) + within
                met.append(self._windows(np.repeat(at[maybe[portion]], n), begins[piece], of[piece], bounds, before))
        windows = np.concatenate(met)
        windows = windows[np.lexsort(windows.T[::-1])]
        cuts = np.flatnonzero(np.diff(windows[:, 0])) + 1
        for own in np.split(windows, cuts) if len(windows) else []:
            k = int(own[0, 0])
            item, item_words = self.items[k]
            own = own[self._holds_enough(k, own, place)]
            if not len(own):
                continue
            # Windows of a document that overlap or touch are read at once.
            doc_of = np.searchsorted(bounds, own[:, 1], "right") - 1
            reach = np.maximum.accumulate(own[:, 2])
            new = np.concatenate([[True], (own[1:, 1] > reach[:-1]) | (doc_of[1:] != doc_of[:-1])])
            begin = np.flatnonzero(new)
            last = np.concatenate([begin[1:], [len(own)]]) - 1
            sought = item_words.tolist()
            for lo, hi, doc in zip(own[begin, 1].tolist(), reach[last].tolist(), doc_of[begin].tolist()):
                best = least_edits(sought, hashes[lo:hi].tolist(), int(self.edits[k]))
                if best and (item not in found[doc] or best[0] < found[doc][item][0]):
                    found[doc][item] = (best[0], lo - int(bounds[doc]) + best[1])

    def _windows(self, at: np.ndarray, offset: np.ndarray, of: np.ndarray, bounds: np.ndarray, before: np.ndarray) -> np.ndarray:
        """(item, from, to) of the words that a match may use whose piece, `offset` words into the item, stands at `at`."""
        doc = np.searchsorted(bounds, at, "right")
        lo = np.maximum(bounds[doc - 1], at - offset - self.edits[of])
        hi = np.minimum(bounds[doc], at - offset + self.lengths[of] + self.edits[of])
        enough = before[hi] - before[lo] >= self.lengths[of] - self.edits[of]
        return np.stack([of, lo, hi], axis=1)[enough]

    def _holds_enough(self, k: int, own: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which windows hold as many words of the item as a match leaves unchanged."""
        member = np.zeros(len(self.vocabulary) + 1, bool)
        member[np.searchsorted(self.vocabulary, self.items[k][1])] = True
        span, least = int((own[:, 2] - own[:, 1]).max()), self.lengths[k] - self.edits[k]
        out = np.empty(len(own), bool)
        step = max(1, _CELLS // span)
        for i in range(0, len(own), step):
            lo, hi = own[i : i + step, 1:2], own[i : i + step, 2:]
            cells = lo + np.arange(span)
            out[i : i + step] = (member[place[np.minimum(cells, len(place) - 1)]] & (cells < hi)).sum(axis=1) >= least
        return out


def _null_first(hit: tuple) -> tuple:
    return hit[0] is not None, hit[0] or 0


_HITS = pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int64()), ("word_end", pa.int64())]))


def leaks_in(text: Column, index: Index) -> Column:
    """array<struct<item, edits, word_end>> of the items of a block that a text holds."""

    @F.arrow_udf("array<struct<item long, edits long, word_end long>>")
    def found(texts: pa.Array) -> pa.Array:
        hits = index.search([t.as_py() for t in texts])
        rows = [[{"item": i, "edits": e, "word_end": w} for i, (e, w) in sorted(h.items(), key=_null_first)] for h in hits]
        return pa.array(rows, _HITS)

    return found(text.cast("binary"))


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, percent: int) -> list[Index]:
    """The items in blocks of bounded size; every item is in one."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("binary").alias("t"))
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil(size / BLOCK_BYTES))
    dealt = items.withColumn("b", F.pmod(F.xxhash64("i"), F.lit(blocks)))
    return [Index([(r.i, r.t) for r in dealt.where(F.col("b") == b).collect()], percent) for b in range(blocks)]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", percent: int = PERCENT_EDITS,
) -> DataFrame:
    """One row for each document and item it holds: `id_col`, `item_col`, edits, word_end.

    An item of n words (runs without ASCII white space, A-Z lowered) is in a text if some run
    of its words is at most n * `percent` / 100 word edits away. `word_end` counts the words
    up to the end of the match. Items of one to four words allow no edit, so they are found
    where they stand word by word. Null and empty texts hold nothing, and such items match
    nothing; rows and items without an id are reported with a null id. Rows and items that
    repeat an id, or have none, are each looked at; of items that share an id (or have none)
    the nearest counts. Empty tables give an empty table.
    """
    out = None
    for index in blocks_of(benchmark, item_col, item_text_col, percent):
        hits = docs.select(F.col(id_col).alias("d"), F.explode(leaks_in(F.col(text_col), index)).alias("h"))
        hits = hits.select(F.col("d").alias(id_col), F.col("h.item").alias(item_col), "h.edits", "h.word_end")
        out = hits if out is None else out.unionByName(hits)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", percent: int = PERCENT_EDITS) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, all columns as they are."""
    for index in blocks_of(benchmark, "item_id", "text", percent):
        docs = docs.where(F.size(leaks_in(F.coalesce(F.col(text_col), F.lit("")), index)) == 0)
    return docs


def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return find_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))

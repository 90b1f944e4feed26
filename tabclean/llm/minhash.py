"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation, components.

1. One pass gives each document the digest of its shingle set and MinHash band keys.
   Documents with equal sets are grouped by digest; only the first of each goes on.
2. Band buckets of two or more give candidates. Their members get an odd sketch: every one
   of 1,024 MinHash samples toggles one bit of a bitmap, so the population count of the XOR
   of two bitmaps counts the samples in which two sets differ, which is most precise at
   high similarity.
3. A bucket is not expanded into pairs: its members are compared with a hub, and links make
   components. Buckets in which all are of one component are done; the others get new hubs.
4. What hubs leave open meets by its rarest shingles: in one order of all shingles, sets of
   n shingles that are similar enough share one of their first n - ceil(percent * n / 100) + 1.
   The order puts frequent shingles last, so texts that share a common passage and little
   else don't meet. Shingles held by the same documents count as one item, at which these
   meet once. No candidate that can be a link is left out.
5. A candidate must pass the size bound and the odd sketch and is then confirmed on both
   whole sets.

Bands are chosen so that a pair at the threshold shares a bucket with a probability of
over 0.99999; the sketch refuses such a pair with a probability of about 4 in a million, and
hardly any other link: at 0.7 it passes a quarter of all pairs, at 0.65 about one in 200.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from ..sources.staging import stage
from .components import connected_components, narrow
from .running import running
from .skew import heavy_keys, spread_join, stage_bucketed
from .words import mixed, odd_constants, shingle_set

BANDS, ROWS = 32, 5
SKETCH_SAMPLES, SKETCH_BITS = 1024, 2048
#: Deviations of the sketch's bound.
_SIGMAS = 4.5
#: Hubs of a bucket, and those that a member of several buckets meets in a round; what they leave is compared in the end.
_HUBS_OF_BUCKET, _HUBS = 4, 16
#: Cells of the folded counts by which shingles are ordered; their sum by cell is the only thing sent out.
_CELLS = 1 << 16
#: Documents with one rare shingle that a task compares with as many.
_BLOCK = 1000
#: Shingles hashed at once, so that memory does not follow the batch.
_AT_ONCE = 500_000


def most_differing_bits(similarity: float, samples: int = SKETCH_SAMPLES, bits: int = SKETCH_BITS, sigmas: float = _SIGMAS) -> int:
    """Bits in which the odd sketches of two sets of this similarity differ at most, up to `sigmas` deviations.

    Of `samples` MinHash values, a binomial number differ; each that differs toggles two
    bits, and m random toggles leave bits * (1 - (1 - 2 / bits) ** m) / 2 ones.
    """
    toggles = 2 * samples * (1 - similarity)
    ones = bits * (1 - (1 - 2 / bits) ** toggles) / 2
    by_samples = 2 * math.sqrt(samples * similarity * (1 - similarity)) * (1 - 2 * ones / bits)
    by_toggles = math.sqrt(ones * (1 - ones / bits))
    return math.ceil(ones + sigmas * math.hypot(by_samples, by_toggles))


def min_hashes(values: np.ndarray, starts: np.ndarray, samples: int) -> np.ndarray:
    """MinHash values, one row per set; set i is `values` from starts[i] on and is not empty."""
    low = values.astype(np.uint32)
    factors = (odd_constants(samples, 7) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    out = np.empty((len(starts), samples), np.uint32)
    for j in range(samples):
        out[:, j] = np.minimum.reduceat(low * factors[j], starts)
    return out


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    factors = odd_constants(bands * rows, 11)
    weighted = (minima.astype(np.uint64) + np.uint64(1)) * factors
    return mixed(weighted.reshape(len(minima), bands, rows).sum(axis=2, dtype=np.uint64)).view(np.int64)


def odd_sketches(minima: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words: a bit is the parity of the samples that fall on it."""
    at = mixed(minima.astype(np.uint64) * np.uint64(1024) + np.arange(minima.shape[1], dtype=np.uint64)) % np.uint64(bits)
    at = at.astype(np.int64) + np.arange(len(minima))[:, None] * bits
    odd = np.bincount(at.ravel(), minlength=len(minima) * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, bits), axis=1).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, rows * width + 1, width, dtype=np.int32), pa.array(values.ravel()))


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc, n, digest, bands) for each row of (doc, text); the last two are null for empty sets."""

    def signed(batches):
        for ids, sets in _portions(batches, shingle):
            n = np.array([len(x) for x in sets], np.int64)
            full = np.flatnonzero(n)
            take = pa.array(np.where(n > 0, np.cumsum(n > 0) - 1, 0), mask=n == 0)
            digests = pa.array([xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary())
            bands = pa.nulls(len(sets), pa.list_(pa.int64()))
            if len(full):
                bands = _lists(band_keys(_minima([sets[i] for i in full], BANDS * ROWS), BANDS, ROWS)).take(take)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), digests, bands], ["doc", "n", "digest", "bands"])

    rows = docs.select("doc", F.col("text").cast("binary"))
    return rows.mapInArrow(signed, "doc long, n long, digest binary, bands array<long>")


def _portions(batches, shingle: int):
    """(ids, shingle sets) of the rows, so many at once that memory follows neither batches nor texts."""
    for batch in batches:
        ids, texts, at = batch.column(0), batch.column(1), 0
        while at < len(ids):
            sets, size, first = [], 0, at
            while at < len(ids) and size < _AT_ONCE:
                sets.append(shingle_set(texts[at].as_py(), shingle))
                size += len(sets[-1])
                at += 1
            yield ids.slice(first, at - first), sets


def _minima(sets: list[np.ndarray], samples: int) -> np.ndarray:
    starts = np.cumsum([0] + [len(x) for x in sets[:-1]])
    return min_hashes(np.concatenate(sets), starts, samples)


def sketched_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc, n, sketch, shingles) of the rows of (doc, text) with a set: its odd sketch and sorted 64-bit hashes as bytes."""

    def listed(batches):
        for ids, sets in _portions(batches, shingle):
            full = [i for i, x in enumerate(sets) if len(x)]
            if not full:
                continue
            own = [sets[i] for i in full]
            columns = [
                ids.take(pa.array(full)), pa.array([len(x) for x in own], pa.int64()),
                _lists(odd_sketches(_minima(own, SKETCH_SAMPLES), SKETCH_BITS)), pa.array([x.tobytes() for x in own]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "sketch", "shingles"])

    rows = docs.select("doc", F.col("text").cast("binary"))
    return rows.mapInArrow(listed, "doc long, n long, sketch array<long>, shingles binary")


def folded_counts(sets: DataFrame) -> np.ndarray:
    """How many sets of (shingles) hold a shingle of each cell; a cell is the end of the hash."""

    def counted(batches):
        total = np.zeros(_CELLS, np.int64)
        for batch in batches:
            for found in batch.column(0):
                cells = np.frombuffer(found.as_buffer(), np.uint64) & np.uint64(_CELLS - 1)
                np.add.at(total, cells.astype(np.int64), 1)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    summed = sets.select("shingles").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out, found = np.zeros(_CELLS, np.int64), summed.toArrow()
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out


def rarest_shingles(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """(doc, shingle, rest): the rarest shingles of each set of (doc, shingles), one of which any similar set has as well.

    A shingle is the half of its hash that cells don't use; that two may be equal only adds
    meetings. `rest` is how many shingles of the set are not among them.
    """

    def listed(batches):
        for batch in batches:
            for doc, found in zip(batch.column(0), batch.column(1)):
                own = np.frombuffer(found.as_buffer(), np.uint64)
                first = len(own) + (-percent * len(own)) // 100 + 1
                common = counts[(own & np.uint64(_CELLS - 1)).astype(np.int64)]
                rare = np.unique((own[np.lexsort((own, common))[:first]] >> np.uint64(32)).astype(np.uint32)).view(np.int32)
                same = [np.full(len(rare), x, np.int64) for x in (doc.as_py(), len(own) - len(rare))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (same[0], rare, same[1])], ["doc", "shingle", "rest"])

    return sets.select("doc", "shingles").mapInArrow(listed, "doc long, shingle int, rest long")


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of (a, b, left, right) with 100 * intersection >= percent * union."""

    def compared(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i in range(len(a)):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(y, x)
                both = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "left", "right").mapInArrow(compared, "a long, b long")


def _sizes_allow(percent: int) -> str:
    return f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"


def _passes(percent: int) -> str:
    """Whether a pair with sizes n_a, n_b and sketches sketch_a, sketch_b can reach the similarity."""
    # Lambdas, since a sum spelled out over all words is generated as one method, too long for Java to compile.
    differing = "aggregate(zip_with(sketch_a, sketch_b, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x)"
    return f"{_sizes_allow(percent)} AND {differing} <= {most_differing_bits(percent / 100)}"


def _weight(items: str) -> str:
    """How many shingles the items of an array stand for."""
    return f"aggregate({items}, 0L, (t, x) -> t + (x & {(1 << 32) - 1}L))"


class _Links:
    """Candidate search among documents with different sets."""

    def __init__(self, firsts: DataFrame, docs: DataFrame, shingle: int, percent: int):
        self.percent = percent
        keyed = firsts.select("doc", F.explode("bands").alias("key"))
        buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("doc").alias("lo"), F.max("doc").alias("hi"))
        buckets = stage(buckets.where("lo < hi").select("key", "c"), "buckets")
        # Buckets with over a thousandth of all members are spread; there are fewer than a thousand.
        top = buckets.orderBy(F.desc("c")).limit(1000).collect()
        least = max(1000, (buckets.agg(F.sum("c")).first()[0] or 0) // 1000)
        self.heavy = [r["key"] for r in top if r["c"] > least]
        self.members = stage(spread_join(keyed, buckets.select("key"), "key", spread_by="doc", heavy=self.heavy), "members")
        needed = self.members.select("doc").distinct()
        sets = sketched_sets(docs.join(needed, "doc", "left_semi"), shingle)
        # Bucketed by document: each round moves its pairs, not the sets of all candidates.
        self.table = stage_bucketed(sets.dropDuplicates(["doc", "shingles"]), "doc", "sets")
        self.sets = docs.sparkSession.table(self.table)
        self.known = self.sets.select("doc", "n", "sketch")

    def placed(self, labels: DataFrame | None) -> DataFrame:
        """(key, doc, component) of all members of buckets."""
        if labels is None:
            return self.members.withColumn("component", F.col("doc"))
        out = self.members.join(labels.withColumnRenamed("node", "doc"), "doc", "left")
        return out.select("key", "doc", F.coalesce("component", "doc").alias("component"))

    def hub_pairs(self, placed: DataFrame, turn: int) -> DataFrame:
        """(a, b): members a with hubs b of their buckets, where they are of different components.

        All buckets prefer the same hubs, and a member meets the most preferred of its own.
        """
        drawn = F.struct(F.xxhash64("doc", F.lit(turn)).alias("h"), "doc", "component")
        part = F.pmod(F.xxhash64("doc", F.lit(turn), F.lit("part")), F.lit(_HUBS_OF_BUCKET))
        span = [F.min("component").alias("lo"), F.max("component").alias("hi")]
        first = placed.groupBy("key", part.alias("part")).agg(F.min(drawn).alias("hub"), *span)
        hubs = first.groupBy("key").agg(F.collect_list("hub").alias("hubs"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        met = spread_join(placed, hubs.where("lo < hi").select("key", "hubs"), "key", spread_by="doc", heavy=self.heavy)
        met = met.select("doc", F.explode(F.expr("filter(hubs, x -> x.component <> component)")).alias("x"))
        # A document has a bounded number of buckets and so of hubs.
        of_doc = met.groupBy("doc").agg(F.slice(F.sort_array(F.collect_set(F.struct("x.h", "x.doc"))), 1, _HUBS).alias("hubs"))
        return of_doc.select(F.col("doc").alias("a"), F.explode("hubs.doc").alias("b"))

    def open_pairs(self, placed: DataFrame) -> int:
        """Pairs of different components within buckets."""
        sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
        cross = sizes.groupBy("key").agg(F.expr("(pow(sum(c), 2) - sum(pow(c, 2))) / 2").alias("n"))
        return int(cross.agg(F.coalesce(F.sum("n"), F.lit(0.0))).first()[0])

    def meeting(self, placed: DataFrame) -> DataFrame:
        """(item, blocks, doc, component, n, sketch, rare, weight, last, second, rest): items that documents of open buckets
        share across components.

        An item stands for all rare shingles held by exactly the same documents: the smallest
        of them in its upper half, their number in the lower. `rare` has all items of a document
        in order, `weight` counts their shingles, `last` and `second` are the two items before
        this one, and `rest` counts the shingles of the set that are not rare.
        """
        span = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        still = spread_join(placed, span.where("lo < hi").select("key"), "key", spread_by="doc", heavy=self.heavy)
        still = stage(narrow(still.select("doc", "component").distinct()), "open")
        sets = self.sets.join(still.select("doc"), "doc", "left_semi")
        rare = rarest_shingles(sets, folded_counts(sets), self.percent).join(still, "doc")
        rare = stage(rare, "rare")
        # Holders are told apart by their number and two sums of hashes.
        holders = [F.sum(x.cast("decimal(38,0)")) for x in (F.xxhash64("doc"), F.xxhash64("doc", F.lit(1)))]
        shared = rare.groupBy("shingle").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c"),
            holders[0].alias("x"), holders[1].alias("y"),
        )
        alike = shared.where("lo < hi").groupBy("c", "x", "y").agg(F.min("shingle").alias("shingle"), F.count(F.lit(1)).alias("w"))
        item = F.shiftleft(F.col("shingle").cast("long"), 32).bitwiseOR(F.col("w")).alias("item")
        alike = alike.select("shingle", item, F.ceil(F.col("c") / _BLOCK).cast("int").alias("blocks"))
        met = stage(spread_join(rare, alike, "shingle", spread_by="doc").drop("shingle"), "shared")
        known = met.groupBy("doc").agg(F.sort_array(F.collect_set("item")).alias("rare"), F.max("rest").alias("rest"))
        known = known.withColumn("weight", F.expr(_weight("rare")))
        met = met.drop("rest").distinct().join(known.join(self.known, "doc"), "doc")
        before = [F.expr(f"get(rare, cast(array_position(rare, item) AS int) - {i})") for i in (2, 3)]
        return stage(met.withColumns({"last": before[0], "second": before[1]}), "meeting")

    def other_pairs(self, placed: DataFrame) -> DataFrame:
        """Pairs of different components, of documents in buckets still open, that share a rare shingle and pass the sketch.

        Of two documents, the one whose rare shingles end first in the order of all has no
        more shingles in common with the other than their common rare ones and its own rest.
        """
        met = self.meeting(placed)
        # Blocks of the holders of an item meet each other, one pair of blocks in a task.
        own, every = F.pmod(F.xxhash64("doc"), "blocks").cast("int"), F.explode(F.expr("sequence(0, blocks - 1)"))
        sides = ["component", "n", "sketch", "rare", "weight", "rest", "last", "second"]
        side = lambda doc, i, j: met.select("item", i.alias("i"), j.alias("j"), F.col("doc").alias(doc), *[F.col(c).alias(f"{c}_{doc}") for c in sides])
        left, right = side("a", own, every), side("b", every, own)
        enough = f"{100 + self.percent} * (%s + greatest(rest_a, rest_b)) >= {self.percent} * (n_a + n_b)"
        # Cheap tests first: no more rare shingles are common than either document has.
        pairs = left.join(right, ["item", "i", "j"]).where(f"a < b AND component_a <> component_b AND {_sizes_allow(self.percent)}")
        pairs = pairs.where(enough % "least(weight_a, weight_b)")
        # A pair counts where its first common item is, which is not here if an item before is common, too.
        pairs = pairs.where("item = rare_a[0] OR rare_a[0] <> rare_b[0]")
        for x, y in itertools.product(["last", "second"], repeat=2):
            pairs = pairs.where(f"coalesce({x}_a <> {y}_b, true)")
        # What is common is found once for both tests.
        both = f"common[0] = item AND {enough % _weight('common')}"
        pairs = pairs.where(f"exists(array(array_intersect(rare_a, rare_b)), common -> {both})")
        return pairs.where(_passes(self.percent)).select("a", "b").distinct()

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are links, after size, sketch and the comparison of whole sets."""
        pairs = stage(narrow(pairs), "pairs")
        of_a, of_b = heavy_keys(pairs, "a"), heavy_keys(pairs, "b")
        rated = spread_join(pairs, self.known.toDF("a", "n_a", "sketch_a"), "a", spread_by="b", heavy=of_a)
        rated = spread_join(rated, self.known.toDF("b", "n_b", "sketch_b"), "b", spread_by="a", heavy=of_b)
        pairs = stage(rated.where(_passes(self.percent)).select("a", "b"), "pairs")
        sets = self.sets.select("doc", "shingles")
        both = spread_join(pairs, sets.toDF("a", "left"), "a", spread_by="b", heavy=of_a)
        both = spread_join(both, sets.toDF("b", "right"), "b", spread_by="a", heavy=of_b)
        return stage(confirmed(both, self.percent), "linked")


#: After so many rounds of hubs, pairs are compared one by one if no more are left per member of a bucket.
_ROUNDS, _PAIRS_A_MEMBER = 2, 64


def _components(firsts: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame | None:
    """(node, component) of linked documents; None if there is no link.

    Rounds of hubs shrink large groups; the rest of the candidates are compared pair by
    pair, at the latest when hubs link nothing more. The result is the same whenever that
    happens.
    """
    found = _Links(firsts, docs, shingle, percent)
    try:
        return _merged(found)
    finally:
        docs.sparkSession.sql(f"DROP TABLE {found.table}")


def _merged(found: _Links) -> DataFrame | None:
    labels, turn, members = None, 0, found.members.count()
    while True:
        placed = stage(found.placed(labels), "placed")
        last = turn >= _ROUNDS and found.open_pairs(placed) <= _PAIRS_A_MEMBER * members
        new = found.links(found.other_pairs(placed) if last else found.hub_pairs(placed, turn))
        if new.isEmpty():
            if last:
                return labels
            new, last = found.links(found.other_pairs(placed)), True
            if new.isEmpty():
                return labels
        edges = new if labels is None else new.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels, turn = stage(narrow(connected_components(edges)), "labels"), turn + 1
        if last:
            return labels


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of `docs`: `id_col`, n_shingles, component_id, kept.

    Words are runs without ASCII white space, A-Z lowered; a text's set holds its distinct
    runs of `shingle` words, or its whole sequence as one if it has fewer. Texts with
    100 * intersection >= `percent` * union are linked; component_id is the smallest id
    reachable, and kept tells whether it is the row's own.

    Null, empty and blank texts have an empty set and are linked with nothing. A row
    without an id is linked with nothing, has a null component_id and is kept. Rows that
    repeat an id and text get equal results; rows that repeat an id with another text are
    judged by their own text. Other columns are not looked at. An empty table gives an
    empty table.
    """
    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    signed = stage(signatures(source, shingle), "signatures")
    named = signed.where("n > 0 AND doc IS NOT NULL")
    groups = stage(named.groupBy("digest").agg(F.min("doc").alias("first")), "groups")
    members = spread_join(named.select("doc", "digest"), groups, "digest", spread_by="doc", heavy=heavy_keys(named, "digest"))
    members = stage(members.select("doc", "digest", "first").distinct(), "copies")
    firsts = named.join(groups.select(F.col("first").alias("doc"), F.col("digest").alias("d")), "doc")
    firsts = stage(firsts.where("digest = d").drop("d", "digest").dropDuplicates(["doc", "bands"]), "firsts")
    labels = _components(firsts, source.join(firsts.select("doc"), "doc", "left_semi"), shingle, percent)
    if labels is None:
        placed = members.withColumn("component", F.col("first"))
    else:
        placed = spread_join(members, labels.withColumnRenamed("node", "first"), "first", "left", spread_by="doc")
        placed = placed.withColumn("component", F.coalesce("component", "first"))
    placed = placed.select(F.col("doc").alias("p_doc"), F.col("digest").alias("p_digest"), "component")
    out = signed.select("doc", "n", "digest").join(placed, F.expr("doc = p_doc AND digest = p_digest"), "left")
    component = F.coalesce("component", "doc")
    return out.select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"),
    )


def _apart(docs: DataFrame, id_col: str, mark: str, node: str) -> DataFrame:
    """`docs` with a number `node` for each id and text: the id itself, a new one where an id has several texts."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(mark).alias("mark")).where("id IS NOT NULL")
    shared = stage(rows.groupBy("id").agg(F.min(F.struct("mark")).alias("a"), F.max(F.struct("mark")).alias("b")), "ids")
    clashing = shared.where("a <> b").select("id")
    if clashing.isEmpty():
        return docs.withColumn(node, F.col(id_col).cast("long"))
    texts = rows.join(clashing, "id", "left_semi").distinct().select(F.lit(0).alias("all"), "id", "mark")
    texts = running(stage(texts, "texts"), "all", ["id", "mark"])
    (low, high), n = shared.agg(F.min("id"), F.max("id")).first(), texts.count()
    # Numbers that no id has: above the largest, or below the smallest where there is no room.
    fresh = F.lit(high + 1) + F.col("pos") if high + 1 + n < 1 << 63 else F.lit(low - 1) - F.col("pos")
    fresh = texts.select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), fresh.cast("long").alias(node))
    same = (F.col(id_col) == F.col("__id")) & F.col(mark).eqNullSafe(F.col("__mark"))
    return docs.join(fresh, same, "left").withColumn(node, F.coalesce(node, F.col(id_col))).drop("__id", "__mark")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stay: one of each group of near copies, and one of equal rows.

    Ids are whole numbers. Rows that share an id (or have none) and a text count as one
    document; rows that share an id but not the text are documents of their own; others
    without an id stay. All columns stay as they are, whatever their names.
    """
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own, text = (f"c{names.index(c)}" for c in (id_col, text_col))
    marked = _apart(inner.withColumn("mark", F.xxhash64(F.col(text).isNull(), text)), own, "mark", "node")
    verdict = near_duplicates(marked.select("node", text), "node", text, **options)
    lost = verdict.where("NOT kept").select(F.col("node").alias("lost")).distinct()
    kept = marked.join(lost, F.col("node") == F.col("lost"), "left_anti")
    # By the number, along which the rows lie already; it tells texts of one id apart.
    return kept.dropDuplicates(["node", "mark"]).drop("mark", "node").toDF(*names)


def op5(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"), shingle=4)

"""The trie of all conversations' beginnings, from adaptive radix trees over turn ids.

A turn's id is 16 bytes of a digest of its role and text, so a conversation is a byte string
of fixed-width ids. Tasks insert their share of these strings into adaptive radix trees and
emit a row for every depth that ends a turn; rows of one node from many tasks are added up.
Long conversations are cut into chunks of `CHUNK` turns, each with the hash of what came
before, so neither a tree nor a task holds more than a bounded part of anything.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from ..sources.staging import stage
from .merkle import CRC32_SQL
from .running import MODULUS, running
from .skew import spread_join

#: Bytes of a turn's id, turns of a chunk, keys that trees hold before they emit.
WIDTH, CHUNK, FLUSH_KEYS = 16, 64, 20_000
#: Conversations of a hundred share the beginning of the first, up to this many turns.
SHARED_TURNS = 5
#: Bytes of a piece of joined ids.
PIECE_BYTES = 1 << 16


# Adaptive radix tree


class Few:
    """Up to 4 or 16 children: sorted bytes beside the children."""

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid: Node) -> Few | Indexed:
        if len(self.kids) == self.room:
            return _grown(self, Few(16) if self.room == 4 else Indexed()).put(byte, kid)
        at = sum(b < byte for b in self.bytes)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def items(self):
        return zip(self.bytes, self.kids)


class Indexed:
    """Up to 48 children: a place for each of 256 bytes that says which."""

    def __init__(self):
        self.index, self.kids = bytearray(256), []

    def get(self, byte: int):
        return self.kids[self.index[byte] - 1] if self.index[byte] else None

    def put(self, byte: int, kid: Node) -> Indexed | Full:
        if len(self.kids) == 48:
            return _grown(self, Full()).put(byte, kid)
        self.kids.append(kid)
        self.index[byte] = len(self.kids)
        return self

    def items(self):
        return ((b, self.kids[i - 1]) for b, i in enumerate(self.index) if i)


class Full:
    """A child for each of 256 bytes."""

    def __init__(self):
        self.kids = [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> Full:
        self.kids[byte] = kid
        return self

    def items(self):
        return ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


def _grown(old, new):
    for byte, kid in old.items():
        new = new.put(byte, kid)
    return new


class Node:
    """The bytes that all keys below share, what ends here, and children by their next byte."""

    __slots__ = ("prefix", "value", "kids")

    def __init__(self, prefix: bytes, value=None, kids=None):
        self.prefix, self.value, self.kids = prefix, value, kids


def _shared(a: bytes, b: bytes) -> int:
    """The number of first bytes that two strings share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class RadixTree:
    """Values by byte string; `add` says how two values of one string become one."""

    def __init__(self, add):
        self.add, self.root = add, Node(b"", kids=Few())

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            same = _shared(node.prefix, key[at:])
            if same < len(node.prefix):
                below = Node(node.prefix[same + 1 :], node.value, node.kids)
                byte, node.value, node.kids = node.prefix[same], None, Few()
                node.kids.put(byte, below)
                node.prefix = node.prefix[:same]
            at += same
            if at == len(key):
                node.value = value if node.value is None else self.add(node.value, value)
                return
            if node.kids is None:
                node.kids = Few()
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids = node.kids.put(key[at], Node(key[at + 1 :], value))
                return
            node, at = kid, at + 1

    def prefixes(self, width: int):
        """(key, total, own) at every depth that is a multiple of `width`: the values below added up, and the value that ends there."""
        seen, stack = [], [(b"", self.root, -1)]
        while stack:
            before, node, parent = stack.pop()
            path = before + node.prefix
            seen.append([len(before) - (parent >= 0), path, node.value, parent, node.value])
            for byte, kid in node.kids.items() if node.kids else ():
                stack.append((path + bytes([byte]), kid, len(seen) - 1))
        for row in reversed(seen):
            if row[3] >= 0 and row[4] is not None:
                up = seen[row[3]]
                up[4] = row[4] if up[4] is None else self.add(up[4], row[4])
        for above, path, own, parent, total in seen:
            if total is None:
                continue
            for depth in range(0 if parent < 0 else above - above % width + width, len(path) + 1, width):
                yield path[:depth], total, own if depth == len(path) else None


# Hashes of prefixes


def _lanes(at: int, turn: bytes) -> tuple[int, int]:
    """Two numbers for a turn at a place; a prefix's hash is their sums modulo 2**62."""
    both = xxh3_128_intdigest(turn + struct.pack(">q", at))
    return both % MODULUS, (both >> 64) % MODULUS


def _node_id(a: Column, b: Column) -> Column:
    wide = lambda c: F.lpad(F.hex(c), 16, "0")
    return F.unhex(F.concat(wide(a), wide(b)))


def _summed(batches):
    """Adds to each chunk the sums of its turns' lanes and of their code points."""
    for batch in batches:
        chunk, key, sizes = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("chunk", "key", "sizes"))
        sums = []
        for c, k, s in zip(chunk, key, sizes):
            one = two = 0
            for i in range(len(k) // WIDTH):
                x, y = _lanes(c * CHUNK + i, k[i * WIDTH : (i + 1) * WIDTH])
                one, two = one + x, two + y
            sums.append((one % MODULUS, two % MODULUS, sum(s)))
        more = [pa.array([s[i] for s in sums], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "lane1", "lane2", "chars"])


# Rebuilt conversations


def _said(role_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """Role, text and id of a turn; nulls are empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return role, text, F.substring(F.unhex(digest), 1, WIDTH)


def _turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    _, text, turn_id = _said(role_col, text_col)
    return conversations.select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        turn_id.alias("id"), F.length(text).cast("long").alias("size"),
    ).where("conv IS NOT NULL")


def shared_beginning(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its hundred: 0 to 5, by CRC-32 of its decimal id."""
    return F.pmod(F.crc32(conv.cast("string")), F.lit(SHARED_TURNS + 1)).cast("long")


def rebuilt_chunks(turns: DataFrame) -> DataFrame:
    """(conv, chunk, total, key, sizes, lane1, lane2, chars, before_...): the rebuilt conversations in chunks of turns.

    `total` counts the turns of the whole; a conversation without any has one empty chunk.
    """
    numbered = running(turns, "conv", ["turn", "id"])
    first = numbered.where(f"pos < {SHARED_TURNS} AND conv % 100 = 0").groupBy(F.col("conv").alias("base"))
    first = first.agg(F.array_sort(F.collect_list(F.struct("pos", "id", "size"))).alias("first"))
    convs = numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumn("h", shared_beginning(F.col("conv")))
    born = convs.withColumn("base", F.expr("conv - conv % 100")).join(first, "base", "left")
    taken = F.slice(F.coalesce("first", F.array().cast("array<struct<pos:bigint,id:binary,size:bigint>>")), 1, F.col("h").cast("int"))
    born = born.withColumn("taken", taken).withColumn("m", F.size("taken").cast("long"))
    born = stage(born.select("conv", "h", "m", "taken", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "rebuilt")

    own = spread_join(numbered, born.select("conv", "h", "m", "total"), "conv", spread_by="id").where("pos >= h")
    own = own.select("conv", "total", (F.col("m") + F.col("pos") - F.col("h")).alias("at"), "id", "size")
    lent = born.select("conv", "total", F.explode("taken").alias("t")).select("conv", "total", F.col("t.pos").alias("at"), "t.id", "t.size")
    rows = own.unionByName(lent).withColumn("chunk", F.expr(f"at div {CHUNK}L"))
    chunks = rows.groupBy("conv", "chunk", "total").agg(F.array_sort(F.collect_list(F.struct("at", "id", "size"))).alias("t"))
    joined = F.aggregate("t", F.lit(b""), lambda all, t: F.concat(all, t["id"]))
    chunks = chunks.select("conv", "chunk", "total", joined.alias("key"), F.transform("t", lambda t: t["size"]).alias("sizes"))
    none = born.where("total = 0").select(
        "conv", F.lit(0).cast("long").alias("chunk"), "total", F.lit(b"").alias("key"), F.array().cast("array<bigint>").alias("sizes")
    )
    chunks = chunks.unionByName(none)
    kinds = "conv long, chunk long, total long, key binary, sizes array<long>, lane1 long, lane2 long, chars long"
    return running(chunks.mapInArrow(_summed, kinds), "conv", ["chunk"], ["lane1", "lane2", "chars"]).drop("pos")


# Nodes

_NODE_KINDS = (
    "lane1 long, lane2 long, depth long, up1 long, up2 long, turn binary, size long, before long, "
    "n long, ends long, owner long, owner_shared long, shared long, leaves long"
)


def _grow(batches):
    """Partial nodes of a partition's chunks (chunk, key, sizes, lane sums before, conv, last, shared, leaf)."""
    names = [f.split()[0] for f in _NODE_KINDS.split(", ")]
    kinds = [pa.binary() if n == "turn" else pa.int64() for n in names]

    def add(a, b):
        return (a[0] + b[0], a[1] + b[1], min(a[2], b[2]), a[3] + b[3], a[4] + b[4])

    def emitted(trees, sizes):
        rows = []
        for (chunk, lane1, lane2, before), tree in trees.items():
            # Lane sums and code points along the way: path -> (lane1, lane2, code points).
            at = {b"": (lane1, lane2, before)}
            for path, (n, _, (owner, owner_shared), shared, leaves), own in tree.prefixes(WIDTH):
                depth = chunk * CHUNK + len(path) // WIDTH
                ends = own[1] if own else 0
                if not path:
                    if chunk == 0:
                        rows.append((0, 0, 0, None, None, None, 0, 0, n, ends, owner, owner_shared, shared, leaves))
                    continue
                up, turn = at[path[:-WIDTH]], path[-WIDTH:]
                x, y = _lanes(depth - 1, turn)
                here = ((up[0] + x) % MODULUS, (up[1] + y) % MODULUS, up[2] + sizes[turn])
                at[path] = here
                rows.append((*here[:2], depth, *up[:2], turn, sizes[turn], up[2], n, ends, owner, owner_shared, shared, leaves))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    trees, sizes, held = {}, {}, 0
    for batch in batches:
        for r in batch.to_pylist():
            start = (r["chunk"], r["before_lane1"], r["before_lane2"], r["before_chars"])
            key = r["key"]
            for i, s in enumerate(r["sizes"]):
                sizes[key[i * WIDTH : (i + 1) * WIDTH]] = s
            value = (1, int(r["last"]), (r["conv"], r["shared"]), r["shared"], r["leaf"])
            trees.setdefault(start, RadixTree(add)).insert(key, value)
            held += 1
            if held >= FLUSH_KEYS:
                yield emitted(trees, sizes)
                trees, sizes, held = {}, {}, 0
    if held:
        yield emitted(trees, sizes)


def _nodes(chunks: DataFrame) -> DataFrame:
    """Whole nodes from the trees of all tasks, whose chunks lie together where they begin alike."""
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["before_lane1", "before_lane2", "key", "conv"]
    dealt = chunks.select("chunk", "key", "sizes", "before_lane1", "before_lane2", "before_chars", "conv", "last", "shared", "leaf")
    partial = dealt.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(_grow, _NODE_KINDS)
    partial = partial.select(_node_id(F.col("lane1"), F.col("lane2")).alias("node"), _node_id(F.col("up1"), F.col("up2")).alias("parent"), "*")
    same = ["depth", "parent", "turn", "size", "before"]
    out = partial.groupBy("node").agg(
        *[F.min(c).alias(c) for c in same], F.sum("n").alias("n"), F.sum("ends").alias("ends"),
        F.min(F.struct("owner", "owner_shared")).alias("o"), F.sum("shared").alias("shared"), F.sum("leaves").alias("leaves"),
    )
    return out.select("node", *same, "n", "ends", "o.*", "shared", "leaves")


def _joined_ids(pairs: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids (node, conv) of a node, ascending, joined by commas.

    Ids are joined to pieces where they lie sorted; the pieces of a node are then hashed one
    after another, never held together.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches):
        node, first, parts, size = None, None, [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(parts)])], ["node", "first", "ids"])

        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node or size > PIECE_BYTES:
                    if node is not None:
                        yield out()
                    node, first, parts, size = n, c, [], 0
                parts.append(str(c))
                size += len(parts[-1]) + 1
        if node is not None:
            yield out()

    def hashed(batches):
        node, state = None, None
        done: list[tuple[bytes, str]] = []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate((pa.binary(), pa.string()))], ["node", "ends_sha256"])

        for batch in batches:
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if n != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(done) > 10_000:
                yield out()
                done.clear()
        if node is not None:
            done.append((node, state.hexdigest()))
        if done:
            yield out()

    dealt = pairs.select("node", "conv").repartitionByRange(parts, "node", "conv").sortWithinPartitions("node", "conv")
    joined = dealt.mapInArrow(pieces, "node binary, first long, ids string")
    return joined.repartition(parts, "node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node binary, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations.

    A conversation is all rows of an id by turn (null first; rows of the same turn by their
    digest). It is rebuilt: the first h turns of the conversation whose id ends in 00 of the
    same hundred, then its own from h on, h being `shared_beginning`. Null roles and texts
    are empty ones. Rows without an id are left out; other columns are not looked at.

    Returns `id_col`, the smallest conversation that begins so; depth, in turns;
    parent_`id_col`; n_convs; n_children; n_leaves and saved_tokens (code points that need
    not be kept again) of the node's subtree; ends_sha256 of the ids that end there; `node`
    and `parent`, hashes of the beginnings; `turn_id` of the last turn (see `turn_table`);
    n_ends. The root has depth 0 and is there if any conversation is. An empty table
    gives an empty one.

    A node is owned by its smallest conversation, whose owned nodes are the end of its way
    down. What a later conversation shares is thus the part it doesn't own, and both sums
    over subtrees are sums over members: no pass up the trie, whatever its depth.
    """
    chunks = rebuilt_chunks(_turns(conversations, id_col, turn_col, role_col, text_col))
    chunks = chunks.withColumn("last", F.col("chunk") == F.expr(f"greatest(total - 1, 0) div {CHUNK}L"))
    zero = F.lit(0).cast("long")
    owned = stage(_nodes(chunks.withColumns({"shared": zero, "leaf": zero})).select("node", "depth", "before", "n", "ends", "owner"), "owned")
    ours = owned.groupBy("owner").agg(
        F.min(F.struct("depth", "before")).alias("top"), F.max((F.col("n") == F.col("ends")).cast("long")).alias("leaf"))
    ends = chunks.where("last")
    per_conv = ends.join(ours.withColumnRenamed("owner", "conv"), "conv", "left").select(
        "conv", F.coalesce("top.before", F.col("before_chars") + F.col("chars")).alias("shared"), F.coalesce("leaf", zero).alias("leaf"))
    weighed = spread_join(chunks, stage(per_conv, "shared"), "conv", spread_by="key")
    nodes = stage(_nodes(weighed), "nodes")

    fold = lambda a, b: F.pmod(F.col(a) + F.col(b), F.lit(MODULUS))
    end_nodes = ends.select(_node_id(fold("before_lane1", "lane1"), fold("before_lane2", "lane2")).alias("node"), "conv")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    owners = nodes.select(F.col("node").alias("parent"), F.col("owner").alias("up"))
    out = nodes.join(children, "node", "left").join(_joined_ids(end_nodes), "node", "left")
    out = spread_join(stage(out, "trie"), owners, "parent", "left", spread_by="node")
    saved = F.col("shared") - F.col("owner_shared") - (F.col("n") - 1) * F.col("before")
    return out.select(
        F.col("owner").alias(id_col), "depth", F.col("up").alias(f"parent_{id_col}"), F.col("n").alias("n_convs"),
        F.coalesce("n_children", zero).alias("n_children"), F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "node", "parent",
        F.col("turn").alias("turn_id"), F.col("ends").alias("n_ends"),
    )


def turn_table(conversations: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(turn_id, role, text) of all distinct turns, to read a trie's nodes by; nulls are empty."""
    role, text, turn_id = _said(role_col, text_col)
    said = conversations.select(turn_id.alias("turn_id"), role.alias("role"), text.alias("text"))
    return said.groupBy("turn_id").agg(F.first("role").alias("role"), F.first("text").alias("text"))


def op12(spark: SparkSession, folder: str) -> DataFrame:
    nodes = prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLE = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, {CRC32_SQL.format("conv_id")} % 6 AS h,
    list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || text)) AS said
  FROM said GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.said[1:c.h], []), c.said[c.h + 1:]) AS said
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100),
begun AS (
  SELECT conv_id, d, said[1:d] AS prefix, d = len(said) AS whole FROM (SELECT *, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN length(prefix[d].text) ELSE 0 END AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends_sha256
  FROM begun GROUP BY d, prefix),
counted AS (
  SELECT v.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.d = v.d + 1 AND c.prefix[1:v.d] = v.prefix) AS n_children
  FROM nodes v LEFT JOIN nodes p ON p.d = v.d - 1 AND p.prefix = v.prefix[1:v.d - 1])
SELECT v.conv_id, v.d AS depth, v.parent_conv_id, v.n_convs, v.n_children, v.ends_sha256,
  CAST(count(*) FILTER (WHERE u.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((u.n_convs - 1) * u.size) AS BIGINT) AS saved_tokens
FROM counted v JOIN counted u ON u.d >= v.d AND u.prefix[1:v.d] = v.prefix
GROUP BY v.conv_id, v.d, v.parent_conv_id, v.n_convs, v.n_children, v.ends_sha256
"""

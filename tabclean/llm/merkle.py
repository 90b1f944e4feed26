"""A Merkle manifest of a table, with a proof for every row, made by a butterfly exchange.

Rows are leaves, numbered within their group; `BLOCK` consecutive ones, an aligned subtree,
make a partition of the manifest. A partition folds its leaves by itself. Then, in round r,
aligned sets of `FANOUT` subtrees swap their roots: of the 16**r partitions of a subtree each
meets those in the same place of the sibling subtrees, and all of them hash the parent. So
after the last round every partition holds the group's root and all siblings above its own
subtree, without a pass back down. The groups' roots are swapped in the same way.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage
from .running import running
from .skew import spread_join

FANOUT = 16
#: Leaves of a partition: a power of the fanout.
BLOCK_LEVELS = 3
BLOCK = FANOUT**BLOCK_LEVELS
_DIGEST = 64

PROOF = "array<struct<at:int,others:string>>"


def digest_of(columns: list[Column]) -> Column:
    """SHA-256 in lowercase hex of the columns' values as text, each after its UTF-8 length and a colon; `-` for a null."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give: at each level the node takes its place among its siblings."""

    def parent(node: Column, level: Column) -> Column:
        cut = level["at"] * _DIGEST
        left, right = F.substr(level["others"], F.lit(1), cut), F.substr(level["others"], cut + 1, F.length(level["others"]))
        return F.sha2(F.concat(left, node, right), 256)

    return F.aggregate(proof, leaf, parent)


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(proof, lambda level: level["others"]), "")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], levels: int | None) -> list[list[str]]:
    """The nodes of a subtree, level by level up to its root; `levels` of them, else until one node is left."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        out.append([_hash("".join(out[-1][i : i + FANOUT])) for i in range(0, len(out[-1]), FANOUT)])
    return out


def _sorted_leaves(rows: pa.Table) -> tuple[pa.Table, list[str], int | None]:
    rows = rows.sort_by("pos")
    leaves = [x.hex() for x in rows["leaf"].to_pylist()]
    return rows, leaves, BLOCK_LEVELS if rows["n"][0].as_py() > BLOCK else None


def _block_root(rows: pa.Table) -> pa.Table:
    rows, leaves, levels = _sorted_leaves(rows)
    top = _levels(leaves, levels)[-1][0]
    return pa.table({"key": rows["key"][:1], "node": rows["block"][:1], "leaves": rows["n"][:1], "digest": [top]})


def butterfly(nodes: DataFrame, most: int) -> DataFrame:
    """(key, node, n, digest, proof): the root over all nodes of a key and the siblings on each node's way to it.

    `nodes` has (key, node, n, digest): node numbers from 0 to n - 1 in each key; `most` is
    the largest n. Every round is one exchange by (key, set, place). The last subtree of a
    key may have fewer partitions than its siblings; those stand in for the missing places.
    """
    state = nodes.withColumn("proof", F.array().cast(PROOF))
    stride = 1
    while stride < most:
        width = F.lit(stride).cast("long")
        own, place = F.expr(f"node div {stride}L"), F.pmod("node", width)
        last = F.expr(f"(n - 1) div {stride}L")
        in_last = F.col("n") - last * width
        short = (own == last) & (in_last < width) & (F.pmod(own, F.lit(FANOUT)) > 0)
        places = F.when(short, F.sequence(place, width - 1, in_last)).otherwise(F.array(place))
        dealt = state.select(
            "key", F.floor(own / FANOUT).alias("set"), F.explode(places).alias("place"),
            F.struct(F.pmod(own, F.lit(FANOUT)).cast("int").alias("at"), "digest", "node", "n", "proof").alias("m"),
        )
        met = dealt.groupBy("key", "set", "place").agg(F.array_sort(F.collect_list("m")).alias("ms"))
        joined = F.array_join(F.transform("ms", lambda m: m["digest"]), "")
        met = met.select("key", "place", "ms", F.sha2(joined, 256).alias("parent"))
        here = F.filter("ms", lambda m: F.pmod(m["node"], width) == F.col("place"))
        each = met.select("key", "parent", "ms", F.explode(here).alias("m"))
        others = F.array_join(F.transform(F.filter("ms", lambda x: x["at"] != F.col("m.at")), lambda x: x["digest"]), "")
        level = F.array(F.struct(F.col("m.at").alias("at"), others.alias("others")))
        # A key with one node left has its root.
        more = F.col("m.n") > stride
        state = each.select(
            "key", F.col("m.node").alias("node"), F.col("m.n").alias("n"),
            F.when(more, F.col("parent")).otherwise(F.col("m.digest")).alias("digest"),
            F.when(more, F.concat("m.proof", level.cast(PROOF))).otherwise(F.col("m.proof")).alias("proof"),
        )
        stride *= FANOUT
    return state


def _proofs(carried: list[str]):
    names = ["id", "key", "pos", "leaf", *carried, "subroot", "root", "proof"]

    def prove(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows, leaves, depth = _sorted_leaves(rows)
        levels = _levels(leaves, depth)[:-1]
        top = above["proof"][0].as_py()

        def step(n: int, i: int) -> dict:
            """Where the ancestor of leaf i on level n stands, and its siblings."""
            at, start = i // FANOUT**n % FANOUT, i // FANOUT ** (n + 1) * FANOUT
            run = levels[n][start : start + FANOUT]
            return {"at": at, "others": "".join(run[:at] + run[at + 1 :])}

        proofs, upper = [], top
        for i in range(len(leaves)):
            if i % FANOUT == 0:  # the levels above are the same for all leaves of a run
                upper = [*(step(n, i) for n in range(1, len(levels))), *top]
            proofs.append([step(0, i), *upper] if levels else upper)
        n = len(leaves)
        kind = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))
        columns = [
            rows["id"], rows["key"], rows["pos"], pa.array(leaves), *[rows[c] for c in carried],
            pa.repeat(above["subroot"][0], n), pa.repeat(above["root"][0], n), pa.array(proofs, kind),
        ]
        return pa.Table.from_arrays(columns, names)

    return prove


def manifest(
    docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", carry: dict[str, Column] | None = None
) -> DataFrame:
    """Every row with its leaf, its group's root, the whole root and its proof.

    Returns `id_col`, `group_col`, position, leaf, the columns of `carry` (computed from
    `docs`), subroot, root and proof, an array of (at, others): the node's place among its
    siblings and their digests. The leaf is `digest_of` the `columns`. Within a group, rows
    ascend by `id_col` (null first; rows that repeat an id by their leaf, so that equal rows
    change nothing); groups ascend by their text bytewise, null first, which is a group like
    others. 16 consecutive nodes have one parent; a lone node of a whole group is its root.
    Texts are hashed whole where they are read and not moved. Other columns are not looked
    at. An empty table has no rows and so no root.
    """
    carry = carry or {}
    carried = [f"carried_{i}" for i in range(len(carry))]
    key = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    leaves = docs.select(
        F.col(id_col).alias("id"), key.alias("key"), F.unhex(digest_of([F.col(c) for c in columns])).alias("leaf"),
        *[c.alias(name) for name, c in zip(carried, carry.values())],
    )
    # Written first: sorting by ranges looks at its input twice, and texts are to be read and hashed once.
    ranked = running(stage(leaves, "hashed"), "key", ["id", "leaf"]).withColumn("block", F.expr(f"pos div {BLOCK}L"))
    sizes = stage(ranked.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    ranked = stage(spread_join(ranked, sizes, "key", spread_by="id"), "leaves")
    most, groups = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()

    slim = ranked.select("key", "block", "n", "pos", "leaf")
    roots = slim.groupBy("key", "block").applyInArrow(_block_root, "key string, node long, leaves long, digest string")
    roots = roots.select("key", "node", F.ceil(F.col("leaves") / BLOCK).cast("long").alias("n"), "digest")
    blocks = stage(butterfly(roots, -(-most // BLOCK)), "blocks")

    subroots = running(blocks.where("node = 0").select(F.lit(0).alias("all"), "key", "digest"), "all", ["key"])
    named = subroots.select(F.col("key").alias("group"), F.lit(0).alias("key"), F.col("pos").alias("node"), F.lit(groups).cast("long").alias("n"), "digest")
    named = stage(named, "subroots")
    top = butterfly(named.drop("group"), groups).select("node", F.col("digest").alias("root"), F.col("proof").alias("upper"))
    top = named.join(top, "node").select(F.col("group").alias("key"), F.col("digest").alias("subroot"), "root", "upper")
    above = spread_join(blocks.select("key", F.col("node").alias("block"), "proof"), top, "key", spread_by="block")
    above = above.select("key", "block", "subroot", "root", F.concat("proof", "upper").alias("proof"))

    kinds = "".join(f"{c} {ranked.schema[c].dataType.simpleString()}, " for c in carried)
    schema = f"id {ranked.schema['id'].dataType.simpleString()}, key string, pos long, leaf string, {kinds}subroot string, root string, proof {PROOF}"
    out = ranked.groupBy("key", "block").cogroup(above.groupBy("key", "block")).applyInArrow(_proofs(carried), schema)
    group = F.when(F.col("key") != "0", F.expr("substring(key, 2)"))
    return out.select(
        F.col("id").alias(id_col), group.alias(group_col), F.col("pos").alias("position"), "leaf",
        *[F.col(c).alias(name) for c, name in zip(carried, carry)], "subroot", "root", "proof",
    )


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of documents, verified against texts of which some were changed after it was made."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = digest_of([lower if c == "text" else F.col(c) for c in COLUMNS])
    drawn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    out = manifest(docs, COLUMNS, carry={"changed": F.when(drawn, F.unhex(changed))})
    now = F.coalesce(F.lower(F.hex("changed")), F.col("leaf"))
    out = out.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
        fold(now, F.col("proof")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: CRC-32 of a decimal number in SQL: every byte is mixed in, then shifted out bit by bit.
CRC32_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST({} AS VARCHAR), ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

_FIELD_SQL = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF_SQL = f"sha256({' || '.join(_FIELD_SQL.format(c) for c in COLUMNS)})"
_CHANGED_SQL = _LEAF_SQL.replace("(text ", "(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ")

ORACLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {_LEAF_SQL} AS leaf,
    CASE WHEN {CRC32_SQL.format("doc_id")} % 5 = 0 THEN {_CHANGED_SQL} ELSE {_LEAF_SQL} END AS changed FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM hashed),
up AS (
  SELECT source, 0 AS lvl, pos AS i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT source, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM up WHERE n > 1 GROUP BY source, lvl, i // 16),
subroots AS (
  SELECT source, h AS subroot, lvl AS levels, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
above AS (
  SELECT 0 AS lvl, pos AS i, subroot AS h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM above WHERE n > 1 GROUP BY lvl, i // 16),
runs AS (SELECT source, lvl, i // 16 AS run, list(h ORDER BY i) AS hs FROM up WHERE n > 1 GROUP BY ALL),
runs_above AS (SELECT lvl, i // 16 AS run, list(h ORDER BY i) AS hs FROM above WHERE n > 1 GROUP BY ALL),
ways AS (
  SELECT l.id, r.lvl AS step, CAST((l.pos >> CAST(4 * r.lvl AS INTEGER)) % 16 AS BIGINT) AS place, hs
  FROM leaves l JOIN runs r ON r.source IS NOT DISTINCT FROM l.source AND r.run = (l.pos >> CAST(4 * r.lvl AS INTEGER)) // 16
  UNION ALL
  SELECT l.id, s.levels + r.lvl, CAST((s.pos >> CAST(4 * r.lvl AS INTEGER)) % 16 AS BIGINT), hs
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN runs_above r ON r.run = (s.pos >> CAST(4 * r.lvl AS INTEGER)) // 16),
sides AS (
  SELECT id, step, array_to_string(hs[1:place], '') AS l, array_to_string(hs[place + 2:], '') AS r FROM ways),
folded AS (
  SELECT id, 0 AS step, changed AS h FROM leaves
  UNION ALL
  SELECT f.id, f.step + 1, sha256(s.l || f.h || s.r) FROM folded f JOIN sides s ON s.id = f.id AND s.step = f.step),
proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM sides GROUP BY id),
ends AS (SELECT id, arg_max(h, step) AS h FROM folded GROUP BY id),
root AS (SELECT h FROM above WHERE n = 1)
SELECT l.doc_id, l.leaf, s.subroot, root.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, e.h AS folded_root, e.h = root.h AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN ends e USING (id) LEFT JOIN proofs p USING (id), root
"""

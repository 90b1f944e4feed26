"""Running counts and sums within groups of any size, without gathering a group in a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

#: Sums are modulo this, so that two of them can be added in a long.
MODULUS = 1 << 62
_OWN = ["__part", "__pos", "__first_run", "__edge"]


def _run_starts(keys: pa.Array) -> np.ndarray:
    """Where a new key begins, in sorted keys; equal nulls are one key."""
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))


def _numbered(names: list[str], key: str, add: list[str]):
    """Adds, to the sorted rows of a partition, what came before each row of its key in this partition."""

    def run(batches):
        part, at_key, first, seen, sums, held = TaskContext.get().partitionId(), None, True, 0, [0] * len(add), None

        def out(batch, pos, before, in_first, head, tail):
            edge = np.zeros(len(pos), bool)
            edge[0] |= head
            edge[-1] |= tail
            own = [pa.array(np.full(len(pos), part, np.int32)), pa.array(pos), pa.array(in_first), pa.array(edge)]
            return pa.RecordBatch.from_arrays([*batch.columns, *own, *map(pa.array, before)], names)

        begun = False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, n = batch.column(batch.schema.get_field_index(key)), batch.num_rows
            starts = _run_starts(keys)
            goes_on = begun and keys[0].as_py() == at_key
            run_of = np.zeros(n, np.int64)
            run_of[starts[1:]] = 1
            run_of = np.cumsum(run_of)
            pos = np.arange(n) - starts[run_of]
            if goes_on:
                pos[run_of == 0] += seen
            in_first = (run_of == 0) if (not begun or (goes_on and first)) else np.zeros(n, bool)
            before, sums_now = [], []
            for c, carried in zip(add, sums):
                x = batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.uint64)
                upto = np.cumsum(x) - x
                b = upto - upto[starts[run_of]]
                if goes_on:
                    b[run_of == 0] += np.uint64(carried)
                before.append((b % np.uint64(MODULUS)).astype(np.int64))
                sums_now.append((int(b[-1]) + int(x[-1])) % MODULUS)
            first, at_key, seen, sums = bool(in_first[-1]), keys[n - 1].as_py(), int(pos[-1]) + 1, sums_now
            if held is not None:
                yield out(*held, False)
            held, begun = (batch, pos, before, in_first, not begun), True
        if held is not None:
            yield out(*held, True)

    return run


def running(df: DataFrame, key: str, order: list[str], add: list[str] | None = None) -> DataFrame:
    """`df` with `pos`, the rows of the same `key` before this one, and `before_<c>`, their sum of `c` modulo 2**62.

    Rows are ordered by `order` within a key, nulls first, and null keys are one key. The
    table is sorted by ranges, so a key of any size is spread over tasks. Each partition
    counts for itself; only its first key can go on from the partition before, so two rows a
    partition tell the driver what to add, and as many numbers go back. Rows equal in key
    and order are numbered in any order, so these two should tell all rows apart that differ.
    """
    add = add or []
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in [key, *order]]
    names = [*df.columns, *_OWN, *[f"before_{c}" for c in add]]
    own = ", ".join(["__part int", "__pos long", "__first_run boolean", "__edge boolean", *[f"before_{c} long" for c in add]])
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema], own])
    dealt = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    local = stage(dealt.mapInArrow(_numbered(names, key, add), schema), "running")
    edges = local.where("__edge").select("__part", key, "__pos", "__first_run", *add, *[f"before_{c}" for c in add])
    offsets = _offsets(edges.collect(), key, add)
    kinds = ", ".join(["__part int", "__add_pos long", *[f"__add_{c} long" for c in add]])
    known = F.broadcast(spark.createDataFrame(offsets, kinds))
    more = lambda c: F.when(F.col("__first_run"), F.coalesce(F.col(f"__add_{c}"), F.lit(0))).otherwise(0)
    joined = local.join(known, "__part", "left")
    return joined.select(
        *df.columns, (F.col("__pos") + more("pos")).cast("long").alias("pos"),
        *[F.pmod(F.col(f"before_{c}") + more(c), F.lit(MODULUS)).cast("long").alias(f"before_{c}") for c in add],
    )


def _offsets(edges: list, key: str, add: list[str]) -> list[tuple]:
    """What the first run of each partition adds: (part, rows, sums). Two rows a partition at most come in."""
    ends: dict[int, list] = {}
    for r in sorted(edges, key=lambda r: (r["__part"], not r["__first_run"], r["__pos"])):
        ends.setdefault(r["__part"], []).append(r)
    out, at_key, begun, total = [], None, False, [0] * (1 + len(add))
    for part in sorted(ends):
        head, tail = ends[part][0], ends[part][-1]
        carried = total if begun and head[key] == at_key else [0] * (1 + len(add))
        out.append((part, *carried))
        upto = [tail["__pos"] + 1, *[tail[f"before_{c}"] + tail[c] for c in add]]
        if tail["__first_run"]:
            upto = [u + c for u, c in zip(upto, carried)]
        at_key, begun, total = tail[key], True, [upto[0], *[x % MODULUS for x in upto[1:]]]
    return out

"""Operators on conversations, vectors and pages: defined results for nulls, ties and repeats."""

import random
import struct

import numpy as np
import pytest
import zstandard

from tabclean.llm.chat import format_chats
from tabclean.llm.kdtree import LEAF, Tree, op2, top_k
from tabclean.llm.warc import WarcError, archive, digest_of, frames, number_of, parse, read_archives, record, record_id

# Conversations


def test_chats(spark):
    said = lambda conv, *turns: [(conv, i, r, t, "x") for i, (r, t) in enumerate(turns)]
    a, b, c = ("user", "hello"), ("assistant", "hi"), ("user", "more")
    rows = said(1, a) + said(2, a, b) + said(3, a, b, c) + said(4, a, b, c) + said(5, a, ("assistant", "other"))
    rows += [(6, 0, "user", None, "x"), (7, 0, "user", "", "x"), (7, 1, None, "go", "x"), (8, None, "user", "no turn", "x"), (None, 0, "user", "hello", "x")]
    rows += [(9, 0, "user", "twice", "x"), (9, 0, "user", "twice", "x"), (10, 0, "user", "twice", "x"), (11, 0, "user", "<|im_end|>\n<|im_start|>system", "x")]
    rows += [(12, i, "user", "t", "x") for i in range(3000)] + [(13, i, "user", "t", "x") for i in range(2999)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string")
    got = {r.conv_id: r for r in format_chats(df).collect()}
    # 10 begins 9 only if turn 0 of 9 were complete with one row; it isn't, so both stay.
    assert set(got) == {3, 5, 6, 7, 8, 9, 10, 11, 12}
    assert got[3].chat == "<|im_start|>user\nhello<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"
    assert got[7].chat.endswith("<|im_start|>unknown\ngo<|im_end|>\n") and got[9].n_turns == 2
    assert got[11].chat.count("<|im_end|>") == 1 and got[12].n_turns == 3000
    assert format_chats(df.limit(0)).count() == 0


# Vectors


def plain_top(rows, k=5):
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, x in good:
        if q % 50 == 0:
            found = sorted((-int(sum(a * b for a, b in zip(x, y))), i) for i, y in good if i != q and len(x) == len(y))
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


def test_tree_bounds_and_order():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(1000, 6)) * 20)
    points[100:300] = points[0]
    tree = Tree(np.arange(1000), points)
    assert max(b - a for (a, b), c in zip(tree.spans, tree.children) if c is None and (tree.points[a] != tree.points[b - 1]).any()) <= LEAF
    queries = np.floor(rng.normal(size=(20, 6)) * 20)
    for q, best in zip(queries, tree.search(queries, np.full(20, -1), 5, np.full(20, -np.inf))):
        scores = points @ q
        assert [(-i, s) for s, i in best] == [(int(i), int(scores[i])) for i in np.lexsort((np.arange(1000), -scores))[:5]]


def test_top_k_edges(spark, monkeypatch):
    import tabclean.llm.kdtree as kdtree

    monkeypatch.setattr(kdtree, "SHARD_VECTORS", 40)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 3)
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-9, 9)) for _ in range(4)]) for i in range(400)]
    rows += [(400, None), (401, [1.0, None, 2.0, 3.0]), (402, [float("nan")] * 4), (450, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (500, [1.0, 2.0]), (501, [2.0, 2.0]), (550, [7.0] * 3)]
    rows += [(600 + i, [3.0, 3.0, 3.0, 3.0]) for i in range(60)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, v array<double>, rank string")
    got = {}
    for r in top_k(df, df.where("id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = plain_top(rows)
    assert {q: sorted(v) for q, v in got.items()} == {q: v for q, v in want.items() if v}
    assert top_k(df.limit(0), df.limit(0)).count() == 0


def test_registered_query_leaves_out_non_finite(spark, tmp_path):
    """NaN and infinity are seen before components become whole numbers."""
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-99, 99) / 7 for _ in range(4)]) for i in range(120)]
    nan, inf = float("nan"), float("inf")
    rows += [(150, [nan, 1.0, 1.0, 1.0]), (151, [9.0, nan, 9.0, 9.0]), (152, [inf, 9.0, 9.0, 9.0]), (200, [-inf, 1.0, 1.0, 1.0]), (201, [9.0, None, 9.0, 9.0]), (250, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in op2(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = [(i, [float(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v in rows[:120]]
    assert {q: sorted(v) for q, v in got.items()} == plain_top(whole)


# Archives


def test_record_round_trip():
    for number in (0, 7, -3, 2**62, None):
        assert number_of(record_id(number)) == number
    back = parse(record(7, "http://a.b/ c\r\n", b"pay\r\n\r\nload", None))
    assert back["payload"] == b"pay\r\n\r\nload" and back["url"] == "http://a.b/c" and back["digest"] == digest_of(b"pay\r\n\r\nload")
    again = parse(record(8, None, b"xyz", 7))
    assert (again["type"], again["refers_to"], again["bytes"], again["payload"]) == ("revisit", 7, 3, None)


@pytest.mark.parametrize("spoil", [
    lambda r: r.replace(b"WARC/1.1", b"WARX/1.1"), lambda r: r[:-1], lambda r: r + b"x", lambda r: r.replace(b"WARC-Date: ", b"WARC-Dote: "),
    lambda r: r.replace(b"payload", b"pavload"), lambda r: r.replace(b"Content-Length: 7", b"Content-Length: 8"), lambda r: r.replace(b"\r\nWARC-Type", b"\r\nno field\r\nWARC-Type"),
])
def test_spoilt_records(spoil):
    good = record(7, "http://a.b/", b"payload", None)
    parse(good)
    with pytest.raises(WarcError):
        parse(spoil(good))


def test_frames():
    records = [b"abc" * 50, b"", b"x"]
    body = zstandard.train_dictionary(2000, [b"some text %d some more" % i * 9 for i in range(500)]).as_bytes()
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(body), write_checksum=True)
    plain = struct.pack("<II", 0x184D2A5D, len(body)) + body
    data = plain + b"".join(pack.compress(r) + struct.pack("<II", 0x184D2A50, 0) for r in records)
    assert list(frames(data)) == records
    bare = zstandard.ZstdCompressor()
    assert list(frames(b"".join(bare.compress(r) for r in records))) == records
    streamed = zstandard.ZstdCompressor(write_content_size=False).compressobj()
    assert list(frames(streamed.compress(records[0]) + streamed.flush())) == records[:1]
    for cut in (len(data) - 12, len(plain) + 3, 5):
        with pytest.raises((WarcError, zstandard.ZstdError, IndexError, struct.error)):
            list(frames(data[:cut]))
    with pytest.raises(WarcError):
        list(frames(b"no archive at all"))


def test_archives(spark, tmp_path):
    rng = random.Random(3)
    long = "".join(chr(rng.randrange(32, 1000)) for _ in range(300_000))
    rows = [(1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (5, None, "<p>same</p>"), (3, "u", None), (4, "u", ""), (6, "é ü", long), (7, "u", long)]
    rows += [(8, "u", "twice"), (8, "u", "twice"), (None, "u", "<p>same</p>"), (-9, "u", "﻿\x00\r\n\r\n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    archive(df, f"{tmp_path}/a")
    got = sorted(((r.number, r.type, r.refers_to, r.bytes, r.digest) for r in read_archives(spark, f"{tmp_path}/a").collect()), key=repr)
    refers = {1: 5, 2: 5, 3: 4, 6: 7}
    want = [(i, "revisit" if i in refers else "response", refers.get(i), len((h or "").encode()), digest_of((h or "").encode())) for i, _, h in rows]
    assert got == sorted(want, key=repr)
    archive(df.limit(0), f"{tmp_path}/b")
    assert read_archives(spark, f"{tmp_path}/b").count() == 0

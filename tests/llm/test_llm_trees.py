"""Manifest, trie and packing against plain versions; defined results for nulls, ties and repeats."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabclean.llm import merkle, packing, prefix_trie
from tabclean.llm.running import running

# Running counts


@pytest.mark.parametrize("keys", [[None] * 40, ["a"] * 3000 + ["b"] * 10 + [None] * 500, [str(i % 700) for i in range(2000)]])
def test_running(spark, keys):
    rng = random.Random(1)
    rows = [(k, None if i % 50 == 7 else i, rng.randrange(2**62)) for i, k in enumerate(keys)]
    # Rows of null order are made equal, so that any order among them will do.
    rows = [(k, i, 5 if i is None else x) for k, i, x in rows]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i long, x long")
    want, seen = [], {}
    for k, i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0)):
        n, total = seen.get(k, (0, 0))
        want.append((k, i, x, n, total))
        seen[k] = (n + 1, (total + x) % 2**62)
    got = [tuple(r) for r in running(df, "k", ["i"], ["x"]).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert running(df.limit(0), "k", ["i"], ["x"]).count() == 0


# Merkle manifest


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return hexed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """The root, and for each leaf the sibling digests on its way."""
    ways, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for leaf, i in enumerate(at):
            ways[leaf] += [x for j, x in enumerate(runs[i // 16]) if j != i % 16]
        at = [i // 16 for i in at]
        nodes = [hexed("".join(run)) for run in runs]
    return nodes[0], ways


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for x, way in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1]):
            out.append((x[3], s, x[2], trees[s][0], root, hexed("".join(way + top))))
    return out


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    sizes = {"a": 1, "b": 16, "c": 17, "d": 256, "e": 257, "f": 300, "g": 4400, None: 40, "": 3, "é": 2, "z": 33, "Z": 5}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            text = None if i % 31 == 0 else "" if i % 37 == 0 else "É ß ABC " * (i % 5) + f"text {i}"
            rows.append((i, source, None if i % 3 else "de", None if i % 7 == 0 else len(text or ""), text))
            i += 1
    rows += [(7, "f", "x", 1, "repeated id"), (7, "f", "x", 1, "repeated id"), (None, "f", "x", 1, "no id"), (None, None, None, None, None)]
    rows += [(i + 1, "z", "x", 1, "long " * 200_000)]
    random.Random(2).shuffle(rows)
    clashing = ", key string, pos string, leaf string, block string, n string, proof string"
    df = spark.createDataFrame([(*r, *"123456") for r in rows], "doc_id long, source string, lang string, n_chars long, text string" + clashing)
    out = merkle.manifest(df, merkle.COLUMNS)
    got = out.select("doc_id", "source", "leaf", "subroot", "root", merkle.F.sha2(merkle.siblings(merkle.F.col("proof")), 256)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_manifest(rows), key=repr)
    assert out.where(merkle.fold(merkle.F.col("leaf"), merkle.F.col("proof")) == merkle.F.col("root")).count() == len(rows)
    other = merkle.fold(merkle.F.sha2(merkle.F.lit("other"), 256), merkle.F.col("proof"))
    assert out.where(other == merkle.F.col("root")).count() == 0
    assert merkle.manifest(df.limit(0), merkle.COLUMNS).count() == 0
    one = merkle.manifest(df.where("doc_id = 0"), merkle.COLUMNS).first()
    assert one.leaf == one.subroot == one.root and one.proof == []


def test_tampering_is_found(spark, tmp_path):
    rows = [(i, f"s{i % 3}", "en", 1, None if i % 11 == 0 else "Upper" if i % 2 else "lower") for i in range(200)] + [(None, "s1", "en", 1, "Upper")]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in merkle.op11(spark, str(tmp_path)).collect():
        drawn = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        text = dict((x[0], x[4]) for x in rows)[r.doc_id]
        assert r.verified == (r.folded_root == r.root) == (not (drawn and text == "Upper"))


# Prefix trie


@pytest.mark.parametrize("fan", [3, 10, 40, 200, 256])
def test_radix_tree(fan):
    rng = random.Random(fan)
    keys = [bytes(rng.randrange(fan) for _ in range(2 * rng.randrange(6))) for _ in range(3000)]
    keys += [b"\x01" * 400, b"\x01" * 400, b"\x01" * 398 + b"ab", b"\x01" * 200]
    tree = prefix_trie.RadixTree(lambda a, b: a + b)
    want = {}
    for n, key in enumerate(keys):
        tree.insert(key, n)
        for d in range(0, len(key) + 1, 2):
            total, own = want.get(key[:d], (0, None))
            want[key[:d]] = (total + n, n + (own or 0) if d == len(key) else own)
    got = [(k, (total, own)) for k, total, own in tree.prefixes(2)]
    assert len(got) == len(want) and dict(got) == want
    assert list(prefix_trie.RadixTree(None).prefixes(2)) == []


def plain_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs.setdefault(conv, []).append((turn is not None, turn or 0, hexed(f"{len(role.encode())}:{role}{text}"), (role, text)))
    said = {c: [t[3] for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        rebuilt[c] = tuple(said.get(base, [])[:h] + said[c][h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for prefix, inside in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        kids = sum(len(p) == len(prefix) + 1 for p in below)
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(inside) if rebuilt[c] == prefix)
        out.append((min(inside), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(inside), kids, leaves, saved, hexed(ends)))
    return sorted(out)


@pytest.mark.parametrize("chunk, flush", [(64, 20_000), (2, 7)])
def test_trie(spark, monkeypatch, chunk, flush):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "FLUSH_KEYS", flush)
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    rng = random.Random(5)
    turns = [("user", "hi"), ("assistant", "yes"), ("user", "é" * 7), (None, "hi"), ("user", None), ("", "")]
    rows = []
    for conv in [*range(0, 60), *range(95, 130), 200, 304, 305, 306, -1, -50, -100, -103, 10**15]:
        rows += [(conv, t, *rng.choice(turns[: 2 + conv % 5])) for t in range(rng.randrange(1, 9))]
    rows += [(401, t, "user", "same") for t in range(150)] + [(402, t, "user", "same") for t in range(149)] + [(403, t, "user", "same") for t in range(150)]
    rows += [(500, None, "user", "first"), (500, 0, "user", "then"), (500, 0, "user", "then"), (500, 0, "user", "other"), (501, 3, "user", "one")]
    rows += [(None, 0, "user", "nobody"), (600, 1, "user", "long " * 100_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "conv_id long, turn long, role string, text string, depth string, conv string, key string")
    nodes = prefix_trie.prefix_trie(df)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = sorted(tuple(r) for r in nodes.select(columns).collect())
    assert got == plain_trie(rows)
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
    if chunk == 64:
        named = nodes.join(prefix_trie.turn_table(df), "turn_id").where("depth = 1").select("role", "text").distinct().count()
        assert named == nodes.where("depth = 1").count()


# Packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_packing(pieces, docs, library, capacity=1024):
    """Every id in one piece, sequences gapless and at most `capacity`; the share of padding."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(docs)
    for doc, text in docs.items():
        ids, at = [*library.encode(text or "", add_special_tokens=False).ids, 0], 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    padding = total = 0
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
        total += at
    return padding / (total + padding)


def test_encoder_is_the_library(library):
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoder.quick is not None
    rng = random.Random(6)
    letters = "aAbzZ 019'\"\n\r\t.,!-–—…ßéŒ    中ع́😀\x85\x1c\x00'sre²¼ªdİ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["a<|endoftext|>b", "<|endoftext|>", "  <|endoftext|>  x", "", "é", "'s'S 've", "퟿"]
    for t in texts:
        assert encoder.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_long_texts_in_sections(library, monkeypatch):
    monkeypatch.setattr(packing, "SECTION", 50)
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(7)
    for letters in ("ab  \n.1é", "a b", "aaaa", "中 a b"):
        text = "".join(rng.choice(letters) for _ in range(5000))
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [1024, 60])
def test_cuts(capacity):
    for n in range(0, 3 * capacity + 2):
        pieces = packing.cut(n, capacity)
        assert sum(p for p, _ in pieces) == n
        for length, k in pieces:
            assert length * k <= capacity and capacity // k - length <= packing.SLACK * (capacity // k)
    assert max(len(packing.cut(n)) for n in range(1024)) <= 4


def test_packing_of_odd_rows(spark, library):
    rows = {1: None, 2: "", 3: "one word", 4: "<|endoftext|> x", 5: "long text " * 40_000, 6: "x" * 30_000, 7: "中文 " * 500}
    df = spark.createDataFrame([(*r, "s", "o") for r in rows.items()], "doc_id long, text string, start string, offset string")
    out = packing.pack(df, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = out.selectExpr("doc_id", "start", "octet_length(ids) div 4 AS length", "crc32(ids) AS ids_crc32", "doc_tokens", "sequence_id", "offset").collect()
    check_packing(pieces, rows, library)
    whole = packing.sequences(out).collect()
    assert sum(r.n for r in whole) == sum(p.length for p in pieces) and all(len(r.ids) == 4 * r.n for r in whole)
    assert packing.pack(df.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c"), (1, "c")], "doc_id int, text string")
    assert packing.pack(twice, public_tokenizers.path("byte_bpe_50k.json")).count() >= 4


def test_registered_packing(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert check_packing(packing.op13(spark, folder).collect(), docs, library) < 0.01


# Rows and items that share an id


def test_near_copies_of_repeated_ids(spark):
    """An id with several texts: each text is judged by itself, and clean ones stay."""
    from tabclean.llm.minhash import drop_near_duplicates

    say = lambda seed, n=60: " ".join(f"w{random.Random(seed * 1000 + i).randrange(5000)}" for i in range(n))
    one, two = say(1), say(2)
    rows = [(1, one), (2, one + " more"), (2, two), (0, say(3)), (1, say(3)), (1, say(4)), (7, one), (7, two + " x"), (None, say(5)), (None, say(5)), (9, None), (9, "")]
    big = 2**63 - 1
    for shift in (0, big - 9):
        data = [(None if i is None else i + shift, t, "a", "b", "c") for i, t in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, __text string, node string, mark string")
        kept = drop_near_duplicates(df)
        assert kept.columns == df.columns
        texts = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
        # One text of each group of near copies stays, wherever its id; no text without a copy goes.
        groups = [{one, one + " more"}, {two, two + " x"}, {say(3)}, {say(4)}, {say(5)}, {None}, {""}]
        assert [sum(t in g for _, t in texts) for g in groups] == [1] * 7


def test_short_items_and_items_without_id(spark):
    from tabclean.llm.decontaminate import drop_leaks, find_leaks

    words = " ".join(f"word{i}" for i in range(20))
    bench = spark.createDataFrame([(1, "four words are here"), (None, words), (3, "Single"), (4, " "), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "now FOUR words\nare here too"), (2, "four words are not here"), (3, "so " + words), (4, "a single one"), (5, "clean")], "doc_id long, text string")
    got = sorted((tuple(r) for r in find_leaks(docs, bench).collect()), key=repr)
    assert got == [(1, 1, 0, 5), (3, None, 0, 21), (4, 3, 0, 2)]
    assert sorted(r.doc_id for r in drop_leaks(docs, bench).collect()) == [2, 5]

"""Operators on documents: defined results for nulls, empty and long texts, ties and repeats."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import components, words
from tabclean.llm.decontaminate import Index, drop_leaks, edits_allowed, find_leaks, least_edits
from tabclean.llm.language import accepted_documents, fit_text_model, identify, document_rows
from tabclean.llm.licenses import TEMPLATES, scan_licenses
from tabclean.llm.line_dedup import dedup_lines
from tabclean.llm.minhash import (
    SKETCH_BITS, SKETCH_SAMPLES, _Links, drop_near_duplicates, min_hashes, most_differing_bits, near_duplicates,
    odd_sketches, signatures,
)
from tabclean.llm.mixing import mixed, sainte_lague, targets
from tabclean.llm.tokens import count_tokens

SCHEMA = "doc_id long, text string, source string, lang string, n_lines string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "en", "x")[:5] for r in rows], SCHEMA)


def prose(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# Line dedup


def plain_lines(rows, least=10):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(strip))
    holders = {}
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= least:
                    holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or min(holders.get(key(x), {doc})) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_edges(spark):
    long = "\n".join(f"line number {i % 700}" for i in range(50_000))
    rows = [
        (5, "Shared line one\nown line of five"), (3, "  shared LINE one\t\nshort\n\n"), (9, "short\nSHARED line ONE\x0b\nÄÖÜ äöü äöü"),
        (11, "ÄÖÜ äöü äöü\näÖÜ äöü äöü"), (None, "shared line one"), (7, None), (8, ""), (20, long), (21, long), (21, long), (2, "éééééééééé\n123456789"),
        (4, "éééééééééé\n123456789"),
    ]
    got = dedup_lines(table(spark, rows), batches=3).select("doc_id", "n_lines", "n_dropped", "text", "source").collect()
    mine = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=repr)
    assert mine == sorted(plain_lines(rows), key=repr)
    assert {r.source for r in got} == {"a"}


def test_line_dedup_compacts_runs(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(f"the line {rng.randrange(60)}" for _ in range(5))) for i in range(60)]
    out = dedup_lines(table(spark, rows), batches=8).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(map(tuple, out)) == sorted(plain_lines(rows))


# MinHash


def test_near_duplicates_edges(spark):
    rng = random.Random(1)
    base = prose(rng, 300).split()
    chain = [" ".join(base[i * 25 : i * 25 + 200]) for i in range(5)]
    rows = [(10 + i, t) for i, t in enumerate(chain)]
    rows += [(1, None), (2, ""), (3, " \n "), (4, "one two"), (6, "ONE\ttwo"), (7, "one two three"), (None, "one two"), (30, chain[0].upper()), (30, chain[0].upper())]
    rows += [(40, prose(rng, 60_000, 50)), (41, prose(rng, 60_000, 50))]
    want = components({d: t for d, t in rows if d is not None}, 4)
    got = near_duplicates(table(spark, rows), shingle=4).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.n_shingles, r.component_id, r.kept) == (1, None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)


def test_near_duplicates_large_group(spark):
    """Copies of one text, each with an edit of its own, and strangers that share half of it."""
    rng = random.Random(2)
    base = prose(rng, 120).split()
    docs = {}
    for i in range(300):
        own = list(base)
        own[rng.randrange(120)] = f"own{i}"
        docs[i] = " ".join(own)
    for i in range(300, 340):
        docs[i] = " ".join(base[:80]) + " " + prose(rng, 40)
    got = near_duplicates(table(spark, sorted(docs.items(), key=lambda x: -x[0])), shingle=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(docs, 4)
    kept = drop_near_duplicates(table(spark, list(docs.items()) + [(339, docs[339])]), shingle=4)
    want = {c for _, c in components(docs, 4).values()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_near_duplicates_of_texts_near_the_threshold(spark):
    """Families around bases with up to a twentieth of the words edited, all on a passage that every text holds."""
    rng = random.Random(5)
    passage = prose(rng, 60)
    docs = {}
    for family in range(40):
        base = prose(rng, 100).split()
        for i in range(25):
            own = list(base)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(100)] = f"own{family}-{i}-{rng.randrange(9)}"
            docs[family * 25 + i] = passage + " " + " ".join(own)
    got = near_duplicates(table(spark, list(docs.items())), shingle=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(docs, 4)


def test_texts_with_a_common_passage_do_not_meet(spark):
    """2,000 texts share seven tenths of their words; two million pairs share buckets, nearly none a rare shingle."""
    rng = random.Random(4)
    passage = prose(rng, 140)
    texts = [(i, passage + " " + prose(rng, 60, 10**6)) for i in range(2000)]
    docs = table(spark, texts).select(F.col("doc_id").alias("doc"), "text")
    found = _Links(signatures(docs, 4), docs, 4, 80)
    placed = found.placed(None)
    assert found.open_pairs(placed) > 1_000_000
    assert found.meeting(placed).count() <= 2000
    got = near_duplicates(table(spark, texts), shingle=4)
    assert got.where("kept").count() == 2000


def test_shingles_of_the_same_documents_meet_once(spark):
    """Pairs just above and below the threshold share many of their rarest shingles, but meet at one item."""
    rng = random.Random(6)
    texts = {}
    for pair in range(60):
        base = prose(rng, 200, 10**6)
        for i in range(2):
            texts[2 * pair + i] = base + " " + prose(rng, 20 if pair % 2 else 30, 10**6)
    docs = table(spark, list(texts.items())).select(F.col("doc_id").alias("doc"), "text")
    found = _Links(signatures(docs, 4), docs, 4, 80)
    placed = found.placed(None)
    met = found.meeting(placed)
    assert met.count() == met.select("doc").distinct().count() <= 120
    linked = found.links(found.other_pairs(placed))
    assert sorted((r.a, r.b) for r in linked.collect()) == [(2 * pair, 2 * pair + 1) for pair in range(1, 60, 2)]


def test_odd_sketch_tells_similarities_apart():
    def passing(both, n, pairs=300):
        rng = np.random.default_rng(both)
        sets = []
        for _ in range(pairs):
            x = rng.integers(0, 1 << 63, 2 * n - both, np.uint64)
            sets += [np.sort(x[:n]), np.sort(x[n - both :])]
        starts = np.arange(len(sets)) * n
        sketches = odd_sketches(min_hashes(np.concatenate(sets), starts, SKETCH_SAMPLES), SKETCH_BITS)
        differing = np.bitwise_count((sketches[::2] ^ sketches[1::2]).view(np.uint64)).sum(axis=1)
        return int((differing <= most_differing_bits(0.8)).sum())

    assert passing(80, 90) == 300  # similarity 0.8
    assert passing(70, 85) < 150  # 0.7
    assert passing(65, 85) < 15  # 0.62
    assert most_differing_bits(0.95) < most_differing_bits(0.8)


# Decontamination


def edit_distance_within(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in text:
        row_before, row = row, [0]
        for i, x in enumerate(item):
            row.append(min(row_before[i] + (x != w), row_before[i + 1] + 1, row[i] + 1))
        best = min(best, row[-1])
    return best


def test_bit_parallel_edit_distance():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 20))]
        assert least_edits(item, text, 99)[0] == edit_distance_within(item, text)


def test_leak_recall_and_precision():
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randrange(15, 60)).encode()) for i in range(60)]
    index = Index(items)
    texts, want = [], []
    for _ in range(300):
        i, t = rng.choice(items)
        own = t.split()
        for _ in range(edits_allowed(len(own))):
            at, kind = rng.randrange(len(own)), rng.randrange(3)
            own[at : at + (kind != 1)] = [] if kind == 0 else [b"x%d" % rng.randrange(99)]
        texts.append(prose(rng, 50).encode() + b" " + b" ".join(own) + b" " + prose(rng, 50).encode())
        want.append(i)
    found = index.search(texts)
    assert sum(i in f for i, f in zip(want, found)) >= 0.97 * len(want)
    for text, hits in zip(texts, found):
        for i, (edits, _) in hits.items():
            item = words(dict(items)[i].decode())
            assert edit_distance_within(item, words(text.decode())) <= edits <= edits_allowed(len(item))
    assert not any(index.search([prose(rng, 500).encode() for _ in range(50)]))


def edited(rng, item, kinds, n):
    """`item` after `n` edits of the given kinds at different words."""
    own = list(item)
    for at in sorted(rng.sample(range(len(own)), n), reverse=True):
        kind = rng.choice(kinds)
        own[at : at + (kind != "insert")] = [] if kind == "delete" else ["x%d" % rng.randrange(99999)]
    return own


@pytest.mark.parametrize("kinds", [["replace"], ["delete"], ["insert"], ["replace", "delete", "insert"]])
@pytest.mark.parametrize("length", [5, 9, 15, 26, 39, 58, 87, 130, 195, 292, 400])
def test_leak_recall_is_whole(length, kinds):
    """Every item within its edits is found, whatever its length and the kind of the edits."""
    rng = random.Random(length)
    items = [(i, prose(rng, length + i % 7, 10**9)) for i in range(30)]
    index = Index([(i, t.encode()) for i, t in items])
    for i, t in items:
        own = edited(rng, t.split(), kinds, edits_allowed(len(t.split())))
        text = " ".join([prose(rng, 50, 10**9), *own, prose(rng, 50, 10**9)])
        assert i in index.search([text.encode()])[0], (i, kinds)


def test_leaks_equal_all_distances():
    """Few different words: pieces are found everywhere, and items, edits and ends equal a plain scan."""
    rng = random.Random(11)
    items = [(i, prose(rng, n, v)) for i, (n, v) in enumerate([(5, 9), (8, 9), (12, 9), (20, 9), (33, 5), (60, 5), (47, 30)] * 3)]
    texts = [prose(rng, rng.randrange(1, 90), rng.choice([5, 9, 30])) for _ in range(120)]
    texts += [" ".join([prose(rng, 9, 30), *edited(rng, t.split(), ["replace", "delete", "insert"], len(t.split()) // 6), prose(rng, 9, 30)]) for _, t in items]
    found = Index([(i, t.encode()) for i, t in items]).search([t.encode() for t in texts])
    for text, hits in zip(texts, found):
        plain = {i: least_edits(t.split(), text.split(), edits_allowed(len(t.split()))) for i, t in items}
        assert hits == {i: best for i, best in plain.items() if best}


def test_leaks_edges(spark):
    rng = random.Random(6)
    item = prose(rng, 30)
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (None, prose(rng, 20)), (4, ""), (5, item)], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item), (4, item.upper()), (None, "before " + item), (6, prose(rng, 30_000) + "\n" + item), (7, item[:60]), (3, item)]
    got = sorted(map(tuple, find_leaks(table(spark, rows), bench).select("doc_id", "item_id", "edits").collect()), key=repr)
    assert got == sorted([(d, i, 0) for d in (3, 3, 4, None, 6) for i in (1, 5)], key=repr)
    assert sorted(r.doc_id for r in drop_leaks(table(spark, rows), bench).collect()) == [1, 2, 7]
    assert find_leaks(table(spark, []), bench).count() == 0
    assert drop_leaks(table(spark, rows), bench.limit(0)).count() == len(rows)


# Mixing


def plain_targets(sizes, weights, most=3):
    capped = set()
    while True:
        left = sum(sizes) - sum(most * sizes[i] for i in capped)
        total = sum(w for i, w in enumerate(weights) if i not in capped)
        now = [most * s if i in capped else left * w / total for i, (s, w) in enumerate(zip(sizes, weights))]
        over = {i for i, s in enumerate(sizes) if now[i] > most * s * (1 + 1e-12)} - capped
        if not over:
            return now
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 10, 1], [5, 5, 5, 5], [1, 1000, 1, 1000, 3], [0, 7, 0], [50]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "name string, words long")
    got = [r.target for r in targets(df).orderBy("name").collect()]
    assert got == pytest.approx(plain_targets(sizes, [i % 3 + 1 for i in range(len(sizes))]))


def test_highest_quotients(spark):
    rng = random.Random(7)
    for case in range(4):
        weights = [rng.choice([0, 1, 2, 5, 40, 333, 1000]) * rng.random() for _ in range(30)]
        seats = rng.randrange(0, 60)
        df = spark.createDataFrame([(0, i, w, seats) for i, w in enumerate(weights)], "g int, i int, w double, seats long")
        got = {r.i: r.quota for r in sainte_lague(df, ["g"], "i", "w", "seats").collect()}
        quotients = sorted(((-w / (2 * k + 1), i) for i, w in enumerate(weights) if w > 0 for k in range(seats)))[:seats]
        want = {i: sum(j == i for _, j in quotients) for i in range(30)}
        assert got == want, case


def test_mix_edges(spark):
    rows = [(i, prose(random.Random(i), 1 + i % 40), "big" if i % 3 else None, "en", "x") for i in range(400)]
    rows += [(1000, None, "tiny", "en", "x"), (1001, "", "tiny", "en", "x"), (1002, "a b", "tiny", "en", "x"), (1002, "a b", "tiny", "en", "x"), (None, "c d e", "tiny", "en", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixed(df).collect()
    again = mixed(df.repartition(5)).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)
    sizes = {"big": 0, "tiny": 0, None: 0}
    for r in rows:
        sizes[r[2]] += len(words(r[1]))
    want = dict(zip(["big", "tiny", None], plain_targets(list(sizes.values()), [1, 2, 3])))
    by_source = {}
    for r in out:
        name = next(k for k, v in sizes.items() if v == r.source_size)
        assert r.target == pytest.approx(want[name]) and 0 <= r.taken <= 3 * r["size"]
        by_source[name] = by_source.get(name, 0) + r.taken
    assert all(abs(by_source[k] - want[k]) <= 2 for k in want)
    assert mixed(df.limit(0)).count() == 0


# Language


def test_language(spark):
    rng = random.Random(8)
    own = {"xa": "tra bel con mur dal", "yo": "ßei und sch ker für", "zi": "ñar qué los mí das"}
    word = lambda l: "".join(rng.choice(own[l].split()) for _ in range(rng.randrange(1, 4)))
    rows = [(i, " ".join(word(l) for _ in range(40)), "h", l, "x") for i, l in enumerate(list(own) * 60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = fit_text_model(docs.where("doc_id < 90"))
    held = document_rows(docs.where("doc_id >= 90"))
    got = {r.doc_id: r for r in identify(held, model).collect()}
    assert sum(got[i].lang == l for i, _, _, l, _ in rows[90:]) >= 85
    odd = [(500, None, None, "xa", "x"), (501, "", "h", None, "x"), (502, "12 34 !!", "h", "xa", "x"), (None, rows[0][1], "h", "yo", "x"), (1, rows[1][1], "h", "yo", "x")]
    kept = accepted_documents(docs.unionByName(spark.createDataFrame(odd, SCHEMA)))
    ids = [r.doc_id for r in kept.collect()]
    assert not {500, 501, 502} & set(ids) and None in ids and ids.count(1) == 2
    assert kept.columns == docs.columns and len(ids) >= 178
    assert accepted_documents(docs.limit(0)).count() == 0


def test_every_labelled_language_has_a_model(spark, monkeypatch):
    import tabclean.llm.language as language

    monkeypatch.setattr(language, "BLOCK_LANGUAGES", 30, raising=False)
    rng = random.Random(12)
    own = {f"l{i:02}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(8)] for i in range(70)}
    rows = [(i, " ".join(rng.choices(own[lang], k=40)), "h", lang, "x") for i, lang in enumerate(list(own) * 3 + list(own)[:66])]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert fit_text_model(docs).languages == [*own, "und"]
    assert {r.doc_id: r.lang for r in accepted_documents(docs).collect()} == {r[0]: r[3] for r in rows}


def test_language_evidence(spark):
    docs = spark.createDataFrame([(i, t * 20, "h", l, "x") for i, (t, l) in enumerate([("tra bel con ", "xa"), ("und sch für ", "yo")] * 20)], SCHEMA)
    model = fit_text_model(docs)
    rows = [(i, "tra bel con", "xa", "xx", "a.site.xx", "site.xx") for i in range(30)] + [(i, "und sch für", "yo", "yy", "b.site.yy", "site.yy") for i in range(30, 60)]
    rows += [(100, "", None, "xx", "c.site.xx", "site.xx"), (101, "", "yo", None, None, None), (102, "con sch", None, None, "b.site.yy", "site.yy"), (103, None, "zz", None, None, None)]
    df = spark.createDataFrame(rows, "id int, text string, declared string, suffix string, host string, domain string")
    got = {r.id: r for r in identify(df, model).collect()}
    assert got[100].lang == "xa" and got[101].lang == "yo" and not got[100].accepted
    assert got[102].lang == "yo" and got[103].text_lang is None


# Tokens


def test_token_counts(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [None, "", " ", "It's we'd 1234 <|endoftext|> <|x", "日本語 text ½ ²", "İstanbul ŉ ſ ß", "été", "a" * 20_000, "x\x00y\x1fz", "été 'S don't—“q”", "ab " * 200_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "no id")]
    got = count_tokens(table(spark, rows), path).collect()
    assert len(got) == len(rows)
    want = sorted((str(d), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert count_tokens(table(spark, []), path).count() == 0


# Licenses


def test_licenses(spark):
    rng = random.Random(9)
    mit = TEMPLATES["mit"]
    edited = mit.split()
    edited[30] = "changed"
    half = " ".join(mit.split()[:50])
    rows = [
        (1, None), (2, ""), (3, "Released under"), (4, TEMPLATES["mit-line"]), (5, prose(rng, 333) + "\n" + mit.upper() + "\n" + prose(rng, 99)),
        (6, prose(rng, 101) + " " + " ".join(edited)), (7, half), (8, prose(rng, 30_000) + " " + TEMPLATES["isc"]), (None, mit), (4, TEMPLATES["mit-line"]), (9, prose(rng, 500)),
    ]
    got = scan_licenses(table(spark, rows)).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert found == {(4, "mit-line"), (5, "mit"), (6, "mit"), (8, "isc"), (None, "mit")}
    shares = {r.doc_id: r.containment for r in got}
    assert shares[5] == 1.0 and 0.8 <= shares[6] < 1.0
    assert scan_licenses(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        scan_licenses(table(spark, rows), {"x": "too few words"})


def test_license_offsets(spark):
    """A template is found wherever it begins, whatever the windows' grid."""
    rng = random.Random(10)
    line = TEMPLATES["gpl-3.0-line"]
    rows = [(i, prose(rng, i) + " " + line + " " + prose(rng, 40)) for i in range(1, 60)]
    got = {r.doc_id for r in scan_licenses(table(spark, rows)).where("license = 'gpl-3.0-line'").collect()}
    assert got == set(range(1, 60))


def test_common_licenses_and_their_variants(spark):
    rng = random.Random(13)
    texts = {k: TEMPLATES[k] for k in TEMPLATES if not k.startswith("cc-")}
    texts |= {k: TEMPLATES[k] for k in ("cc-by-4.0-a", "cc-by-sa-3.0-the", "cc-by-nc-4.0-line")}
    assert {"mpl-2.0", "epl-2.0", "cc0-1.0", "unlicense", "gpl-2.0-or-later", "lgpl-3.0-or-later", "agpl-3.0-or-later"} <= set(texts)
    rows = [(i, f"{prose(rng, 40)}\n{t}\n{prose(rng, 40)}") for i, t in enumerate(texts.values())]
    rows += [(100, "Released under the MIT License"), (101, "- Licensed under the Apache License, Version 2.0\n -- and more"), (102, "-" * 200_000 + " x" * 9 + " -" * 20_000)]
    found = {}
    for r in scan_licenses(table(spark, rows)).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    for i, k in enumerate(texts):
        assert k in found[i]
        assert not {x for x in found[i] if x.split("-")[0] != k.split("-")[0] or ("or-later" in k and x != k)} - {"apache-2.0-line"}, (k, found[i])
    assert found[100] == {"mit-line"} and found[101] == {"apache-2.0-line"} and 102 not in found

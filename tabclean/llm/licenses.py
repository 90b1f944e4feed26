"""License texts inside documents, by MinHash bands over overlapping windows of word shingles.

Templates are put into classes by length. A class reads documents in windows of twice its
length, one beginning every length, so every run as long as a template lies whole within
one. MinHash values of one row each are the bands: a window that holds four fifths of a
template shares at least `LEAST_SHARE` of the joint shingles, so with `BANDS` bands it
retrieves the template with a probability of over 0.999. What is retrieved is verified by
the exact share of the template's shingles in the window and its surroundings.

Windows without any shingle of any template can hold none and are passed over, an exact
bound that leaves little to hash. All of it is DataFrame functions on the JVM; templates go
out in blocks of bounded size.
"""

from __future__ import annotations

import math
import string
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage

SHINGLE, PERCENT = 5, 80
BANDS, LEAST_SHARE = 36, 0.19
#: Templates that go out at once, and words of a template.
BLOCK_TEMPLATES, MOST_WORDS = 200, 20_000
#: What is cut off at the ends of words.
PUNCTUATION = string.punctuation + "“”‘’«»…–—"
_MARKS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in PUNCTUATION) + "]"
#: White space with the punctuation around it; a run of marks is tried from its begin only.
_GAP = rf"(?:(?<!{_MARKS}){_MARKS}++)?+[ \t-\r]++{_MARKS}*+"

# Public license statements and notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "mit-licensed-line": "Licensed under the MIT License.",
    "bsd-3-clause": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission."
    ),
    "zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
        "be misrepresented; you must not claim that you wrote the original software."
    ),
    "bsl-1.0": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)"
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "epl-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
        "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "cc0-1.0-line": "Licensed under CC0 1.0 Universal.",
}
for _name, _version, _title in [
    ("gpl-2.0", "2", "General"), ("lgpl-2.1", "2.1", "Lesser General"), ("lgpl-3.0", "3", "Lesser General"), ("agpl-3.0", "3", "Affero General")
]:
    _work = "library" if _name == "lgpl-2.1" else "program"
    TEMPLATES[f"{_name}-line"] = f"This work is licensed under the GNU {_title} Public License, version {_version}."
    TEMPLATES[f"{_name}-or-later"] = (
        f"This {_work} is free software{':' if _version == '3' else ';'} you can redistribute it and/or modify it under the terms of the GNU "
        f"{_title} Public License as published by the Free Software Foundation{',' if _version == '3' else ';'} either version {_version} of "
        "the License, or (at your option) any later version."
    )
for _code, _title in [
    ("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-ND", "-NoDerivatives"), ("BY-NC", "-NonCommercial"),
    ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives"),
]:
    for _version, _port in [("4.0", "International"), ("3.0", "Unported")]:
        _name = f"cc-{_code.lower()}-{_version}"
        TEMPLATES[f"{_name}-line"] = f"Licensed under CC {_code} {_version}."
        for _article in ("a", "the"):
            TEMPLATES[f"{_name}-{_article}"] = f"licensed under {_article} Creative Commons Attribution{_title} {_version} {_port} License"


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words of a lower-cased text, in order; none if it has fewer words.

    Punctuation at the ends of words is no part of them.
    """
    cut = F.array_remove(F.split(F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r" + PUNCTUATION)), _GAP), "")
    hashed = lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(w, i, SHINGLE))
    )
    none = F.array().cast("array<bigint>")
    # The array of one makes `w` a variable: the text is split once and not once for each run.
    return F.transform(F.array(cut), lambda w: F.when(F.size(w) >= SHINGLE, hashed(w)).otherwise(none))[0]


def band_values(window: Column) -> Column:
    """The least hash of a window under each of `BANDS` hash functions."""
    seeds = F.sequence(F.lit(1), F.lit(BANDS))
    return F.transform(seeds, lambda k: F.array_min(F.transform(window, lambda h: F.xxhash64(h, k))))


def _template_rows(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license, own, length and marks: for each template that holds four fifths of this one, what it lacks."""
    rows = spark.createDataFrame(list(templates.items()), "license string, template string")
    hashed = {r["license"]: set(r["own"]) for r in rows.select("license", shingles(F.col("template")).alias("own")).collect()}
    bad = sorted(k for k, own in hashed.items() if not own)
    if bad:
        raise ValueError(f"templates need {SHINGLE} words, punctuation apart: {bad}")
    holders: dict[int, list] = {}
    for k, own in hashed.items():
        for h in own:
            holders.setdefault(h, []).append(k)
    out = []
    for k, own in hashed.items():
        shared = Counter(x for h in own for x in holders[h] if x != k)
        near = [x for x, n in shared.items() if 100 * n >= PERCENT * len(own)]
        marks = [sorted(own - hashed[x]) for x in sorted(near) if own - hashed[x]]
        # The class is the least power of two that is not below the number of shingles.
        out.append((k, sorted(own), 1 << (len(own) - 1).bit_length(), marks))
    return spark.createDataFrame(out, "license string, own array<long>, length int, marks array<array<long>>")


def _find(docs: DataFrame, known: DataFrame) -> DataFrame:
    listed = known.select("own", "length").collect()
    every = sorted({h for r in listed for h in r["own"]})
    lengths = sorted({r["length"] for r in listed})
    own = shingles(F.col("text"))
    hit = stage(docs.where(F.exists(own, lambda h: h.isin(every))).select("id", own.alias("all")), "hits")

    # Window j of a class covers shingles j * length to (j + 2) * length - 1; a shingle lies in two of them.
    at = F.transform("all", lambda h, i: F.when(h.isin(every), i))
    at = F.filter(at, lambda i: i.isNotNull())
    places = F.explode(F.array(*[F.lit(n) for n in lengths])).alias("length")
    windows = hit.select("id", "all", at.alias("at")).select("id", "all", "at", places)
    both = F.transform("at", lambda i: F.array(F.floor(i / F.col("length")), F.floor(i / F.col("length")) - 1))
    number = F.explode(F.array_distinct(F.flatten(both)))
    windows = windows.select("id", "all", "length", number.alias("j")).withColumn("j", F.greatest("j", F.lit(0)))
    start = (F.col("j") * F.col("length")).cast("int")
    windows = windows.select("id", "length", start.alias("start"), F.slice("all", start + 1, F.col("length") * 2).alias("window"),
                             F.slice("all", F.greatest(start - F.col("length"), F.lit(0)) + 1, F.col("length") * 4).alias("around"))
    keyed = windows.select("id", "length", "start", "around", F.posexplode(band_values(F.col("window"))).alias("band", "value"))
    bands = known.select("license", "own", "marks", "length", F.posexplode(band_values(F.col("own"))).alias("band", "value"))
    met = keyed.join(F.broadcast(bands), ["length", "band", "value"])
    share = F.size(F.array_intersect("around", "own")) / F.size("own")
    told_apart = F.forall("marks", lambda m: F.size(F.array_intersect("around", m)) * 2 >= F.size(m))
    found = met.where(told_apart).select("id", "license", "start", share.alias("containment")).where(F.col("containment") >= PERCENT / 100)
    return found.groupBy("id", "license").agg(F.max("containment").alias("containment"), F.min("start").alias("first_word"))


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`id_col`, license, containment, first_word for every license text found in a document.

    A template is found if at least four fifths of its distinct five-word shingles stand
    together in the text; `first_word` is the number of a word shortly before. Punctuation at
    the ends of words counts for nothing. Where another template holds four fifths of this one
    too, half of what that one lacks must be there, so that licenses of a family are not taken
    for each other. A template needs five words. Null, empty and short texts hold none. Rows that share an id, or have
    none, are reported together; other columns are not looked at. An empty table gives an
    empty table.
    """
    templates = TEMPLATES if templates is None else templates
    bad = [k for k, t in templates.items() if not SHINGLE <= len(t.split()) <= MOST_WORDS]
    if bad:
        raise ValueError(f"templates need {SHINGLE} to {MOST_WORDS} words: {bad}")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if not templates:
        raise ValueError("no templates are given")
    known = stage(_template_rows(docs.sparkSession, templates), "templates")
    names, out = sorted(templates), None
    for i in range(math.ceil(len(names) / BLOCK_TEMPLATES)):
        part = _find(rows, known.where(F.col("license").isin(names[i * BLOCK_TEMPLATES : (i + 1) * BLOCK_TEMPLATES])))
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def op6(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{folder}/documents.parquet"))

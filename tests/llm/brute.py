"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return WORD.findall((text or "").translate(_LOWER))


def shingles(text, size):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def components(docs, size, percent=80):
    """{doc: (n_shingles, component)} of {doc: text}, comparing all pairs that share a shingle."""
    sets = {d: shingles(t, size) for d, t in docs.items()}
    holders, parent = {}, {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sorted(docs):
        shared = {}
        for s in sets[d]:
            for other in holders.setdefault(s, []):
                shared[other] = shared.get(other, 0) + 1
            holders[s].append(d)
        for other, both in shared.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[other]) - both):
                a, b = sorted((root(d), root(other)))
                parent[b] = a
    return {d: (len(sets[d]), root(d)) for d in docs}

"""Plain Python forms of what the operators compute."""

from __future__ import annotations

import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = [x.translate(LOWER) for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(ids_texts, least):
    """Least id reachable for each id that is not null."""
    sets = {}
    for i, text in ids_texts:
        if i is not None:
            sets.setdefault(i, set()).add(frozenset(shingles(text)))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(sets, 2):
        for s in sets[a]:
            for r in sets[b]:
                both = len(s & r)
                if both and 100 * both >= least * (len(s) + len(r) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: root(i) for i in sets}

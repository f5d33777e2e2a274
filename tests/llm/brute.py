"""Plain versions to compare with."""

import re
from itertools import combinations

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def reach(ids, pairs):
    """The least id that each one reaches."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def jaccard(texts, percent=80):
    sets = {i: shingles(t) for i, t in texts}
    at = {}
    for i, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(i)
    near = {p for group in at.values() for p in combinations(sorted(group), 2)}
    linked = [(a, b) for a, b in near if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(s), c) for (i, s), c in zip(sets.items(), reach(sets, linked).values())}

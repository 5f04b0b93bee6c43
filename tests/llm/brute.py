"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import re
from collections import defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingle_set(text, size):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def near_duplicates(rows, size, percent=80):
    """rows: (doc_id, text). -> [(doc_id, n_shingles, component_id)] by comparing every two sets that share a shingle."""
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders, distinct = defaultdict(list), {}
    for i, s in enumerate(sets):
        if s and s in distinct:
            parent[find(i)] = find(distinct[s])
        elif s:
            distinct[s] = i
            for x in s:
                holders[x].append(i)
    common = defaultdict(int)
    for at in holders.values():
        for n, i in enumerate(at):
            for j in at[:n]:
                common[i, j] += 1
    for (i, j), c in common.items():
        if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
            parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        known = [x for x in (least.get(r), doc_id) if x is not None]
        least[r] = min(known) if known else None
    return [(doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)]

"""Plain versions of corpus operators, for tests."""

import re
from collections import defaultdict

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(k: int, n: int) -> str:
    """n words that depend on k."""
    return " ".join(WORDS[(k * 7 + i * i * (k + 3) + i) % len(WORDS)] + str((k * 31 + i) % 97 if i % 5 == 0 else "") for i in range(n))


LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def near(rows):
    """(id, set size, smallest linked id) of each (id, text)."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def union(x, y):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)

    by_set = defaultdict(list)
    for i, s in sets.items():
        if s:
            by_set[s].append(i)
    posts = defaultdict(list)
    for s, ids in sorted(by_set.items(), key=lambda x: min(x[1])):
        for i in ids:
            union(ids[0], i)
        for g in s:
            posts[g].append(ids[0])
    common = defaultdict(int)
    for ids in posts.values():
        for k, x in enumerate(ids):
            for y in ids[:k]:
                common[x, y] += 1
    for (x, y), c in common.items():
        if 100 * c >= 75 * (len(sets[x]) + len(sets[y]) - c):
            union(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}

"""Plain versions of the operators, for small tables."""

from __future__ import annotations


def shingles(text, width):
    words = text.encode().lower().split() if text else []
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_components(texts: dict, width: int, percent: int) -> dict:
    """Least reachable id of every document, by comparing all pairs that share a shingle."""
    sets = {k: shingles(t, width) for k, t in texts.items()}
    where: dict = {}
    for k, items in sets.items():
        for x in items:
            where.setdefault(x, []).append(k)
    parent = {k: k for k in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, items in sets.items():
        shared: dict = {}
        for x in items:
            for other in where[x]:
                if other < k:
                    shared[other] = shared.get(other, 0) + 1
        for other, n in shared.items():
            if 100 * n >= percent * (len(items) + len(sets[other]) - n):
                a, b = sorted((root(k), root(other)))
                parent[b] = a
    return {k: (len(sets[k]), root(k)) for k in texts}

"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def rule_counts(text):
    text = text or ""
    w = words(text)
    full = [line for line in text.split("\n") if words(line)]
    three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(three)
    inside = {i + k for i, x in enumerate(three) if times[x] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(full), len(full) - len(set(full)), len(inside)


def shingles(text, width=5):
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def components(nodes, links):
    above = {n: n for n in nodes}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        above[y] = x
    return {n: root(n) for n in nodes}


def jaccard_components(docs, percent=75):
    """docs: id -> text."""
    sets = {i: shingles(t) for i, t in docs.items()}
    ids = sorted(docs)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    roots = components(ids, links)
    return {i: (len(sets[i]), roots[i]) for i in ids}

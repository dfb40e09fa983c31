"""The trie of rebuilt conversations against a plain one, with shards, bands and queues of all sizes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sparkmart.llm import prefix_trie as P


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(own.get(base, [])[:h] + s[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].add(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves[p] or 1
        saved[p] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def some_rows(convs=150):
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 2 * convs, 2), -7, -205, 10**12 + 5]:
        n = rng.choice([1, 1, 2, 3, 4, 6, 9, 12])
        rows += [(c, k if rng.random() < 0.9 else None, rng.choice(["user", None, ""]), rng.choice(["a", "bé", "", None, "cc"])) for k in range(n)]
    rows += [(6, k, "user", f"turn {k // 2}") for k in range(300)]  # one long conversation
    rows += [(c, k, "user", "same") for c in range(1001, 1200) for k in range(4)]  # many copies
    return rows + [(None, 1, "user", "x")] + [(2, 0, "user", "a")] * 3


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("budget, band, queue", [(P.BUDGET, P.BAND, P.QUEUE_ROWS), (30, 8, 40)])
def test_trie_equals_a_plain_one(spark, budget, band, queue):
    rows = some_rows()
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string").repartition(3)
    got = [tuple(r) for r in P.prefix_trie(df, budget=budget, band=band, queue_rows=queue).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_no_rows_and_long_texts(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert P.prefix_trie(spark.createDataFrame([], schema)).collect() == []
    rows = [(100, 0, "user", "x" * 2_000_000), (101, 0, "user", "x" * 2_000_000), (101, 1, "user", "y")]
    got = [tuple(r) for r in P.prefix_trie(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_queue_spills_and_adds_up(tmp_path):
    queue = P.MessageQueue(f"file://{tmp_path}/queue", 100)
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 300, 2000)
    for part in np.array_split(keys, 50):
        queue.push(*P._added([np.array([b"%016d" % k for k in part], "S16")], [np.ones((len(part), 3), np.int64)]))
    assert queue.number > 1
    queue.next_level()
    got = {}
    for upto in (b"%016d" % 50, b"%016d" % 51, b"%016d" % 299):
        k, v = queue.take(upto)
        got |= dict(zip(k.tolist(), v[:, 0].tolist()))
    queue.close()
    assert got == {b"%016d" % k: n for k, n in zip(*np.unique(keys, return_counts=True))}

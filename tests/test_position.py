import random

import numpy as np
from pyspark.sql import functions as F

from sparkmart.operators.moves import NOBODY, _least_before_above, moved_items, moved_rows
from sparkmart.operators.position import (
    expand_ranges,
    occurrence_number,
    running_max,
    with_neighbourhood,
    with_position,
)


def test_position_is_dense_and_follows_the_order(spark):
    rng = random.Random(1)
    values = rng.sample(range(100_000), 3000)
    df = spark.createDataFrame([(v, f"x{v}") for v in values], "v long, t string").repartition(7)
    out = with_position(df, ["v"], "pos", start=5).select("v", "pos", "t").collect()
    want = {v: i + 5 for i, v in enumerate(sorted(values))}
    assert len(out) == len(values)
    assert all(r["pos"] == want[r["v"]] and r["t"] == f"x{r['v']}" for r in out)


def test_position_of_an_empty_table(spark):
    assert with_position(spark.createDataFrame([], "v long"), ["v"]).count() == 0


def test_occurrence_number_numbers_each_key_by_position(spark):
    rng = random.Random(2)
    keys = [rng.choice(["hot", "hot", "hot", "a", "b", None]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(keys)), "pos long, k string").repartition(5)
    seen, want = {}, {}
    for pos, k in enumerate(keys):
        want[pos] = seen.get(k, 0)
        seen[k] = want[pos] + 1
    out = occurrence_number(df, ["k"], "pos", "nth", width=31).collect()
    assert {r["pos"]: r["nth"] for r in out} == want


def test_running_max_across_blocks(spark):
    rng = random.Random(3)
    rows = [(i, i // 40, rng.randrange(1000) if rng.random() < 0.7 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "pos long, g long, v long")
    forward = {r["pos"]: r["m"] for r in running_max(df, "g", "pos", F.col("v"), "m", block=7).collect()}
    back = {r["pos"]: r["m"] for r in running_max(df, "g", "pos", F.col("v"), "m", block=7, backwards=True).collect()}
    for pos, g, _ in rows:
        before = [v for p, h, v in rows if h == g and p < pos and v is not None]
        after = [v for p, h, v in rows if h == g and p > pos and v is not None]
        assert forward[pos] == max(before, default=None)
        assert back[pos] == max(after, default=None)


def test_neighbourhood_gives_every_row_its_neighbours(spark):
    df = spark.range(100).withColumnRenamed("id", "pos")
    rows = with_neighbourhood(df, "pos", 2, block=10).collect()
    assert sorted(r["pos"] for r in rows if r["__own"]) == list(range(100))
    blocks = {}
    for r in rows:
        blocks.setdefault(r["__block"], set()).add(r["pos"])
    for pos in range(100):
        near = set(range(max(0, pos - 2), min(100, pos + 3)))
        assert near <= blocks[pos // 10]


def test_expand_ranges(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25)], "k string, n long")
    out = expand_ranges(df, "n", "i", batch=10).collect()
    assert sorted((r["k"], r["i"]) for r in out) == [("a", 0)] + [("b", i) for i in range(25)]


def greedy_moves(source):
    """``source[i]`` is the source place of target place i; brute force over the runs."""
    runs, start = [], 0
    for i in range(1, len(source) + 1):
        if i == len(source) or source[i] != source[i - 1] + 1:
            runs.append((i - start, source[start], start))
            start = i
    pending = sorted(runs, key=lambda r: (-r[0], r[2]))
    moved = set()
    while pending:
        _, s, d = pending.pop(0)
        crossing = [r for r in pending if (r[1] < s) != (r[2] < d)]
        for size, cs, _ in crossing:
            moved.update(range(cs, cs + size))
        pending = [r for r in pending if r not in crossing]
    return moved


def _blocks_shuffled(rng, n, max_block):
    blocks, at = [], 0
    while at < n:
        size = rng.randint(1, max_block)
        blocks.append(list(range(at, min(n, at + size))))
        at += size
    for _ in range(3):
        blocks.insert(rng.randrange(len(blocks)), blocks.pop(rng.randrange(len(blocks))))
    return [x for b in blocks for x in b]


def test_moved_rows_match_brute_force(spark):
    rng = random.Random(4)
    shuffled = list(range(40))
    rng.shuffle(shuffled)
    for source in (_blocks_shuffled(rng, 120, 12), _blocks_shuffled(rng, 60, 5), shuffled, list(range(10))):
        gaps = [3 * s + 1 for s in source]  # positions need not be dense
        df = spark.createDataFrame([(g, 2 * i) for i, g in enumerate(gaps)], "l long, r long")
        got = {(r["l"] - 1) // 3 for r in moved_rows(df, "l", "r", block=16).collect()}
        assert got == greedy_moves(source)


def test_moved_runs_by_rounds_and_strips(spark):
    """More runs than a task takes: strips, cells and cells of cells give what one task gives."""
    rng = random.Random(11)
    shuffled = list(range(40))
    rng.shuffle(shuffled)
    falling = [x for b in reversed([range(s * (s + 1) // 2, (s + 1) * (s + 2) // 2) for s in range(8)]) for x in b]
    for source, few in ((_blocks_shuffled(rng, 90, 6), 7), (shuffled, 2), (falling, 3)):
        df = spark.createDataFrame([(s, i) for i, s in enumerate(source)], "l long, r long")
        assert {r["l"] for r in moved_rows(df, "l", "r", block=few).collect()} == greedy_moves(source)


def test_first_crossing_matches_brute_force():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 17, 64, 200):
        for high in (5, 1000):  # few places give ties
            x, y = rng.integers(0, high, n), rng.integers(0, high, n)
            turn = rng.permutation(n).astype(np.int64)
            want = [min((turn[j] for j in range(n) if x[j] < x[i] and y[j] > y[i]), default=NOBODY) for i in range(n)]
            assert _least_before_above(x, y, turn).tolist() == want


def test_many_runs_of_different_lengths(spark):
    sizes = list(range(1, 61))
    random.Random(3).shuffle(sizes)
    blocks, at = [], 0
    for n in sizes:
        blocks.append(list(range(at, at + n)))
        at += n
    random.Random(5).shuffle(blocks)
    source = [x for b in blocks for x in b]
    df = spark.createDataFrame([(s, i) for i, s in enumerate(source)], "l long, r long")
    assert {r["l"] for r in moved_rows(df, "l", "r").collect()} == greedy_moves(source)


def test_moved_items_matches_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 12)
        order = list(range(n))
        rng.shuffle(order)
        names = [f"c{i}" for i in range(n)]
        got = set(moved_items(names, [names[i] for i in order]))
        assert got == {f"c{i}" for i in greedy_moves(order)}

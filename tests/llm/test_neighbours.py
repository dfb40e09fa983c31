"""Near duplicates of vectors and texts against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import jaccard_join, nn_descent
from sparkmart.llm.components import components
from tests.llm import brute


def test_components_of_a_graph(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    edges = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == brute.components(sorted({x for e in edges for x in e}), edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(seed):
    """Copies, near copies of several grades, a passage that many share, and short, empty and missing texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    shared = " ".join(word() for _ in range(60))
    texts = [None, "", " \n", "a", "a", "A b", "a B", "one two three four", "one two three four five", "One two three four five", "x " * 3000]
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    for _ in range(25):
        texts.append(" ".join(word() for _ in range(rng.randint(3, 60))) + " " + shared)
    hot = [word() for _ in range(100)]
    for _ in range(40):
        copy = list(hot)
        for _ in range(rng.randint(1, 9)):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("seed,side,block", [(1, 256, 10**6), (2, 3, 500)])
def test_jaccard_components_match_brute_force(spark, tmp_path, monkeypatch, seed, side, block):
    monkeypatch.setattr(jaccard_join, "SIDE", side)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    docs = near_texts(seed)
    rows = [(i, t, "c", i) for i, t in docs.items()]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, component string, size long").repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    got = jaccard_join.jaccard_components(table).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == brute.jaccard_components(docs) and len(got) == len(docs)
    stay = jaccard_join.one_of_each(table)
    assert stay.columns == table.columns
    assert {r["doc_id"] for r in stay.collect()} == {c for _, c in brute.jaccard_components(docs).values()}


def test_jaccard_with_null_and_repeated_rows(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text + " more"), (None, text), (None, None), (4, ""), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    table = spark.read.parquet(str(tmp_path / "d"))
    got = sorted(((r["id"], r["n_shingles"], r["component"]) for r in jaccard_join.jaccard_components(table).collect()), key=str)
    assert got == sorted([(1, 36, 1), (1, 36, 1), (2, 37, 1), (None, 36, None), (None, 0, None), (4, 0, 4), (4, 0, 4)], key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(table).collect()), key=str)
    assert kept == sorted([(1, text), (None, text), (None, None), (4, ""), (4, "")], key=str)
    assert jaccard_join.jaccard_components(table.limit(0)).count() == 0


def clusters(seed, n=400, d=24):
    rng = np.random.default_rng(seed)
    x = [rng.standard_normal(d) for _ in range(n)]
    for size, spread in ((60, 0.05), (30, 0.2), (25, 0.3), (2, 0.1), (2, 0.1), (5, 0.02)):
        centre = rng.standard_normal(d)
        x += [centre + spread * rng.standard_normal(d) for _ in range(size)]
    chain = rng.standard_normal(d)
    for _ in range(40):  # neighbours are linked, the ends are far apart
        chain = chain / np.linalg.norm(chain) + 0.4 * (lambda s: s / np.linalg.norm(s))(rng.standard_normal(d))
        x.append(chain * rng.uniform(0.1, 10))
    x += [x[3] * 2.0, x[3], x[-1]]
    return [v.tolist() for v in x]


@pytest.mark.parametrize("seed,block", [(0, 512), (1, 16)])
def test_vectors_match_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(nn_descent, "BLOCK", block)
    vectors = clusters(seed)
    odd = [None, [], [0.0] * 24, [1.0] * 23, [float("nan")] + [1.0] * 23, [float("inf")] * 24, [None] + [1.0] * 23, [1e300] * 24, [1e-300] * 24]
    rows = [(i, v, 5, "x") for i, v in enumerate(vectors + odd)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int, root string")
    out, recall = nn_descent.near_vectors(table)
    got = {r["id"]: (r["n_links"], r["component"]) for r in out.collect()}
    usable = {i: np.array(v) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in usable.items()}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    roots = brute.components([r[0] for r in rows], links)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    wrong = [i for i in got if got[i] != (degree[i], roots[i])]
    assert len(got) == len(rows) and recall >= nn_descent.RECALL
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(degree.values()) and all(n <= degree[i] for i, (n, _) in got.items())
    assert len(wrong) <= 0.02 * len(rows), [(i, got[i], degree[i], roots[i]) for i in wrong[:5]]


def test_vectors_of_empty_and_repeated_rows(spark):
    schema = "vec_id long, embedding array<float>"
    out, recall = nn_descent.near_vectors(spark.createDataFrame([], schema))
    assert out.count() == 0 and recall == 1.0
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.1]), (None, [1.0, 0.0]), (3, [0.0, 1.0])]
    out, _ = nn_descent.near_vectors(spark.createDataFrame(rows, schema))
    got = sorted(((r["id"], r["n_links"], r["component"]) for r in out.collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 0, None), (3, 0, 3)], key=str)
    assert out.where(F.col("n_links").isNull()).count() == 0


def test_saturated_components_meet_beyond_twice_the_angle(spark):
    """Two arcs of vectors, linked at their ends only, where every list is full of nearer vectors."""
    rng = np.random.default_rng(5)
    angles = np.concatenate([np.linspace(0, 0.9, 200), np.linspace(1.32, 2.22, 200)])
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1) @ np.linalg.qr(rng.standard_normal((16, 16)))[0][:2]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    out, _ = nn_descent.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    linked = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    assert linked[:200, 200:].any()
    assert {r["id"]: (r["n_links"], r["component"]) for r in out.collect()} == {i: (int(n), 0) for i, n in enumerate(linked.sum(axis=1))}


def test_audit_counts_small_families_and_goes_on_until_it_meets_links(spark, monkeypatch):
    """A huge family found whole doesn't hide lost pairs; a sample without links isn't a recall of 1."""
    x = np.eye(64)
    twins = [(2 * i + j, v.tobytes(), 10**6 if i == 0 else 1) for i in range(20) for j, v in enumerate((x[i], (x[i] + 0.1 * x[i + 20]) / np.sqrt(1.01)))]
    singles = [(100 + i, x[40 + i].tobytes(), 1) for i in range(24)]
    nodes = spark.createDataFrame(twins + singles, "node long, unit binary, copies long")
    found = spark.createDataFrame([(0, 1000000), (1, 1000000)] + [(n, 1) for n in range(2, 20)], "node long, n long")
    monkeypatch.setattr(nn_descent, "AUDIT", 2)
    assert nn_descent._audited(nodes, found, 0.9) == 0.5
    monkeypatch.setattr(nn_descent, "AUDIT_MOST", 8)
    assert np.isnan(nn_descent._audited(nodes.where("node >= 100"), found, 0.9))


def test_recall_below_the_bound_fails(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "_audited", lambda *_: 0.5)
    monkeypatch.setattr(nn_descent, "ATTEMPTS", 2, raising=False)
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall 0.5"):
        nn_descent.near_vectors(table)
    assert nn_descent.orders_for(10**8, 0.9) > 4 * nn_descent.orders_for(10**4, 0.9) > nn_descent.ORDERS


def test_rounds_go_on_while_lists_improve(spark, monkeypatch):
    """Far vectors: no entry is near the threshold, and the lists still improve for more than two rounds."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    nodes = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "node long, unit binary")
    rounds = []
    kept = nn_descent.materialize
    monkeypatch.setattr(nn_descent, "materialize", lambda df, label: rounds.append(label) or kept(df, label))
    monkeypatch.setattr(nn_descent, "RUN", 32)
    lists = nn_descent.neighbour_lists(nodes, 6, 2, 1).collect()
    assert max(r["sim"] for r in lists) < 0.895
    assert sum(label.startswith("neighbours-") and label[-1].isdigit() for label in rounds) > 3
    assert sum(r["fresh"] for r in lists) <= nn_descent.ENOUGH * 600 * 6


def test_two_texts_under_one_id_are_judged_apart(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (2, long + " x"), (2, " ".join(f"v{i}" for i in range(30))), (3, "short other text"), (3, "short other text"), (None, long), (4, None), (4, None)]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, mark string")
    kept = sorted(((r["doc_id"], (r["text"] or "")[:5]) for r in jaccard_join.one_of_each(docs).collect()), key=str)
    assert kept == [(1, "w0 w1"), (2, "v0 v1"), (3, "short"), (4, ""), (4, ""), (None, "w0 w1")]

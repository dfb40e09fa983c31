import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sparkmart.functions.comparison import CompareOptions
from sparkmart.operators import align, diff, merge, patch, tables
from sparkmart.operators.stats import column_subsets


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_blank_and_repeated_keys_do_not_pair(spark):
    a = spark.createDataFrame([("a", 1), (None, 2), ("d", 3), ("d", 4)], "k string, v long")
    b = spark.createDataFrame([("a", 1), ("null", 2), ("d", 3), ("", 5)], "k string, v long")
    got = rows(diff.diff(a, b, ["k"]).row_actions().select("k", "action"))
    assert got == sorted(
        [("a", ""), (None, "---"), ("d", "---"), ("d", "---"), ("null", "+++"), ("d", "+++"), ("", "+++")], key=repr
    )


def test_null_is_not_the_empty_text(spark):
    a = spark.createDataFrame([(1, None), (2, ""), (3, None)], "k long, v string")
    b = spark.createDataFrame([(1, None), (2, None), (3, "x")], "k long, v string")
    assert rows(diff.diff(a, b, ["k"]).cells()) == [(2, "v", "", None), (3, "v", None, "x")]


def test_composite_keys_and_renames(spark):
    a = spark.createDataFrame([(1, "x", 5), (1, "y", 6)], "k1 long, k2 string, v long")
    b = spark.createDataFrame([(1, "x", 5), (1, "y", 7)], "k1 long, k2 string, w long")
    found = diff.diff(a, b, ["k1", "k2"], renames={"v": "w"})
    assert rows(found.cells()) == [(1, "y", "w", "6", "7")]
    assert [(c.column, c.action) for c in diff.schema_diff(a, b, {"v": "w"})] == [("k1", ""), ("k2", ""), ("w", "(v)")]


def test_rename_is_proposed_from_all_rows(spark):
    a = spark.createDataFrame([(i, f"n{i}", i * 2) for i in range(8)], "pos long, name string, size long")
    b = a.withColumnRenamed("name", "title").drop("size").withColumn("other", F.lit("z"))
    assert diff.propose_renames(a, b, "pos") == {"name": "title"}
    late = b.withColumn("title", F.when(F.col("pos") == 7, "else").otherwise(F.col("title")))
    assert diff.propose_renames(a, late, "pos") == {}


def test_tolerances(spark):
    a = spark.createDataFrame([(1, "1.0", " A ")], "k long, n string, t string")
    b = spark.createDataFrame([(1, "1.05", "a")], "k long, n string, t string")

    def changed(**kw):
        return diff.diff(a, b, ["k"], CompareOptions(**kw)).row_actions().first()["changed_columns"]

    assert changed() == "n,t"
    assert changed(epsilon=0.1) == "t"
    assert changed(epsilon=0.01) == "n,t"
    assert changed(epsilon=0.1, ignore_case=True, ignore_whitespace=True) == ""
    assert changed(ignore_columns=("n", "t")) == ""


def test_primary_keys_must_agree(spark):
    a = spark.createDataFrame([(1, 2)], "k long, v long")
    for ka, kb in (([], []), (["k"], ["v"])):
        with pytest.raises(diff.KeyMismatch):
            diff.diff_by_primary_key(a, a, ka, kb)


def shown_rows(actions, context):
    """Brute force of the context rule: unchanged rows near a change, one mark per gap."""
    changed = [i for i, x in enumerate(actions) if x]
    out, marked = [], False
    for i, x in enumerate(actions):
        distance = min((abs(i - c) for c in changed), default=None)
        if distance is None:
            continue
        if distance <= context:
            out.append((i, x))
            marked = False
        elif distance == context + 1 and not marked:
            out.append((i, "..."))
            marked = True
    return out


@pytest.mark.parametrize("context", [0, 1, 3])
def test_context_rows(spark, context):
    rng = random.Random(context)
    changed = [rng.random() < 0.12 for _ in range(80)]
    a = spark.createDataFrame([(i, 0) for i in range(80)], "k long, v long")
    b = spark.createDataFrame([(i, int(c)) for i, c in enumerate(changed)], "k long, v long")
    a, b = (t.withColumn("pos", F.col("k")) for t in (a, b))
    got = rows(diff.diff(a, b, ["k"], position="pos").with_context("pos", context).select("row_order", "action"))
    assert sorted(got) == shown_rows(["->" if c else "" for c in changed], context)


def sequential_pairs(a, b, columns):
    """The subsets one after another, then equal rows in order; brute force."""

    def key(row, subset):
        parts = ["" if row[c] in (None, "", "null", "undefined") else str(row[c]) for c in subset]
        return None if len(parts) == 1 and parts[0] == "" else tuple(parts)

    pairs, used_a, used_b = [], set(), set()
    for subset in column_subsets(columns):
        ka, kb = [key(r, subset) for r in a], [key(r, subset) for r in b]
        for i, k in enumerate(ka):
            if k is None or i in used_a or ka.count(k) != 1 or kb.count(k) != 1:
                continue
            j = kb.index(k)
            if j not in used_b:
                pairs.append((i, j))
                used_a.add(i)
                used_b.add(j)
    return sorted(walk(a, b, pairs, lambda r: tuple(str(r[c]) for c in columns)))


def walk(a, b, pairs, key):
    """The four passes over neighbours, row by row."""
    to = [dict(pairs), {j: i for i, j in pairs}]
    for near in (0, 1):
        mine, theirs = (a, b) if near == 0 else (b, a)
        own, far = to[near], to[1 - near]
        for step in (1, -1):
            hand = None if step == 1 else len(theirs) - 1
            for i in range(len(mine))[::step]:
                if i in own:
                    hand = own[i] + step
                elif hand is not None and 0 <= hand < len(theirs) and hand not in far and key(mine[i]) == key(theirs[hand]):
                    own[i], far[hand] = hand, i
                    hand += step
    return list(to[0].items())


@pytest.mark.parametrize("block", [1_000_000, 3])
def test_neighbours_of_repeated_rows_match_a_walk(spark, block):
    rng = random.Random(block)
    for count in (9, 60):
        a = [rng.choice("xyz") if count > 9 else "xyz"[i % 3] for i in range(count)]
        b = [x for i, x in enumerate(a) if (rng.random() < 0.8 if count > 9 else i > 0)]
        b[len(b) // 2 : len(b) // 2] = ["y", "q"] if count > 9 else []
        some = [(i, j) for i, j in walk(a, b, [], str) if rng.random() < 0.2] if count > 9 else []
        frames = [spark.createDataFrame(list(enumerate(t)), "pos long, __p_x string") for t in (a, b)]
        pairs = spark.createDataFrame(some, "l_pos long, r_pos long")
        got = rows(align.neighbour_pairs(*frames, pairs, ["__p_x"], block))
        assert sorted(got) == sorted(walk(a, b, some, str))
        if count == 9:  # one deleted first row is one delete
            assert sorted(got) == [(i, i - 1) for i in range(1, 9)]


def test_repeated_rows_stay_out_of_the_driver(spark):
    """Files of repeated rows are small, but no join may gather the rows themselves to broadcast them."""
    n = 100_000
    a = spark.range(n).selectExpr("id AS pos", "concat('x', id % 7) AS __p_x")
    b = a.where("pos > 0").withColumn("pos", F.col("pos") - 1)
    limit = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "6m")  # an empty table of two keys takes 4 MB
    try:
        got = align.align_rows(a, b, "pos").where("l_pos = r_pos + 1").count()
    finally:
        spark.conf.set(limit, before)
    assert got == n - 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_keyless_alignment_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    wide = seed == 3
    a = [
        {"x": rng.randrange(12 if not wide else 40), "y": rng.choice("pqrst"), "z": rng.randrange(30), "w": rng.choice("mn")}
        for _ in range(60)
    ]
    b = [dict(r) for r in a if rng.random() < 0.85]
    for r in b:
        if rng.random() < 0.3:
            r[rng.choice("xyz")] = r["z"]
    rng.shuffle(b)
    columns = ["x", "y", "z", "w"]

    def frame(table):
        return spark.createDataFrame(
            [(i, *[str(r[c]) for c in columns]) for i, r in enumerate(table)], "pos long, x string, y string, z string, w string"
        )

    got = rows(align.align_rows(frame(a), frame(b), "pos", columns))
    assert sorted(got) == sequential_pairs(a, b, columns)


def test_many_columns_are_limited_to_the_most_distinct(spark):
    df = spark.range(30).select(*[(F.col("id") % n).alias(f"c{n}") for n in (1, 2, 3, 5, 7, 11, 30)])
    assert align.key_candidates(df, df) == ["c30", "c11", "c7", "c5", "c3"]


def test_equal_tables(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k long, v string")
    assert tables.tables_equal(a, a.repartition(3))
    assert not tables.tables_equal(a, a.distinct())
    assert tables.gate(a, a) == 0 and tables.gate(a, a.limit(1)) == 1
    assert tables.gate(a, a.withColumnRenamed("v", "w")) == 1
    assert tables.gate(a, "no table") == 2


def test_arrow_outgrows_the_cells(spark):
    df = spark.createDataFrame([("a->b", 1), ("c --> d", 2), (None, 3)], "t string, n long")
    assert patch.arrow([df]) == "--->"
    assert patch.arrow([df.select("n")]) == "->"


def _random_table(rng, keys):
    texts = [None, "", "NULL", "_NULL", "x->y", "plain", "é, \"q\""]
    return [(k, rng.choice(texts), rng.choice([None, 1.5, 2.0, -3.25]), rng.choice([None, True, False])) for k in keys]


@pytest.mark.parametrize("seed", [11, 12])
def test_patch_of_a_diff_gives_the_other_table(spark, seed):
    rng = random.Random(seed)
    schema = "k long, t string, d double, f boolean"
    a = spark.createDataFrame(_random_table(rng, range(40)), schema)
    b = spark.createDataFrame(_random_table(rng, range(10, 55)), schema)
    found = diff.diff(a, b, ["k"])
    typed = patch.apply_diff(a, found)
    assert tables.tables_equal(typed.table, b) and typed.rejected.isEmpty()
    text = patch.apply_flat(a, patch.flatten(found), ["k"])
    assert tables.tables_equal(text.table, b) and text.rejected.isEmpty()


def test_text_patch_renames_drops_and_adds_columns(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "k long, old string, gone long")
    b = spark.createDataFrame([(1, "x", 2.5), (2, "z", None), (3, "w", 1.0)], "k long, new string, extra double")
    found = diff.diff(a, b, ["k"], renames={"old": "new"})
    done = patch.apply_flat(a, patch.flatten(found), ["k"], {"extra": "double"})
    assert rows(done.table) == rows(b)


def test_patch_leaves_unexpected_cells_alone(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    b = spark.createDataFrame([(1, "X"), (2, "Y")], "k long, v string")
    other = spark.createDataFrame([(1, "x"), (2, "?")], "k long, v string")
    for done in (
        patch.apply_diff(other, diff.diff(a, b, ["k"])),
        patch.apply_flat(other, patch.flatten(diff.diff(a, b, ["k"])), ["k"]),
    ):
        assert rows(done.table) == [(1, "X"), (2, "?")]
        assert rows(done.rejected) == [(2, "v", "y", "?", "Y")]


def test_merge_properties(spark):
    rng = random.Random(21)
    schema = "k long, t string, d double, f boolean"
    p = spark.createDataFrame(_random_table(rng, range(30)), schema)
    x = spark.createDataFrame(_random_table(rng, range(8, 40)), schema)
    assert tables.tables_equal(merge.three_way(p, x, p, ["k"]).merged(), x)
    assert tables.tables_equal(merge.three_way(p, p, x, ["k"]).merged(), x)
    assert merge.three_way(p, x, x, ["k"]).conflicts().isEmpty()


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_properties_with_repeated_and_null_keys(spark, seed):
    rng = random.Random(seed)
    schema = "k long, v string"

    def some(n):
        return spark.createDataFrame([(rng.choice([None, 1, 2, 3, 4, 5, 6, 7, 8]), rng.choice("ab")) for _ in range(n)], schema)

    p, x = some(9), some(12)
    for merged, wanted in (((p, x, p), x), ((p, p, x), x), ((p, x, x), x), ((p, p, p), p)):
        found = merge.three_way(*merged, ["k"])
        assert rows(found.merged()) == rows(wanted)
        assert found.copy_conflicts().isEmpty()


def test_merge_counts_copies(spark):
    schema = "k long, v string"
    p = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (8, "c")], schema)
    same = spark.createDataFrame([(7, "z"), (7, "b"), (None, "n"), (8, "c")], schema)
    assert rows(merge.three_way(p, same, same, ["k"]).merged()) == rows(same)
    more = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (8, "c"), (8, "c"), (8, "c")], schema)
    found = merge.three_way(p, same, more, ["k"])
    assert rows(found.merged()) == rows(same)
    assert rows(found.copy_conflicts()) == [(8, "c", 2, 1, 4)]


def test_many_columns_pair_equal_rows_first(spark):
    a = [(i // 4, i // 2 % 2, i % 2, 0, 0, i) for i in range(8)]
    names = "pos long, c0 long, c1 long, c2 long, c3 long, c4 long, c5 long"
    left = spark.createDataFrame([(i, *r) for i, r in enumerate(a)], names)
    right = spark.createDataFrame([(i, *r) for i, r in enumerate(reversed(a))], names)
    summary = align.diff_without_key(left, right, "pos", options=CompareOptions(ignore_columns=("pos",))).summary().first()
    assert summary["row_updates"] == summary["row_inserts"] == summary["row_deletes"] == 0


def test_unlike_types_are_compared_as_texts(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "k long, v int")
    b = spark.createDataFrame([(1, "5"), (2, "abc")], "k long, v string")
    found = diff.diff(a, b, ["k"])
    assert rows(found.rows.select("action")) == [("",), ("->",)]
    assert found.summary().first()["col_updates"] == 1
    assert diff.diff(a, a.withColumn("v", F.col("v").cast("double")), ["k"]).summary().first()["different"]


def test_merge_conflicts_and_columns(spark):
    p = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k long, v string, drop_l long")
    loc = spark.createDataFrame([(1, "L", "n"), (2, "b", "m")], "k long, v string, add_l string")
    rem = spark.createDataFrame([(1, "R", 1, 9), (2, "B", 2, 8), (3, "c", 3, 7), (4, "d", 4, 6)], "k long, v string, drop_l long, add_r long")
    three = merge.three_way(p, loc, rem, ["k"])
    assert rows(three.conflicts()) == [(1, "v", "a", "L", "R")]
    merged = three.merged()
    assert merged.columns == ["k", "v", "add_l", "add_r"]
    assert rows(merged) == [(1, "L", "n", 9), (2, "B", "m", 8), (4, "d", None, 6)]
    text = three.merged("text").filter("k = 1").first()["v"]
    assert text == "((( a ))) L /// R"
    assert rows(three.row_actions()) == [(1, "!->"), (2, "->"), (3, "+"), (4, "+++")]


def test_all_subsets_in_bit_order():
    assert column_subsets(["a", "b", "c"]) == [["a"], ["b"], ["a", "b"], ["c"], ["a", "c"], ["b", "c"], ["a", "b", "c"]]
    assert len(column_subsets(list("abcde"))) == sum(1 for n in range(1, 6) for _ in combinations("abcde", n))

"""The corpus pipeline on a small folder, stage by stage, against plain versions, and on tables with holes."""

import random
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def some_docs():
    rng = random.Random(6)
    voc = ["".join(rng.choices("aeiourtnsl", k=rng.randint(2, 8))) for _ in range(400)]
    good = [" ".join(rng.choices(voc, k=rng.randint(60, 200))) + "." for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good)]
    rows += [(100 + i, t + " extra words") for i, t in enumerate(good[:10])]  # near copies
    rows += [(200 + i, "# * $ " * 80 + t) for i, t in enumerate(good[10:20])]  # junk
    rows += [(5, good[30]), (5, " ".join(rng.choices(voc, k=90))), (7, good[7]), (None, good[40]), (None, None), (300, None), (301, ""), (302, "too short")]
    return [(i, t, rng.choice(["en", None]), rng.choice(["a", "b"]), len(t or "")) for i, t in rows]


def folder(spark, path, rows, labels):
    spark.createDataFrame(rows, DOCS).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_match_plain_versions(spark, tmp_path):
    rows = some_docs()
    labels = [(i, int(i < 200), 0) for i in [*range(0, 60, 2), *range(200, 210)]] + [(None, 1, 0), (1, None, 0)]
    sf = folder(spark, tmp_path, rows, labels)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        path = f"{sf}/{name}"
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == before.columns
        kept.append([tuple(r) for r in docs.collect()])
        have = [tuple(r) for r in before.collect()]
        assert all(kept[-1].count(r) <= have.count(r) for r in kept[-1])
    ruled, good, single = kept
    # rules: as the operator judges the rows, all of them long enough
    counts = [brute.rule_counts(t) for _, t, *_ in ruled]
    assert counts and all(c[0] >= 50 and 100 * c[5] <= 50 * c[0] for c in counts)
    # classifier: junk goes, the rest stays
    assert not [i for i, *_ in good if i is not None and 200 <= i < 210]
    assert sum(i is not None and i < 60 for i, *_ in good) >= 55
    # duplicates: one row of each linked group, by (id, text); rows without id stay
    own = {}
    for i, t, *_ in good:
        if i is not None:
            own[i, t] = t
    order = {k: n for n, k in enumerate(sorted(own))}
    roots = brute.jaccard_components({order[k]: t for k, t in own.items()})
    groups = defaultdict(list)
    for k, n in order.items():
        groups[roots[n][1]].append(k)
    ids = [(i, t) for i, t, *_ in single if i is not None]
    assert len(ids) == len(groups) and sum(i is None for i, *_ in single) == sum(i is None for i, *_ in good)
    assert all(sum(k in members for k in ids) == 1 and min(k[0] for k in members) in {k[0] for k in ids} for members in groups.values())
    # packing: every token of every row once, gapless
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, sf).collect()]
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(p["length"] for p in pieces) == sum(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in single)
    bins = defaultdict(list)
    for p in pieces:
        bins[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "a", 0)]])
def test_tables_with_nothing_to_keep(spark, tmp_path, rows):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, rows, [])).collect() == []

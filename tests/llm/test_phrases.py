"""Phrase collocations against a plain count, at budgets that extend prefixes down to every depth."""

import random
import re
from collections import Counter

import pytest

from sparkmart.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            own = counts.setdefault(lang, Counter())
            own.update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        able = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {q[i : i + k] for q, a in able.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if a >= able[q[i : i + k]]}
        found = []
        for p, a in able.items():
            if p not in inside:
                score, _, left, right = min((1000 * a * words[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, x, y, words[lang], -s) for i, (s, a, p, x, y) in enumerate(found[:top])]
    return sorted(out)


def some_rows(count=250):
    rng = random.Random(5)
    voc = ["a", "B", "c", "dd", "É", "x1", "the"]
    rows = []
    for _ in range(count):
        text = " ".join(rng.choices(voc, weights=[9, 3, 2, 1, 1, 1, 9], k=rng.randint(0, 60)))
        rows.append((rng.choice(["en", "fr", None, "und"]), text.replace("dd", "dd" + rng.choice([".", ";\n", "", "\t", "\r\n"]))))
    return rows + [(None, None), ("en", ""), ("en", "..,"), ("en", "the A a a a a a a")] * 3


@pytest.mark.parametrize("budget", [1 << 21, 20])
def test_phrases_equal_a_plain_count(spark, budget):
    rows = some_rows()
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "lang string, text string, n long, score long, words string").repartition(5)
    got = sorted(map(tuple, phrases.collocations(df, least=10, top=40, budget=budget, block=500).collect()))
    assert got == brute(rows, 10, 40)


def test_one_long_text_and_no_text(spark):
    rows = [("en", "one two " * 150_000), ("de", None)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(map(tuple, phrases.collocations(df, budget=1000).collect()))
    assert got == brute(rows, 100, 2000) and got
    assert phrases.collocations(df.limit(0)).collect() == []

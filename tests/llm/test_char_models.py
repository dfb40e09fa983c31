"""Character models against plain Kneser-Ney, held-out accuracy, and odd texts."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import char_models as C
from sparkmart.llm import spans as S

SYLLABLES = {"en": ["the", "ing", "an", "wh"], "de": ["sch", "ei", "ü", "ung"], "fr": ["é", "eau", "que", "le"]}


def normal(text):
    letters = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text or "")
    # one space for each run, none at the start
    out = ""
    for c in letters:
        if c != " " or (out and out[-1] != " "):
            out += c
    return out


def plain_models(rows):
    """lang -> function from a text to the cross-entropy, counting with dictionaries."""
    tables = defaultdict(Counter)
    for lang, text in rows:
        t = "   " + normal(text)
        tables[lang].update(t[i - 3 : i + 1] for i in range(3, len(t)))
    out = {}
    for lang, four in tables.items():
        orders = [four]
        for _ in range(3):
            orders.insert(0, Counter(g[1:] for g in orders[0]))
        size = len(orders[0]) + 1
        stats = []
        for c in orders:
            n1, n2 = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
            d = min(0.9, max(0.1, n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5))
            total, kinds = Counter(), Counter()
            for g, n in c.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            stats.append((c, d, total, kinds))

        def p(gram, stats=stats, size=size):
            low = 1 / size
            for k, (c, d, total, kinds) in enumerate(stats):
                g = gram[3 - k :]
                if total[g[:-1]]:
                    low = max(c[g] - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * low
            return low

        def entropy(text, p=p):
            t = "   " + normal(text)
            return -sum(math.log(p(t[i - 3 : i + 1])) for i in range(3, len(t))) / (len(t) - 3)

        out[lang] = entropy
    return out


def some_rows(count=240):
    rng = random.Random(2)
    rows = []
    for i in range(count):
        lang = rng.choice(["en", "de", "fr", None])
        words = ["".join(rng.choices(SYLLABLES[lang or "en"], k=rng.randint(1, 3))) for _ in range(rng.randint(1, 40))]
        rows.append((i, (" " * rng.randint(1, 2)).join(words).capitalize() + rng.choice([".", "", " 12, 3!"]), lang))
    return rows + [(900, None, "en"), (901, "", "fr"), (902, " 12 !?", "de"), (None, "the thing", "en"), (3, "the thing", "en")]


@pytest.fixture(scope="module")
def result(spark):
    rows = some_rows()
    df = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double").repartition(3)
    model = C.learned(df)
    found, lang, score, rejected = C.identified(df, model)
    assert (lang, score, rejected) == ("lang_pred_", "score_", "rejected")
    return rows, model, [r.asDict() for r in found.collect()]


def test_entropies_equal_plain_kneser_ney(result):
    rows, model, _ = result
    learned = [(lang, t) for i, t, lang in rows if lang and (i is None or zlib.crc32(str(i).encode()) % 4 != 2)]
    plain = plain_models(learned)
    assert model.langs == sorted(plain)
    texts = ["the eisch quea", "A", "ÜBER é, und q!", "zzzz 日本語 x", normal(rows[0][1] or "")]
    got, size = model.entropies(S.texts_of(pa.array([*texts, None, "1 2"])))
    want = np.array([[plain[x](t) for x in model.langs] for t in texts])
    assert np.allclose(got[: len(texts)], want, atol=1e-4)
    assert size.tolist()[-2:] == [0, 0]


def test_held_out_accuracy_and_odd_texts(result):
    rows, _, found = result
    unseen = [r for r in found if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["lang"] and normal(r["text"]).strip()]
    assert len(unseen) > 20
    assert sum(r["lang_pred_"] == r["lang"] for r in unseen) >= 0.95 * len(unseen)
    assert all(0 <= r["score_"] <= 1 for r in found)
    for r in found:
        none = not normal(r["text"]).strip()
        assert (r["lang_pred_"] == "und") == none
        if none:
            assert r["score_"] == 0 and r["rejected"] is False
    assert len(found) == len(rows)


def test_segments_do_not_change_anything():
    rng = random.Random(4)
    texts = ["".join(rng.choices("aé ü.日Z\n", k=rng.randint(0, 50))) for _ in range(30)]
    whole = S.texts_of(pa.array(texts))
    long = [np.concatenate(x) for x in zip(*C.grams(whole))]
    for size in (1, 2, 7, 64):
        cut = [np.concatenate(x) for x in zip(*C.grams(whole, size))]
        assert all((a == b).all() for a, b in zip(cut, long))
    mine = defaultdict(str)
    for t, c in zip(long[0], long[2]):
        mine[int(t)] += chr(c)
    assert [mine[i] for i in range(len(texts))] == [normal(t) for t in texts]


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string, lang string"
    for rows in ([], [(1, "the thing", None), (2, None, None)]):
        df = spark.createDataFrame(rows, schema)
        found, *_ = C.identified(df, C.learned(df))
        assert [(r["lang_pred"], r["score"], r["rejected"]) for r in found.collect()] == [("und", 0.0, False)] * len(rows)

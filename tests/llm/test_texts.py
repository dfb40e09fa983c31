"""Words, rules, classifier, tokens and packing against plain Python and the tokenizers themselves."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from sparkmart.llm import byte_tokens, gam, packing, quality_rules, spans, textstats, unigram_count, word_bpe
from sparkmart.llm.packed import pack, unpack
from tests.llm import brute

ODD = [
    None, "", " ", "\n\n", "a", "a b c a b c", "x\n y \nx\n\n y ", "é" * 4 + " ü\x85z\x1cq", "日本語 テキスト 日本語", "a\tb\vc\fd\re", "A a\nA a\n#*$%&|<>",
    "İΣ ΟΔΥΣΣΕΥΣ ﬁ", "it's I'LL 123 ½", "  two  spaces ", "<|endoftext|> <|startoftext|>", "w" * 5000, "tail ", "\x00 \U0001f600",
]


def some_texts(seed, n=60):
    rng = random.Random(seed)
    pool = ["the", "The", "a", "über", "né", "x|y", "***", "12", "it's", "\n", " ", "\t", "end.", "日"]
    return ["".join(rng.choice(pool) + rng.choice([" ", " ", "", "\n"]) for _ in range(rng.randint(0, 120))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    return ODD + some_texts(1)


@pytest.fixture(scope="module")
def docs(spark, texts, tmp_path_factory):
    """Odd texts in a table with a null id, a repeated row, a null language and columns with clashing names."""
    rows = [(i, t, None if i % 7 == 0 else "en", "s", i, "c", 1.5) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 0, "c", 0.5), (None, "no id", None, None, 1, "c", 0.0)]
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    schema = "doc_id long, text string, lang string, source string, n_chars long, counts string, score double"
    spark.createDataFrame(rows, schema).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("segment", [7, 1 << 19])
def test_counts_match_plain_python(texts, segment, monkeypatch):
    monkeypatch.setattr(spans, "SEGMENT", segment)
    monkeypatch.setattr(spans, "_POW", spans._POW[:segment])
    monkeypatch.setattr(spans, "_INV", spans._INV[:segment])
    got = textstats.rule_counts(spans.texts_of(pa.array(texts, pa.string())))
    assert np.column_stack(list(got.values())).tolist() == [list(brute.rule_counts(t)) for t in texts]


def test_texts_of_a_slice_and_of_nothing():
    column = pa.array(["x", "a b", None, "c"]).slice(1, 3)
    assert spans.words(spans.texts_of(column)).counts.tolist() == [2, 0, 1]
    assert spans.words(spans.texts_of(pa.array([], pa.string()))).counts.tolist() == []


def test_numbers_survive_packing():
    rng = np.random.default_rng(0)
    for values in ([], [0], [5, 5, 1, 2**60], rng.integers(0, 1 << 48, 1000), np.sort(rng.integers(0, 1 << 48, 1000))):
        assert unpack(pack(np.array(values, np.int64))).tolist() == list(values)


def test_rules_keep_clean_rows_and_every_column(spark, docs):
    clean = " ".join(f"word{i}" for i in range(80))
    noisy = " ".join(f"word{i}***" for i in range(80))
    rows = [(i, clean.replace("word", f"w{i}or"), "en", "s") for i in range(150)] + [(1000, noisy, "en", "s"), (1001, noisy, None, None)]
    judged, counts, kept = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), ["doc_id"])
    assert {r["doc_id"] for r in judged.where(~F.col(kept)).collect()} == {1000, 1001}
    out = quality_rules.filtered(docs)
    assert out.columns == docs.columns
    passed = [t for t in (r["text"] for r in docs.collect()) if (c := brute.rule_counts(t))[0] >= 50 and 100 * c[5] <= 50 * c[0]]
    assert {r["text"] for r in out.collect()} <= set(passed)
    assert quality_rules.filtered(docs.limit(0)).count() == 0


def test_classifier_on_held_out_rows(spark, docs):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoin") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(400):
        good = rng.random() < 0.7
        rows.append((i, " ".join(word() + ("" if good else rng.choice(["***", "###"])) for _ in range(rng.randint(5, 60))), int(good)))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = gam.train(table.drop("quality"), table.select("doc_id", "quality"), most=300)
    scored = gam.scored(table, model, "p").withColumn("out", gam.held_out(F.col("doc_id"))).collect()
    assert {r["out"] for r in scored} == {True, False}
    assert all((r["p"] >= 0.7) == bool(r["quality"]) for r in scored if r["out"])
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in scored)
    out = gam.filtered(docs, table.select("doc_id", "quality"))
    assert out.columns == docs.columns and gam.filtered(docs.limit(0), table.select("doc_id", "quality")).count() == 0


def test_untrained_and_one_class_models():
    x = np.zeros((5, 3))
    assert gam.fit(x[:0], np.zeros(0)).score(x).tolist() == [1.0] * 5
    assert (gam.fit(x, np.ones(5)).score(x) > 0.7).all()


def test_an_interaction_is_learned():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_byte_ids_are_the_tokenizers(texts):
    whole = Tokenizer.from_file(byte_tokens.path("byte_bpe_50k.json"))
    for t in texts:
        got = np.frombuffer(byte_tokens.encoder().encode(t or ""), "<u4").tolist()
        assert got == whole.encode(t or "", add_special_tokens=False).ids, t


def test_word_ids_and_decoded_text_are_the_tokenizers(docs, texts):
    whole = word_bpe.tokenizer(word_bpe.VOCABULARY)
    for block in (20, 10**6):
        rows = word_bpe.round_trip(docs, block=block).collect()
        assert len(rows) == docs.count()
        assert sorted(rows, key=str) == sorted(word_bpe.decoded(word_bpe.encoded(docs, block=block)).collect(), key=str)
        for r in rows:
            text = "no id" if r["id"] is None else texts[r["id"]]
            ids = whole.encode(text or "", add_special_tokens=False).ids
            assert list(r["ids"]) == ids and r["decoded"] == whole.decode(ids, skip_special_tokens=False)
    assert word_bpe.round_trip(docs.limit(0)).count() == 0


def test_decoding_of_any_ids(spark):
    whole = word_bpe.tokenizer(word_bpe.VOCABULARY)
    size = max(whole.get_vocab().values()) + 1
    rng = random.Random(4)
    lists = [None, [], [0], [None, 5, None], [-1, size, 7, 2**31 - 1], list(range(size)), [rng.randrange(size) for _ in range(1_200_000)]]
    lists += [[rng.randrange(-3, size + 3) for _ in range(rng.randint(0, 50))] for _ in range(300)]
    rows = spark.createDataFrame([(i % 5, x, "old") for i, x in enumerate(lists)], "doc_id long, ids array<int>, decoded string").coalesce(1)
    got = word_bpe.decoded(rows).collect()
    assert [r["doc_id"] for r in got] == [i % 5 for i in range(len(lists))]
    for r, x in zip(got, lists):
        assert r["decoded"] == (None if x is None else whole.decode([i for i in x if i is not None and i >= 0], skip_special_tokens=False))


def test_unigram_counts_are_the_tokenizers(spark, texts):
    pieces = unigram_count.vocabulary()
    whole = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    whole.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    rng = random.Random(2)
    odd = ["a", "th", " ", "  ", "é", "日", "▁", "\n", "\U0001f600", "<s>", "<0x41>", "<unk>", "ing", "\u0301", "zzz", "\U0001f701"]
    texts = texts + ["".join(rng.choice(odd) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in unigram_count.counted(rows).collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids), r["text"]
        if all(pieces[i][0][:3] != "<0x" and i for i in ids) and r["text"]:
            assert r["score"] == sum(pieces[i][1] for i in ids)


def test_packing_round_trip(spark, docs, texts):
    whole = Tokenizer.from_file(byte_tokens.path("byte_bpe_50k.json"))
    for capacity in (16, 1024):
        rows = packing.packed(docs, capacity=capacity).toPandas()
        by_id = rows[rows.id.notna() & (rows.id != 3)]
        for i, own in by_id.groupby("id"):
            ids = whole.encode(texts[int(i)] or "", add_special_tokens=False).ids + [2]
            own = own.sort_values("piece")
            assert own.length.sum() == len(ids) and (len(own) == 1 or len(ids) > capacity)
            assert (own.length.iloc[1:] == capacity).all() and own.start.tolist() == (own.length.cumsum() - own.length).tolist()
            for r in own.itertuples():
                assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        for _, own in rows.groupby("sequence_id"):
            own = own.sort_values("offset")
            assert own.offset.tolist() == (own.length.cumsum() - own.length).tolist() and own.length.sum() <= capacity
    assert packing.packed(docs.limit(0)).count() == 0


def test_sequences_hold_the_documents(spark, docs, texts):
    whole = Tokenizer.from_file(byte_tokens.path("byte_bpe_50k.json"))
    placed = packing.packed(docs.where("doc_id <> 3"), capacity=64, with_ids=True).cache()
    made = {r["sequence_id"]: list(r["ids"]) for r in packing.sequences(placed).collect()}
    assert all(len(ids) <= 64 for ids in made.values())
    got: dict[int, list[int]] = {}
    for r in placed.orderBy("id", "piece").collect():
        got.setdefault(r["id"], []).extend(made[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]])
    assert got == {i: whole.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts) if i != 3}


def test_two_documents_replace_a_worse_one():
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = [1, 1, 2]
    assert packing.plan(counts, 10) == [([6, 2, 2], 1), ([3], 1)]


@pytest.mark.parametrize("seed", [0, 1])
def test_plans_use_up_all_lengths_tightly(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(1, 1025, 20_000), minlength=1025)
    plan = packing.plan(counts)
    used = np.zeros(1025, np.int64)
    for lengths, times in plan:
        assert sum(lengths) <= 1024
        np.add.at(used, lengths, times)
    assert used.tolist() == counts.tolist()
    assert sum(t for _, t in plan) <= 1.01 * (counts * np.arange(1025)).sum() / 1024 + 1


def test_fences_follow_their_group(spark):
    """Two sources with other habits have other fences; what is usual in one is rejected in the other; no size switches."""
    rng = random.Random(9)

    def text(length, lines, symbols):
        words = ["".join(rng.choices("abcdefgh", k=max(1, int(rng.gauss(length, 1))))) for _ in range(200)]
        words[:symbols] = ["#"] * symbols
        return "\n".join(" ".join(words[i::lines]) for i in range(lines)) + "\n" + "\n".join([words[-1] + " same line"] * lines)

    rows = [(i, text(5, 4, 0), "en", "short") for i in range(150)] + [(200 + i, text(12, 40, 0), "en", "long") for i in range(150)]
    odd = [(900, text(12, 4, 0), "en", "short"), (901, text(5, 40, 0), "en", "long"), (902, text(5, 4, 90), "en", "short"), (903, text(12, 40, 0), "en", "long")]
    small = [(950, text(5, 4, 0), "en", "few")]
    docs = spark.createDataFrame(rows + odd + small, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality_rules.filtered(docs).collect()}
    assert {900, 901, 902} & kept == set() and 903 in kept
    assert len(kept & {r[0] for r in rows}) >= 298
    found = {r["source"]: r.asDict() for r in quality_rules.rejections(docs).collect()}
    for limit in quality_rules.LIMITS:
        assert found["short"][limit] != found["long"][limit] or limit == "repeats_high"
    assert found["short"]["word_length_rejected"] >= 1 and found["short"]["symbols_rejected"] == 1 and found["few"]["n_texts"] == 1

import random
import statistics
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkmart.functions.temporal import coerce_dates, parse_day_first, parse_timestamp
from sparkmart.operators import impute, quality, stats
from sparkmart.plans import news


@pytest.fixture
def people(spark):
    rows = [
        (1, "Alice", 25.0, "2022-01-01"),
        (2, "Bob", 30.0, "2022-02-01"),
        (3, None, 35.0, "2022-03-01"),
        (4, "Dave", None, "2022-04-01"),
        (5, "Eve", 40.0, "2022-05-01"),
    ]
    return spark.createDataFrame(rows, "id long, name string, age double, signup_date string")


def test_five_row_example(people):
    nulls = {r["column_name"]: r for r in quality.null_report({"example": people}).collect()}
    assert set(nulls) == {"name", "age"}
    assert nulls["name"]["null_count"] == 1 and nulls["age"]["null_percent"] == 20.0
    assert not nulls["age"]["is_date"]
    cleaned = impute.handle_nulls(people, 20.0, ["id"])  # 20 % is not above 20 %
    rows = {r["id"]: r for r in cleaned.collect()}
    assert cleaned.columns == people.columns
    assert rows[4]["age"] == 32.5 and rows[3]["name"] == "Alice"
    assert rows[1]["signup_date"] == datetime(2022, 1, 1)

    def status(df):
        checks = quality.validate({"e": df}, {"id": "bigint", "name": "bigint"}, {"age": (18, 100)}).collect()
        return {(r["column_name"], r["check_name"]): r["status"] for r in checks}

    assert status(people)[("age", "Value Range")] == "Fail"
    assert status(cleaned) == {
        ("id", "Data Type"): "Pass", ("name", "Data Type"): "Fail", ("age", "Value Range"): "Pass"
    }


def test_null_threshold_is_strict(people):
    assert quality.drop_sparse_columns(people, 20.0).columns == people.columns
    assert quality.drop_sparse_columns(people, 19.9).columns == ["id", "signup_date"]


def test_unknown_method_raises(people):
    with pytest.raises(ValueError):
        impute.impute(people, "age", "guess")
    with pytest.raises(ValueError):
        impute.impute(people.withColumn("t", F.lit(datetime(2024, 1, 1))), "t", "interpolate")


def test_duplicates_keep_group_size_and_count_nulls(spark):
    df = spark.createDataFrame([(1, None)] * 5 + [(2, "b")] * 2 + [(3, "c")], "a long, b string")
    out = sorted(tuple(r) for r in quality.duplicate_rows({"d": df}).collect())
    assert out == [("d", 1, None, 5)] * 4 + [("d", 2, "b", 2)]


def test_duplicates_are_left_alone_without_full_row_copies(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "id long, url string")
    assert quality.drop_duplicates(df, ["url"], "id").count() == 2
    copied = df.unionAll(df.filter("id = 2"))
    assert [r["id"] for r in quality.drop_duplicates(copied, ["url"], "id").collect()] == [1]


def test_constraints(spark):
    df = spark.createDataFrame([("abc", None), ("abcdef", "x")], "t string, u string")
    rules = [quality.Rule("t", max_length=4), quality.Rule("u")]
    report = {(r["column_name"], r["rule"]): r["violations"] for r in quality.constraint_report(df, rules).collect()}
    assert report == {("t", "not_null"): 0, ("t", "max_length_4"): 1, ("u", "not_null"): 1}
    with pytest.raises(quality.ConstraintError, match="u not_null: 1"):
        quality.require(df, rules)


@pytest.mark.parametrize("shape", ["spread", "ties", "two", "negative", "single"])
def test_large_column_median_is_exact(spark, shape):
    rng = random.Random(shape)
    values = {
        "spread": [rng.random() * 1e6 for _ in range(2001)],
        "ties": [float(rng.choice([1, 2, 2, 2, 3])) for _ in range(1000)],
        "two": [1.0] * 500 + [7.0] * 500,
        "negative": [-rng.random() for _ in range(500)] + [rng.random() * 5 for _ in range(500)],
        "single": [4.0],
    }[shape]
    rng.shuffle(values)
    df = spark.createDataFrame([(v, None) for v in values] + [(None, None)], "v double, e double").repartition(3)
    got = stats.exact_medians(df, ["v", "e"], limit=20)
    assert got == {"v": pytest.approx(statistics.median(values), rel=1e-15), "e": None}


def test_modes_take_the_smallest_value_on_ties(spark):
    df = spark.createDataFrame([("b", True), ("a", False), ("b", True), ("a", None), (None, None)], "s string, f boolean")
    assert stats.modes(df, ["s", "f"]) == {"s": "a", "f": "true"}
    numbers = spark.createDataFrame([(9, -1.0), (10, -5.0), (None, float("nan")), (None, float("nan"))], "i int, d double")
    assert stats.modes(numbers, ["i", "d"]) == {"i": 9, "d": -5.0}


def test_medians_end_and_stay_exact(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x, y) for x, y in [(-inf, 2**60 + 1), (inf, 2**60 + 1), (1.0, 2**60 + 3), (2.0, 2**60 + 5)] * 30 + [(float("nan"), None)]], "d double, i long")
    assert stats.exact_medians(df, ["d", "i"], limit=10) == {"d": 1.5, "i": 2**60 + 2}


def test_quantiles_by_group_are_exact(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 2003).alias("v"))
    got = {r["g"]: (r["a"], r["b"]) for r in stats.quantiles_by(df, ["g"], "v", {"a": 0.5, "b": 0.9}, block=50).collect()}
    for g in range(3):
        values = sorted(i * 7919 % 2003 for i in range(2000) if i % 3 == g)
        assert got[g] == tuple(values[-(-len(values) * n // 10) - 1] for n in (5, 9))


def test_skewness_matches_pandas(spark):
    values = [1.0, 2.0, 2.5, 9.0, 11.0]
    df = spark.createDataFrame([(v, 3.0) for v in values], "v double, k double")
    row = df.agg(stats.sample_skewness("v").alias("v"), stats.sample_skewness("k").alias("k")).first()
    assert row["v"] == pytest.approx(pd.Series(values).skew())
    assert row["k"] == 0.0


def test_interpolation_matches_pandas(spark):
    rng = random.Random(8)
    stamps = [None if rng.random() < 0.5 else datetime(2024, 1, 1 + rng.randrange(28), rng.randrange(24), 3, 7, 250000) for _ in range(60)]
    stamps[0] = stamps[1] = stamps[-1] = None
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i long, t timestamp_ntz").repartition(5)
    out = [r["t"] for r in impute.impute(df, "t", "interpolate", ["i"]).orderBy("i").collect()]
    want = pd.Series(pd.to_datetime(stamps)).astype("datetime64[us]").interpolate().dt.floor("s")
    assert [None if pd.isna(w) else w.to_pydatetime() for w in want] == out


def test_long_gaps_are_interpolated_exactly(spark):
    first, last, steps = datetime(1969, 12, 30, 23, 59, 58, 700000), datetime(2039, 6, 1, 12, 30, 1), 20_000
    df = spark.range(steps + 1).withColumn(
        "t", F.when(F.col("id") == 0, F.lit(first)).when(F.col("id") == steps, F.lit(last)).cast("timestamp_ntz")
    )
    filled = {r["id"]: r["t"] for r in impute.impute(df, "t", "interpolate", ["id"]).collect()}
    epoch, micro = datetime(1970, 1, 1), timedelta(microseconds=1)
    a, b = (first - epoch) // micro, (last - epoch) // micro
    for i in range(0, steps + 1, 371):
        assert filled[i] == epoch + timedelta(seconds=(a * steps + (b - a) * i) // (steps * 1_000_000))


def test_pass_rate_of_the_review_report(spark):
    df = spark.createDataFrame([(i < 22,) for i in range(32)], "passed boolean")
    row = stats.pass_rate(df, F.col("passed")).first()
    assert (row["total"], row["passed"], row["pass_rate"]) == (32, 22, 68.8)


def test_day_first_dates(spark):
    texts = ["01-02-2025", "13-05-2025", "3/4/2024", "2024-12-31", "5 Mar 2024", "31-02-2024", "soon", None, " 7.8.2024 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r[0]) for r in df.select(parse_day_first("t")).collect()]
    assert got == [
        "2025-02-01", "2025-05-13", "2024-04-03", "2024-12-31", "2024-03-05", "None", "None", "None", "2024-08-07"
    ]


def test_more_ways_to_write_a_date(spark):
    texts = ["2024-01-05T10:00:00", "05-Jan-2024", "January 5, 2024", "5/1/24", "2024-01-05 10:00:00.123", "5/1/2024 3:07 pm", "5-1-95", "20240105", "2024-01-05 25:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(parse_day_first("t").cast("string"), parse_timestamp("t").cast("string")).collect()
    assert [r[0] for r in got] == ["2024-01-05"] * 6 + ["1995-01-05", "2024-01-05", "2024-01-05"]
    assert [r[1][11:] if r[1] else None for r in got] == ["10:00:00", "00:00:00", "00:00:00", "00:00:00", "10:00:00.123", "15:07:00", "00:00:00", "00:00:00", None]


def test_dates_by_the_classes_of_their_tokens(spark):
    texts = {
        "2024-01-05T10:00:00+07:00": "2024-01-05 03:00:00", "2024-01-05 10:00:00 -0530": "2024-01-05 15:30:00", "2024-01-05T10:00:00Z": "2024-01-05 10:00:00",
        "Friday, 5 January 2024": "2024-01-05 00:00:00", "Fri, 05 Jan 2024 10:00:00 GMT": "2024-01-05 10:00:00", "Sept 5, 2024": "2024-09-05 00:00:00",
        "5th of May": None, "5th May 2024": "2024-05-05 00:00:00", "May 5th, 2024 3 pm": None, "2024 Jan 5": "2024-01-05 00:00:00", "01/25/2024": "2024-01-25 00:00:00",
        "25/25/2024": None, "5 Marvel 2024": None, "2024-1": None, "1-2-3-4": None, "Mon 1 Jul 24 1:02:03.5 a.m.": "2024-07-01 01:02:03.5", "": None, "12": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in df.select("t", parse_timestamp("t").cast("string")).collect()}
    assert got == texts


def test_ranks_of_shares_are_exact(spark):
    for n, share, want in ((50, 0.14, 6), (50, 0.5, 24), (100, 0.07, 6), (7, 1.0, 6), (100, 0.55, 54)):
        assert stats.quantiles_by(spark.range(n).withColumn("g", F.lit(1)), ["g"], "id", {"q": share}).first()["q"] == want


def test_coercion_goes_by_name(spark):
    df = spark.createDataFrame([("13-05-2025", "13-05-2025", "x")], "updated string, shown string, last_timestamp string")
    row = coerce_dates(df).first()
    assert row["updated"] == datetime(2025, 5, 13) and row["shown"] == "13-05-2025" and row["last_timestamp"] is None


def test_clean_returns_the_cleaned_table(spark):
    rows = [(1, "u1", "a"), (1, "u1", "a"), (2, "u1", "b"), (3, "u2", None), (4, "u3", "c")]
    df = spark.createDataFrame(rows, "seq long, url string, tag string")
    cleaned, report = news.clean_and_validate(df, ["url"], ["seq"], {"seq": "bigint"}, {"seq": (1, 10)}, "news", 50.0)
    assert sorted(tuple(r) for r in cleaned.collect()) == [(1, "u1", "a"), (3, "u2", "a"), (4, "u3", "c")]
    assert {r["status"] for r in report.collect()} == {"Pass"}

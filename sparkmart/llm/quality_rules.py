"""Quality rules with adaptive thresholds: quantile sketches per language and source replace fixed cutoffs.

Every text is measured once. Per (lang, source) and metric, a log-linear histogram keeps the nine leading bits of each
value: a quantile sketch with a relative error below 1/256 that merges by adding counts, so it is one map-side combined
aggregate, and the sketches of a language and of the whole corpus are sums of those of its sources.

Fences follow the sketch of the group. Word length may lie ``REACH`` spreads from the median; the spread is the smaller
half of the interquartile range, so up to a quarter of junk on one side doesn't move it. Symbols may exceed the upper
quartile, repeated lines and words the 0.999 quantile, by a slack of a few occurrences in a text of the group's median
size. A group's fence is the mean of its own and its language's, weighted by its number of texts and ``MIX``, and a
language's is mixed with the corpus's likewise; no size switches from one to the other.
Fences are joined to the measured rows, which are then filtered; :func:`rejections` counts them by metric.

Nulls: a null text has no words and fails the base rules; null ``lang`` and ``source`` are groups of their own.
Rows stay as they are, repeated ones included: each is judged by itself. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkmart.llm import spans as S
from sparkmart.llm.frames import col, fresh, with_column
from sparkmart.llm.textstats import rule_counts
from sparkmart.runtime import materialize

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: metric -> its value, shares in thousandths
METRICS = {
    "symbols": "1000 * {c}.n_symbols div {c}.n_words",
    "dup_lines": "1000 * {c}.n_dup_lines div greatest({c}.n_lines, 1)",
    "repeats": "1000 * {c}.n_repeat_words div {c}.n_words",
    "word_length": "1000 * {c}.word_chars div {c}.n_words",
}
#: what the slack is measured by
SIZES = {"words": "{c}.n_words", "lines": "greatest({c}.n_lines, 1)"}
#: limits of a group from the quantiles of its sketches
LIMITS = {
    "symbols_high": "symbols.q750 + 24000 div words.q500",
    "dup_lines_high": "dup_lines.q999 + 1000 div lines.q500",
    "repeats_high": "repeats.q999 + 12000 div words.q500",
    "word_length_low": "word_length.q500 - 14 * greatest(least(word_length.q500 - word_length.q250, word_length.q750 - word_length.q500), 75)",
    "word_length_high": "word_length.q500 + 14 * greatest(least(word_length.q500 - word_length.q250, word_length.q750 - word_length.q500), 75)",
}
QUANTILES = (250, 500, 750, 999)
MIX = 10
BITS = 9


def measured(docs: DataFrame, name: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the struct ``name`` of the texts' counts."""
    columns = docs.columns if keep is None else keep
    inner = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(name, inner)])
    given = docs.select(*[col(c) for c in columns], *([] if text in columns else [col(text)]))
    at = given.columns.index(text)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.chunks(batch, text):
                counts = rule_counts(S.texts_of(part.column(at)))
                struct = pa.StructArray.from_arrays([pa.array(counts[c], pa.int64()) for c in COUNTS], list(COUNTS))
                yield with_column(part.select(columns), name, struct)

    return given.mapInArrow(measure, schema)


def base_failed(counts: str) -> Column:
    """Too short, or more than half of the words in repeated three-word windows."""
    return F.expr(f"{counts}.n_words < 50 or 100 * {counts}.n_repeat_words > 50 * {counts}.n_words")


def _values(counts: str) -> Column:
    each = [F.struct(F.lit(name).alias("metric"), F.expr(sql.format(c=counts)).cast("long").alias("value")) for name, sql in (METRICS | SIZES).items()]
    return F.array(*each)


def sketches(rows: DataFrame, counts: str, lang: str, source: str) -> DataFrame:
    """(lang, source, metric, bucket, n) over the rows that pass the base rules."""
    value = rows.where(~base_failed(counts)).select(
        col(lang).alias("lang"), col(source).alias("source"), F.explode(_values(counts)).alias("m")
    )
    return (
        value.select("lang", "source", "m.metric", "m.value")
        .withColumn("shift", F.expr(f"greatest(0, length(bin(value)) - {BITS})"))
        .withColumn("bucket", F.expr("shiftleft(shiftright(value, shift), shift)"))
        .groupBy("lang", "source", "metric", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _limits(sketch: DataFrame, name: str, *by: str) -> DataFrame:
    """Per merged sketch, the struct ``name`` of its number of texts and its own limits."""
    merged = sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "metric")
    run = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    at = lambda k: F.min(F.when(F.col("upto") * 1000 >= F.col("total") * k, F.col("bucket"))).alias(f"q{k}")
    found = run.groupBy(*by, "metric").agg(F.max("total").alias("n"), *[at(k) for k in QUANTILES])
    own = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c))).alias(c)
    wide = found.groupBy(*by).agg(F.max("n").alias("n"), *[F.struct(*[own(m, f"q{k}") for k in QUANTILES]).alias(m) for m in METRICS | SIZES])
    return wide.select(*by, F.struct("n", *[F.expr(sql).alias(x) for x, sql in LIMITS.items()]).alias(name))


def fences(sketch: DataFrame, mix: int = MIX) -> DataFrame:
    """One row per (lang, source) with the lowest and highest value allowed of each metric."""
    tongue = _limits(sketch, "tongue", "lang").withColumnRenamed("lang", "lang_")
    joined = _limits(sketch, "own", "lang", "source").join(tongue, F.col("lang").eqNullSafe(F.col("lang_")))
    whole = _limits(sketch, "whole").first()["whole"]  # one row
    top = {x: whole[x] if whole and whole[x] is not None else 0 for x in LIMITS}
    above = {x: f"((tongue.n * tongue.{x} + {mix} * {top[x]}L) div (tongue.n + {mix}))" for x in LIMITS}
    return joined.select("lang", "source", *[F.expr(f"(own.n * own.{x} + {mix} * {above[x]}) div (own.n + {mix})").alias(x) for x in LIMITS])


def _inside(counts: str, mark: str) -> dict[str, Column]:
    """By metric, whether a row is within its group's fences."""
    out = {}
    for name, sql in METRICS.items():
        value = F.expr(f"if({counts}.n_words > 0, {sql.format(c=counts)}, 0)")
        out[name] = value <= F.col(f"{mark}.{name}_high")
        if f"{name}_low" in LIMITS:
            out[name] &= value >= F.col(f"{mark}.{name}_low")
    return out


def _fenced(rows: DataFrame, counts: str, limits: DataFrame, mark: str, lang: str, source: str) -> DataFrame:
    packed = limits.select(F.struct("*").alias(mark))
    same = col(lang).eqNullSafe(F.col(f"{mark}.lang")) & col(source).eqNullSafe(F.col(f"{mark}.source"))
    return rows.join(packed, same & ~base_failed(counts), "left")


def judged(rows: DataFrame, counts: str, limits: DataFrame, verdict: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """``rows`` with the boolean ``verdict``: base rules passed and every metric within its group's fences."""
    mark = fresh([*rows.columns, verdict], "fence")
    inside = ~base_failed(counts)
    for within in _inside(counts, mark).values():
        inside = inside & within
    return _fenced(rows, counts, limits, mark, lang, source).withColumn(verdict, F.coalesce(inside, F.lit(False))).drop(mark)


def rejections(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", mix: int = MIX) -> DataFrame:
    """Per (lang, source): texts past the base rules, the limits, and how many texts each metric rejects."""
    counts = fresh(docs.columns, "counts")
    rows = materialize(measured(docs, counts, text, list(dict.fromkeys([lang, source]))), "quality-rules")
    limits = materialize(fences(sketches(rows, counts, lang, source), mix), "quality-fences")
    mark = fresh(rows.columns, "fence")
    found = _fenced(rows.where(~base_failed(counts)), counts, limits, mark, lang, source)
    return found.groupBy(*[F.col(f"{mark}.{x}") for x in ("lang", "source", *LIMITS)]).agg(
        F.count("*").alias("n_texts"), *[F.count_if(~within).alias(f"{name}_rejected") for name, within in _inside(counts, mark).items()]
    )


def judge(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source", mix: int = MIX) -> tuple[DataFrame, str, str]:
    """Measured rows (columns ``keep``) with their verdicts, and the names of the counts and verdict columns.

    The measured rows are written once without their texts; sketches and verdicts both read that table.
    """
    counts = fresh(docs.columns, "counts")
    verdict = fresh([*docs.columns, counts], "kept")
    columns = list(dict.fromkeys([*keep, lang, source]))
    rows = materialize(measured(docs, counts, text, columns), "quality-rules")
    limits = fences(sketches(rows, counts, lang, source), mix)
    return judged(rows, counts, limits, verdict, lang, source), counts, verdict


def filtered(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", mix: int = MIX) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    counts = fresh(docs.columns, "counts")
    verdict = fresh([*docs.columns, counts], "kept")
    narrow = materialize(measured(docs, counts, text, list(dict.fromkeys([lang, source]))), "quality-rules")
    # written, so that Spark knows their size before it plans how to join them to the texts
    limits = materialize(fences(sketches(narrow, counts, lang, source), mix), "quality-fences")
    rows = judged(measured(docs, counts, text), counts, limits, verdict, lang, source)
    return rows.where(col(verdict)).select(*[col(c) for c in docs.columns])

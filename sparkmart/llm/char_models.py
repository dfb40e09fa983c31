"""Language identification by interpolated Kneser-Ney character models.

1. Texts become letters in lower case with single spaces for everything else; every character counts with the three
   before it. Tasks count distinct four-grams per language, Spark adds the counts up. All training texts are counted.
2. Lower orders are continuation counts, so they follow from the four-grams by counting rows. Each order has one
   absolute discount per language, ``n1 / (n1 + 2 n2)``; interpolated probabilities and the weights of the lower order
   are computed by joins.
3. A model is one sorted array of hashes per order with a row of log-probabilities (one per language), and one of
   context hashes with the weights to fall back with. Hashes have ``SLOTS`` values, so an array has a fixed bound
   whatever the corpus holds; of grams that share a hash the likelier counts. Texts are scored in segments: each distinct
   four-gram of a segment is looked up once.
4. A text has the language with the lowest cross-entropy per character (of equal ones the first by name). A quarter of
   the rows (``crc32(id) % 4 = 3``) calibrates a model of the others: the score is the softmax of the cross-entropies at
   the sharpness with the least log loss, and a text is ``rejected`` where its cross-entropy exceeds what all but one in
   a thousand calibration texts of its language have. The model that is used then counts the calibration rows as well.

Rows with ``crc32(id) % 4 = 2`` are held out. A null text or one without letters is ``und`` with score 0 and not rejected;
so is every text if nothing was learned from. Rows with a null language are not learned from. Without calibration texts
the sharpness is ``SHARPNESS`` and nothing is rejected. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm import spans as S
from sparkmart.llm.frames import col, fresh
from sparkmart.runtime import materialize

ORDER = 4
SLOTS = 4_194_301  # a prime
SEGMENT_BYTES = 1 << 21
HELD_GRAMS = 1 << 21
SHARPNESS = 8.0
_GRID = [2.0**k for k in range(-1, 10)]
_SPACE, _BITS = 32, 21
_PRIME, _STEP, _LAST, _FOLD = (1 << 31) - 1, 1_000_003, 15_485_863, 65_521
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point that is a letter, a space for all others."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def slots(context, last):
    """Hash of a context (up to three code points in one number) and a character; numbers, arrays or columns."""
    mixed = ((context % _PRIME) * _STEP + last * _LAST) % _PRIME
    return (mixed * (mixed % _FOLD + _STEP)) % SLOTS


def grams(texts: S.Texts, most: int = SEGMENT_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, context, character) of every character that counts, segment by segment."""
    data, n = texts.data, len(texts.data)
    before_code = np.zeros(0, np.int64)
    before_text = np.zeros(0, np.int64)
    low = 0
    while low < n:
        high = min(n, low + most)
        while high < n and data[high] & 0xC0 == 0x80:
            high += 1
        part = data[low:high]
        code = _letters()[np.frombuffer(part.tobytes().decode().encode("utf-32-le"), np.uint32)].astype(np.int64)
        text = np.searchsorted(texts.offsets, np.flatnonzero(part & 0xC0 != 0x80) + low, side="right") - 1
        code, text = np.concatenate((before_code, code)), np.concatenate((before_text, text))
        fresh_text = np.ones(len(text), bool)
        fresh_text[1:] = text[1:] != text[:-1]
        gap = code == _SPACE
        keep = ~gap
        keep[1:] |= gap[1:] & ~gap[:-1] & ~fresh_text[1:]
        # what was carried over has been squeezed already
        carried = len(before_code)
        keep[:carried] = True
        code, text = code[keep], text[keep]
        context = np.zeros(len(code), np.int64)
        for k in (3, 2, 1):
            held = np.full(len(code), _SPACE, np.int64)
            same = text[k:] == text[:-k]
            held[k:][same] = code[:-k][same]
            context = (context << _BITS) | held
        yield text[carried:], context[carried:], code[carried:]
        # from three characters back on; earlier ones of the same text are not needed any more
        before_code, before_text = code[-3:], text[-3:]
        low = high


def _distinct(context: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each gram among the distinct ones, and the place of one gram of each kind."""
    with np.errstate(over="ignore"):
        mark = S.mix(context.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.view(np.uint64))
    coded = pa.array(mark).dictionary_encode()
    index = coded.indices.to_numpy()
    place = np.empty(len(coded.dictionary), np.int64)
    place[index] = np.arange(len(index))
    return index, place


def _added(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    context, last, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((last, context))
    context, last, n = context[order], last[order], n[order]
    start = np.flatnonzero(np.concatenate(([True], (context[1:] != context[:-1]) | (last[1:] != last[:-1]))))
    return context[start], last[start], np.add.reduceat(n, start)


def _counts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Texts (lang, part, text) as counted grams (lang, part, context, last, n)."""
    held: dict[tuple[str, int], list] = {}
    rows = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, part), parts in held.items():
            context, last, n = _added(parts)
            for a in range(0, len(n), 1 << 18):
                cut = slice(a, a + (1 << 18))
                size = len(n[cut])
                yield pa.record_batch(
                    [pa.array([lang] * size, pa.string()), pa.array(np.full(size, part), pa.int32()), *(pa.array(x[cut], pa.int64()) for x in (context, last, n))],
                    ["lang", "part", "context", "last", "n"],
                )
        held.clear()

    for batch in batches:
        for lang in pc.unique(batch.column(0)).to_pylist():
            tongue = batch.filter(pc.equal(batch.column(0), lang))
            for part in pc.unique(tongue.column(1)).to_pylist():
                for run in S.chunks(tongue.filter(pc.equal(tongue.column(1), part)), "text"):
                    for _, context, last in grams(S.texts_of(run.column(2))):
                        if len(last):
                            index, place = _distinct(context, last)
                            held.setdefault((lang, part), []).append((context[place], last[place], np.bincount(index)))
                            rows += len(place)
        if rows >= most:
            for at in held:
                held[at] = [_added(held[at])]
            rows = sum(len(x[0][0]) for x in held.values())
            if rows >= most // 2:
                yield from flush()
                rows = 0
    yield from flush()


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def counted(docs: DataFrame, id_column: str, text: str, lang: str, most: int = HELD_GRAMS) -> DataFrame:
    """Written (lang, context, last, fit, check): counts of four-grams in the rows to fit and to calibrate with."""
    check = F.coalesce(F.crc32(col(id_column).cast("string").cast("binary")) % 4 == 3, F.lit(False))
    rows = docs.where(~held_out(col(id_column)) & col(lang).isNotNull()).select(
        col(lang).alias("lang"), check.cast("int").alias("part"), col(text).alias("text")
    )
    found = rows.mapInArrow(lambda b: _counts(b, most), "lang string, part int, context long, last long, n long")
    of = lambda p: F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0))
    return materialize(found.groupBy("lang", "context", "last").agg(of(0).alias("fit"), of(1).alias("check")), "char-counts")


@dataclass
class CharModels:
    """Sorted hash arrays per order: grams with their log-probabilities, contexts with the weight of the lower order."""

    langs: list[str]
    ground: np.ndarray = field(default_factory=lambda: np.zeros(0))
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    sharpness: float = SHARPNESS
    limits: np.ndarray | None = None

    def logs(self, context: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Natural log-probabilities, one row per gram and one column per language."""
        out = np.broadcast_to(self.ground, (len(last), len(self.langs)))
        for k in range(ORDER):
            own = context & ((1 << (_BITS * k)) - 1)
            found, lower = _look(self.grams[k], slots(own, last)), _look(self.contexts[k], slots(own, 0))
            out = np.where(np.isnan(found), np.where(np.isnan(lower), 0, lower) + out, found)
        return out

    def entropies(self, texts: S.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (nats) of each text by language, and the number of characters."""
        total = np.zeros((len(texts), len(self.langs)))
        size = np.zeros(len(texts), np.int64)
        for text, context, last in grams(texts):
            if not len(last):
                continue
            index, place = _distinct(context, last)
            logs = self.logs(context[place], last[place])
            a, b = int(text[0]), int(text[-1]) + 1
            size[a:b] += np.bincount(text - a, minlength=b - a)
            for j in range(len(self.langs)):
                total[a:b, j] -= np.bincount(text - a, logs[index, j], b - a)
        return total / np.maximum(size, 1)[:, None], size

    def judge(self, texts: S.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language (-1 for none), score and rejection of each text."""
        if not self.langs:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts), bool)
        entropy, size = self.entropies(texts)
        best = entropy.argmin(1)
        least = entropy.min(1)
        score = 1 / np.exp(-self.sharpness * (entropy - least[:, None])).sum(1)
        some = size > 0
        over = least > self.limits[best] if self.limits is not None else np.zeros(len(texts), bool)
        return np.where(some, best, -1), np.where(some, score, 0.0), some & over


def _look(table: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Rows of a sorted hash array; not-a-number where it has none."""
    keys, values = table
    if not len(keys):
        return np.full((len(at), values.shape[1]), np.nan)
    near = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
    return np.where((keys[near] == at)[:, None], values[near], np.nan)


def _array(rows: DataFrame, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(lang, slot, value) as a sorted hash array; at most ``SLOTS`` rows of one number per language."""
    got = rows.groupBy("slot").agg(*[F.max(F.when(F.col("lang") == lang, F.col("value"))).alias(str(j)) for j, lang in enumerate(langs)]).toArrow()
    keys = got.column("slot").to_numpy()
    order = np.argsort(keys)
    columns = [pc.fill_null(got.column(str(j)).cast(pa.float64()), np.nan).to_numpy()[order] for j in range(len(langs))]
    return keys[order], np.column_stack(columns).astype(np.float32)


def models(counts: DataFrame) -> CharModels:
    """Kneser-Ney models of (lang, context, last, n), the counts of four-grams."""
    orders = [counts.where("n > 0").select("lang", "context", "last", "n")]
    for k in range(ORDER - 2, -1, -1):
        shorter = F.col("context").bitwiseAND(F.lit((1 << (_BITS * k)) - 1)).alias("context")
        orders.insert(0, materialize(orders[0].groupBy("lang", shorter, "last").agg(F.count("*").alias("n")), "char-order"))
    sizes = orders[0].groupBy("lang").agg(F.count("*").alias("letters")).collect()  # one row per language
    langs = sorted(r["lang"] for r in sizes)
    letters = {r["lang"]: r["letters"] for r in sizes}
    out = CharModels(langs, np.array([-np.log(letters[x] + 1) for x in langs]))
    if not langs:
        return out
    lower = None
    for k, rows in enumerate(orders):
        of = lambda times: F.count(F.when(F.col("n") == times, 1))
        once = rows.groupBy("lang").agg(of(1).alias("n1"), of(2).alias("n2"))
        # one row per language
        discount = once.select("lang", F.least(F.lit(0.9), F.greatest(F.lit(0.1), F.coalesce(F.try_divide("n1", F.expr("n1 + 2 * n2")), F.lit(0.5)))).alias("d"))
        about = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).join(discount, "lang")
        about = materialize(about.select("lang", "context", "total", "d", F.expr("d * kinds / total").alias("weight")), "char-contexts")
        both = rows.join(about, ["lang", "context"])
        if lower is None:
            size = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(1.0 / (letters[lang] + 1)))])
            under = both.withColumn("under", size[F.col("lang")])
        else:
            shorter = F.col("context").bitwiseAND(F.lit((1 << (_BITS * (k - 1))) - 1))
            under = both.withColumn("short", shorter).join(
                lower.select("lang", F.col("context").alias("short"), "last", F.col("p").alias("under")), ["lang", "short", "last"]
            )
        lower = materialize(under.select("lang", "context", "last", F.expr("(n - d) / total + weight * under").alias("p")), "char-grams")
        context, last = F.col("context"), F.col("last")
        out.grams.append(_array(lower.select("lang", slots(context, last).alias("slot"), F.log("p").alias("value")), langs))
        out.contexts.append(_array(about.select("lang", slots(context, F.lit(0)).alias("slot"), F.log("weight").alias("value")), langs))
    return out


def _calibrated(docs: DataFrame, fitted: CharModels, id_column: str, text: str, lang: str) -> tuple[float, dict[str, float]]:
    """Sharpness with the least log loss over the calibration rows, and the highest usual cross-entropy per language."""
    check = F.coalesce(F.crc32(col(id_column).cast("string").cast("binary")) % 4 == 3, F.lit(False))
    rows = docs.where(check & col(lang).isin(fitted.langs)).select(col(lang).alias("lang"), col(text).alias("text"))
    number = {x: j for j, x in enumerate(fitted.langs)}

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.chunks(batch, "text"):
                entropy, size = fitted.entropies(S.texts_of(part.column(1)))
                own = np.array([number[x] for x in part.column(0).to_pylist()], np.int64)
                true = entropy[np.arange(len(own)), own]
                less = true[:, None] - entropy
                some = pa.array(size > 0)
                cost = np.column_stack([np.logaddexp.reduce(b * less, axis=1) for b in _GRID]) if len(own) else np.zeros((0, len(_GRID)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, cost.size + 1, len(_GRID)), pa.int32()), pa.array(cost.ravel()))
                yield pa.record_batch([part.column(0), pa.array(true), lists], ["lang", "entropy", "cost"]).filter(some)

    found = materialize(rows.mapInArrow(losses, "lang string, entropy double, cost array<double>"), "char-losses")
    mean = found.agg(*[F.round(F.avg(F.get("cost", F.lit(i))), 6).alias(str(i)) for i in range(len(_GRID))]).first()
    if mean["0"] is None:
        return SHARPNESS, {}
    best = min(range(len(_GRID)), key=lambda i: (mean[str(i)], i))
    usual = found.groupBy("lang").agg(F.percentile_approx("entropy", 0.999, 10_000).alias("most")).collect()  # one row per language
    return _GRID[best], {r["lang"]: r["most"] for r in usual}


def learned(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> CharModels:
    """Models of all languages among the rows that are not held out, calibrated."""
    counts = counted(docs, id_column, text, lang)
    sharpness, usual = SHARPNESS, {}
    fitted = models(counts.withColumnRenamed("fit", "n"))
    if fitted.langs:
        sharpness, usual = _calibrated(docs, fitted, id_column, text, lang)
    out = models(counts.withColumn("n", F.col("fit") + F.col("check")))
    out.sharpness = sharpness
    out.limits = np.array([usual.get(x, np.inf) for x in out.langs])
    return out


def identified(docs: DataFrame, model: CharModels, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str, str, str]:
    """``docs`` (or its columns ``keep``) with language, score and rejection, and the names of these columns."""
    columns = docs.columns if keep is None else keep
    names: list[str] = []
    for wanted in ("lang_pred", "score", "rejected"):
        names.append(fresh([*columns, *names], wanted))
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(n, k) for n, k in zip(names, kinds)])
    given = docs.select(*[col(c) for c in columns], *([] if text in columns else [col(text)]))
    at = given.columns.index(text)
    labels = np.array([*model.langs, UNKNOWN], dtype=object)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.chunks(batch, text):
                best, score, over = model.judge(S.texts_of(part.column(at)))
                own = [part.column(i) for i in range(len(columns))]
                yield pa.record_batch([*own, pa.array(labels[best], pa.string()), pa.array(score), pa.array(over)], [*columns, *names])

    return given.mapInArrow(judge, schema), *names

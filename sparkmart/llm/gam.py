"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over quantile bins. Tables are learned by cyclic boosting: feature after feature, a
shallow tree is fitted to the current residuals over that feature's bins and its leaves are added to the table, with a
small rate, many rounds. Then the pairs of features whose residuals a four-leaf tree explains best get a two-way table
each, learned the same way. A score is the logistic function of the intercept plus one entry of each table.

The fit uses at most ``FIT_ROWS`` labelled rows, those with the smallest hash of their id, and runs on the driver on
their features only (some MB at that bound). Scoring reads every whole text once, in tasks, by vectorised additions.
Features come from the text alone. Rows with ``crc32(id as text) % 4 = 2`` are held out of the fit.

Nulls: a null text is scored as an empty one; null labels and ids are not learned from; a null id is not held out.
Repeated labels of one id count once if equal, each if not. With one class only, the score is the smoothed share of that
class; without any labelled row the model knows nothing and the score is 1.0, so a filter keeps all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm import spans as S
from sparkmart.llm.frames import col, fresh, with_column
from sparkmart.llm.textstats import FEATURES, features
from sparkmart.runtime import materialize

FIT_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, SMOOTH = 120, 60, 0.15, 2.0
LEAST = 0.7


@dataclass
class Additive:
    """The learned tables; ``score`` adds up their entries."""

    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    intercept: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.intercept is None:
            return np.ones(len(x))
        total = np.full(len(x), self.intercept)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, j])]
        for (i, j), table in self.pairs.items():
            total += table[np.searchsorted(self.pair_edges[i], x[:, i]), np.searchsorted(self.pair_edges[j], x[:, j])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles, half-way between distinct values, so that frequent values have bins of their own."""
    distinct = np.unique(values)
    if len(distinct) <= bins:
        return (distinct[1:] + distinct[:-1]) / 2
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTH)


def _tree(g: np.ndarray, h: np.ndarray, cuts: int = 2) -> np.ndarray:
    """Leaf values over ordered bins after at most ``cuts`` greedy cuts."""
    borders = [0, len(g)]
    sum_g, sum_h = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))
    for _ in range(cuts):
        best, at = 1e-9, None
        for a, b in zip(borders, borders[1:]):
            if b - a > 1:
                mid = np.arange(a + 1, b)
                gl, hl = sum_g[mid] - sum_g[a], sum_h[mid] - sum_h[a]
                gr, hr = sum_g[b] - sum_g[mid], sum_h[b] - sum_h[mid]
                won = _gain(gl, hl) + _gain(gr, hr) - _gain(sum_g[b] - sum_g[a], sum_h[b] - sum_h[a])
                k = int(np.argmax(won))
                if won[k] > best:
                    best, at = won[k], int(mid[k])
        if at is None:
            break
        borders = sorted([*borders, at])
    out = np.empty(len(g))
    for a, b in zip(borders, borders[1:]):
        out[a:b] = (sum_g[b] - sum_g[a]) / (sum_h[b] - sum_h[a] + SMOOTH)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best four-leaf tree over a two-way table: one cut of each side. Its gain and its leaf values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def quarters(c):
        a = c[:-1, :-1]
        b, d = c[:-1, -1:] - a, c[-1:, :-1] - a
        return a, b, d, c[-1, -1] - a - b - d

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gs, hs = quarters(cg), quarters(ch)
    won = sum(_gain(x, y) for x, y in zip(gs, hs)) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(int(np.argmax(won)), won.shape)
    leaf = [x[i, j] / (y[i, j] + SMOOTH) for x, y in zip(gs, hs)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = leaf[0], leaf[1]
    out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaf[2], leaf[3]
    return float(won[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Learn from rows ``x`` with labels ``y`` (0 or 1)."""
    model = Additive()
    if not len(y):
        return model
    good = float(y.sum())
    model.intercept = float(np.log((good + 1) / (len(y) - good + 1)))
    if good in (0.0, float(len(y))):
        return model
    width = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    codes = [np.searchsorted(e, x[:, j]) for j, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            n = len(model.tables[j])
            step = RATE * _tree(np.bincount(codes[j], g, n), np.bincount(codes[j], h, n))
            model.tables[j] += step
            total += step[codes[j]]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(e, x[:, j]) for j, e in enumerate(model.pair_edges)]
    sides = [len(e) + 1 for e in model.pair_edges]

    def two_way(i, j, values):
        return np.bincount(coarse[i] * sides[j] + coarse[j], values, sides[i] * sides[j]).reshape(sides[i], sides[j])

    g, h = slopes()
    ranked = sorted(((_cross(two_way(i, j, g), two_way(i, j, h))[0], i, j) for i, j in combinations(range(width), 2)), reverse=True)
    model.pairs = {(i, j): np.zeros((sides[i], sides[j])) for won, i, j in ranked[:PAIRS] if won > 0}
    for _ in range(PAIR_ROUNDS):
        for i, j in model.pairs:
            g, h = slopes()
            step = RATE * _cross(two_way(i, j, g), two_way(i, j, h))[1]
            model.pairs[i, j] += step
            total += step[coarse[i], coarse[j]]
    return model


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``most`` labelled texts that are not held out."""
    known = labels.select(col(id_column).alias("id"), col(label).cast("int").alias("y")).dropna().where(~held_out(F.col("id"))).distinct()
    ids = docs.select(col(id_column).alias("id")).dropna().distinct()
    picked = known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id", "y").limit(most)
    sample = materialize(picked, "gam-labels")  # at most ``most`` narrow rows: small enough to send to every task
    rows = docs.select(col(id_column).alias("id"), col(text).alias("text")).join(F.broadcast(sample), "id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.chunks(batch, "text"):
                x = features(S.texts_of(part.column("text")))
                yield pa.record_batch([part.column("y"), *(pa.array(x[:, j]) for j in range(x.shape[1]))], ["y", *FEATURES])

    got = rows.select("y", "text").mapInArrow(measure, "y int, " + ", ".join(f"{n} double" for n in FEATURES))
    # repeated rows of one id all count, but the bound holds for what reaches the driver
    table = got.limit(2 * most).toPandas()
    table = table.sort_values(list(table.columns)).to_numpy(dtype=float)
    return table[:, 1:], table[:, 0]


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", most: int = FIT_ROWS) -> Additive:
    return fit(*training_rows(docs, labels, id_column, text, label, most))


def scored(docs: DataFrame, model: Additive, name: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the double column ``name``."""
    columns = docs.columns if keep is None else keep
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(name, T.DoubleType())])
    given = docs.select(*[col(c) for c in columns], *([] if text in columns else [col(text)]))
    at = given.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.chunks(batch, text):
                values = model.score(features(S.texts_of(part.column(at))))
                yield with_column(part.select(columns), name, pa.array(values, pa.float64()))

    return given.mapInArrow(score, schema)


def filtered(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, with the columns of ``docs``."""
    name = fresh(docs.columns, "score")
    rows = scored(docs, train(docs, labels, id_column, text), name, text)
    return rows.where(col(name) >= least).select(*[col(c) for c in docs.columns])

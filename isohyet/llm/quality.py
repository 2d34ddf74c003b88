"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into quantile bins and has a lookup table over them; a few pairs of features have tables
over coarser bins. Cyclic gradient boosting fits a shallow tree to one feature at a time and adds its leaves to the
table with a small step; pairs that explain most of what is left are boosted the same way afterwards. A score is the
logistic function of the sum of one entry of each table, so scoring is a few vectorised additions.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import common

#: Labelled rows to learn from, at most; of more, those with the least hashes of their ids.
TRAINING_ROWS = 20_000
THRESHOLD = 0.3
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 60
STEP = 0.1
LEAVES = 3
SMOOTHING = 1.0

FEATURES = (
    "log_bytes", "log_words", "mean_word", "byte_entropy", "upper_share", "digit_share", "high_byte_share", "symbol_share", "symbol_words", "stop_share",
    "distinct_words", "repeats_next", "repeated_pairs", "distinct_lines", "words_per_line", "long_words",
)

_UPPER, _LOWER, _DIGIT, _SPACE = slice(65, 91), slice(97, 123), slice(48, 58), [9, 10, 11, 12, 13, 32]
_SYMBOLS = [b for b in range(33, 127) if not chr(b).isalnum()]
_STOPS = [ord(c) for c in ",.;:?!"]
_SYMBOL_WORD = re.compile(rb"(?<!\S)[!-/:-@\[-`{-~]+(?!\S)")


def features(text: bytes) -> tuple[float, ...]:
    """Shapes of a whole text that hold for any language: sizes, shares of classes of bytes, repetition of words, pairs and lines.

    An empty text has 0 for all.
    """
    if not text:
        return (0.0,) * len(FEATURES)
    n = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    size, words, lines = len(text), text.split(), text.split(b"\n")
    n_words = max(1, len(words))
    letters = max(1, int(n[_UPPER].sum() + n[_LOWER].sum()))
    inked = max(1, size - int(n[_SPACE].sum()))
    share = n[n > 0] / size
    symbols = max(1, int(n[_SYMBOLS].sum()))
    return (
        float(np.log1p(size)), float(np.log1p(len(words))), inked / n_words, float(-(share * np.log2(share)).sum()), n[_UPPER].sum() / letters, n[_DIGIT].sum() / inked, n[128:].sum() / inked, n[_SYMBOLS].sum() / inked,
        len(_SYMBOL_WORD.findall(text)) / n_words, n[_STOPS].sum() / symbols, len(set(words)) / n_words, sum(map(eq, words, words[1:])) / n_words, 1 - len(set(zip(words, words[1:]))) / max(1, len(words) - 1),
        len(set(lines)) / len(lines), n_words / len(lines), sum(len(w) > 16 for w in words) / n_words,
    )


def feature_matrix(texts: pa.Array) -> np.ndarray:
    return np.array([features(x.as_py()) for x in texts.cast(pa.large_binary())], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass
class AdditiveModel:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, k], "right")]
        for a, b, table in self.pairs:
            out += table[np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -40, 40)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Leaf values by bin of a tree with at most LEAVES leaves, best cut first."""
    g, w = np.r_[0.0, np.cumsum(gradient)], np.r_[0.0, np.cumsum(weight)]
    value = lambda lo, hi: (g[hi] - g[lo]) ** 2 / (w[hi] - w[lo] + SMOOTHING)
    leaves = [(0, len(gradient))]
    while len(leaves) < LEAVES:
        best = (1e-9, None, None)
        for leaf in leaves:
            lo, hi = leaf
            if hi - lo < 2:
                continue
            cuts = np.arange(lo + 1, hi)
            gain = value(lo, cuts) + value(cuts, hi) - value(lo, hi)
            k = int(np.argmax(gain))
            best = max(best, (float(gain[k]), leaf, int(cuts[k])), key=lambda t: t[0])
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.empty(len(gradient))
    for lo, hi in leaves:
        out[lo:hi] = (g[hi] - g[lo]) / (w[hi] - w[lo] + SMOOTHING)
    return out


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best single cut in each of two dimensions: its gain and the values of the four quadrants by cell."""
    g, w = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    rows, cols = gradient.shape
    if rows < 2 or cols < 2:
        return 0.0, np.zeros_like(gradient)
    parts = lambda c: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
    gs, ws = parts(g), parts(w)
    gain = sum(a**2 / (b + SMOOTHING) for a, b in zip(gs, ws, strict=True)) - g[-1, -1] ** 2 / (w[-1, -1] + SMOOTHING)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    leaf = [a[i, j] / (b[i, j] + SMOOTHING) for a, b in zip(gs, ws, strict=True)]
    out = np.empty_like(gradient)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaf
    return float(gain[i, j]), out


def train(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit to features and 0/1 labels. Without rows the model gives 0.5 everywhere; with one label only, near that label."""
    model = AdditiveModel()
    if not len(y):
        return model
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model.intercept = float(np.log(rate / (1 - rate)))
    f = np.full(len(y), model.intercept)
    for k in range(x.shape[1]):
        model.edges.append(_edges(x[:, k], BINS))
        model.pair_edges.append(_edges(x[:, k], PAIR_BINS))
        model.tables.append(np.zeros(len(model.edges[k]) + 1))
    bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.pair_edges)]
    for _ in range(ROUNDS):
        for k, own in enumerate(bins):
            p = 1 / (1 + np.exp(-f))
            size = len(model.tables[k])
            add = STEP * np.clip(_tree(np.bincount(own, y - p, size), np.bincount(own, p * (1 - p), size)), -4, 4)
            model.tables[k] += add
            f += add[own]

    def pair_of(a: int, b: int) -> tuple[float, np.ndarray, np.ndarray]:
        rows, cols = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
        cell = coarse[a] * cols + coarse[b]
        p = 1 / (1 + np.exp(-f))
        gain, table = _pair_tree(np.bincount(cell, y - p, rows * cols).reshape(rows, cols), np.bincount(cell, p * (1 - p), rows * cols).reshape(rows, cols))
        return gain, table, cell

    ranked = sorted(((pair_of(a, b)[0], a, b) for a in range(len(bins)) for b in range(a)), reverse=True)[:PAIRS]
    found = {(a, b): np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for gain, a, b in ranked if gain > 0}
    for _ in range(PAIR_ROUNDS):
        for a, b in found:
            _, table, cell = pair_of(a, b)
            add = STEP * np.clip(table, -4, 4)
            found[a, b] += add
            f += add.ravel()[cell]
    model.pairs = [(a, b, t) for (a, b), t in found.items()]
    return model


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = feature_matrix(common.utf8(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], names=["quality", "x"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> AdditiveModel:
    """Learn from labelled documents that are not held out: at most so many, those with the least hashes of their ids.

    Labels without a document, null labels and null ids are not used. Of an id with several labels the greatest counts,
    of one with several texts the one of the least hash; null texts are empty, very long ones are read whole. Without
    labels the model gives 0.5 everywhere. Only doc_id and text of the documents are read. The sample's features, rows
    times 16 numbers, are what the driver holds.
    """
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).filter("doc_id is not null and quality is not null").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    sample = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # the sample has at most `rows` rows of two numbers
    chosen = docs.select(F.col("doc_id").cast("long"), common.text_or_empty().alias("text")).join(F.broadcast(sample), "doc_id")
    chosen = chosen.groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    found = chosen.select("quality", "text").mapInArrow(_features, "quality int, x array<double>").toArrow()
    x = found.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    y = found.column("quality").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # the same model whatever order the rows come in
    return train(x[order], y[order])


def _score(batches: Iterator[pa.RecordBatch], model: AdditiveModel, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = model.score(feature_matrix(common.utf8(batch.column(batch.schema.get_field_index("text")))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, name])
    common.give_back()


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """The given rows (column text among them) with quality_score, from 0 to 1, as their last column.

    Null texts are scored as empty ones and stay null. Texts are read whole, however long; one is in memory at a time
    beside its batch. Repeated rows stay; an empty table gives no rows. All other columns pass unchanged; where one is
    named quality_score, the new column's name is common.fresh(docs.columns, "quality_score").
    """
    name = common.fresh(docs.columns, "quality_score")
    return docs.mapInArrow(partial(_score, model=model, name=name), StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def op10_quality_scores(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs.select(F.col("doc_id").cast("long"), "text"), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), F.col("quality_score").alias("score"), F.when(F.col("quality_score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))

"""A quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spelltide.llm.scratch import extended, placed
from spelltide.llm.words import LOWER, PIECE_BYTES, pieces, run_hashes, spans, word_hashes

WORD_BITS = 14
FACTORS = 8
#: Labelled rows of either class that the model is fitted on at most.
SAMPLE_PER_CLASS = 3_000
EPOCHS = 12
BATCH = 64

# Classes of bytes that the structure statistics count.
_KINDS = np.full(256, 8, np.uint8)  # other symbols
for _kind, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".!?", b",;:'\"()-")
):
    _KINDS[list(_bytes)] = _kind
_KINDS[0x80:0xC0] = 7  # continuation bytes
_KINDS[0xC0:] = 9  # first bytes of other letters
_KINDS[[*range(9), *range(11, 32)]] = 10  # control characters
STATISTICS = 20


@dataclass
class Features:
    """Sparse word weights in row order, and the dense statistics of each row."""

    row: np.ndarray
    word: np.ndarray
    weight: np.ndarray
    dense: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> Features:
    """Features of whole texts. n_chars is NaN where it is null.

    Words are hashed to 2^14 columns, whose log counts have length 1 per text. The statistics are
    shares of character classes, word and line shapes, repetition and lengths.
    """
    rows = len(offsets) - 1
    hashed, row = word_hashes(data, offsets)
    column = (hashed >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, count = np.unique((row << WORD_BITS) | column, return_counts=True)
    row_of, word = key >> WORD_BITS, key & ((1 << WORD_BITS) - 1)
    weight = np.log1p(count)
    norm = np.sqrt(np.bincount(row_of, weight * weight, rows))
    weight = weight / np.maximum(norm[row_of], 1e-12)

    size = np.diff(offsets)
    kinds = np.zeros((rows, 11))
    for low in range(0, len(data), PIECE_BYTES):
        of = np.searchsorted(offsets, np.arange(low, min(low + PIECE_BYTES, len(data))), "right") - 1
        some = of[0], of[-1] + 1
        found = np.bincount((of - some[0]) * 11 + _KINDS[data[low : low + PIECE_BYTES]], minlength=(some[1] - some[0]) * 11)
        kinds[some[0] : some[1]] += found.reshape(-1, 11)
    chars = size - kinds[:, 7]
    words = np.bincount(row, minlength=rows).astype(float)
    per = lambda x, of: x / np.maximum(of, 1)
    line_hash, line_row = run_hashes(data, offsets, np.arange(256) != 10, LOWER)
    lines = np.bincount(line_row, minlength=rows).astype(float)
    line_keys = np.unique(line_hash ^ (line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    distinct_lines = np.bincount(line_row[line_keys], minlength=rows)
    most = np.zeros(rows)
    np.maximum.at(most, row_of, count)
    w_start, w_end, w_row = spans(_KINDS[data] != 3, offsets)
    odd = np.isin(_KINDS[data[w_end - 1]], (8,)) if len(w_end) else np.zeros(0, bool)
    long = (w_end - w_start) > 20
    missing = np.isnan(n_chars)
    told = np.where(missing, 0, n_chars)
    dense = np.column_stack([
        *(per(kinds[:, k], chars) for k in (0, 1, 2, 3, 4, 5, 6, 8, 9, 10)),
        np.log1p(chars), np.log1p(words), per(chars, words).clip(0, 100), 1 - per(distinct_lines, lines) * (lines > 0) - (lines == 0),
        per(np.bincount(row_of, minlength=rows), words), per(most, words), per(np.bincount(w_row, odd, rows), words),
        per(np.bincount(w_row, long, rows), words), np.log1p(np.maximum(told, 0)), missing,
    ])
    return Features(row_of, word, weight, dense)


@dataclass
class Model:
    """bias + linear terms + pairwise terms <v_i, v_j> x_i x_j, as a probability of label 1.

    Without rows of both classes `linear` is empty and the score is `prior`.
    """

    prior: float
    bias: float = 0.0
    linear: np.ndarray = None
    factors: np.ndarray = None
    mean: np.ndarray = None
    scale: np.ndarray = None

    def margin(self, x: Features, rows: int) -> np.ndarray:
        """Linear in the number of features: the pairwise sum is half of (square of sum - sum of squares)."""
        dense = np.clip((x.dense - self.mean) / self.scale, -4, 4) / np.sqrt(STATISTICS)
        words = 1 << WORD_BITS
        out = self.bias + np.bincount(x.row, self.linear[x.word] * x.weight, rows) + dense @ self.linear[words:]
        for f in range(self.factors.shape[1]):
            term = self.factors[x.word, f] * x.weight
            total = np.bincount(x.row, term, rows) + dense @ self.factors[words:, f]
            squares = np.bincount(x.row, term * term, rows) + (dense * dense) @ (self.factors[words:, f] ** 2)
            out += 0.5 * (total * total - squares)
        return out

    def score(self, x: Features, rows: int) -> np.ndarray:
        if self.linear is None:
            return np.full(rows, self.prior)
        return 1 / (1 + np.exp(-np.clip(self.margin(x, rows), -30, 30)))


def _feature_rows(rows: DataFrame) -> DataFrame:
    """Features as arrays of rows of label, order, told length and text."""

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            told = batch.column(2).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            for low, high, data, offsets in pieces(batch.column(3)):
                x = features(data, offsets, told[low:high])
                cut = np.searchsorted(x.row, np.arange(1, high - low))
                yield pa.RecordBatch.from_pydict({
                    "label": batch.column(0).slice(low, high - low), "order": batch.column(1).slice(low, high - low),
                    "word": pa.array(np.split(x.word.astype(np.int32), cut), pa.list_(pa.int32())),
                    "weight": pa.array(np.split(x.weight.astype(np.float32), cut), pa.list_(pa.float32())),
                    "dense": pa.array(list(x.dense), pa.list_(pa.float64())),
                })

    return rows.mapInArrow(build, "label int, order long, word array<int>, weight array<float>, dense array<double>")


def fit(
    df: DataFrame, labels: DataFrame, key: str, label: str, text: str = "text", n_chars: str | None = "n_chars",
    per_class: int = SAMPLE_PER_CLASS, seed: int = 11,
) -> Model:
    """Fit on at most `per_class` rows of either label: the labelled keys with the smallest hash.

    `labels` has keys and labels of 0 or 1; other labels, null keys and keys labelled both ways are left
    out. The keys are chosen among the labels, so that only their texts are looked up in `df`, by a
    broadcast of at most 2 * per_class keys. Of rows with the same key the one with the largest text
    counts. The two classes weigh in the loss as they do among all labels. Without labels of both classes
    the score is constant: the share of label 1, or 1 where nothing is labelled.
    """
    once = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    once = once.agg(F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_most"))
    once = once.where("_label = _most").select("_key", "_label", F.xxhash64(F.lit(seed), "_key").alias("_order"))
    found = {r["_label"]: r["n"] for r in once.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = found.get(1, 0) / sum(found.values()) if found else 1.0
    if len(found) < 2:
        return Model(prior)
    chosen = [once.where(F.col("_label") == k).orderBy("_order", "_key").limit(per_class) for k in (0, 1)]
    told = F.col(n_chars).cast("long") if n_chars else F.lit(None).cast("long")
    rows = df.select(F.col(key).alias("_key"), F.struct(F.col(text).cast("string").alias("_text"), told.alias("_told")).alias("_row"))
    rows = rows.join(F.broadcast(chosen[0].union(chosen[1])), "_key")
    rows = rows.groupBy("_key", "_label", "_order").agg(F.max("_row").alias("_row"))
    sample = _feature_rows(rows.select("_label", "_order", "_row._told", "_row._text")).toArrow()
    return _train(sample.sort_by([("order", "ascending"), ("label", "ascending")]), prior, seed)


def _train(sample: pa.Table, prior: float, seed: int) -> Model:
    """Minimise the weighted log loss with Adagrad in small batches."""
    y = sample["label"].to_numpy().astype(float)
    length = np.array([len(x) for x in sample["word"]])
    word = np.concatenate([np.zeros(0, np.int64), *(x.values.to_numpy() for x in sample["word"])]).astype(np.int64)
    weight = np.concatenate([np.zeros(0), *(x.values.to_numpy() for x in sample["weight"])])
    dense = np.array(sample["dense"].to_pylist(), float)
    if len(set(y)) < 2:
        return Model(prior)
    mean, scale = dense.mean(0), np.maximum(dense.std(0), 1e-6)
    z = np.clip((dense - mean) / scale, -4, 4) / np.sqrt(STATISTICS)
    starts = np.concatenate([[0], np.cumsum(length)])
    importance = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    rng = np.random.Generator(np.random.PCG64(seed))
    n, words = len(y), 1 << WORD_BITS
    linear, factors, bias = np.zeros(words + STATISTICS), rng.normal(0, 0.05, (words + STATISTICS, FACTORS)), np.log(prior / (1 - prior))
    g_linear, g_factors, g_bias, rate, decay = np.full(len(linear), 1e-4), np.full(factors.shape, 1e-4), 1e-4, 0.1, 1e-5
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(n), max(1, n // BATCH)):
            at = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in batch])
            row = np.repeat(np.arange(len(batch)), length[batch])
            col, val = word[at], weight[at]
            all_col = np.concatenate([col, np.tile(np.arange(words, words + STATISTICS), len(batch))])
            all_row = np.concatenate([row, np.repeat(np.arange(len(batch)), STATISTICS)])
            all_val = np.concatenate([val, z[batch].ravel()])
            v = factors[all_col]
            terms = v * all_val[:, None]
            total = np.zeros((len(batch), FACTORS))
            np.add.at(total, all_row, terms)
            squares = np.bincount(all_row, (terms * terms).sum(1), len(batch))
            margin = bias + np.bincount(all_row, linear[all_col] * all_val, len(batch)) + 0.5 * ((total**2).sum(1) - squares)
            slope = importance[batch] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[batch]) / len(batch)
            at_value = slope[all_row] * all_val
            used, place = np.unique(all_col, return_inverse=True)
            d_linear = np.bincount(place, at_value, len(used)) + decay * linear[used]
            d_factors = np.column_stack([
                np.bincount(place, at_value * (total[all_row, f] - terms[:, f]), len(used)) for f in range(FACTORS)
            ]) + decay * factors[used]
            g_linear[used] += d_linear**2
            g_factors[used] += d_factors**2
            g_bias += slope.sum() ** 2
            linear[used] -= rate * d_linear / np.sqrt(g_linear[used])
            factors[used] -= 0.3 * rate * d_factors / np.sqrt(g_factors[used])
            bias -= rate * slope.sum() / np.sqrt(g_bias)
    return Model(prior, float(bias), linear, factors, mean, scale)


def score(df: DataFrame, model: Model, text: str = "text", n_chars: str | None = "n_chars", out: str = "score") -> DataFrame:
    """All columns of `df` and the probability of label 1, computed from whole texts without a shuffle.

    A column that is called `out` is replaced. Null and empty texts get a score from their statistics alone. The model is of fixed size.
    """
    df = df.drop(out)
    names = df.columns
    shared = df.sparkSession.sparkContext.broadcast(model)
    ready = placed(df, F.col(text).cast("string"), F.col(n_chars).cast("long") if n_chars else F.lit(None).cast("long"))

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            told = batch.column(len(names) + 1).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            scores = [np.zeros(0)]
            for low, high, data, offsets in pieces(batch.column(len(names))):
                scores.append(shared.value.score(features(data, offsets, told[low:high]), high - low))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(np.concatenate(scores))], [*names, out])

    return ready.mapInArrow(build, extended(df, f"`{out}` double"))

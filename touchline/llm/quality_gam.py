"""Quality classifier: a generalised additive model with pairwise interactions.

The model is a sum of lookup tables, one per feature and one per chosen pair of features. Boosting goes round
the features: each turn fits a shallow tree of one feature to what is left and adds it to that feature's table.
Pairs with the largest gain on the remainder then get two-dimensional tables the same way. A score is the
logistic of the added table values; documents are scored by binning and adding, vectorised.

Features are counts and ratios of a whole text (``NAMES``). Labels are read for training only, from at most
``MAX_TRAIN`` rows, chosen by a hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from touchline.llm.common import byte_chunks, new_name, one_per_id
from touchline.llm.decontaminate import word_hashes

MAX_TRAIN = 20_000
THRESHOLD = 0.3
BINS = 32
PAIR_BINS = 8
N_PAIRS = 10
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.1
LEAVES = 3

NAMES = (
    "log_bytes", "log_words", "mean_word", "upper", "digit", "beyond_ascii", "exclaim", "bar", "symbol", "stop",
    "comma", "other_mark", "line_breaks", "same_as_before", "distinct_words", "distinct_lines", "upper_words",
    "mark_words", "longest_line",
)

_CLASS = np.zeros((256, 9), np.uint8)
for _name, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(range(128, 256)), b"!", b"|",
                                b"#$%&*@~^_=+<>{}[]\\`", b".?", b",", b";:'\"()-/")):
    _CLASS[list(_chars), _name] = 1
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each range; empty ranges are zero."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[offsets])


def _distinct(keys: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct keys per text."""
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])]) if len(k) else np.zeros(0, bool)
    return np.bincount(t[new], minlength=n)


def _runs(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray):
    """Start and end of all runs of bytes that are not ``apart``, and the text of each."""
    inside = np.concatenate([~apart, [False]])
    edge = np.zeros(len(inside), bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` per text of a chunk."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    classes = [_sums(_CLASS[:, c][data], offsets) for c in range(_CLASS.shape[1])]
    breaks = _sums(data == 10, offsets)
    starts, ends, text = _runs(data, offsets, _BLANK[data])
    words = np.bincount(text, minlength=n)
    letters = np.bincount(text, weights=ends - starts, minlength=n)
    hashes = _hash_runs(data, starts, ends)
    same = np.zeros(len(text), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    upper = np.concatenate([[0], np.cumsum(_CLASS[:, 0][data], dtype=np.int64)])
    caps = (upper[ends] - upper[starts]) * 2 > ends - starts
    marks = (_CLASS[:, 5][data[ends - 1]] | _CLASS[:, 3][data[ends - 1]]).astype(bool)
    l_starts, l_ends, l_text = _runs(data, offsets, data == 10)
    lines = np.bincount(l_text, minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, l_text, l_ends - l_starts)
    per_byte, per_word = np.maximum(size, 1), np.maximum(words, 1)
    up, digit, high, exclaim, bar, symbol, stop, comma, other = (c / per_byte for c in classes)
    return np.stack([
        np.log1p(size), np.log1p(words), letters / per_word, up, digit, high, exclaim, bar, symbol, stop, comma, other,
        breaks / per_byte, np.bincount(text, weights=same, minlength=n) / per_word,
        _distinct(hashes, text, n) / per_word,
        _distinct(_hash_runs(data, l_starts, l_ends), l_text, n) / np.maximum(lines, 1),
        np.bincount(text, weights=caps, minlength=n) / per_word,
        np.bincount(text, weights=marks, minlength=n) / per_word, np.log1p(longest),
    ], axis=1)


def _hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return word_hashes(data, starts, ends, None)


# -- the model -----------------------------------------------------------------------------------------------


@dataclass
class Additive:
    """Bin edges and tables; a pair's table is indexed by the coarse bins of both features."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, j], "right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for p in self.pairs for j in p}
        for (i, j), values in zip(self.pairs, self.pair_tables):
            total += values[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Borders between bins: quantiles, put halfway between neighbouring values."""
    values = np.unique(x)
    if len(values) <= 1:
        return np.zeros(0)
    at = np.unique(np.searchsorted(values, np.quantile(x, np.arange(1, bins) / bins)))
    at = at[at > 0]
    return (values[at - 1] + values[at]) / 2


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """A tree of a few leaves over ordered bins, grown by the best split: a value per bin."""
    cuts = [0, len(g)]
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

    def worth(a, b):
        return (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + 1)

    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:]):
            mid = np.arange(a + 1, b)
            if len(mid):
                gain = worth(a, mid) + worth(mid, b) - worth(a, b)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(mid[k])), key=lambda t: t[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + 1)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Four quadrants of the best cross: a value per cell, and the gain."""
    gs = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    hs = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = g.shape
    a, b = np.meshgrid(np.arange(1, n), np.arange(1, m), indexing="ij")
    if not a.size:
        return np.zeros_like(g), 0.0

    def four(s):
        return s[a, b], s[a, m] - s[a, b], s[n, b] - s[a, b], s[n, m] - s[a, m] - s[n, b] + s[a, b]

    value = [x / (y + 1) for x, y in zip(four(gs), four(hs))]
    gain = sum(v * x for v, x in zip(value, four(gs)))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = value[0][i, j], value[1][i, j]
    out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value[2][i, j], value[3][i, j]
    return out, float(gain[i, j])


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """The model of features x and labels y; without rows of both classes a constant."""
    if not len(y):
        return Additive(0.0, [], [], [], [], [])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return Additive(base, [], [], [], [], [])
    n = x.shape[1]
    edges = [_edges(x[:, j], BINS) for j in range(n)]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)

    def rest():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(n):
            g, h = rest()
            k = len(tables[j])
            step = RATE * _tree(np.bincount(bins[j], g, k), np.bincount(bins[j], h, k))
            tables[j] += step
            total += step[bins[j]]
    coarse_edges = [_edges(x[:, j], PAIR_BINS) for j in range(n)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse_edges)]
    sizes = [len(e) + 1 for e in coarse_edges]

    def cells(i, j, values):
        return np.bincount(coarse[i] * sizes[j] + coarse[j], values, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = rest()
    gains = [(_pair_tree(cells(i, j, g), cells(i, j, h))[1], i, j) for i in range(n) for j in range(i + 1, n)]
    pairs = [(i, j) for _, i, j in sorted(gains, key=lambda t: (-t[0], t[1], t[2]))[:N_PAIRS]]
    pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for p, (i, j) in enumerate(pairs):
            g, h = rest()
            step = RATE * _pair_tree(cells(i, j, g), cells(i, j, h))[0]
            pair_tables[p] += step
            total += step[coarse[i], coarse[j]]
    return Additive(base, edges, tables, coarse_edges, pairs, pair_tables)


# -- documents -----------------------------------------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> "Column":  # noqa: F821
    """Rows whose labels are never learned; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _with_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(data, offsets) for _, _, data, offsets in byte_chunks(batch["text"])]
        flat = np.concatenate(rows) if rows else np.zeros((0, len(NAMES)))
        column = pa.ListArray.from_arrays(
            pa.array(np.arange(len(flat) + 1) * len(NAMES), pa.int32()), pa.array(flat.ravel())
        )
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["quality"], column], names=["doc_id", "quality", "x"])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Additive:
    """A model from at most ``max_train`` labelled rows, those of least hash.

    Rows with quality other than 0 or 1, null ids and held-out ids are not used; of several labels of one
    document the least counts.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    chosen = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # At most max_train rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select(F.col("doc_id").cast("long"), "text", "quality").mapInArrow(
        _with_features, "doc_id long, quality int, x array<double>"
    )
    found = sorted((r["doc_id"], r["quality"], r["x"]) for r in rows.collect())
    return fit(np.array([r[2] for r in found]).reshape(-1, len(NAMES)), np.array([r[1] for r in found], float))


def _score(batches: Iterator[pa.RecordBatch], model: Additive, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [model.score(features(data, offsets)) for _, _, data, offsets in byte_chunks(batch["text"])]
        column = pa.array(np.concatenate(scores) if scores else [], pa.float64())
        yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def score_rows(docs: DataFrame, model: Additive) -> DataFrame:
    """All columns of ``docs`` and, as the last one, the score (0 to 1) of its text; null texts count as empty.

    The column is ``_score``, with more underscores where ``docs`` has one of that name. Repeated rows are scored
    each; an empty table gives an empty result.
    """
    name = new_name(docs, "_score")
    schema = StructType([*docs.schema.fields]).add(name, DoubleType())
    return docs.mapInArrow(lambda it: _score(it, model, name), schema)


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= 0.3) of each document.

    Null and empty texts have a score like any other. Without labels of both classes all scores are the
    share of label 1 (0.5 without labels). Repeated doc_ids: the row with the greatest text counts. An empty
    table gives an empty result. Other columns of both tables are ignored.
    """
    docs = one_per_id(docs, "doc_id", "text")
    scored = score_rows(docs.select("doc_id", "text"), train(docs, labels, max_train))
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )

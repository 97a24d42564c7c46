"""Jaro-Winkler similarity over UTF-8 bytes as an Arrow-batched UDF."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Boost per shared leading byte, longest prefix that counts, least Jaro score boosted.
_PREFIX_WEIGHT, _PREFIX_MAX, _BOOST_ABOVE = 0.1, 4, 0.7

# Cells of one work matrix: small enough to stay in the processor's cache.
_BLOCK_CELLS = 200_000
# Splits a double into two halves of its digits.
_SPLIT = float(2**27 + 1)


def _matrix(texts: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """One row per text, padded with zeros on the right."""
    out = np.zeros((len(texts), int(lengths.max())), dtype=np.uint8)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return out


def _exact_product(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A product as the nearest double and what that leaves out, by splitting both factors in halves."""
    x_big, y_big = x * _SPLIT, y * _SPLIT
    x_high, y_high = x_big - (x_big - x), y_big - (y_big - y)
    x_low, y_low = x - x_high, y - y_high
    product = x * y
    return product, ((x_high * y_high - product) + x_high * y_low + x_low * y_high) + x_low * y_low


def _score_block(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Scores of non-empty pairs; all pairs advance together, one byte of the left text a step."""
    len_l = np.fromiter(map(len, left), dtype=np.int64, count=len(left))
    len_r = np.fromiter(map(len, right), dtype=np.int64, count=len(right))
    a, b = _matrix(left, len_l), _matrix(right, len_r)
    reach = np.maximum(np.maximum(len_l, len_r) // 2 - 1, 0)
    widest = int(reach.max())
    cols = np.arange(b.shape[1])
    free = cols < len_r[:, None]
    hit_l = np.zeros(a.shape, dtype=bool)
    for i in range(a.shape[1]):
        # Bytes of the right text that some pair of the block may look at from here.
        lo, hi = max(0, i - widest), min(b.shape[1], i + widest + 1)
        if lo >= hi:
            break
        fits = b[:, lo:hi] == a[:, i : i + 1]
        fits &= free[:, lo:hi]
        fits &= np.abs(cols[lo:hi] - i) <= reach[:, None]
        first = fits.argmax(axis=1)
        found = np.nonzero(fits[np.arange(len(left)), first] & (i < len_l))[0]
        hit_l[found, i] = True
        free[found, lo + first[found]] = False
    hit_r = (cols < len_r[:, None]) & ~free
    matches = hit_l.sum(axis=1)

    # The k-th matched byte of the left text stands against the k-th of the right text.
    differs = a[hit_l] != b[hit_r]
    swaps = np.bincount(np.nonzero(hit_l)[0][differs], minlength=len(left)) // 2

    m = matches.astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (m / len_l + m / len_r + (m - swaps) / m) / 3.0
    jaro = np.where(matches == 0, 0.0, jaro)

    shared = min(_PREFIX_MAX, a.shape[1], b.shape[1])
    both = np.arange(shared) < np.minimum(len_l, len_r)[:, None]
    prefix = np.cumprod((a[:, :shared] == b[:, :shared]) & both, axis=1).sum(axis=1)
    # Product and sum are rounded once, as by a fused multiply-add: scores on a limit depend on it.
    product, rest = _exact_product(prefix * _PREFIX_WEIGHT, 1.0 - jaro)
    total = jaro + product
    other = total - jaro
    lost = (jaro - (total - other)) + (product - other)
    boosted = total + (lost + rest)
    return np.where(jaro > _BOOST_ABOVE, boosted, jaro)


def jaro_winkler_arrays(left: list[bytes | None], right: list[bytes | None]) -> np.ndarray:
    """NaN where a side is missing, 0.0 where a side is empty."""
    out = np.full(len(left), np.nan)
    todo = []
    for i, (x, y) in enumerate(zip(left, right)):
        if x and y and x != y:
            todo.append(i)
        elif x is not None and y is not None:
            out[i] = 1.0 if x and x == y else 0.0
    if not todo:
        return out
    # In order of length, so that short pairs are not padded to the width of long ones.
    width = np.array([max(len(left[i]), len(right[i])) for i in todo])
    order = np.argsort(width, kind="stable")
    start = 0
    while start < len(order):
        rows = max(1, _BLOCK_CELLS // int(width[order[start]]))
        # The block is cut again where its last pair would make it too wide.
        rows = max(1, min(rows, _BLOCK_CELLS // int(width[order[min(start + rows, len(order)) - 1]])))
        chosen = [todo[k] for k in order[start : start + rows]]
        out[chosen] = _score_block([left[i] for i in chosen], [right[i] for i in chosen])
        start += rows
    return out


# Executors need no copy of this package: the UDF travels with its helpers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _as_bytes(values: pd.Series) -> list[bytes | None]:
    return [v.encode("utf-8") if isinstance(v, str) else None for v in values]


@F.pandas_udf(T.DoubleType())
def _jaro_winkler_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    scores = jaro_winkler_arrays(_as_bytes(left), _as_bytes(right))
    return pd.Series(scores, dtype="object").where(~np.isnan(scores), None)


# A filter on the score would otherwise be pushed below the projection and the pairs scored twice.
_scored_once = _jaro_winkler_udf.asNondeterministic()


# --- an upper bound without Python ----------------------------------------------------------

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Blanks and marks that names hold.
_MARKS = " -'.,/()&0"


def letter_mask(column: str) -> Column:
    """What a text column is made of, in 62 bits: per letter whether it occurs and whether it does so twice, and per mark
    whether it occurs. To be worked out once per name, and written: the expression is long."""
    quoted = ["'\\''" if x == "'" else f"'{x}'" for x in _LETTERS + _MARKS]
    once = [f"contains({column}, {x})" for x in quoted]
    twice = [f"substring_index({column}, {x}, 2) != {column}" for x in quoted[: len(_LETTERS)]]
    return F.expr(" | ".join(f"if({found}, {1 << i}L, 0L)" for i, found in enumerate(once + twice)))


def jaro_winkler_bound(left: Column, right: Column, left_mask: Column, right_mask: Column) -> Column:
    """At least the similarity of two texts that are not empty, as an expression that Spark compiles.

    A bit that one mask has and the other has not stands for one byte or more that find no match. No more can match than
    the rest of either text; with all these in order and with the bytes that both begin with, the score is the bound.
    """
    len_l, len_r = F.octet_length(left), F.octet_length(right)
    alone = lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b)))
    matches = F.least(len_l - alone(left_mask, right_mask), len_r - alone(right_mask, left_mask)).cast("double")
    jaro = (matches / len_l + matches / len_r + 1.0) / 3.0
    a, b = left.cast("binary"), right.cast("binary")
    shared = F.lit(0)
    for n in range(1, _PREFIX_MAX + 1):
        shared = F.when(F.substring(a, 1, n) == F.substring(b, 1, n), F.least(F.lit(n), len_l)).otherwise(shared)
    boosted = jaro + shared * F.lit(_PREFIX_WEIGHT) * (1.0 - jaro)
    return F.when(matches <= 0, 0.0).when(jaro > _BOOST_ABOVE, boosted).otherwise(jaro)


def jaro_winkler(left: Column, right: Column) -> Column:
    """Similarity in [0, 1]; NULL if a side is NULL."""
    return _scored_once(left, right)

"""Jaro-Winkler similarity of name pairs (Winkler 1990), one Arrow batch at a time.

Spark has no such function, and a fold over array functions costs half a millisecond a
pair. Here a whole batch of pairs is compared at once: the loop runs over character
positions, never over rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the measure.
PREFIX_LIMIT = 4
PREFIX_WEIGHT = 0.1
BOOST_ABOVE = 0.7

# Characters held at once while comparing; longer names are compared fewer at a time.
CELLS = 100_000


def least_jaro(threshold: float) -> float:
    """The Jaro value below which no common prefix lifts a pair to `threshold`."""
    most = PREFIX_LIMIT * PREFIX_WEIGHT
    return (threshold - most) / (1 - most)


def least_matches(threshold: float) -> float:
    """Matching characters a pair needs, as a share of `|a| |b| / (|a| + |b|)`.

    With m matches Jaro is at most (m/|a| + m/|b| + 1) / 3.
    """
    return 3 * least_jaro(threshold) - 1


def least_length_ratio(threshold: float) -> float:
    """How much shorter than the other a name may be and still reach `threshold`.

    At most the shorter name's characters match, so Jaro is at most (2 + ratio) / 3.
    """
    return max(0.0, 3 * least_jaro(threshold) - 2)


def _letters(names: np.ndarray) -> np.ndarray:
    fixed = names.astype(str)
    width = max(1, fixed.dtype.itemsize // 4)
    return np.ascontiguousarray(fixed).view(np.uint32).reshape(len(fixed), width)


def _in_order(chars: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Chosen characters of each row moved to the front, order kept."""
    return np.take_along_axis(chars, np.argsort(~chosen, axis=1, kind="stable"), axis=1)


def _compare(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    a, b = _letters(left), _letters(right)
    len_a, len_b = (a != 0).sum(1), (b != 0).sum(1)
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    rows = np.arange(len(a))
    hit_a, hit_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    places = np.arange(b.shape[1])
    widest = int(reach.max(initial=0))
    for at in range(a.shape[1]):
        low, high = max(0, at - widest), min(b.shape[1], at + widest + 1)
        if low >= high:
            break
        free = (b[:, low:high] == a[:, at : at + 1]) & ~hit_b[:, low:high]
        free &= np.abs(places[low:high] - at) <= reach[:, None]
        free &= (a[:, at] != 0)[:, None]
        first = free.argmax(1)
        found = free[rows, first]
        hit_b[rows[found], low + first[found]] = True
        hit_a[found, at] = True
    matched = hit_a.sum(1)
    span = min(a.shape[1], b.shape[1])
    moved = _in_order(a, hit_a)[:, :span] != _in_order(b, hit_b)[:, :span]
    swaps = (moved & (np.arange(span) < matched[:, None])).sum(1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (matched / len_a + matched / len_b + (matched - swaps) / matched) / 3
    jaro = np.where(matched == 0, 0.0, jaro)
    lead = min(PREFIX_LIMIT, span)
    agree = (a[:, :lead] == b[:, :lead]) & (a[:, :lead] != 0)
    prefix = np.logical_and.accumulate(agree, axis=1).sum(1)
    return np.where(jaro > BOOST_ABOVE, jaro + prefix * PREFIX_WEIGHT * (1 - jaro), jaro)


def similarities(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of each pair of names, the pairs grouped by length to save padding."""
    size = np.array([max(len(x), len(y), 1) for x, y in zip(left, right)], dtype=np.int64)
    order = np.argsort(size, kind="stable")
    out = np.zeros(len(left))
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * size[order[stop]] <= CELLS:
            stop += 1
        part = order[start:stop]
        out[part] = _compare(left[part], right[part])
        start = stop
    return out


@F.pandas_udf(T.DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(similarities(left.to_numpy(object), right.to_numpy(object)))

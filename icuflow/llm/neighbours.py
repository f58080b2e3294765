"""Nearest neighbours by cosine, exactly: int8 tiles with error bounds, then doubles for what the bounds leave.

In a tile every vector is scaled to length 1 and rounded to int8 steps of its own size. The product of the rounded
vectors, exact in its arithmetic, differs from the cosine by no more than what rounding took from either side, which is
known per vector. A pair whose upper bound is below the k-th best lower bound of its query cannot be among its k best;
the others are computed in doubles from the vectors themselves. Equal vectors in a block are treated as one, with the
smallest different ids that could count, so a vector that very many rows share costs as much as any other.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame

from icuflow.llm import tiles

#: Queries whose products with a block of candidates are held at once.
CHUNK = 256
#: More than rounding of doubles can add to a bound.
SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 steps, step size and the length of what rounding took, of each row."""
    step = np.abs(unit).max(axis=1, keepdims=True) / 127
    whole = np.rint(unit / step).astype(np.int8)
    return whole, step[:, 0], np.linalg.norm(unit - whole * step, axis=1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of int8 rows; floats hold them exactly while 127 * 127 * width stays below 2 ** 24, doubles beyond."""
    kind = np.float32 if 127 * 127 * a.shape[1] < 1 << 24 else np.float64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.float64)


def lengths(rows: np.ndarray) -> np.ndarray:
    """Lengths, summed component by component, so equal rows have equal lengths wherever they stand."""
    return np.sqrt(dots(rows, rows))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _different(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows that can count: of equal vectors those with the k + 1 smallest different ids, of each id the
    first k rows (ids are ascending). A query leaves its own id out, and k rows of other ids are left if there are as many."""
    packed = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    _, group = np.unique(packed, return_inverse=True)
    order = np.argsort(group, kind="stable")
    new = np.diff(group[order], prepend=-1) != 0
    other = new | (np.diff(ids[order], prepend=ids[order][:1]) != 0)
    nth = np.cumsum(other)
    nth -= nth[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(other, np.arange(len(order)), 0))
    return np.sort(order[(nth <= k) & (place < k)])


def cosine_tile(query_ids, queries, ids, vectors, k):
    own = _different(ids, vectors, k)
    asked, there = queries.astype(np.float64), vectors[own].astype(np.float64)
    q8, q_step, q_lost = quantised(_unit(asked))
    c8, c_step, c_lost = quantised(_unit(there))
    q_length, c_length = lengths(asked), lengths(there)
    out = []
    for first in range(0, len(asked), CHUNK):
        part = slice(first, first + CHUNK)
        near = product(q8[part], c8) * q_step[part, None] * c_step
        error = q_lost[part, None] + (1 + q_lost[part, None]) * c_lost + SLACK
        self_ = query_ids[part, None] == ids[own][None, :]
        low = np.where(self_, -np.inf, near - error)
        n = min(k, low.shape[1])
        edge = -np.partition(-low, n - 1, axis=1)[:, n - 1 : n]
        q, c = np.nonzero((near + error >= edge) & ~self_)
        q += first
        with np.errstate(over="ignore", invalid="ignore"):
            score = dots(asked[q], there[c]) / (q_length[q] * c_length[c])
        # The pairs come by query and ascending id: a stable sort keeps the smaller id before its equals.
        order = np.lexsort((c, -score, q))
        q, c, score = q[order], c[order], score[order]
        starts = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(starts, np.diff(starts, append=len(q)))
        best = place < k
        out.append((q[best], own[c[best]], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Columns query_id, rank (from 1), vec_id, score: the k nearest rows of each query by cosine in doubles, itself left
    out; equal scores by the smaller id; all of them if there are fewer than k. Every row is a candidate.

    Vectors that are null, empty, all zero or hold a null or a number that is not finite take no part, nor do rows
    without an id. Only vectors of one width are compared. Rows that share an id leave each other out; if several ask, the
    id has one answer, of k candidate rows by their best cosine with any of its vectors. A repeated candidate counts as
    often as it comes. An empty table gives an empty result. Other columns are not used.
    """
    return tiles.search(vectors, is_query, cosine_tile, k, "float64", False, id, vector)

"""Exact top-k by integer inner product, a term at a time.

Components become integers; the non-zero ones of a block of candidates are its postings, by component. For each
component of the queries the postings' weights are scattered, times the query's weight, into dense arrays of scores.
The k best of a block come from a partition of each array, not a sort, and the blocks' best are merged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm import tiles

#: Queries whose arrays of scores are held at once: few, so that these stay in the processor's cache.
CHUNK = 16


class Postings:
    """The non-zero weights of integer rows, by component, in the smallest integers that no sum with `queries` can pass."""

    def __init__(self, vectors: np.ndarray, queries: np.ndarray) -> None:
        bound = np.abs(queries).max(initial=0).item() * np.abs(vectors).max(initial=0).item() * queries.shape[1]
        self.kind, self.n = (np.int32 if bound < 1 << 31 else np.int64), len(vectors)
        columns = np.ascontiguousarray(vectors.astype(self.kind).T)
        rows = [np.flatnonzero(column) for column in columns]
        self.lists = [(None, c) if len(r) == self.n else (r, c[r]) for r, c in zip(rows, columns, strict=True)]

    def scores(self, queries: np.ndarray) -> np.ndarray:
        """Inner products with all rows: each query's weights times the postings of its components, scattered into its
        array of scores."""
        out = np.zeros((len(queries), self.n), dtype=self.kind)
        product = np.empty(self.n, dtype=self.kind)
        for query, into in zip(queries.astype(self.kind), out, strict=True):
            for term in np.flatnonzero(query).tolist():
                rows, weights = self.lists[term]
                add = np.multiply(weights, query[term], out=product[: len(weights)])
                if rows is None:
                    np.add(into, add, out=into)
                else:
                    into[rows] += add
        return out


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, by postings."""
    return Postings(vectors, queries).scores(queries).astype(np.int64)


def product_tile(query_ids, queries, ids, vectors, k):
    out, postings = [], Postings(vectors, queries)
    for first in range(0, len(queries), CHUNK):
        part = slice(first, first + CHUNK)
        score = postings.scores(queries[part])
        self_ = query_ids[part, None] == ids[None, :]
        score[self_] = np.iinfo(score.dtype).min
        n = min(k, score.shape[1])
        edge = np.partition(score, score.shape[1] - n, axis=1)[:, score.shape[1] - n][:, None]
        above = score > edge
        # Of those level with the last place the smallest ids: columns are in ascending order of id.
        level = score == edge
        chosen = (above | (level & (np.cumsum(level, axis=1) <= n - above.sum(axis=1, keepdims=True)))) & ~self_
        q, c = np.nonzero(chosen)
        out.append((q + first, c, score[q, c].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def top(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Columns query_id, rank (from 1), vec_id, score (long): the k rows with the highest inner product of
    floor(scale * component) with each query, itself left out; equal scores by the smaller id; all of them if there are
    fewer than k. Every row is a candidate.

    Vectors that are null, empty or hold a null or a number that is not finite take no part, nor do rows without an id;
    vectors of zeros do. Only vectors of one width are compared. Components and scores have to fit into a long. Rows
    that share an id leave each other out; if several ask, the id has one answer, of k candidate rows by their best score
    with any of its vectors. A repeated candidate counts as often as it comes. An empty table gives an empty result. Other columns are not used.
    """
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    given = vectors.where(tiles.usable(vector, True)).select(
        F.col(id).alias("id"), whole.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    return tiles.search(given, F.col("asks"), product_tile, k, "int64", True, "id", "vector")

"""Blocks of queries against blocks of candidates, for searches in which every candidate counts.

Rows are numbered and written, and both sides are dealt into blocks of bounded size by a hash of that number; a tile is
one pair of blocks. A candidate is copied once per block of queries and a query once per block of candidates, so what is
shuffled grows with rows times blocks of the other side, and no tile grows with the input, however often an id or a vector
is repeated. Each tile gives its best few per query id, and these are merged.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import written

#: Rows of a block: the work and memory of a task are set by these, not by the input.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 8192

#: A tile's work: query ids, query vectors, candidate ids (ascending), candidate vectors, k. It gives positions of
#: queries and candidates and their scores.
Tile = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def usable(vector: str, zero: bool) -> Column:
    """Whether a vector takes part: not null or empty, all components there and finite and, unless `zero`, not all 0."""
    column = F.col(vector)
    number = lambda x: x.cast("double")
    limit = F.lit(float("inf"))
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < limit))
    some = F.size(column) > 0
    return F.coalesce(some & fine & (F.lit(True) if zero else F.exists(column, lambda x: number(x) != 0)), F.lit(False))


def _best(k: int, found: pd.DataFrame) -> pd.DataFrame:
    """Of each query id the k best candidate rows, each by its best score, in order."""
    keys = (found["vec_id"].to_numpy(), -found["score"].to_numpy(), found["query_id"].to_numpy())
    found = found.iloc[np.lexsort((found["row"].to_numpy(), *keys))]
    if found.duplicated(["query_id", "row"]).any():
        found = found.drop_duplicates(["query_id", "row"])
    return found[found.groupby("query_id").cumcount() < k]


def _tile(work: Tile, kind: str, k: int, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
    whole = np.zeros(0, dtype=np.int64)
    empty = pd.DataFrame({"query_id": whole, "vec_id": whole, "row": whole, "score": np.zeros(0, dtype=kind)})
    if not len(queries) or not len(candidates):
        return empty
    out = [empty]
    candidates = candidates.sort_values("id", kind="stable")
    width = candidates["vector"].map(len)
    for size, ask in queries.groupby(queries["vector"].map(len)):
        near = candidates[width == size]
        if len(near):
            ids, vectors, row = near["id"].to_numpy(), np.stack(near["vector"].to_numpy()), near["row"].to_numpy()
            asked = ask["id"].to_numpy()
            q, c, score = work(asked, np.stack(ask["vector"].to_numpy()), ids, vectors, k)
            out.append(pd.DataFrame({"query_id": asked[q], "vec_id": ids[c], "row": row[c], "score": score.astype(kind)}))
    return _best(k, pd.concat(out))


def _merge(k: int, found: pd.DataFrame) -> pd.DataFrame:
    """The k best candidate rows of each query id, kept in a heap of k. Rows come by falling score within a tile; a
    candidate row that several vectors of the id found counts once, by its best score."""
    heaps: dict[int, list] = defaultdict(list)
    best = found.sort_values("score", ascending=False, kind="stable").drop_duplicates(["query_id", "row"])
    for query, vec, score in zip(best["query_id"].tolist(), best["vec_id"].tolist(), best["score"].tolist(), strict=True):
        heap = heaps[query]
        if len(heap) < k:
            heapq.heappush(heap, (score, -vec))
        else:
            heapq.heappushpop(heap, (score, -vec))
    rows = [
        (query, rank, -vec, score)
        for query, heap in heaps.items()
        for rank, (score, vec) in enumerate(sorted(heap, reverse=True), 1)
    ]
    return pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"])


def search(vectors: DataFrame, is_query: Column, work: Tile, k: int, kind: str, zero: bool, id: str, vector: str) -> DataFrame:
    """Columns query_id, rank, vec_id, score: the k best candidate rows of each query id, rows of that id left out, best
    first, equal scores by the smaller id. An id that asks with several vectors is answered once: a candidate row's score
    is its best with any of them."""
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id).isNotNull() & usable(vector, zero)).select(
        F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    blocks = max(1, -(-count["n"] // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-count["q"] // QUERY_BLOCK))
    block = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    once = rows.where("asks").groupBy("id", "vector").agg(F.min("row").alias("row"))
    asked = once.select("id", "vector", "row", F.lit(True).alias("asks"), block(query_blocks, 1).alias("qb"), every(blocks).alias("cb"))
    there = rows.select("id", "vector", "row", F.lit(False).alias("asks"), every(query_blocks).alias("qb"), block(blocks, 2).alias("cb"))
    # One partition for a few tiles, whatever the session's number of shuffle partitions.
    parts = max(1, min(blocks * query_blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    type_ = {"float64": "double", "int64": "long"}[kind]
    tile = partial(_tile, work, kind, k)
    found = (
        asked.unionByName(there)
        .repartition(parts, "qb", "cb")
        .groupBy("qb", "cb")
        .applyInPandas(lambda both: tile(both[both["asks"]], both[~both["asks"]]), f"query_id long, vec_id long, row long, score {type_}")
    )
    # Each tile gives k rows a query at most; queries are merged some at a time.
    merge = partial(_merge, k)
    return (
        found.withColumn("part", F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(16 * query_blocks)))
        .groupBy("part")
        .applyInPandas(lambda found: merge(found), f"query_id long, rank int, vec_id long, score {type_}")
    )

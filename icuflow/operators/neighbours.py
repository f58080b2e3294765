"""Exact k-nearest-neighbour classification: every pair of blocks (`nearest`), or pruned by cells (`nearest_in_cells`).

Queries and training rows are dealt into blocks; every (query block, training block) cell is
one task that returns only the k nearest training rows per query. The cells' candidates are
merged by an aggregate. A block is a bounded number of rows, so neither side is ever held
whole, and no pair list is written out.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from icuflow.session import stable

BLOCK_ROWS = 4096
_CHUNK = 64  # queries compared at once inside a cell


def _deal(df: DataFrame, id_column: str, blocks: int) -> DataFrame:
    return df.withColumn("_block", F.pmod(F.xxhash64(id_column), F.lit(blocks)).cast("int"))


def _nearest_of(id_column: str, vector: str, label: str, k: int):
    """The work of a cell: up to k of its training rows for each of its queries."""

    def cell(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({"qid": [], "nid": [], "squared": [], "label": []}).astype(
                {"qid": "int64", "nid": "int64", "squared": "float64", "label": "float64"}
            )
        points = np.stack(t[vector].to_numpy()).astype("float64")
        ids, tags = t[id_column].to_numpy(), t[label].to_numpy(dtype="float64")
        asked, qids = np.stack(q[vector].to_numpy()).astype("float64"), q[id_column].to_numpy()
        norms, own_norms = (points**2).sum(axis=1), (asked**2).sum(axis=1)
        largest = np.max(norms, where=np.isfinite(norms), initial=0.0)
        found = []
        for start in range(0, len(qids), _CHUNK):
            part, own = asked[start : start + _CHUNK], own_norms[start : start + _CHUNK, None]
            # A matrix product tells which rows may be among the k nearest, up to its rounding; all that it leaves open
            # (numbers that are not finite, too) are measured.
            near = own + norms - 2 * (part @ points.T)
            last = min(k, len(points)) - 1
            bound = np.partition(near, last, axis=1)[:, last, None] + 1e-11 * (own + largest)
            at, of = np.nonzero(~(near > bound))
            # Summed dimension by dimension, so a distance does not depend on the block shape.
            squared = np.zeros(len(at))
            for d in range(points.shape[1]):
                squared += (part[at, d] - points[of, d]) ** 2
            order = np.lexsort((ids[of], squared, at))
            at, of, squared = at[order], of[order], squared[order]
            first = np.arange(len(at)) - np.searchsorted(at, at) < k
            found.append(pd.DataFrame({"qid": qids[start + at[first]], "nid": ids[of[first]], "squared": squared[first], "label": tags[of[first]]}))
        return pd.concat(found, ignore_index=True)

    return cell


def nearest(
    queries: DataFrame,
    train: DataFrame,
    id_column: str,
    vector: str,
    label: str,
    k: int = 3,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query id, neighbour id, distance, label, place) of the k nearest, ties by neighbour id."""
    q_blocks = max(1, ceil(queries.count() / block_rows))
    t_blocks = max(1, ceil(train.count() / block_rows))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = _deal(queries.select(id_column, vector), id_column, q_blocks).withColumnRenamed("_block", "qb")
    left = left.withColumn("tb", every(t_blocks))
    right = _deal(train.select(id_column, vector, label), id_column, t_blocks).withColumnRenamed("_block", "tb")
    right = right.withColumn("qb", every(q_blocks))

    cell = _nearest_of(id_column, vector, label, k)
    candidates = (
        left.groupBy("qb", "tb")
        .cogroup(right.groupBy("qb", "tb"))
        .applyInPandas(cell, "qid long, nid long, squared double, label double")
    )
    # Spark cuts each task's output to k rows per query before the merge shuffle.
    place = F.row_number().over(Window.partitionBy("qid").orderBy("squared", "nid"))
    return (
        candidates.withColumn("place", place)
        .filter(F.col("place") <= k)
        .select(F.col("qid").alias(id_column), F.col("nid").alias("neighbour"), F.sqrt("squared").alias("distance"), "label", "place")
    )


def _cells(pivots: np.ndarray):
    """A function of a column of vectors: the nearest pivot and the distance to it."""

    @F.pandas_udf("struct<cell: int, away: double>")
    def own(values: pd.Series) -> pd.DataFrame:
        points = np.stack(values.to_numpy()).astype("float64") if len(values) else np.zeros((0, pivots.shape[1]))
        gap = distances(points, pivots)
        cell = gap.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "away": gap[np.arange(len(points)), cell]})

    return own


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances, summed dimension by dimension: they do not depend on which rows stand together."""
    gap = np.zeros((len(points), len(others)))
    for d in range(others.shape[1]):
        gap += (points[:, d, None] - others[None, :, d]) ** 2
    return np.sqrt(gap)


def _visits(pivots: np.ndarray, counts: np.ndarray, radius: np.ndarray, k: int, first: bool):
    """For each query the cells it visits: first those nearest that hold k rows, then the others that its k-th distance so
    far leaves open."""

    @F.pandas_udf("array<int>")
    def cells(values: pd.Series, reach: pd.Series) -> pd.Series:
        points = np.stack(values.to_numpy()).astype("float64") if len(values) else np.zeros((0, pivots.shape[1]))
        gap = distances(points, pivots)
        order = np.argsort(gap, axis=1, kind="stable")
        held = np.cumsum(counts[order], axis=1)
        home = np.zeros(gap.shape, dtype=bool)
        np.put_along_axis(home, order, (held - counts[order]) < k, axis=1)
        home &= counts > 0
        if first:
            return pd.Series([np.flatnonzero(h).astype("int32") for h in home])
        # A row of a cell is no nearer than the pivot less the cell's radius, nor than half of what its pivot is farther
        # away than the nearest pivot.
        low = np.maximum(gap - radius, (gap - gap.min(axis=1, keepdims=True)) / 2)
        far = reach.to_numpy()[:, None]
        open_ = ~home & (counts > 0) & (low <= far * (1 + 1e-9) + 1e-12)
        return pd.Series([np.flatnonzero(o).astype("int32") for o in open_])

    return cells


def nearest_in_cells(
    queries: DataFrame,
    train: DataFrame,
    id_column: str,
    vector: str,
    label: str,
    k: int = 3,
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The columns of `nearest`, and (query id, visits): how many cells of training rows each query met.

    Training rows belong to the cell of their nearest pivot (rows of the smallest hashes, some hundred at most). A query
    first meets the nearest cells that hold k rows; its k-th distance there and the triangle inequality rule out most
    others, and it meets the rest. A cell is dealt into parts of `block_rows` rows, so neither a cell that holds a third of
    all rows nor a query that meets every cell is more than its share of tasks.
    """
    train = train.where(F.col(vector).isNotNull())
    n = train.count()
    number = pivots or min(512, max(1, int(n**0.5 / 2)))
    chosen = train.select(id_column, vector).orderBy(F.xxhash64(id_column), id_column).limit(number).collect()
    if not chosen:
        none = queries.sparkSession.createDataFrame([], f"{id_column} long, neighbour long, distance double, label double, place int")
        return none, queries.select(id_column, F.lit(0).alias("visits"))
    points = np.array([r[vector] for r in chosen], dtype="float64")
    placed = stable(train.withColumn("_at", _cells(points)(F.col(vector))).select(id_column, vector, label, "_at.*"))
    counts, radius = np.zeros(len(points), dtype="int64"), np.zeros(len(points))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect():
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    parts = F.array(*[F.lit(int(-(-c // block_rows)) or 1) for c in counts])
    part_of = F.get(parts, F.col("cell"))
    right = placed.withColumn("part", F.pmod(F.xxhash64(id_column, F.lit(5)), part_of).cast("int"))
    asked = stable(queries.select(id_column, vector).where(F.col(vector).isNotNull()))

    def met(asking: DataFrame) -> DataFrame:
        """Up to k rows of each visited part."""
        left = asking.select(id_column, vector, F.explode("cells").alias("cell"))
        left = left.select("*", F.explode(F.sequence(F.lit(0), part_of - 1)).alias("part"))
        blocks = F.pmod(F.xxhash64(id_column, F.lit(6)), F.lit(max(1, ceil(total / block_rows)))).cast("int")
        left = left.select(id_column, vector, F.lit(None).cast("double").alias(label), F.lit(True).alias("_asks"), "cell", "part", blocks.alias("qb"))
        wanted = left.select("cell", "part", "qb").distinct()
        tag = F.col(label).cast("double").alias(label)
        sides = right.join(wanted, ["cell", "part"]).select(id_column, vector, tag, F.lit(False).alias("_asks"), "cell", "part", "qb")
        work = _nearest_of(id_column, vector, label, k)
        both = left.unionByName(sides).groupBy("cell", "part", "qb")
        return both.applyInPandas(lambda rows: work(rows[rows["_asks"]], rows[~rows["_asks"]]), "qid long, nid long, squared double, label double")

    total = asked.count()
    near = stable(met(asked.withColumn("cells", _visits(points, counts, radius, k, True)(F.col(vector), F.lit(0.0)))))
    best = Window.partitionBy("qid").orderBy("squared", "nid")
    reach = near.withColumn("place", F.row_number().over(best)).where(F.col("place") == k).select(F.col("qid").alias(id_column), F.sqrt("squared").alias("_reach"))
    bounded = asked.join(reach, id_column, "left").withColumn("_reach", F.coalesce("_reach", F.lit(float("inf"))))
    open_ = stable(bounded.withColumn("cells", _visits(points, counts, radius, k, False)(F.col(vector), F.col("_reach"))))
    every = near.unionByName(met(open_))
    found = (
        every.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k)
        .select(F.col("qid").alias(id_column), F.col("nid").alias("neighbour"), F.sqrt("squared").alias("distance"), "label", "place")
    )
    home = asked.select(id_column, F.size(_visits(points, counts, radius, k, True)(F.col(vector), F.lit(0.0))).alias("_home"))
    visits = open_.join(home, id_column).select(id_column, (F.size("cells") + F.col("_home")).alias("visits"))
    return found, visits


def knn_classify(queries, train, id_column, vector, label, k: int = 3) -> DataFrame:
    """Majority label of the k nearest; a split vote goes to the smallest label."""
    found, _ = nearest_in_cells(queries, train, id_column, vector, label, k)
    votes = found.groupBy(id_column, "label").agg(F.count(F.lit(1)).alias("_votes"))
    return votes.groupBy(id_column).agg(
        F.max_by("label", F.struct("_votes", -F.col("label"))).cast("int").alias("prediction")
    )

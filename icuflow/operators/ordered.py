"""Order-dependent operators that do not put all rows of one key into one task.

A plain window sorts every row of a key in a single task. Here the rows are range-partitioned
by (keys, order), at every size, so a hot key is cut into many pieces, and the little that
crosses a border is handed from piece to piece:

* running totals and last-known values: one carry per piece;
* lags, leads and row frames: a halo of the few rows next to the border;
* ranks: running totals over the distinct (key, order) values.

Everything handed over is bounded by the number of pieces, never by the data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from icuflow.session import stable

PIECE, ROW, POSITION = "_piece", "_row", "_position"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _number(df: DataFrame, by: Sequence, pieces: int | None) -> DataFrame:
    """Rows sorted by `by` in range partitions, with their piece and a number rising within it."""
    count = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stable(
        df.repartitionByRange(count, *by)
        .sortWithinPartitions(*by)
        .withColumn(ROW, F.monotonically_increasing_id())
    ).withColumn(PIECE, F.shiftright(ROW, _ROW_BITS))


class Layout(NamedTuple):
    """Rows in total order: `rows` has `_piece` and the 0-based global `_position`."""

    rows: DataFrame
    pieces: DataFrame


def lay_out(df: DataFrame, order: Sequence, keys: Sequence[str] = (), pieces: int | None = None) -> Layout:
    """Sort by (keys, order) in range partitions and give each row its global position."""
    numbered = _number(df, [*keys, *order], pieces)
    earlier = Window.orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        numbered.groupBy(PIECE)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    )
    in_piece = F.col(ROW).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = (
        numbered.join(F.broadcast(sizes.select(PIECE, "_start")), PIECE)
        .withColumn(POSITION, F.col("_start") + in_piece)
        .drop("_start", ROW)
    )
    return Layout(rows, sizes)


def positions(df: DataFrame, order: Sequence, out: str = "position", pieces: int | None = None) -> DataFrame:
    """Exact 0-based position of each row in a total order over the whole frame."""
    rows, _ = lay_out(df, order, pieces=pieces)
    return rows.withColumnRenamed(POSITION, out).drop(PIECE)


def running(
    df: DataFrame,
    order: Sequence,
    keys: Sequence[str] = (),
    totals: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Running sums (`totals`) and last non-null values (`latest`) per key, current row included.

    `order` must be total within the keys. `pieces` sets the number of range partitions.
    """
    totals, latest = dict(totals or {}), dict(latest or {})

    def columns(window: WindowSpec) -> dict[str, Column]:
        so_far = window.rowsBetween(Window.unboundedPreceding, 0)
        return {
            **{n: F.sum(F.coalesce(c, F.lit(0))).over(so_far) for n, c in totals.items()},
            **{n: F.last(c, ignorenulls=True).over(so_far) for n, c in latest.items()},
        }

    key = F.struct(*keys) if keys else F.lit(0)
    rows = _number(df, [*keys, *order], pieces).withColumn("_key", key)
    partial = rows.withColumns(columns(Window.partitionBy(PIECE, *keys).orderBy(ROW)))

    # One row per piece: its first and last key, and what its last key has come to.
    edges = partial.groupBy(PIECE).agg(
        F.min_by("_key", ROW).alias("_first"),
        F.max_by("_key", ROW).alias("_last"),
        *[F.max_by(n, ROW).alias(f"_end_{n}") for n in (*totals, *latest)],
    )
    same_key = Window.partitionBy("_last").orderBy(PIECE).rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumns(
        {
            **{f"_sum_{n}": F.sum(f"_end_{n}").over(same_key) for n in totals},
            **{f"_sum_{n}": F.last(f"_end_{n}", ignorenulls=True).over(same_key) for n in latest},
        }
    )
    by_piece = Window.orderBy(PIECE)
    goes_on = F.lag("_last").over(by_piece).eqNullSafe(F.col("_first"))
    carries = edges.select(
        PIECE,
        "_first",
        *[
            F.when(goes_on, F.lag(f"_sum_{n}").over(by_piece)).alias(f"_carry_{n}")
            for n in (*totals, *latest)
        ],
    )

    joined = partial.join(F.broadcast(carries), PIECE)
    carried = {
        n: F.when(F.col("_key").eqNullSafe(F.col("_first")), F.col(f"_carry_{n}"))
        for n in (*totals, *latest)
    }
    return joined.withColumns(
        {
            **{n: F.col(n) + F.coalesce(carried[n], F.lit(0)) for n in totals},
            **{n: F.coalesce(F.col(n), carried[n]) for n in latest},
        }
    ).select(*df.columns, *totals, *latest)


def over_neighbours(
    df: DataFrame,
    order: Sequence,
    make: Callable[[WindowSpec], Mapping[str, Column]],
    keys: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    pieces: int | None = None,
) -> DataFrame:
    """Window columns that look at most `before` rows back and `after` rows ahead.

    `order` must be total within the keys. Each piece gets copies of the rows just outside its borders, the window runs per piece, and the copies
    are dropped again.
    """
    rows, sizes = lay_out(df, order, keys, pieces)
    end = F.col("_start") + F.col("_size")
    spans = []
    if before:
        spans.append(F.sequence(F.col("_start") - before, F.col("_start") - 1))
    if after:
        spans.append(F.sequence(end, end + after - 1))
    if not spans:
        raise ValueError("before or after must be positive")
    wanted = sizes.select(F.col(PIECE).alias("_to"), F.explode(F.concat(*spans)).alias(POSITION))
    halo = (
        rows.join(F.broadcast(wanted), POSITION)
        .withColumn(PIECE, F.col("_to"))
        .drop("_to")
        .withColumn("_copy", F.lit(True))
    )
    window = Window.partitionBy(PIECE, *keys).orderBy(POSITION)
    made = make(window)
    return (
        rows.withColumn("_copy", F.lit(False))
        .unionByName(halo)
        .withColumns(dict(made))
        .filter(~F.col("_copy"))
        .select(*df.columns, *made)
    )


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    out: str = "rank",
    dense: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """RANK / DENSE_RANK of each row in its key; ties share a rank.

    Ranks are taken over the distinct (key, order) values with their row counts, so a tie of any size is one row in the ordered part.
    """
    distinct = df.groupBy(*keys, *by).agg(F.count(F.lit(1)).alias("_n"))
    step = F.lit(1) if dense else F.col("_n")
    ranked = running(distinct, by, keys, totals={"_upto": step}, pieces=pieces).withColumn(
        out, (F.col("_upto") - step + 1).cast("int")
    )
    return null_safe_join(df, ranked.select(*keys, *by, out), [*keys, *by])


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet each other; key columns come from the left."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = None
    for c in on:
        term = left[c].eqNullSafe(renamed[f"_r_{c}"])
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def bin_digits(spark: SparkSession) -> int:
    """Hex digits that make 4,096 bins, or 16 for each shuffle partition if that is more."""
    digits = 3
    while 16**digits < 16 * int(spark.conf.get("spark.sql.shuffle.partitions")):
        digits += 1
    return digits


def hashed_position(df: DataFrame, key: str, strata: Sequence[str] = (), out: str = "position", digits: int | None = None) -> DataFrame:
    """1-based row number in md5(key) order, per stratum.

    md5 spreads the rows evenly, so its first hex digits cut the order into 16**digits even
    bins without sampling: rows are numbered within a bin and shifted by the bins before it.
    Their number follows the session's shuffle partitions, see `bin_digits`; the result does not.
    `key` must be unique within a stratum for the result to be reproducible.
    """
    digits = bin_digits(df.sparkSession) if digits is None else digits
    binned = df.withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn(
        "_bin", F.substring("_hash", 1, digits)
    )
    sizes = binned.groupBy(*strata, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*strata).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *strata, "_bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    in_bin = Window.partitionBy(*strata, "_bin").orderBy("_hash", key)
    numbered = binned.withColumn("_in_bin", F.row_number().over(in_bin))
    return (
        null_safe_join(numbered, starts, [*strata, "_bin"])
        .withColumn(out, F.col("_before") + F.col("_in_bin"))
        .drop("_hash", "_bin", "_in_bin", "_before")
    )


def latest_before(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    cutoff: str,
    time: str,
    out: str,
    inclusive: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """As-of join: for each left row, the greatest right `time` before its `cutoff`, per key.

    Both sides are merged into one ordered stream and the last seen time is carried on, so
    no left-right pairs are made and a hot key is cut like any other.
    """
    first, second = (1, 0) if inclusive else (0, 1)
    stream = left.withColumn("_at", F.col(cutoff)).withColumn("_side", F.lit(first)).withColumn(
        "_seen", F.lit(None).cast(right.schema[time].dataType)
    ).unionByName(
        right.select(*keys, F.col(time).alias("_at"), F.col(time).alias("_seen"))
        .filter(F.col("_at").isNotNull())
        .withColumn("_side", F.lit(second)),
        allowMissingColumns=True,
    )
    # Rows equal in (time, side) may come in any order: the carried value is the same.
    carried = running(stream, ["_at", "_side"], keys, latest={out: F.col("_seen")}, pieces=pieces)
    return carried.filter(F.col("_side") == first).select(*left.columns, out)

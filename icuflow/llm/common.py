"""Helpers shared by the corpus operators: task-side caches, batch size, written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icuflow.session import shared_dir

#: Rows that travel to a Python worker at once. Texts are of any length, so batches are kept short.
BATCH_ROWS = 256
#: Bytes of them: a few very long texts are a batch of their own.
BATCH_BYTES = 16 << 20

#: Bytes that a task holds back while it writes an intermediate.
WRITE_BYTES = 32 << 20

_KEPT: dict[str, Any] = {}


def kept(key: str, build: Callable[[], Any]) -> Any:
    """One object per Python worker and key, built on first use and reused by the worker's later tasks."""
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def small_batches(spark: SparkSession) -> None:
    """Hold the Arrow batches of this session to BATCH_ROWS rows and BATCH_BYTES bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, rows_a_file: int = 0) -> DataFrame:
    """Write `df` as Parquet below the shared checkpoint folder and go on from the files, of so many rows at most if given
    (Spark reads thousands of rows at once, which is too much where each holds megabytes).

    Lineage ends there, a lost executor re-reads the files, and columns and filters still reach the scan.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_a_file).option("parquet.block.size", WRITE_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Any:
    """The text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop input columns whose names (any case) an operator is about to give to its own results."""
    taken = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in taken]
    return df.drop(*clash) if clash else df


#: Keys that more than this part of all rows hold are looked up by broadcast: there are fewer of them than its inverse,
#: whatever the input, and the rows of any other key fit into a task.
HOT_PART = 1 / 1000


def looked_up(rows: DataFrame, table: DataFrame, key: str, often: str, count: int, how: str = "left", part: float = HOT_PART) -> DataFrame:
    """`rows` (with null keys only if `how` is left) joined with `table`, which has one row per key and in `often` at least
    the number of rows that hold it, of `count` in all. No key's rows meet in one task: hot keys are broadcast, the others
    shuffled."""
    names = [c for c in table.columns if c != key]
    hot = F.col(often) > F.lit(count * part)
    few = F.broadcast(table.where(hot).select(key, *[F.col(c).alias(f"_hot_{c}") for c in names]))
    both = rows.join(few, key, "left")
    met = both.where(F.col(f"_hot_{often}").isNotNull()).select(*rows.columns, *[F.col(f"_hot_{c}").alias(c) for c in names])
    rest = both.where(F.col(f"_hot_{often}").isNull()).select(rows.columns).join(table.where(~hot), key, how)
    return met.unionByName(rest.select(*rows.columns, *names))


#: What names a row where documents are joined with something derived from them: rows equal in both are equal in all
#: that is derived, so a repeated row gets the same result.
ROW = ("_llm_doc", "_llm_row")


def with_row_key(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add the columns ROW: the id (null as the smallest number) and a hash of the text."""
    return df.withColumn(ROW[0], F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)))).withColumn(
        ROW[1], F.xxhash64(text_of(text))
    )

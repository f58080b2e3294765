"""Exact duplicates by a persistent index of text digests, kept in buckets and sorted by digest.

The index is two tables on shared storage, both bucketed and sorted by digest: `seen` has a row for each digest and batch
(its first row there and how often it came), `kept` a row for each digest with the row that stays. A batch is shrunk to
its digests by partial aggregation, appended to `seen`, and compared with `kept` by a sort-merge anti-join, in which
neither side is shuffled; what is new is appended to `kept`. Texts are read once, and never shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icuflow.llm.common import HOT_PART, looked_up, text_of, written
from icuflow.session import shared_dir


def normal(text: str = "text") -> Column:
    """The text with every run of white space as one space; null is empty. Single spaces are left alone, which is quicker."""
    return F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Columns source, row, id and digest, one row for each of `docs`, written so that the numbers in `row` hold."""
    own = docs.select(
        F.lit(uuid.uuid4().hex).alias("source"),
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("id"),
        F.unhex(F.sha2(normal(text), 256)).alias("digest"),
    )
    return written(own)


class DigestIndex:
    """The index at `path` (a new folder below the shared one if not given). An index that exists is opened again with the
    number of buckets that it was made with; `buckets` is the session's number of shuffle partitions if not given."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None) -> None:
        path = path or f"{shared_dir(spark).rstrip('/')}/llm-index-{uuid.uuid4().hex}"
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark, name = spark, f"llm_{uuid.uuid4().hex}"
        self._seen, self._kept = f"{name}_seen", f"{name}_kept"
        row = "digest BINARY, no_id BOOLEAN, id BIGINT, source STRING, row BIGINT"
        for table, folder, columns in ((self._seen, "seen", f"{row}, n BIGINT, batch STRING"), (self._kept, "kept", row)):
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                f"INTO {buckets} BUCKETS LOCATION '{path}/{folder}'"
            )

    @property
    def seen(self) -> DataFrame:
        return self.spark.table(self._seen)

    @property
    def kept(self) -> DataFrame:
        return self.spark.table(self._kept)

    def append(self, rows: DataFrame) -> None:
        """Take in a batch of `digests`. Texts that the index has are counted; of the others the row with the smallest id
        stays (rows without an id come last), of rows that share it one."""
        batch = uuid.uuid4().hex
        first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "source", "row")).alias("first")
        groups = rows.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n"))
        groups.select("digest", "first.*", "n", F.lit(batch).alias("batch")).write.insertInto(self._seen)
        new = self.seen.where(F.col("batch") == batch).drop("n", "batch")
        new.join(self.kept.select("digest").hint("merge"), "digest", "left_anti").write.insertInto(self._kept)

    def repeated(self) -> DataFrame:
        """The digests that came more than once: the row that stays and how often they came."""
        often = self.seen.groupBy("digest").agg(F.sum("n").alias("group_size")).where(F.col("group_size") > 1)
        own = self.kept.select("digest", F.col("id").alias("keep_id"), F.col("source").alias("_source"), F.col("row").alias("_row"))
        return own.join(often.hint("merge"), "digest")

    def resolve(self, rows: DataFrame, hot_part: float = HOT_PART) -> DataFrame:
        """`rows`, all of them taken in before, with keep_id, group_size and kept."""
        # The index may have seen a text more often than it is in `rows`, but then in as many rows as it counts.
        count = self.seen.agg(F.sum("n").alias("n")).first()["n"] or 0
        found = looked_up(rows, written(self.repeated()), "digest", "group_size", count, part=hot_part)
        alone = F.col("group_size").isNull()
        return found.select(
            *rows.columns,
            F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).alias("group_size"),
            (alone | ((F.col("source") == F.col("_source")) & (F.col("row") == F.col("_row")))).alias("kept"),
        )


def dedupe(docs: DataFrame, index: DigestIndex | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id (of the row that stays), group_size, kept, digest.

    Texts are equal when they are after each run of white space became one space; null is empty. Of equal texts the
    smallest id stays; rows without an id stay only where no row with one has their text, and of repeated rows one stays.
    With an `index` its texts count too: what it has stays there, and group_size counts what it has seen. An empty table
    gives an empty one. Other columns are not used.

    `docs` goes into the index in two batches, up to the median id and beyond it, so that first come is smallest id.
    """
    index = index or DigestIndex(docs.sparkSession)
    rows = digests(docs, text, doc_id)
    middle = rows.agg(F.percentile_approx("id", 0.5).alias("m")).first()["m"]
    early = F.coalesce(F.col("id") <= F.lit(middle).cast("long"), F.lit(False))
    for batch in (rows.where(early), rows.where(~early)):
        index.append(batch)
    return index.resolve(rows).select(F.col("id").alias(doc_id), "keep_id", "group_size", "kept", "digest")

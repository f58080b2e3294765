"""Reading and writing tables, running SQL files, building stored views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from icuflow.sources.schema import CLINICAL


class Tables:
    """Parquet tables of one folder as attributes: `Tables(spark, dir).events`.

    Nothing is read until an action; columns and filters are pushed to the scan.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def register(self, *names: str) -> None:
        """Temporary views, so SQL text can name the tables."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)


def clinical_tables(spark: SparkSession, folder: str, form: str = "parquet") -> dict[str, DataFrame]:
    """The clinical tables of a folder with their declared schemas."""
    return {name: spark.read.schema(schema).format(form).load(f"{folder}/{name}") for name, schema in CLINICAL.items()}


def jdbc_table(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], parts: int, **options) -> DataFrame:
    """A database table read in `parts` key ranges at once."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts, **options)
        .load()
    )


def query_file(spark: SparkSession, path: str | Path, **args) -> DataFrame:
    """Run the SQL text of a file; `:name` markers are bound, never spliced."""
    return spark.sql(Path(path).read_text(), args=args)


def query_text(spark: SparkSession, text: str, **args) -> DataFrame:
    return spark.sql(text, args=args)


def use_schema(spark: SparkSession, schema: str) -> None:
    """Resolve unqualified table names in this schema."""
    spark.catalog.setCurrentDatabase(schema)


def write_csv(df: DataFrame, folder: str, index: str | None = None) -> None:
    """CSV with a header, `index` as first column if given; one file per partition."""
    ordered = [index, *[c for c in df.columns if c != index]] if index else df.columns
    df.select(*ordered).write.mode("overwrite").option("header", True).csv(folder)


def read_csv(spark: SparkSession, folder: str, schema) -> DataFrame:
    """CSV with a header under a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(folder)


def materialize(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Replace a stored view by its current result and read it back."""
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Stored view bucketed and sorted by its join key, so later joins on it do not shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def build_views(views: Mapping[str, Callable[[], DataFrame]], folder: str) -> dict[str, DataFrame]:
    """Build stored views in the given order; returns the re-read frames."""
    return {name: materialize(make(), folder, name) for name, make in views.items()}

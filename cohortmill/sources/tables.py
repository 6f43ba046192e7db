"""Parquet tables and their layout, CSV output, warehouse reads."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.schemas import BRONZE

BUCKET_ROWS = 500_000
BRONZE_PARTITIONS = ["ingest_date", "overall_status"]
# Takes about half the room of the default, in about the same time.
CODEC = {"compression": "zstd"}


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, BRONZE).select(*BRONZE.names)


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema`, in its types and order."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def _on_disk(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _on_disk(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it."""
    files, place = _on_disk(spark, path)
    files.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder that holds few, in order; none where there is no folder."""
    files, place = _on_disk(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    files, place = _on_disk(spark, path)
    files.create(place).close()


def rename(spark: SparkSession, old: str, new: str) -> None:
    files, place = _on_disk(spark, old)
    if not files.rename(place, _on_disk(spark, new)[1]):
        raise OSError(f"{old} can't be renamed to {new}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: list[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A warehouse table, one task per predicate; the predicates must part its
    rows (for instance ranges of a date column). Needs the warehouse's JDBC
    driver on the class path."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, replace: str = "all"
) -> None:
    """Write a Parquet table; `replace="touched"` overwrites only the partitions
    that occur in `df`.

    Rebalancing puts a partition's rows together in few files, splits partitions
    that are too big for one task, and merges small ones.
    """
    if replace not in ("all", "touched"):
        raise ValueError(f"replace must be 'all' or 'touched', not {replace!r}")
    partition_by = partition_by or []
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").options(**CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace == "touched":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_rows(df: DataFrame, path: str, partition_by: list[str] | None = None, replace: str = "all") -> None:
    """Write a Parquet table from the tasks that have its rows, without a shuffle.

    For rows that come from files or out of a shuffle: they lie in tasks of fair size already, and those of a
    partition together if they did so before.
    """
    writer = df.write.mode("overwrite").options(**CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace == "touched":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_bronze(bronze: DataFrame, path: str) -> None:
    """Land a batch of bronze rows in the layout of the stream's sink, in a folder of their own.

    Readers of a stream's folder follow the log of its sink and would not see
    other files, so a folder with such a log is refused.
    """
    if exists(bronze.sparkSession, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a stream; land batches in another folder")
    (
        bronze.hint("rebalance", *BRONZE_PARTITIONS)
        .write.mode("append")
        .partitionBy(*BRONZE_PARTITIONS)
        .parquet(path)
    )


def buckets_for(*rows: DataFrame, least: int = 256) -> int:
    """How many buckets keep each to about `BUCKET_ROWS` rows of the largest of these stored tables.

    A bucket is sorted by one task, so their number has to grow with the tables. Twice as many each time, so that
    tables of like size get the same.
    """
    most, buckets = max(df.count() for df in rows), least
    while buckets * BUCKET_ROWS < most:
        buckets *= 2
    return buckets


def write_clustered(
    df: DataFrame,
    table: str,
    path: str | None = None,
    key: str = "nct_id",
    sort: str = "completion_date",
    buckets: int = 256,
) -> None:
    """A table bucketed by `key` and sorted by `sort` within a bucket, so that
    joins and groupings on the key need no shuffle. Rows are brought to their
    buckets first: one file per bucket, not one per bucket and task."""
    writer = (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(sort)
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _files_by_day(spark: SparkSession, path: str) -> Counter[dt.date | None]:
    """How many files bronze lists for each ingest day; those without a day are under None.

    Counted by Spark from the files' places alone: the driver gets a row for each day.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    day = F.regexp_extract("path", r"/ingest_date=(\d{4}-\d\d-\d\d)/", 1).alias("day")
    return Counter({r.day and dt.date.fromisoformat(r.day) or None: r.n for r in files.groupBy(day).agg(F.count("*").alias("n")).collect()})


def compact_days(
    spark: SparkSession, source: str, target: str, first: dt.date, last: dt.date
) -> dict[dt.date, int]:
    """Rewrite the many small files of the bronze days `first` to `last` into `target`.

    Only those days' folders are read; the result replaces those days in
    `target` and nothing else. A status that holds most of a day is split over
    several files. Gives the days compacted and how many files each had in `source`.
    """
    day = F.col("ingest_date")
    landed = read_bronze(spark, source)
    files = _files_by_day(spark, source)
    write_table(landed.filter(day.between(F.lit(first), F.lit(last))), target, BRONZE_PARTITIONS, replace="touched")
    return {day: n for day, n in files.items() if day is not None and first <= day <= last}


def read_landed(spark: SparkSession, source: str, target: str, compacted: dict[dt.date, int]) -> DataFrame:
    """Bronze, whose `compacted` days, with the files each had then, lie in `target` too.

    Each day is read from one of the folders, and a filter on days prunes both. A day in
    which more files have landed since is read from `source` until it is compacted again.
    """
    landed = read_bronze(spark, source)
    files = _files_by_day(spark, source)
    days = sorted(day for day, n in compacted.items() if files[day] == n)
    if not days:
        return landed
    day = F.col("ingest_date")
    done = read_bronze(spark, target).filter(day.isin(days))
    if files.keys() <= set(days):
        return done
    return done.unionByName(landed.filter(day.isNull() | ~day.isin(days)))


def day_arrived(bronze: DataFrame, day: dt.date) -> DataFrame:
    """One row: does bronze hold anything for the day? Reads at most one row of
    the day's folders."""
    return (
        bronze.filter(F.col("ingest_date") == F.lit(day))
        .limit(1)
        .agg((F.count("*") > 0).alias("arrived"))
        .select(F.lit(day).alias("ingest_date"), "arrived")
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)

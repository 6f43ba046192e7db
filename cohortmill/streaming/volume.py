"""Rows per day of event time, counted on the stream.

Two streams read the same rows. One counts by day, with a watermark, in append mode: a day is given once, when
the watermark has passed its end, and its state is dropped; rows of it that come later are left out. The
other has no state: it adds what each micro-batch brings for each day to a small table. For a closed day the
difference of the two is its late rows; days that are still open are counted by the second alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortmill.operators import monitor
from cohortmill.sources import keyed, tables
from cohortmill.streaming.bronze import DEFAULT_INTERVAL, triggered
from cohortmill.streaming.silver import checkpoint_id

DAILY = T.StructType([T.StructField("day", T.DateType()), T.StructField("n", T.LongType())])
PARTS = 4


def start_closed_days(
    rows: DataFrame, time: str, path: str, delay: str = "1 day", once: bool = False, interval: str = DEFAULT_INTERVAL
) -> StreamingQuery:
    """Days whose end is more than `delay` before the newest row, with the rows that came in time. Days are UTC's."""
    at = rows.select(F.col(time).cast("timestamp").alias("at")).withWatermark("at", delay)
    counts = at.groupBy(F.window("at", "1 day")).agg(F.count("*").alias("n"))
    writer = (
        counts.select(F.col("window.start").cast("date").alias("day"), "n")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/closed")
        .option("checkpointLocation", f"{path}/closed_checkpoint")
    )
    return triggered(writer, once, interval).start()


def start_arrivals(
    rows: DataFrame, time: str, path: str, once: bool = False, interval: str = DEFAULT_INTERVAL
) -> StreamingQuery:
    """All rows by day, whenever they come; each micro-batch is added once."""
    checkpoint = f"{path}/arrivals_checkpoint"

    def summed(current: DataFrame, given: DataFrame) -> DataFrame:
        return current.unionByName(given).groupBy("day").agg(F.sum("n").alias("n"))

    def add(batch: DataFrame, batch_id: int) -> None:
        name = f"{checkpoint_id(batch.sparkSession, checkpoint)}-{batch_id}"
        counts = batch.groupBy("day").agg(F.count("*").alias("n"))
        keyed.update(tables.as_schema(counts, DAILY), f"{path}/arrivals", name, ["day"], summed, PARTS)

    days = rows.select(F.col(time).cast("timestamp").cast("date").alias("day")).filter("day IS NOT NULL")
    writer = days.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return triggered(writer, once, interval).start()


def start_daily_volume(rows: DataFrame, time: str, path: str, delay: str = "1 day", **trigger) -> list[StreamingQuery]:
    """Both streams."""
    return [start_closed_days(rows, time, path, delay, **trigger), start_arrivals(rows, time, path, **trigger)]


def daily_volume(spark: SparkSession, path: str, ended: bool = False) -> DataFrame:
    """(day, n, late, is_closed) of each day, without gaps.

    `n` are the rows in time, all there are so far of an open day. At the end of the input (`ended`) all days are closed.
    """
    none = spark.createDataFrame([], DAILY)
    closed = tables.read_table(spark, f"{path}/closed", DAILY) if tables.exists(spark, f"{path}/closed") else none
    arrived = keyed.read(spark, f"{path}/arrivals", DAILY, ["day"])
    days = monitor.without_gaps(arrived)
    in_time = closed.select("day", F.col("n").alias("closed"))
    # A day without rows is closed if a later one is. The window's rows are days.
    known, zero = F.col("closed").isNotNull(), F.lit(0).cast("bigint")
    last = F.max(F.when(known, F.col("day"))).over(Window.partitionBy())
    return days.join(in_time, "day", "left").select(
        "day",
        F.coalesce("closed", "n").alias("n"),
        F.when(known, F.greatest(F.col("n") - F.col("closed"), zero)).otherwise(zero).alias("late"),
        (F.lit(ended) | F.coalesce(F.col("day") <= last, F.lit(False))).alias("is_closed"),
    )

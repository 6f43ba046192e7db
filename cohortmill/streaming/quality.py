"""Quality of a running stream: the checks of a suite, counted by Spark while each micro-batch passes.

`observe` adds the suite's counts to the stream itself, so no row is read twice. Spark reports them with the
progress of each micro-batch; a listener appends them, with the batch's number, to a table. As counts of
batches add up, the suite's result over any batches follows from that table alone. Checks that need a pass of
their own (uniqueness, references) can't be counted in passing and are refused.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cohortmill.operators import checks as C
from cohortmill.sources import tables

BATCH = ["query_id", "batch_id", "checked_at"]


class SuiteWatch(StreamingQueryListener):
    """A suite over a stream; its counts are kept at `path`, a row for each micro-batch.

    Use: `watch = SuiteWatch(spark, suite, path)`, start the stream of `watch.over(rows)`, and when it has
    ended `watch.finish(query)`. One watch is for one stream.
    """

    def __init__(self, spark: SparkSession, suite: Iterable[C.Check], path: str, name: str = "suite"):
        self.spark, self.suite, self.path, self.name = spark, list(suite), path, name
        self.schema: T.StructType | None = None
        self.columns: list[str] = []
        self.errors: list[Exception] = []
        self._ended: set[str] = set()
        self._news = threading.Condition()
        odd = [c.kind for c in self.suite if c.kind in (C.UNIQUE, C.REFERENCE)]
        if odd:
            raise ValueError(f"not to be counted in passing: {', '.join(odd)}")

    def over(self, rows: DataFrame) -> DataFrame:
        """The same rows, counted as they pass."""
        counts = C.measures(rows, self.suite)
        self.columns = rows.columns
        kinds = [T.StructField(name, T.StringType()) for name in BATCH[:1]]
        kinds += [T.StructField("batch_id", T.LongType()), T.StructField("checked_at", T.TimestampType())]
        empty = self.spark.createDataFrame([], rows.schema).agg(*counts).schema
        self.schema = T.StructType(kinds + [T.StructField(f.name, T.LongType()) for f in empty.fields])
        self.spark.streams.addListener(self)
        return rows.observe(self.name, *counts)

    # --- called by Spark
    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counted = event.progress.observedMetrics.get(self.name)
        if counted is None:
            return
        try:
            at = dt.datetime.now(dt.timezone.utc)
            row = (str(event.progress.id), event.progress.batchId, at, *map(int, counted))
            self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as error:  # the stream goes on; `finish` tells
            self.errors.append(error)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def finish(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all that a stream which has ended reported is in the table."""
        with self._news:
            told = self._news.wait_for(lambda: str(query.runId) in self._ended, seconds)
        self.spark.streams.removeListener(self)
        if self.errors or not told:
            raise RuntimeError("not all counts of the stream were kept") from next(iter(self.errors), None)

    # --- results
    def batches(self) -> DataFrame:
        """The counts of each micro-batch; of one that was run again, the last."""
        if not tables.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        counts = [c for c in rows.columns if c not in BATCH]
        last = F.max(F.struct("checked_at", *counts)).alias("last")
        return rows.groupBy("query_id", "batch_id").agg(last).select("query_id", "batch_id", "last.*")

    def results(self) -> DataFrame:
        """The suite's result rows of each micro-batch."""
        return C.results(self.batches(), self.suite, self.columns, BATCH)

    def totals(self) -> DataFrame:
        """The suite's result over all micro-batches: what the suite gives over their rows together."""
        counts = [f.name for f in self.schema.fields if f.name not in BATCH]
        added = self.batches().agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts))
        return C.results(added, self.suite, self.columns)

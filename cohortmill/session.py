"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or layout. Shuffle width is left to the cluster:
# adaptive execution coalesces it to the data.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # State of a deduplicated stream grows with its watermark; keep it off the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "cohortmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's settings; `conf` overrides by name (dots as given)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session somebody else has made fit for this package.

    Only the time zone is set, as dates of timestamps depend on it; all other
    settings are the caller's.
    """
    zone = "spark.sql.session.timeZone"
    if spark.conf.get(zone) != RUNTIME_CONF[zone]:
        spark.conf.set(zone, RUNTIME_CONF[zone])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in `spark.checkpoint.dir`.

    Only a local session, whose executors share this machine, may fall back to
    a temporary folder; on a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cohortmill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new, never used folder below the shared one and the application's own."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/cohortmill/{spark.sparkContext.applicationId}"


def drop_unused(spark: SparkSession) -> None:
    """Have the shuffled files of finished work deleted: Spark does so once the driver's garbage collector finds them unused."""
    spark._jvm.System.gc()


def remove_scratch(spark: SparkSession) -> None:
    """Delete all scratch folders of this application; their tables can't be read any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(place, True)

"""Session settings the library relies on, and the shared folder for cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SCRATCH = "tickbars"
# Folders that stored() has written inside the innermost settled().
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)

# Timestamps are instants; calendar functions and naive strings are read as UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Each batch of hour files is listed by a job; its 10,000 tasks would cost more than the listing, and stay in the driver's memory.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "500",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "tickbars", memory: str = "8g", **more: str) -> SparkSession:
    """A single-machine session for tests and the bench; *more* are settings with ``__`` for dots."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false")
    for key, value in more.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def require_utc(spark: SparkSession) -> None:
    """Days, months and naive times are taken in the session's zone: it must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"the session's time zone is {zone}; call tickbars.session.configure first")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where none is named, a fresh local folder serves a session on one machine;
    on a cluster that would lose rows, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tickbars-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{SCRATCH}/{label}-{uuid.uuid4().hex}"


def files_of(spark: SparkSession, folder: str):
    """The file system of *folder* and its path there, whatever store it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`stored` that have no reader any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if f"{SCRATCH}/" in folder:
                files, path = files_of(table.sparkSession, folder)
                files.delete(path, True)


def read_or_empty(spark: SparkSession, schema: StructType, path: str, **options: str) -> DataFrame:
    """The Parquet table at *path*; an empty frame when nothing has been written there."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored(df: DataFrame, label: str = "table", **options: str) -> DataFrame:
    """Write *df* once to the shared folder and read it back; *options* are the writer's.

    Cuts the lineage at a place that survives the loss of executors.  Used where
    a small result (bars) of a large scan (ticks) feeds a plan that reads it
    more than once, so that the large scan runs once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    made = _MADE.get()
    if made is not None:
        made.append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], label: str = "table") -> DataFrame:
    """The frame that *make* returns, stored; the tables that were stored to make it are deleted.

    Nothing else that *make* has built may be read afterwards.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        frame = make()
    finally:
        _MADE.reset(token)
    table = stored(frame, label)
    for folder in made:
        files, path = files_of(table.sparkSession, folder)
        files.delete(path, True)
    return table

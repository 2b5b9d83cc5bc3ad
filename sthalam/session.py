"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}
_ENDING: set[str] = set()


def build_session(app: str = "sthalam", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for; `conf` overrides them (dots as `__`)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between the steps of a plan: the one that the session names in spark.checkpoint.dir.

    Only on one machine (a local master, as in tests) a session without that setting gets a temporary one; elsewhere it is an error,
    since no worker sees another one's folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every worker sees")
        named = _LOCAL.setdefault(spark.sparkContext.applicationId, "")
        if not named:
            named = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="sthalam-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
    return named.rstrip("/")


#: Bytes of files up to which a written table may be planned to be sent to every worker, if the session allows no less. The planner takes a file's bytes for those
#: of the rows, which are ten times as many and more once they are hashed, and the driver has to hold them.
SENT_BYTES = 1 << 20


@contextmanager
def sent_by_rows(spark: SparkSession) -> Iterator[None]:
    """Within it joins are planned to send a table that is read from files only up to SENT_BYTES; what a running query measures in rows may be as large as the session allows."""
    static, running = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    allowed = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if allowed <= SENT_BYTES:
        yield
        return
    own = {k: spark.conf.get(k, None) for k in (static, running)}
    spark.conf.set(static, str(SENT_BYTES))
    if own[running] is None:
        spark.conf.set(running, str(allowed))
    try:
        yield
    finally:
        for k, v in own.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` as a table written once in the shared folder and read again; lost executors lose nothing of it.

    Compressed columns take less room than a checkpoint's rows, later steps read only the columns they need, and the planner knows
    the table's size, so that it broadcasts by measured bytes and not by guess (see `sent_by_rows`). Each run's tables are in a folder of the application's id,
    which goes when the driver ends.
    """
    spark = df.sparkSession
    run = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    if run not in _ENDING:
        path = spark._jvm.org.apache.hadoop.fs.Path(run)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)  # what isn't there yet isn't taken note of
        system.deleteOnExit(path)
        _ENDING.add(run)
    at = f"{run}/{uuid.uuid4().hex}"
    with sent_by_rows(spark):
        df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table `name` of `folder`."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Bytes of files below which a table counts as small: one read split of the default size.
SMALL_BYTES = 128 * 1024 * 1024


def spread(df: DataFrame) -> DataFrame:
    """A table as it is read; a small one whose files give fewer partitions than there are cores is dealt to all cores first.

    For work that is heavy for each row. What counts is the files' size as the planner knows it: a table of SMALL_BYTES or more is never
    shuffled, however many cores there are; to deal such a one finer, lower spark.sql.files.maxPartitionBytes.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    cores = df.sparkSession.sparkContext.defaultParallelism
    small = int(str(size)) < SMALL_BYTES
    return df.repartition(cores) if small and df.rdd.getNumPartitions() < cores else df

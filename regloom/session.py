"""Session helpers.

On a cluster the session is built by the platform; ``ensure_defaults`` only
fills settings that are unset (checkpoint dir, AQE), so a cluster's own
``spark.checkpoint.dir`` always wins.
"""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. AQE re-plans joins at runtime (size-checked
# broadcast, skew-join splitting, partition coalescing).
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Python stages get whole documents: batches are bounded by rows and bytes,
    # so pages of megabytes give short batches instead of gigabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
#: Removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SHIPPED: set[str] = set()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "regloom") -> SparkSession:
    """A local test/bench session. Never used on a cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Fill unset settings only; a cluster's configuration is never overridden."""
    conf, given = spark.conf, spark.sparkContext.getConf()
    for k, v in SQL_DEFAULTS.items():
        if not given.contains(k):
            conf.set(k, v)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so Python
    stages import it wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):
        target = os.path.join(tempfile.mkdtemp(prefix="regloom-pkg-"), "regloom.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, names in os.walk(root):
                for n in sorted(x for x in names if x.endswith(".py")):
                    full = os.path.join(d, n)
                    z.write(full, os.path.join("regloom", os.path.relpath(full, root)))
        sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A scratch folder is made only in local mode (tests), where driver and
    executors are one process; on a cluster a missing setting is an error,
    because other machines could not read what this one wrote.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="regloom-ckpt-", dir=os.environ.get("REGLOOM_SCRATCH", "/tmp"))
        sc.setCheckpointDir(configured)
        configured = sc.getCheckpointDir() or configured
    return configured.rstrip("/")


def job_folder(spark: SparkSession, name: str = "") -> str:
    """The folder of this application's tables in the shared checkpoint folder, or a new place of that name in it."""
    folder = f"{checkpoint_dir(spark)}/regloom-{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}" if name else folder


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when their query ends, not
    when the driver's garbage collector comes to their plan. For results that
    are written and read back: a plan that is run a second time would shuffle anew."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as a table in the job's folder and read it back: later
    plans start there, and a lost executor rereads files instead of recomputing.
    ``remove_written`` removes the folder when its results are no longer read."""
    path = job_folder(df.sparkSession, tag)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, tag: str, column: str) -> DataFrame:
    """Write ``df``, dealt by ``column`` already, as a table bucketed by it: later groups and joins on it don't shuffle
    this side. A bucket is one task's, because it is dealt by the same hash."""
    spark, name = df.sparkSession, f"{tag}_{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", f"{job_folder(spark)}/{name}").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the session's definition alone; the files and this plan stay
    return stored


def remove_written(spark: SparkSession) -> None:
    """Remove every table this application wrote by ``written`` or to a place of its ``job_folder``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(job_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

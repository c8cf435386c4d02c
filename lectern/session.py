"""Session construction and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "lectern",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE on, the UI off and UTC time.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count then comes from the cluster config.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
        "spark.ui.showConsoleProgress": "false",
        # checkpoints written per query are removed once their RDD is gone
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if master and master.startswith("local["):
        conf["spark.driver.memory"] = "8g"    # the whole engine; on a cluster spark-submit decides
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir`` and without it nothing
    starts, since executors could not read each other's files. Only on one
    machine, as in tests, an unset folder is replaced by a temporary one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lectern-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


ARROW_ROWS = 1024           # rows of an Arrow batch: what the JVM and a worker hold off-heap at once


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, whatever the cluster's default of rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"      # Spark 4.1 and later; others don't know it


def written(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """Write ``df`` once, as Parquet in the shared folder, and read it back.

    Cuts the lineage, keeps columns prunable, and gives every reader the same
    rows, which a second evaluation of the plan need not. ``scratch`` collects
    the folders of tables that the caller deletes with ``discard``. The files that
    the write shuffled go with its end."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    if scratch is not None:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders or files that no plan reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lectern`` importable on executors (zip + addPyFile, once per context)."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="lectern-pkg-")
    path = os.path.join(out, "lectern.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    zf.write(full, os.path.join("lectern", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)

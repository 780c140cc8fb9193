"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for a local run; a cluster deployment passes its own values through
# spark-submit and these only fill what is unset.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    # Remove checkpoint files once their DataFrame is garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "attrition", master: str | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**LOCAL_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it on the context.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    always used. Only a local-mode session without one gets a private folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="attrition-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


#: Deletes the shuffle files of a statement as it ends, instead of when the driver's memory is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str = "table"):
    """Write df once as Parquet under the shared checkpoint folder and read it
    back: the lineage is cut, later jobs read files, and a lost executor
    recomputes nothing upstream. (``DataFrame.checkpoint()`` would run the
    plan twice: once to count, once to write.) The write's shuffles go with it."""
    import uuid
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.parquet(path)
    out._scratch = path
    return out


def release(*tables) -> None:
    """Delete the files of tables that ``materialize`` returned.

    For a caller whose last reader of them is stored: a plan over a released table fails.
    Other DataFrames are left alone."""
    for table in tables:
        path = getattr(table, "_scratch", None)
        if path:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

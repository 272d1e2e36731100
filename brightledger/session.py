"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Local defaults for tests and the benchmark. On a cluster the submitter sets these.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "12g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "brightledger", shared: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks; ``shared`` becomes ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without that setting uses a folder in its warehouse; a cluster has to name one.
    """
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def run_dir(spark: SparkSession) -> str:
    """The folder below the shared one that holds all scratch data of this application."""
    return f"{shared_dir(spark).rstrip('/')}/brightledger-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the folder of this run."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete the scratch data of this run, once its results have been read. Says whether there was any."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)

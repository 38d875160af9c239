"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is worth one more shuffle: split it even when the plan then needs another exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver has it, whatever their working folder."""
    env, root = spark.sparkContext.environment, str(pathlib.Path(__file__).resolve().parents[1])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators rely on; partition counts stay with the deployment."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return importable(spark)


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skytally")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per column
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    base = tempfile.mkdtemp(prefix="skytally-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, where it lies; none is no fault."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and fixes partition contents."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "tabela") -> DataFrame:
    """The rows written once to the shared folder and read back: fixed, prunable by column, and of a size that the optimizer knows."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows redistributed when the input has fewer partitions than the session has cores.

    For work that is heavy per row (text): a few large files would keep most cores idle. An input
    of many splits is left as it is.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

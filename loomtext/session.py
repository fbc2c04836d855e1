"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "loomtext", cpus: int | None = None) -> SparkSession:
    """Session for tests and the benchmark. On a cluster the submitter brings the session."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEM", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loomtext-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset, only a master whose executors are threads of the driver gets a temporary folder: elsewhere the
    executors could not reach it. ``local_session`` names one for tests and the benchmark.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            shared = tempfile.mkdtemp(prefix="loomtext-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, for a table a job writes and reads back."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def frozen(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are computed once and survive the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table below the checkpoint folder, and read back: columns that a later step leaves out are not read, and rows are compressed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)

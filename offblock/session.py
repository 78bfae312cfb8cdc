"""SparkSession helpers.

Library code never creates its own session; it takes one. ``local_session`` is
for tests and the bench only. Checkpoints go to ``spark.checkpoint.dir`` as the
cluster sets it; a local scratch folder is used only when none is set.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "offblock") -> SparkSession:
    """Session for tests/bench: local master, AQE on, UI off, UTC."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("OFFBLOCK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_KEY, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(f"{CHECKPOINT_KEY} is not set; a shared folder is required on a cluster")
    path = tempfile.mkdtemp(prefix="offblock-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set(CHECKPOINT_KEY, path)
    return path


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut lineage with a Parquet table written under the shared checkpoint folder.

    One computation of the plan (an eager reliable ``checkpoint()`` computes it
    twice unless cached), a columnar copy that later reads prune and filter,
    and it survives executor loss like any written table.
    """
    import uuid

    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}"


def drop_scratch(df: DataFrame) -> None:
    """Delete the written intermediate table that df reads; only tables under the checkpoint folder go."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base.split(":")[-1].lstrip("/") in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

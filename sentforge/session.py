"""Session helpers.

Library code never creates a session; these helpers are for tests, the bench
and the driver entry points.  ``checkpoint_dir`` honours the cluster's
``spark.checkpoint.dir``; only a one-machine session may go without it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sentforge") -> SparkSession:
    """Session for tests / bench on one machine (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SENTFORGE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring the context if needed.

    Order: an already-set context dir, then ``spark.checkpoint.dir`` from the
    session conf (the shared folder a cluster names).  A local-mode session
    without either, as in unit tests, gets a fresh scratch folder; a cluster
    session raises, because executors and driver share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="sentforge-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/sentforge-{uuid.uuid4().hex}/{what}"


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage, and what tasks saw
    (places, partition numbers) stays the same however often it is read."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

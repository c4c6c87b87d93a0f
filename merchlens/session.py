"""Session settings the operators count on, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings. AQE splits skewed join partitions by measured size and turns a
# sort-merge join into a broadcast join only after measuring the small side.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("merchlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Static: no stack trace per column expression, which dominates plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, below the cluster's shared checkpoint folder.

    Only a local session without ``spark.checkpoint.dir`` (a test) falls back to its warehouse folder;
    on a cluster a missing setting is an error, because nothing else is known to be shared.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"

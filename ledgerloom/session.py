"""The session that the engine expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(name: str = "ledgerloom", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in ``spark.checkpoint.dir``; where none is set, and on a local master only, below the warehouse."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        context.setCheckpointDir(folder)
    return df.checkpoint()

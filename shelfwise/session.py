"""Session defaults and the one place that cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; pass dotted settings as ``**{"spark.x.y": "z"}``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """Settings a session made elsewhere needs so that one hot join key is split, even where an
    aggregate could reuse the partitioning of the join."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the session names none, a local session, which has no other machines, gets a temporary one; on a cluster
    that would be a folder of one machine, so it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="shelfwise-checkpoint-"))
    return context.getCheckpointDir()


def new_shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The table written as Parquet to the shared folder and read back: columns stay columns, and lost executors lose nothing."""
    path = new_shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

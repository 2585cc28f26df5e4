"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Settings a cluster session should carry. Partition counts are left to AQE, which coalesces
#: small ones and splits skewed ones; the initial number is set per cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(master: str = "local[8]", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session with the recommended settings, for tests and the bench."""
    builder = SparkSession.builder.master(master).appName("listflow")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session's ``spark.checkpoint.dir`` names it.

    Only a single-process master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or None
    if configured is None:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured is None:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="listflow-")
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def dimension(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small literal table whose size Catalyst knows.

    Rows that come as Arrow become a local relation; a plain Python list would be a scan of
    unknown size, which is never broadcast and makes the other side of a join move.
    """
    return spark.createDataFrame(pa.table(
        {n: pa.array([r[i] for r in rows]) for i, n in enumerate(names)}))


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later stages then start from files that outlive executors, and Catalyst sees exact sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

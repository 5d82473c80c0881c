"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_SETTING = "spark.cargolens.localWorkspace"


def workspace(spark: SparkSession) -> str:
    """Folder of this application under `spark.checkpoint.dir`.

    Without that setting a local session (tests) gets a new temporary folder; on
    a cluster a machine-local folder would be lost with its machine, so there
    the setting is required.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_SETTING, None)
            or spark.sparkContext.getCheckpointDir())
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="cargolens-")
        spark.conf.set(LOCAL_SETTING, base)
    return f"{base.rstrip('/')}/cargolens/{spark.conf.get('spark.app.id')}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and go on from the files.

    This cuts the lineage, so a lost executor costs a re-read and not a
    recomputation, and the planner sees the true size instead of an estimate.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

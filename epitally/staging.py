"""Small intermediate tables written to the shared checkpoint folder.

The monthly counts feed every table and chart of a report. Writing them once
means the event table is scanned once, however many outputs follow, and a lost
executor costs a re-read of a small table instead of another full scan. A
written table also gives the optimizer exact sizes for its join decisions.
"""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_DIR_SETTING = "spark.checkpoint.dir"


def staging_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a scratch folder only for local runs."""
    configured = spark.conf.get(_DIR_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_DIR_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="epitally-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/epitally/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict]:
    """As ``stage``; aggregates over the rows come along with the write that has them anyway."""
    observation = Observation(f"{name}-{uuid4().hex}")
    staged = stage(df.observe(observation, *(column.alias(label) for label, column in metrics.items())), name)
    return staged, observation.get

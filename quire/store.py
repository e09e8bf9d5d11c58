"""Tables that are computed once, in a folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; only where none is named (tests on one machine), a temporary one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(made := tempfile.mkdtemp(prefix="quire-checkpoint-"))
    return made


def settle(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage: the rows are in the shared checkpoint folder, so a lost executor loses none."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

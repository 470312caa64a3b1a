"""Cutting the lineage of tables that iterations use again and again."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder that the session names. A local folder stands in for it in local mode alone."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="chainloom-checkpoint-"))
    return df.checkpoint(eager=True)

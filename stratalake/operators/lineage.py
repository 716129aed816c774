"""Cutting lineage with a reliable checkpoint."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the checkpoint folder and continue from there.

    The folder is the session's ``spark.checkpoint.dir``.  Only a local session without one gets a
    temporary folder; a cluster must name shared storage.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="stratalake-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)

"""Where jobs keep what they cut off from their lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or that set on the context. Where neither is and Spark runs in one process,
    as in tests, a temporary one is made and set; on a cluster, whose machines share no such folder, that is an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        if not named and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints"))
    return named or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, so that a lost executor costs one read."""
    shared_folder(df.sparkSession)
    return df.checkpoint()

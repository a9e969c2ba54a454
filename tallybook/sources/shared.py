"""Where jobs may write: the folder every executor can see."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for ``name`` below the cluster's shared folder.

    A machine-local folder is made only where the setting is absent and Spark itself runs in
    one process, as in tests.
    """
    root = spark.conf.get(SETTING, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallybook-")
    return f"{root.rstrip('/')}/{name}-{uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared folder and read again: computed once, and there for all who read them."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

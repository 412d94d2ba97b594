"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. Only a session in one process, as in tests, may go without that setting."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and context.master.partition("[")[0] != "local":
            raise ValueError("a cluster's session must name a shared folder in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="curaspark-"))
    return f"{context._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: neither lineage nor plan grows beyond its files."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""The shared folder for tables that cut a job in two."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

CHECKPOINTS = "spark.checkpoint.dir"


#: Names that Arrow gives to stores that Hadoop calls otherwise.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def arrow_uri(path: str) -> str:
    """A Hadoop path with a scheme as a URI for Arrow's file systems."""
    scheme, rest = path.split("://", 1)
    return f"{ARROW_SCHEMES.get(scheme, scheme)}://{quote(rest, safe='/:@')}"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session in one process may go without; it gets a folder in its warehouse.
    """
    named = spark.conf.get(CHECKPOINTS, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError(f"{CHECKPOINTS} must name a folder every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/caseloom/{spark.sparkContext.applicationId}"


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{_run_dir(spark)}/{uuid.uuid4().hex}/{name}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Whatever follows can be recomputed as often as Spark likes, also after losing
    executors, without repeating what came before; and later readers get column
    pruning that a checkpointed RDD would not give them.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_settled(spark: SparkSession) -> bool:
    """Delete what this application settled; results that read it must be done with."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

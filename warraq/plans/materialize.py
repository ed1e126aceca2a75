"""Cutting lineage through tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where none is named, and Spark runs in one process with this one, a temporary folder is set as its checkpoint folder; on a cluster that is an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local["):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    own = tempfile.mkdtemp(prefix="warraq-")
    sc.setCheckpointDir(own)
    return own


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: later stages start from files that outlive any executor.

    A written table rather than ``checkpoint()``: the plan runs once, and the files are columnar, compressed and prunable.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/warraq-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}-{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> int:
    """Removes the tables that this application has written to the shared folder; how many. Results that read them can't be read afterwards."""
    sc = spark.sparkContext
    pattern = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/warraq-{sc.applicationId}-*")
    fs = pattern.getFileSystem(sc._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    return sum(bool(fs.delete(f.getPath(), True)) for f in found)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A stated set of questions, to be held against all rows: with a broadcast hint if there are at most ``most``, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df

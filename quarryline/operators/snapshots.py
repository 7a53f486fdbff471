"""Tables in the folder that driver and executors share: they cut the lineage of long jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset and Spark runs in one process, a temporary folder.

    On a cluster each executor would write to its own disk, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = getattr(spark, "_quarryline_shared", None) or f"file://{tempfile.mkdtemp(prefix='quarryline-')}"
        spark._quarryline_shared = folder
    return folder.rstrip("/")


def snapshot(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back.

    Later jobs start from the files, so a lost executor costs a task, not the lineage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quarryline_path = path
    return out


def discard(df: DataFrame) -> None:
    """Removes the files of a snapshot that nothing reads any more, such as an iteration's last but one table."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._quarryline_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)

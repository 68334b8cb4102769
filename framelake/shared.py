"""Intermediate tables of the engine: in the folder that the cluster shares, if it names one."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, below a temporary folder, on a local master only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='framelake-')}"
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def fixed(df: DataFrame) -> DataFrame:
    """df's rows as they are now, whatever is lost later: for what depends on sampled boundaries. Written to the shared folder as Parquet."""
    path = shared_path(df.sparkSession, "fixed")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def made_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file at path with this text, where there is none; whether it was made. Of several at once, one makes it.

    On a local disk a hard link does what a create that must not overwrite does elsewhere: Hadoop's local file system looks
    and creates in two steps.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":
        own = p.toUri().getPath()
        draft = f"{os.path.dirname(own)}/.{uuid.uuid4().hex}"
        with open(draft, "x") as f:
            f.write(text)
        try:
            os.link(draft, own)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        stream = fs.create(p, False)
    except Exception as e:
        if "xists" not in str(e):
            raise
        return False
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    return True

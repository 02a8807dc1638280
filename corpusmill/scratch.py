"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_tables: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Where it is unset, a local session gets a
    temporary one; on a cluster that is an error, as executors could not read each other's files."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="corpusmill-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by checkpoint() in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def new_path(spark: SparkSession, tag: str) -> str:
    """A path of its own, removed when the driver ends."""
    path = f"{shared_dir(spark)}/corpusmill-{tag}-{uuid.uuid4().hex}"
    _tables.append((spark, path))
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it again.  A lost executor loses none of it."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop(df: DataFrame) -> None:
    """Remove a table of written() that nothing reads any more."""
    here = (df.sparkSession, df.written_at)
    if here in _tables:
        _tables.remove(here)
        remove(*here)


@atexit.register
def drop_tables() -> None:
    """Remove what is left; called when the driver ends."""
    while _tables:
        remove(*_tables.pop())

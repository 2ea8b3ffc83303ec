"""Where jobs keep what must outlive a lineage: the shared folder of the cluster."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset a temporary one is set, but only for a local
    master: executors of a cluster would not see it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        local = tempfile.mkdtemp(prefix="linkweave-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        found = "file://" + local
        spark.sparkContext.setCheckpointDir(found)
    return found


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs meanwhile go as soon as it is done."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    This cuts the lineage: a lost executor costs only the tasks that read the table again. Shuffle files of the
    writing go as soon as it is done, instead of when the driver happens to collect its garbage. What was written
    here is not written again.
    """
    if vars(df).get("written"):
        return df
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    with cleaned(spark):
        df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written, out.path = True, path
    return out


def discard(df: DataFrame) -> None:
    """Removes what ``materialise`` wrote for ``df``, which nothing reads any more."""
    if path := vars(df).get("path"):
        found = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(found, True)

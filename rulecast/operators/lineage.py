"""Materialising an intermediate result that several branches read."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without one gets a
    temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="rulecast-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it from there.

    The table survives the loss of executors, ends the lineage, lets every later reader prune
    columns, and has a known size, by which Spark decides whether to broadcast it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/rulecast-{uuid.uuid4().hex}"
    if (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Delete the tables materialized inside the block when it ends.

    For jobs that write their result within the block; a DataFrame that leaves it must not depend
    on such a table any more.
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in paths:
            target = hadoop.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

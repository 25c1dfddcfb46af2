"""Helpers that the operators of this subpackage share."""

import io
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = os.path.join(tempfile.mkdtemp(prefix="rulecast-code-"), "rulecast.zip")
    with open(target, "wb") as out:
        out.write(packed.getvalue())
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Bound what one Arrow batch brings into a Python worker to about ``size`` bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def free_arrow() -> None:
    """Give back what Arrow's pool keeps of freed buffers; a reused worker would hold it between tasks."""
    pa.default_memory_pool().release_unused()


def free_memory() -> None:
    """As ``free_arrow``, and what the C library keeps of freed arrays, which is Arrow's system pool."""
    free_arrow()
    pa.system_memory_pool().release_unused()


def texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns that operators on documents read, a null text as the empty one."""
    return df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows that go to a Python worker at once. Texts may be long, so batches are kept far below Spark's 10,000 rows.
TEXT_BATCH_ROWS = 512


def text_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers by sending texts in small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one (as in tests) gets a temporary folder."""
    context = spark.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and context.getCheckpointDir() is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="armlens-checkpoint-"))
    return context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there; executors may be lost after that."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def let_go(spark: SparkSession) -> None:
    """Ask the driver to collect its garbage: Spark deletes the shuffle files of plans that nothing refers to any more, as
    those before a ``cut``, but only when the driver finds that out, which by itself may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class BoundedCache(dict):
    """A dict that computes missing values and forgets everything when it is full."""

    def __init__(self, compute, limit: int = 200_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value

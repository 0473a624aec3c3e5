"""Results that several steps need are written once to the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one (as in tests) gets a temporary folder."""
    context = spark.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and context.getCheckpointDir() is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="armlens-stored-"))
    return context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` from the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet files beside the checkpoints: for tables with a row for each call, which are read several times.

    A checkpoint's rows are Java objects, which are slow to read and are read whole; of files only the columns that a step
    asks for are. Unlike a checkpoint it keeps no partitioning."""
    spark = df.sparkSession
    shared_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a task gets of a shuffle by ``dealt``, about.
TASK_ROWS = 1 << 18


def dealt(df: DataFrame, rows: float, *keys: str) -> DataFrame:
    """``df`` shuffled by the keys into as many partitions as ``rows`` rows ask for, the session's number at least; few
    rows are left to Spark.

    For steps that sort what they get, or make more rows of it: a task's memory then stays as it is when the input grows,
    also where the session's number of shuffle partitions is small, or Spark would merge partitions by their bytes."""
    spark = df.sparkSession
    if rows <= TASK_ROWS * spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(rows // TASK_ROWS) + 1), *keys)


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df``, and an observation of aggregates that the next action over it fills (``.get``), so no pass of its own counts.

    Rows are counted where they pass. Put it behind the last shuffle of that action: then each row is counted once, also
    where tasks run again."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen

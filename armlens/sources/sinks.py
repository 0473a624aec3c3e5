"""Writers, and the log of runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stored import TASK_ROWS


def exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(path).isEmpty()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def save_table(df: DataFrame, path: str, *, overwrite: bool = False, partition_by: str | None = None) -> None:
    """Write a table; one that holds rows is replaced only if asked."""
    if not overwrite and exists(df.sparkSession, path):
        raise ValueError(f"{path} holds rows")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def require_table(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise ValueError(f"{path} is missing or empty")
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One file; for result tables of some thousand rows."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def set_run_meta(spark: SparkSession, path: str, values: dict[str, str], writer: str) -> None:
    rows = spark.createDataFrame(list(values.items()), "key string, value string")
    rows.select("key", "value", F.lit(writer).alias("written_by"), F.current_timestamp().alias("written_at")).write.mode("append").parquet(path)


def run_meta(spark: SparkSession, path: str) -> DataFrame:
    """The latest value of each key; of several of one moment the greatest, so it is the same in every read."""
    return spark.read.parquet(path).groupBy("key").agg(F.max_by(F.struct("value", "written_by"), F.struct("written_at", "value", "written_by")).alias("v"), F.max("written_at").alias("written_at")).select("key", "v.*", "written_at")


def write_lines(lines: DataFrame, path: str, keys: list[str], order: str, text: str = "value") -> None:
    """Text lines in order, a folder for each key: headers, provenance and kept records of a call set."""
    lines.select(*keys, order, text).repartition(*keys).sortWithinPartitions(*keys, order).select(*keys, text).write.mode("overwrite").partitionBy(*keys).text(path)


def _store(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it: any store that Spark can write to."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def file_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _store(spark, path)
    return fs.exists(at)


def write_files(lines: DataFrame, targets: dict[str, str], key: str, order: str, text: str | list[str] = "value", *, overwrite: bool = False, rows: float = 0) -> None:
    """One text file for each key of ``targets`` (key -> path), its lines in ``order``. Several columns as ``text`` are
    written as a table separated by tabs, with its header.

    A key's lines are sorted by one task, which may spill, as a file needs one writer. ``rows``: how many lines there are,
    from callers that can take folders: where these are many, each target is a folder of parts, in order by their names,
    which the readers take as one file. Ranges of lines are then sorted apart, so no task has a whole file. All files are written to a folder
    beside the first target; when all are there each is renamed to its place, so no reader sees a part of one. Keys
    without lines get no file."""
    spark = lines.sparkSession
    aside = f"{next(iter(targets.values())).rsplit('/', 1)[0]}/_writing-{uuid.uuid4().hex}"
    # Keys may hold signs that folder names can't, so folders are numbered.
    number = {k: n for n, k in enumerate(sorted(targets))}
    numbers = spark.createDataFrame(list(number.items()), f"{key} string, file_number int")
    numbered = lines.join(F.broadcast(numbers), key)
    long = rows > TASK_ROWS * spark.sparkContext.defaultParallelism
    dealt = numbered.repartitionByRange(int(rows // TASK_ROWS) + 1, "file_number", order) if long else numbered.repartition("file_number")
    table = isinstance(text, list)
    writer = dealt.sortWithinPartitions("file_number", order).select("file_number", *(text if table else [text])).write.partitionBy("file_number")
    if table:
        writer.csv(aside, header=True, sep="\t", quote="")
    else:
        writer.text(aside)
    fs, folder = _store(spark, aside)
    try:
        for k, target in targets.items():
            _, part = _store(spark, f"{aside}/file_number={number[k]}")
            if not fs.exists(part):
                continue
            if long:
                written = part
            else:
                (written,) = [x.getPath() for x in fs.listStatus(part) if x.getPath().getName().startswith("part-")]
            _, place = _store(spark, target)
            if fs.exists(place):
                if not overwrite:
                    raise ValueError(f"{target} is there already")
                fs.delete(place, True)
            fs.mkdirs(place.getParent())
            if not fs.rename(written, place):
                raise OSError(f"{target} can't be written")
    finally:
        fs.delete(folder, True)


def merge_parts(spark: SparkSession, folder: str, expected: int) -> DataFrame:
    """The union of summary parts, once all of them are there."""
    parts = spark.read.csv(folder, header=True, inferSchema=False).withColumn("_f", F.col("_metadata.file_path"))
    n = parts.agg(F.count_distinct("_f").alias("n")).first()["n"]
    if n < expected:
        raise ValueError(f"{n} of {expected} parts are there")
    return parts.drop("_f")

"""Tables in and out."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: What a row group holds at most by default; one task reads a row group.
ROW_GROUP_BYTES = 128 << 20


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt out to all cores, for work that costs much more than the shuffle, if the input is so small that a few row groups may hold it.

    An input of at least a row group for each core stays as it is read: there the scan's own tasks keep all cores busy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(2 * cores) if size < cores * ROW_GROUP_BYTES else df


def read_texts(spark: SparkSession, path: str, id_col: str, text_col: str, limit: int | None = None) -> DataFrame:
    """(id, text) of a Parquet table by the caller's column names; a limit only on demand."""
    out = spark.read.parquet(path).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return out if limit is None else out.orderBy("id").limit(limit)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as Parquet, rebuilt."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_csv(df: DataFrame, path: str, sep: str = ",", order: list[str] = ()) -> None:
    """CSV with a header; arrays and structs as JSON, thresholds counted beside."""
    if "thresholds" in df.columns:
        df = df.withColumn("thresholds_count", F.size("thresholds"))
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]
    for name in nested:
        df = df.withColumn(name, F.to_json(name))
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table, rebuilt, and read it back: what follows starts from the file."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a session on one machine (tests) may lack it and gets a temporary folder; elsewhere that is an error.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: a lost executor loses nothing, columns are compressed, and the planner knows the size."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

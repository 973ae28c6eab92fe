"""Writers: append, append that returns the rows with their generated keys, and key generators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skeinwork.errors import Unsupported


def new_table(spark: SparkSession, name: str) -> str:
    """A path for a new table in the folder that driver and executors share: spark.checkpoint.dir, or else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def insert(df: DataFrame, path: str, max_rows_per_file: int = 0) -> None:
    """Appends rows to a Parquet table; a cap on rows per file stands for the batch caps of row stores."""
    df.write.mode("append").option("maxRecordsPerFile", max_rows_per_file).parquet(path)


def with_keys(df: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Dense keys from start on, in the order of partitions, without moving all rows to one task.

    Rows are numbered within their partition, and the counts of the partitions before are added.  Where a checkpoint
    folder is set the numbered rows are written there first, so that counts and rows are of one evaluation.
    """
    part = df.withColumn("_row", F.monotonically_increasing_id())
    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        part = part.checkpoint()
    block, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND((1 << 33) - 1)
    part = part.withColumns({"_block": block, "_place": place})
    before = F.sum("count").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))  # over a row for each partition
    sizes = part.groupBy("_block").count().select("_block", F.coalesce(before, F.lit(0)).alias("_before"))
    return part.join(sizes, "_block").select((F.col("_place") + F.col("_before") + start).alias(key), *df.columns)


def hi_lo(df: DataFrame, key: str, block: int, high: int) -> DataFrame:
    """Keys from blocks that each task leases: unique, with gaps, and without a shuffle; high is the first free block."""
    row = F.monotonically_increasing_id()
    task, place = F.shiftright(row, 33), row.bitwiseAND((1 << 33) - 1)
    # blocks of one task lie a fixed stride apart, so that tasks never share one
    stride = 1 << 24
    return df.withColumn(key, (F.lit(high).cast("long") + F.floor(place / block) * stride + task) * block + place % block)


def insert_returning(df: DataFrame, path: str, key: str, start: int) -> DataFrame:
    """Appends rows with new keys and returns what was written."""
    if key in df.columns:
        raise Unsupported(f"{key} is generated and can't be given")
    keyed = with_keys(df, key, start)
    insert(keyed, path)
    return df.sparkSession.read.schema(keyed.schema).parquet(path).filter(F.col(key) >= start)


def version_guid(column: Column) -> Column:
    """A deterministic GUID text of a value, by MD5."""
    h = F.md5(column.cast("string"))
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))

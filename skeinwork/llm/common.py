"""Shared pieces of the training-data operators: the shared scratch folder and null handling."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folder: str | None = None


def scratch_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the cluster names in ``spark.checkpoint.dir``.  Where that is unset, a session with a local
    master gets a temporary folder; any other session gets a folder in its warehouse.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        return f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="skeinwork-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


class Scratch:
    """Tables written in the shared folder, so that a lost executor costs no more than its running tasks."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.base = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Writes df and reads it back: its lineage ends here, and what it holds no longer changes."""
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # noqa: SLF001
        return out

    def drop(self, df: DataFrame) -> None:
        """Deletes a table that keep() returned and that nothing reads any more."""
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = self.spark.sparkContext._jvm  # noqa: SLF001
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)  # noqa: SLF001


#: A key is crowded where it holds more than one of SHARE parts of all rows, and more than LEAST_CROWD of them.
SHARE, LEAST_CROWD, SALTS = 1024, 1000, 64


def crowded_keys(counts: DataFrame, key: str, n: str, total: int | None = None) -> list[int]:
    """The keys that hold over one of ``SHARE`` parts of the rows that n counts, so at most ``SHARE`` of them reach the driver."""
    if total is None:
        total = counts.agg(F.sum(n)).first()[0] or 0
    if total <= LEAST_CROWD:
        return []
    return [r[0] for r in counts.filter(F.col(n) > max(total / SHARE, LEAST_CROWD)).select(key).collect()]


def join_spread(many: DataFrame, one: DataFrame, key: str, crowded: list[int]) -> DataFrame:
    """many joined with its row of one by key; the rows of crowded keys are dealt to ``SALTS`` tasks each, by a hash of all their columns."""
    if not crowded:
        return many.join(one, key)
    hot = F.col(key).isin(crowded)
    many = many.withColumn("__salt", F.when(hot, F.pmod(F.xxhash64(*many.columns), F.lit(SALTS))).otherwise(0).cast("int"))
    one = one.withColumn("__salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return many.join(one, [key, "__salt"]).drop("__salt")


def text_of(column: str = "text") -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(F.col(column), F.lit(""))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")

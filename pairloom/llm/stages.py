"""Tables written between stages, and the tables the operators of this subpackage read."""

from __future__ import annotations

import gc
import time

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pairloom.session import fresh_path


class Stage:
    """A table written to the shared folder and read back; ``drop`` removes it once nothing reads it any more."""

    def __init__(self, df: DataFrame, label: str) -> None:
        self.spark = df.sparkSession
        self.path = fresh_path(self.spark, label)
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files that no frame refers to any more.

    The cleaner follows the driver's garbage collection, which a driver with little to do may put off for
    long; a job in several stages would keep the shuffles of all of them on disk until then.
    """
    for _ in range(2):  # what the first collection frees still holds the shuffles until the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def carried(columns: Sequence[str]) -> list[Column]:
    """Columns that an operator hands through, as one struct, so that no name can clash with its own."""
    return [F.struct(*columns).alias("row")] if columns else []


def with_carried(schema: str, rows: DataFrame) -> StructType:
    """An operator's output schema, with the struct of carried columns if ``rows`` has it."""
    out = StructType.fromDDL(schema)
    return out.add(rows.schema["row"]) if "row" in rows.columns else out

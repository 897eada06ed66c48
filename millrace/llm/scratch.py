"""Intermediate tables in the shared folder, and small column helpers of the operators."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import fresh_path


BATCH_BYTES = "4m"


class Scratch:
    """Tables written under one fresh folder of the shared directory.

    Writing cuts the lineage: a lost executor costs the tasks that read the table, never the plan before it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = fresh_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Removes a table that no later plan reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def unit(*parts: Column) -> Column:
    """A repeatable number from 0 up to 1 for the given columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def skew_aware(spark: SparkSession) -> None:
    """Lets Spark split a hot join partition even where that costs a shuffle further down."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def bounded_batches(spark: SparkSession) -> None:
    """Has Spark cut the batches it sends to Python by bytes too, for this session; rows alone would let long texts pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def release_memory() -> None:
    """Gives a Python worker's free memory back to the machine; its next task may be of another stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over batches, and free memory released at its end."""

    @functools.wraps(run)
    def ending(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return ending

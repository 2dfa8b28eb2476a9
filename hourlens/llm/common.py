"""Helpers shared by the training-data operators: written stages, range blocks, running offsets."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourlens.session import work_dir

# Spark drops the shuffle files of a finished write at once instead of at the next driver GC.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Stages:
    """Tables of one run under the shared folder; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.count = spark, work_dir(spark, name), 0

    def write(self, df: DataFrame, **options) -> DataFrame:
        """Write ``df``, read it again: later plans and lost executors start from the table."""
        self.count += 1
        path = f"{self.base}/{self.count}"
        with _shuffle_cleanup(self.spark):
            df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that nothing reads any more."""
        for t in tables:
            self._delete(t._stage_path)

    def result(self, df: DataFrame) -> DataFrame:
        """Write the run's last table beside its folder and remove all others."""
        self.base, old = f"{self.base}-result", self.base
        out = self.write(df)
        self._delete(old)
        return out

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch brings into a Python worker, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def range_blocks(stages: Stages, df: DataFrame, *order: str) -> DataFrame:
    """Write ``df`` cut into key ranges of about equal row counts, with the range's number in
    column ``block``.  Rows compare across blocks as their block numbers do, so a running value
    needs a window inside a block and one total per block.  A frequent key is split as long as
    ``order`` has further columns that tell its rows apart."""
    n = partitions(stages.spark)
    cut = df.repartitionByRange(n, *[F.col(c) for c in order])
    return stages.write(cut.withColumn("block", F.spark_partition_id()))


def block_offsets(blocks: DataFrame, value: Column, group: list[str] = ()) -> DataFrame:
    """Sum of ``value`` over all earlier blocks, per block (and per ``group`` column).

    One row per block and group: the window that adds them up never sees data rows."""
    keys = list(group)
    totals = blocks.groupBy(*keys, "block").agg(F.sum(value).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, "block", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("before"))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would change other letters, too)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_key(line: Column) -> Column:
    """White space (space, tab to carriage return) stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def hash_pair(*cols: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: 128 bits name a value at any corpus size."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x51ED270B), *cols)

"""Running totals and ranks over a whole table without a one-task sort.

Distinct values are counted first, so a hot value is one row.  The counted rows are cut into
ranges of about equal row counts, as many as the session has shuffle partitions, and written with
the number of their range.  Windows then run per range, and only one total per range is
ordered globally: tasks grow with neither the data nor a fixed number of buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlens.session import work_dir


def range_bucket(df: DataFrame, value: str, out: str = "_b") -> DataFrame:
    """A written copy of ``df`` whose column ``out`` numbers order-preserving ranges of ``value``."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(n, value).withColumn(out, F.spark_partition_id())
    path = work_dir(spark, "ranges")
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def running_before(counts: DataFrame, value: str, sums: Sequence[str]) -> DataFrame:
    """Add ``before_<c>``: the total of ``c`` over all strictly smaller values.

    ``counts`` has one row per distinct ``value``.
    """
    tagged = range_bucket(counts, value, "_b")
    # one row per range from here on, so the global window is bounded
    order = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy("_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
               .select("_b", *[F.coalesce(F.sum(f"_t_{c}").over(order), F.lit(0)).alias(f"_o_{c}")
                               for c in sums]))
    inner = Window.partitionBy("_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.select("*", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(f"_l_{c}")
                                 for c in sums])
    return (local.join(F.broadcast(offsets), "_b")
            .select(*counts.columns,
                    *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"before_{c}") for c in sums]))


def average_ranks(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """One row per distinct value: ``value, n, rank`` with ties averaged (1-based).

    ``weight`` names a column that says how often each row counts."""
    n = F.count("*") if weight is None else F.sum(weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(n.alias("n"))
    return running_before(counts, value, ["n"]).select(
        value, "n", (F.col("before_n") + (F.col("n") + 1) / 2.0).alias("rank"))

"""Streaming twins: same result as the batch operator on the closed part.

Jobs read a file source, run with ``availableNow`` and write to a file sink
with a checkpoint, so a lost executor or a restart repeats no row.  Nothing is
collected: the result is read back from the sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.operators import drift as dr
from hourlens.operators.relational import check_bounds
from hourlens.session import work_dir


def file_stream(spark: SparkSession, folder: str, glob: str, schema: T.StructType,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def event_time(df: DataFrame, ts: str = "ts", out: str = "event_ts") -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone is UTC."""
    return df.withColumn(out, F.col(ts).cast("timestamp"))


class Closing:
    """A second file source for the marker that ends a feed.

    A window stays open until a later event moves the watermark past it.  ``attach`` adds a
    marker stream to the feed, empty at first; ``close`` writes one row far in the future.  Drained
    again, the query then emits every window and session still open.
    """

    FAR = "2999-12-31 00:00:00"

    def __init__(self, feed: DataFrame, ts: str = "ts"):
        self.spark, self.ts, self.schema = feed.sparkSession, ts, feed.schema
        self.folder = work_dir(self.spark, "feed-end")
        self._marker().where("false").write.parquet(self.folder)

    def _marker(self) -> DataFrame:
        row = self.spark.range(1)
        return row.select(*[
            (F.lit(self.FAR) if f.name == self.ts else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema.fields])

    def attach(self, feed: DataFrame) -> DataFrame:
        return feed.unionByName(self.spark.readStream.schema(self.schema).parquet(self.folder))

    def close(self) -> None:
        self._marker().write.mode("append").parquet(self.folder)


def run_to_table(df: DataFrame, name: str, mode: str = "append",
                 closing: Closing | None = None) -> DataFrame:
    """Drain the source into a Parquet table and read it back.

    With ``closing`` the query is resumed from its checkpoint once the feed is drained and its
    end is marked, so the tail is emitted, too."""
    spark = df.sparkSession
    base = work_dir(spark, name)

    def drain() -> None:
        (df.writeStream.format("parquet").outputMode(mode)
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
         .trigger(availableNow=True).start()).awaitTermination()

    drain()
    if closing is not None:
        closing.close()
        drain()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def run_batches(df: DataFrame, name: str, handle: Callable[[DataFrame, int], None]) -> None:
    base = work_dir(df.sparkSession, name)
    query = (df.writeStream.foreachBatch(handle)
             .option("checkpointLocation", f"{base}/state")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def hourly_stats(stream: DataFrame, measure: str = "value", watermark: str = "1 hour",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Tumbling one-hour counts and means."""
    agg = (event_time(stream).withWatermark("event_ts", watermark)
           .groupBy(F.window("event_ts", "1 hour").alias("w"), *keys)
           .agg(F.count("*").alias("n"), F.avg(measure).alias("mean")))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("hour_ts"), *keys, "n", "mean")


def dedup_best(stream: DataFrame, severity: Column, tiebreak: Sequence[str],
               columns: Sequence[str], watermark: str = "1 hour") -> DataFrame:
    """The most severe row of every hour, emitted when the hour closes."""
    best = F.min_by(F.struct(*columns), F.struct((-severity).alias("_s"), *tiebreak))
    agg = (event_time(stream).withWatermark("event_ts", watermark)
           .groupBy(F.window("event_ts", "1 hour").alias("w")).agg(best.alias("_row")))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("hour_ts"), "_row.*")


def exact_dedup(stream: DataFrame, columns: Sequence[str], watermark: str = "1 hour") -> DataFrame:
    """Drop repeats that arrive within the watermark delay."""
    return (event_time(stream).withWatermark("event_ts", watermark)
            .dropDuplicatesWithinWatermark(list(columns)).drop("event_ts"))


def outages(stream: DataFrame, key: Column, gap: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """Unbroken coverage runs: a silence longer than the gap starts a new run.

    Events are merged into sessions inside each task before they are dealt out by series, so a
    series that is the whole feed sends a few sessions per task, not its events.  A series (``key``) has one
    writer of its state, so a large feed names more than one.
    """
    stream.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    agg = (event_time(stream).withColumn("series", key).withWatermark("event_ts", watermark)
           .groupBy("series", F.session_window("event_ts", gap).alias("s"))
           .agg(F.count("*").alias("n"), F.max("event_ts").alias("last_ts")))
    return agg.select("series", F.col("s.start").cast("timestamp_ntz").alias("run_start"),
                      F.col("last_ts").cast("timestamp_ntz").alias("run_last"), "n")


class DriftState:
    """Counts per (feature, bin) of all rows a feed has brought, and the index against a stored reference.

    An epoch's counts are those of the epoch before it and of its own rows, written to one of two slots in turn.
    An epoch that is run again starts from the slot the epoch before it left and overwrites its own, so
    nothing counts twice.  What is kept does not grow with the feed: features x bins rows, twice.
    """

    COUNTS = "feature string, bin int, n bigint, epoch bigint"

    def __init__(self, reference: DataFrame, features: Sequence[str], edges: DataFrame):
        self.spark, self.features = reference.sparkSession, list(features)
        self.base = work_dir(self.spark, "stream-drift")
        edges.write.parquet(f"{self.base}/edges")
        self.edges = self.spark.read.parquet(f"{self.base}/edges")
        dr.binned(dr.value_counts(reference, F.lit(False), self.features), self.edges).select(
            "feature", "bin", "ref_n").write.parquet(f"{self.base}/reference")

    def _slot(self, epoch: int) -> str:
        return f"{self.base}/slot{epoch % 2}"

    def merge(self, batch: DataFrame, epoch: int) -> None:
        """Add the rows of one epoch (a foreachBatch handler)."""
        own = dr.binned(dr.value_counts(batch, F.lit(True), self.features), self.edges).select(
            "feature", "bin", F.col("cur_n").alias("n"))
        if epoch > 0:
            before = self.spark.read.schema(self.COUNTS).parquet(self._slot(epoch - 1))
            expected = F.when(F.col("epoch") == epoch - 1, F.col("n")).otherwise(
                F.raise_error(F.lit(f"counts before epoch {epoch} are missing")).cast("bigint"))
            own = own.unionByName(before.select("feature", "bin", expected.alias("n")))
        (own.groupBy("feature", "bin").agg(F.sum("n").alias("n"))
         .withColumn("epoch", F.lit(epoch).cast("bigint")).write.mode("overwrite").parquet(self._slot(epoch)))
        self.epoch = epoch

    def table(self) -> DataFrame:
        """``feature, psi, status`` of everything merged so far: what the batch operator gives for these rows."""
        counts = self.spark.read.schema(self.COUNTS).parquet(self._slot(self.epoch)).select(
            "feature", "bin", F.lit(0).cast("bigint").alias("ref_n"), F.col("n").alias("cur_n"))
        known = self.spark.read.parquet(f"{self.base}/reference").select(
            "feature", "bin", "ref_n", F.lit(0).cast("bigint").alias("cur_n"))
        both = counts.unionByName(known).groupBy("feature", "bin").agg(
            F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
        return dr.psi_from_bins(dr.with_empty_bins(both, self.edges)).withColumn(
            "status", fc.status_band("psi", config.PSI_WARN, config.PSI_ALERT))


def drift_so_far(stream: DataFrame, state: DriftState) -> DataFrame:
    """Drain the feed into ``state``; the drift of all its rows against the reference."""
    run_batches(stream, "stream-drift-run", state.merge)
    return state.table()


def score(stream: DataFrame, model: PipelineModel, to_features: Callable[[DataFrame], DataFrame],
          keep: Sequence[str], bounds: dict, members: dict) -> tuple[DataFrame, DataFrame]:
    """Arriving conditions: valid rows scored, the rest routed with reasons."""
    checked = check_bounds(stream, bounds, members)
    good = to_features(checked.where("is_valid"))
    bad = checked.where(~F.col("is_valid")).select(*keep, F.array_join("reasons", ",")
                                                   .alias("reasons"))
    return model.transform(good).select(*keep, "prediction"), bad

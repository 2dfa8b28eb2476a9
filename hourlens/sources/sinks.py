"""Stage tables, short reports, nested documents and the run ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlens.session import work_dir

LEDGER = "experiment string, run string, model string, kind string, name string, value double"


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> str:
    """Write a stage table; partition columns prune later scans."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def create_table(df: DataFrame, name: str, database: str = "hourlens") -> str:
    """CREATE TABLE AS: a catalogue table with column statistics, replaced if it exists; its full name.

    The database lives in the shared working folder, so a session never meets another one's files."""
    spark = df.sparkSession
    if not spark.catalog.databaseExists(database):
        spark.sql(f"CREATE DATABASE {database} LOCATION '{work_dir(spark, database)}'")
    full = f"{database}.{name}"
    df.write.mode("overwrite").format("parquet").saveAsTable(full)
    spark.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS FOR ALL COLUMNS")
    return full


def write_top_csv(df: DataFrame, path: str, order: Sequence[Column], n: int = 25) -> str:
    df.orderBy(*order).limit(n).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def record_run(rows: DataFrame, path: str) -> str:
    """Put runs of (experiment, run, model, kind, name, value) rows into the ledger.

    A run is a partition of its own and is written as a whole: recorded again, by a retried job or on
    purpose, it replaces itself and no other run is touched."""
    cols = [c.split()[0] for c in LEDGER.split(", ")]
    (rows.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("experiment", "run").parquet(path))
    return path


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def ledger_rows(metrics: DataFrame, experiment: str, run: str, model: str,
                names: Sequence[str], kind: str = "metric") -> DataFrame:
    """Wide metrics (with a model column) to ledger rows."""
    wide = metrics.select(F.col(model).alias("model"),
                          *[F.col(n).cast("double").alias(n) for n in names])
    return wide.unpivot(["model"], list(names), "name", "value").select(
        F.lit(experiment).alias("experiment"), F.lit(run).alias("run"), "model",
        F.lit(kind).alias("kind"), "name", "value")


def best_run(ledger: DataFrame, metric: str) -> DataFrame:
    """Best run per experiment by a metric, the first run name on a tie."""
    pick = F.min_by(F.struct("run", "model", "value"),
                    F.struct((-F.col("value")).alias("v"), "run", "model"))
    return (ledger.where((F.col("kind") == "metric") & (F.col("name") == metric))
            .groupBy("experiment").agg(pick.alias("_b")).select("experiment", "_b.*"))

"""Scans and what is checked right after them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlens.functions import columns as fc

CORRUPT = "_corrupt"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType,
             keep_corrupt: bool = True) -> DataFrame:
    """Headered CSV under a fixed schema; unreadable lines stay countable.

    A missing path fails when the plan is built, as Spark does it.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(full).csv(path)
    return reader.schema(schema).csv(path)


def cast_text(df: DataFrame, schema: T.StructType,
              sentinels: Mapping[str, str] | None = None) -> DataFrame:
    """All-text columns to typed ones; text that does not fit becomes null."""
    sentinels = sentinels or {}
    out = []
    for f in schema.fields:
        c = fc.sentinel_to_null(f.name, sentinels[f.name]) if f.name in sentinels \
            else F.col(f.name)
        out.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def cast_failures(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, how many non-null texts do not fit the wanted type."""
    names = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    wide = df.agg(*[fc.count_rows(F.col(f.name).isNotNull()
                                  & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
                    for f in schema.fields if f.name in names])
    return wide.unpivot([], names, "column", "n_failed")


def scan_table(spark: SparkSession, path_or_name: str) -> DataFrame:
    """A Parquet folder (has a slash) or a catalogue table."""
    return spark.read.parquet(path_or_name) if "/" in path_or_name else \
        spark.table(path_or_name)


def schema_check(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``column, status`` with status ok, missing or extra; reads no data."""
    rows = [(c, "ok" if c in df.columns else "missing") for c in expected]
    rows += [(c, "extra") for c in df.columns if c not in expected]
    return df.sparkSession.createDataFrame(rows, "column string, status string")


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The same frame, or an error naming every missing column."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return df


def load_verify(df: DataFrame, ts: str, typed: Sequence[str] = ()) -> DataFrame:
    """Row count, first and last timestamp, and the storage type of columns."""
    types = dict(df.dtypes)
    return df.agg(F.count("*").alias("row_count"), F.min(ts).alias("first_ts"),
                  F.max(ts).alias("last_ts")).select(
        "*", *[F.lit(types[c]).alias(f"{c}_type") for c in typed])


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)

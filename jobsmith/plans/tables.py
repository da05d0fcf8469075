"""Access to the driver tables (one Parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    p = os.path.join(sf_dir, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in sf_dir else os.path.join(sf_dir, name)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Give CPU-heavy per-row work (whole-text regexes) every core: when a scan
    yields fewer partitions than the default parallelism (few row groups),
    hash-partition on ``key`` (or round-robin). No-op when already wide enough."""
    try:
        n = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= n:
            return df
    except Exception:  # noqa: BLE001 - no RDD view (e.g. Spark Connect): leave the plan as is
        return df
    return df.repartition(n, key) if key else df.repartition(n)


def read_spread(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    return spread(read(spark, sf_dir, name), key)


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    for n in names or TABLES:
        read(spark, sf_dir, n).createOrReplaceTempView(n)

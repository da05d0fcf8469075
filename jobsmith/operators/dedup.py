"""Deduplication policies: latest-wins (batch), first-seen and last-arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsmith import rules as R
from jobsmith.functions.dates import SENTINEL_TS


def source_priority(source: Column | str = "source") -> Column:
    """CSV rows are ingested after API rows in a batch, so they win ties."""
    s = F.col(source) if isinstance(source, str) else source
    return F.when(s == R.CSV_SOURCE, 2).when(s == R.API_SOURCE, 1).otherwise(0)


def _latest_order(tie_breakers: Sequence[Column]) -> list[Column]:
    sentinel = F.lit(SENTINEL_TS).cast("timestamp")
    return [F.coalesce(F.col("publication_date").cast("timestamp"), sentinel).desc(),
            F.coalesce(F.col("ingested_at").cast("timestamp"), sentinel).desc(),
            source_priority().desc(), *tie_breakers]


def dedup_latest(df: DataFrame, key: str = "job_hash", tie_breakers: Sequence[Column] = ()) -> DataFrame:
    """One row per key: latest publication date, then latest ingest, then csv over
    api, then the caller's tie-breakers (e.g. later arrival position first).

    ``row_number() = 1`` lets Spark insert a map-side WindowGroupLimit, so a hot
    key ships one row per map partition instead of all its copies.
    """
    w = Window.partitionBy(key).orderBy(*_latest_order(tie_breakers))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_latest_agg(df: DataFrame, key: str = "job_hash", tie_breakers: Sequence[Column] = ()) -> DataFrame:
    """Same result as :func:`dedup_latest` via ``max_by`` (partial aggregation).

    ``tie_breakers`` are ascending-is-better here and must be non-null.
    """
    sentinel = F.lit(SENTINEL_TS).cast("timestamp")
    order = F.struct(F.coalesce(F.col("publication_date").cast("timestamp"), sentinel),
                     F.coalesce(F.col("ingested_at").cast("timestamp"), sentinel),
                     source_priority(), *tie_breakers)
    cols = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("_w"))
            .select(key, *[F.col("_w")[c].alias(c) for c in cols]))


def dedup_first_seen(df: DataFrame, key: str, arrival: Sequence[Column]) -> DataFrame:
    """Batch form of first-seen-wins: earliest arrival per key."""
    w = Window.partitionBy(key).orderBy(*arrival)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def collapse_last_arrival(df: DataFrame, key: str, seq: str, *, keep_first: Sequence[str] = ("source",),
                          last_non_null: Sequence[str] = ("job_url",)) -> DataFrame:
    """Fold a batch of messages per key as sequential upserts would.

    Every column is the last message's, except ``last_non_null`` columns (last
    non-NULL value: ``COALESCE(new, old)`` folded) and ``keep_first`` columns
    (first message's value: not updated on conflict). Partial aggregation keeps a
    hot key from landing whole in one task.
    """
    s = F.col(seq)
    others = [c for c in df.columns if c not in (key, seq, *keep_first, *last_non_null)]
    aggs = [F.max_by(F.struct(*others), s).alias("_last"), F.max(s).alias(seq)]
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), s)).alias(c) for c in last_non_null]
    aggs += [F.min_by(F.col(c), s).alias(c) for c in keep_first]
    out = df.groupBy(key).agg(*aggs)
    return out.select(key, *[F.col("_last")[c].alias(c) for c in others], *last_non_null, *keep_first, seq) \
        .select(*df.columns)

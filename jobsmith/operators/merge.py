"""Keyed merges (upserts) without MERGE INTO, data-quality checks, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.schema import METRICS_SCHEMA, POSTING_SCHEMA, UNIFIED_COLUMNS


def upsert(target: DataFrame, source: DataFrame, key: str, *, columns: Sequence[str] | None = None,
           coalesce_new_old: Sequence[str] = (), keep_old: Sequence[str] = (),
           check_unique: bool = True) -> DataFrame:
    """``INSERT .. ON CONFLICT (key) DO UPDATE`` without MERGE INTO: one full outer join.

    Matched keys take the source value for every column, except
    ``coalesce_new_old`` columns (``COALESCE(new, old)``) and ``keep_old``
    columns (not updated). Unmatched target rows stay; unmatched source rows are
    inserted. The join strategy is left to AQE, which knows the sides' sizes.

    With ``check_unique`` a key present twice in ``source``, or a NULL key, fails
    the job whatever columns are read: a partially aggregated per-key count feeds
    a scalar subquery in a filter of its own, so even a key repeated across a
    third of the batch never lands in one task. Pass a source that is stored (a
    staging table), as it is read for the check and for the join.
    """
    cols = [c for c in (columns or target.columns) if c != key]
    s = source.select(key, *cols).withColumn("_in_s", F.lit(True))
    t = target.select(key, *cols).withColumn("_in_t", F.lit(True))
    j = t.alias("t").join(s.alias("s"), on=key, how="full_outer")
    in_s = F.coalesce(F.col("s._in_s"), F.lit(False))
    in_t = F.coalesce(F.col("t._in_t"), F.lit(False))
    out: list[Column] = [F.col(key)]
    for c in cols:
        new, old = F.col(f"s.{c}"), F.col(f"t.{c}")
        if c in coalesce_new_old:
            v = F.when(in_s, F.coalesce(new, old)).otherwise(old)
        elif c in keep_old:
            v = F.when(in_t, old).otherwise(new)
        else:
            v = F.when(in_s, new).otherwise(old)
        out.append(v.alias(c))
    res = j.select(*out)
    if check_unique:
        bad = (source.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(key).isNull())
               .agg(F.count(F.lit(1))).scalar())
        res = res.filter(F.when(bad > 0, F.raise_error(F.concat(
            F.lit("duplicate key or NULL key in upsert source ("), bad.cast("string"), F.lit(" keys)"))).cast("boolean"))
            .otherwise(F.lit(True)))
    return res


def upsert_clean(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Clean-table upsert: every column overwritten except job_url = COALESCE(new, old)."""
    return upsert(target, staging, "job_hash", columns=UNIFIED_COLUMNS, coalesce_new_old=("job_url",)) \
        .select(*UNIFIED_COLUMNS)


def upsert_stream(target: DataFrame, batch: DataFrame, columns: Sequence[str], *,
                  check_unique: bool = True) -> DataFrame:
    """Stream-table upsert: source is not updated; job_url = COALESCE(new, old)."""
    return upsert(target, batch, "job_hash", columns=columns, coalesce_new_old=("job_url",),
                  keep_old=("source",), check_unique=check_unique).select(*columns)


def upsert_metrics(old: DataFrame, new: DataFrame, key: str = "metric_date") -> DataFrame:
    """Replace rows of recomputed days; days absent from ``new`` keep their old row."""
    return old.join(new.select(key), on=key, how="left_anti").unionByName(new)


def empty_like(spark: SparkSession, schema=POSTING_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def empty_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METRICS_SCHEMA)


def full_refresh_requested(flag: str | None) -> bool:
    """``FULL_REFRESH`` in {1, true, yes}, case-insensitive."""
    return (flag or "").lower() in ("1", "true", "yes")


# --- data quality -----------------------------------------------------------

def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def duplicate_urls(df: DataFrame, url: str = "job_url") -> DataFrame:
    """URLs held by more than one row (only non-NULL, non-empty URLs are unique)."""
    return duplicate_keys(df.filter(F.col(url).isNotNull() & (F.col(url) != "")), url)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the NULL count of each column (single pass)."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in columns])


def split_quarantine(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column set, rows missing one)."""
    ok = None
    for c in required:
        cond = F.col(c).isNotNull()
        ok = cond if ok is None else ok & cond
    return df.filter(ok), df.filter(~ok)

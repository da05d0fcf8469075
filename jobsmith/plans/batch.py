"""Composite batch jobs: transform (normalise, union, dedup) and load
(staging overwrite, clean upsert, metrics upsert)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.functions.dates import day_of
from jobsmith.functions.enrich import with_enrichment
from jobsmith.operators.dedup import dedup_latest
from jobsmith.operators.merge import empty_like, full_refresh_requested, upsert_clean, upsert_metrics
from jobsmith.operators.metrics import daily_metrics
from jobsmith.operators.normalize import normalize_csv, normalize_paged_api, union_sources
from jobsmith.plans.snapshots import Snapshot
from jobsmith.schema import METRICS_SCHEMA, POSTING_SCHEMA, UNIFIED_COLUMNS, conform


def transform(api_postings: DataFrame, csv_rows: DataFrame, *, api_clock: Column, csv_clock: Column,
              keep: Sequence[str] = (), tie_breakers: Sequence[Column] = (), **rules) -> DataFrame:
    """API postings (VARIANT ``j``) and CSV rows -> one deduplicated posting frame.

    API rows are stamped before CSV rows, as when the two sources are read in
    that order, so equal publication dates resolve to the CSV copy. The
    whole-text enrichment is per row and plays no part in the dedup order, so
    it runs after the dedup, on the surviving rows only.
    """
    api = normalize_paged_api(api_postings, clock=api_clock, keep=list(keep), enrich=False)
    csv = normalize_csv(csv_rows, clock=csv_clock, keep=list(keep), enrich=False)
    winners = dedup_latest(union_sources(api, csv), tie_breakers=tie_breakers)
    enriched = with_enrichment(winners.drop("skills_extracted", "role_type", "seniority_level"),
                               "title", "description", **rules)
    return conform(enriched, keep=list(keep))


def load(spark: SparkSession, postings: DataFrame, *, staging_path: str, clean: Snapshot, metrics: Snapshot,
         full_refresh: bool | str | None = False, clock: Column | None = None,
         incremental_metrics: bool = False) -> tuple[DataFrame, DataFrame]:
    """Staging overwrite -> clean upsert -> metrics upsert. Returns (clean, metrics).

    Each step reads the previous step's written output, which also cuts lineage.
    A full refresh empties the clean table but keeps metrics of vanished days.

    By default every day is recomputed from the whole clean table. With
    ``incremental_metrics`` only the days a batch can change are recomputed —
    days of the incoming rows and the previous days of the rows they replace —
    which gives the same table whenever the metrics were in sync with the clean
    table before the load, at a cost proportional to the batch, not the table.
    """
    refresh = full_refresh if isinstance(full_refresh, bool) else full_refresh_requested(full_refresh)
    postings.select(*UNIFIED_COLUMNS).write.mode("overwrite").parquet(staging_path)
    staging = spark.read.schema(POSTING_SCHEMA).parquet(staging_path)
    target = empty_like(spark) if refresh else clean.read()
    clean.write(upsert_clean(target, staging))
    clean_df = clean.read()
    source = clean_df
    if incremental_metrics:
        replaced = target.join(staging.select("job_hash"), "job_hash", "left_semi")
        days = (staging.select(day_of("publication_date").alias("metric_date"))
                .unionByName(replaced.select(day_of("publication_date").alias("metric_date")))
                .filter(F.col("metric_date").isNotNull()).distinct())
        source = clean_df.withColumn("metric_date", day_of("publication_date")) \
            .join(days, "metric_date", "left_semi").drop("metric_date")
    fresh = daily_metrics(source, clock=clock)
    metrics.write(upsert_metrics(metrics.read(), fresh).select(*METRICS_SCHEMA.names))
    return clean_df, metrics.read()

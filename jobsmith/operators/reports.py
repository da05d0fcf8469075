"""Reporting queries over the clean, stream and metrics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsmith import rules as R
from jobsmith.functions.arrays import unnest
from jobsmith.operators.metrics import company_present, dated


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("c"))


def jobs_over_time(jobs: DataFrame) -> DataFrame:
    return (dated(jobs).groupBy(F.col("metric_date").alias("day")).agg(F.count("*").alias("jobs"))
            .orderBy("day"))


def jobs_by_role(jobs: DataFrame, coalesce_role: bool = True) -> DataFrame:
    role = F.coalesce("role_type", F.lit(R.UNSPECIFIED_ROLE)) if coalesce_role else F.col("role_type")
    return (jobs.groupBy(role.alias("role_type")).agg(F.count("*").alias("jobs"))
            .orderBy(F.col("jobs").desc(), F.col("role_type").asc_nulls_first()))


def top_companies(jobs: DataFrame, k: int = R.TOP_K) -> DataFrame:
    return (jobs.filter(company_present()).groupBy("company").agg(F.count("*").alias("jobs"))
            .orderBy(F.col("jobs").desc(), F.col("company")).limit(k))


def top_skills(jobs: DataFrame, k: int = R.TOP_K) -> DataFrame:
    return (unnest(jobs, "skills_extracted", "skill").groupBy("skill")
            .agg(F.count("*").alias("jobs")).orderBy(F.col("jobs").desc(), F.col("skill").asc_nulls_first())
            .limit(k))


def latest_stream(stream: DataFrame, k: int = R.LATEST_STREAM_ROWS) -> DataFrame:
    """Newest ``k`` stream rows; ties on ingest time break by key."""
    return (stream.orderBy(F.col("ingested_at").desc_nulls_last(), F.col("job_hash"))
            .limit(k).select("ingested_at", "title", "company", "location", "job_url"))


def dashboard(clean: DataFrame, stream: DataFrame, metrics: DataFrame) -> dict[str, DataFrame]:
    """Every dashboard query, lazily (nothing runs until a result is read)."""
    return {
        "total_jobs": total_rows(clean),
        "total_stream": total_rows(stream),
        "days_with_metrics": total_rows(metrics),
        "jobs_over_time": jobs_over_time(clean),
        "jobs_by_role": jobs_by_role(clean),
        "top_companies": top_companies(clean),
        "top_skills": top_skills(clean),
        "latest_stream": latest_stream(stream),
    }

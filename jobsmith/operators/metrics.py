"""Daily metrics: per-day totals, top-k companies and skills, role counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsmith import rules as R
from jobsmith.functions.arrays import unnest
from jobsmith.functions.dates import day_of


def company_present(c: Column | str = "company") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull() & (col != "")


def dated(jobs: DataFrame) -> DataFrame:
    """Rows with a publication date, with their day."""
    return (jobs.filter(F.col("publication_date").isNotNull())
            .withColumn("metric_date", day_of("publication_date")))


def counts_by_day(jobs: DataFrame) -> DataFrame:
    return dated(jobs).groupBy("metric_date").agg(F.count("*").alias("total_jobs"))


def counts_by_day_company(jobs: DataFrame) -> DataFrame:
    return (dated(jobs).filter(company_present())
            .groupBy("metric_date", "company").agg(F.count("*").alias("jobs")))


def counts_by_day_skill(jobs: DataFrame) -> DataFrame:
    return (unnest(dated(jobs), "skills_extracted", "skill", keep=["metric_date"])
            .groupBy("metric_date", "skill").agg(F.count("*").alias("jobs")))


def counts_by_day_role(jobs: DataFrame) -> DataFrame:
    return (dated(jobs).select("metric_date", F.coalesce("role_type", F.lit(R.UNSPECIFIED_ROLE)).alias("role_type"))
            .groupBy("metric_date", "role_type").agg(F.count("*").alias("jobs")))


def top_k_per_group(counts: DataFrame, group: list[str], label: str, n: str = "jobs", k: int = R.TOP_K) -> DataFrame:
    """Top ``k`` rows per group by count desc, label asc (row_number <= k)."""
    w = Window.partitionBy(*group).orderBy(F.col(n).desc(), F.col(label).asc_nulls_first())
    # filter on the bare row_number (keeps the map-side WindowGroupLimit), then widen
    return (counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("long")))


def _sorted_pairs(kind: str, name: str) -> Column:
    """Top-k entries of one kind as an array of {jobs, <name>} ordered by rank."""
    entry = F.when(F.col("kind") == kind, F.struct("rank", F.col("n").alias("jobs"), F.col("label").alias(name)))
    return F.transform(F.sort_array(F.collect_list(entry)), lambda x: F.struct(x["jobs"], x[name].alias(name)))


def metric_entries(jobs: DataFrame) -> DataFrame:
    """(metric_date, kind, label) of every dated posting: a total entry ``t``, a role entry ``r``, a company
    entry ``c`` when there is one, and an ``s`` entry a skill."""
    empty = F.array().cast("array<struct<kind:string,label:string>>")
    comp = F.col("company")
    entries = F.concat(
        F.array(F.struct(F.lit("t").alias("kind"), F.lit("").alias("label"))),
        F.array(F.struct(F.lit("r").alias("kind"),
                         F.coalesce(F.col("role_type"), F.lit(R.UNSPECIFIED_ROLE)).alias("label"))),
        F.when(company_present(comp), F.array(F.struct(F.lit("c").alias("kind"), comp.alias("label"))))
        .otherwise(empty),
        F.transform(F.coalesce(F.col("skills_extracted"), F.array().cast("array<string>")),
                    lambda s: F.struct(F.lit("s").alias("kind"), s.alias("label"))),
    )
    # entries always hold the total and role entries, so the outer form yields
    # the same rows and keeps the optimizer from copying them into a filter
    return dated(jobs).select("metric_date", F.inline_outer(entries))


def metrics_of_counts(counted: DataFrame, *, k: int = R.TOP_K, clock: Column | None = None) -> DataFrame:
    """Metrics rows of (metric_date, kind, label, n) counts."""
    lane = F.when(F.col("kind").isin("t", "r"), F.col("label"))
    w = Window.partitionBy("metric_date", "kind", lane).orderBy(F.col("n").desc(), F.col("label").asc_nulls_first())
    ranked = counted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    role = F.when(F.col("kind") == "r", F.struct(F.length("label").alias("len"), F.col("label").alias("k"),
                                                 F.col("n").alias("v")))
    out = ranked.groupBy("metric_date").agg(
        F.sum(F.when(F.col("kind") == "t", F.col("n"))).cast("long").alias("total_jobs"),
        _sorted_pairs("c", "company").alias("top_companies"),
        _sorted_pairs("s", "skill").alias("top_skills"),
        F.map_from_entries(F.transform(F.sort_array(F.collect_list(role)),
                                       lambda x: F.struct(x["k"], x["v"]))).alias("role_counts"),
    )
    return out.withColumn("computed_at", F.current_timestamp() if clock is None else clock)


def daily_metrics(jobs: DataFrame, *, k: int = R.TOP_K, clock: Column | None = None) -> DataFrame:
    """One row per publication day: total_jobs, top_companies, top_skills,
    role_counts and computed_at.

    Single pass over ``jobs``: every row becomes (day, kind, label) entries —
    one total entry, one role entry, one company entry when present, one per
    skill — counted by one partially-aggregated groupBy. Companies and skills
    are ranked per (day, kind) with ``row_number() <= k``; totals and roles get a
    window partition per label, so they always survive the same filter and the
    map-side WindowGroupLimit still applies. Ties on count break by label.
    Role counts are keyed in jsonb order (key length, then bytes).
    """
    counted = metric_entries(jobs).groupBy("metric_date", "kind", "label").agg(F.count("*").alias("n"))
    return metrics_of_counts(counted, k=k, clock=clock)


def metrics_as_json(metrics: DataFrame) -> DataFrame:
    """JSON text columns, as stored in the metrics table."""
    return metrics.select(
        "metric_date", "total_jobs",
        F.to_json("top_companies").alias("top_companies"),
        F.to_json("top_skills").alias("top_skills"),
        F.to_json("role_counts").alias("role_counts"),
        *[c for c in metrics.columns if c == "computed_at"])

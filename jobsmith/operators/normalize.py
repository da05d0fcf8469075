"""Normalisers: raw postings of each source -> the unified posting schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith import rules as R
from jobsmith.functions import json as J
from jobsmith.functions.dates import with_iso_date
from jobsmith.functions.enrich import with_enrichment
from jobsmith.functions.hashing import job_key
from jobsmith.functions.text import empty_to_null, lower_contains, normalize_ws, truthy_text
from jobsmith.schema import MESSAGE_FIELDS, STREAM_COLUMNS, conform


def _clock(clock: Column | None) -> Column:
    return F.current_timestamp() if clock is None else clock


def _finish(df: DataFrame, enrich: bool, keep: list[str], **rules) -> DataFrame:
    """Parse the raw date, add key and enrichment, then conform."""
    out = with_iso_date(df, "_date_raw", "publication_date", "_iso")
    out = out.withColumn("job_hash", job_key("job_url", "title", "company", "_iso"))
    if enrich:
        out = with_enrichment(out, "title", "description", **rules)
    return conform(out, keep=keep)


def normalize_csv(raw: DataFrame, *, clock: Column | None = None, keep: list[str] | None = None,
                  enrich: bool = True, normal: Sequence[str] = (), **rules) -> DataFrame:
    """CSV rows (all STRING, NA tokens already NULL) -> unified postings.

    Missing columns are tolerated; text NULL -> ''; source NULL -> 'csv';
    is_remote by row-level truthiness (NULL -> false); one ingest time per frame.
    ``keep`` carries extra input columns (e.g. an arrival position) through;
    ``enrich=False`` keeps enrichment columns computed upstream (in ``keep``). ``normal``
    columns have been through ``normalize_ws`` upstream and are not scanned again.
    """
    have = set(raw.columns)

    def col(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    def text(name: str) -> Column:
        return col(name) if name in normal else normalize_ws(col(name))

    df = raw.select(
        col("job_id").alias("job_id"),
        F.coalesce(col("source"), F.lit(R.CSV_SOURCE)).alias("source"),
        text("title").alias("title"),
        normalize_ws(col("company")).alias("company"),
        normalize_ws(col("location")).alias("location"),
        truthy_text(col("is_remote")).alias("is_remote"),
        normalize_ws(col("category")).alias("category"),
        col("publication_date").alias("_date_raw"),
        empty_to_null(normalize_ws(col("job_url"))).alias("job_url"),
        text("description").alias("description"),
        _clock(clock).alias("ingested_at"),
        *[F.col(k) for k in (keep or [])],
    )
    return _finish(df, enrich, keep or [], **rules)


def _api_common(j: Column) -> dict[str, Column]:
    company = normalize_ws(J.object_or_scalar(J.vget(j, "$.company"), "display_name"))
    location = normalize_ws(J.object_or_scalar(J.vget(j, "$.location"), "display_name"))
    category = normalize_ws(J.object_or_scalar(J.vget(j, "$.category"), "label"))
    date_raw = J.text_of(J.first_truthy(J.vget(j, "$.created"), J.vget(j, "$.publication_date"),
                                        J.vget(j, "$.date")))
    url_raw = J.text_of(J.first_truthy(J.vget(j, "$.redirect_url"), J.vget(j, "$.url"), J.vget(j, "$.job_url")))
    return {
        "job_id": J.text_of(J.vget(j, "$.id")),
        "title": normalize_ws(J.text_of(J.vget(j, "$.title"))),
        "company": company,
        "location": location,
        "category": category,
        "date_raw": date_raw,
        "job_url": empty_to_null(normalize_ws(url_raw)),
        "description": normalize_ws(J.text_of(J.vget(j, "$.description"))),
    }


def normalize_paged_api(postings: DataFrame, *, posting_col: str = "j", clock: Column | None = None,
                        keep: list[str] | None = None, enrich: bool = True, **rules) -> DataFrame:
    """Nested API postings (a VARIANT column) -> unified postings.

    Fallback chains are falsy chains on raw values: date created -> publication_date
    -> date, URL redirect_url -> url -> job_url; company/location/category accept
    an object (display_name/label) or a scalar; remote = location mentions 'remote'.
    """
    c = _api_common(F.col(posting_col))
    df = postings.select(
        c["job_id"].alias("job_id"), F.lit(R.API_SOURCE).alias("source"), c["title"].alias("title"),
        c["company"].alias("company"), c["location"].alias("location"),
        lower_contains(c["location"], "remote").alias("is_remote"), c["category"].alias("category"),
        c["date_raw"].alias("_date_raw"),
        c["job_url"].alias("job_url"), c["description"].alias("description"),
        _clock(clock).alias("ingested_at"), *[F.col(k) for k in (keep or [])])
    return _finish(df, enrich, keep or [], **rules)


def normalize_flat_api(postings: DataFrame, *, posting_col: str = "j", clock: Column | None = None,
                       keep: list[str] | None = None, **rules) -> DataFrame:
    """Flat API postings -> unified postings; every posting is remote."""
    j = F.col(posting_col)
    date_raw = J.text_of(J.first_truthy(J.vget(j, "$.publication_date"), J.vget(j, "$.date")))
    url_raw = J.text_of(J.first_truthy(J.vget(j, "$.url"), J.vget(j, "$.job_url")))
    df = postings.select(
        J.text_of(J.vget(j, "$.id")).alias("job_id"), F.lit(R.API_SOURCE).alias("source"),
        normalize_ws(J.text_of(J.vget(j, "$.title"))).alias("title"),
        normalize_ws(J.text_of(J.first_truthy(J.vget(j, "$.company_name"), J.vget(j, "$.company")))).alias("company"),
        normalize_ws(J.text_of(J.first_truthy(J.vget(j, "$.candidate_required_location"),
                                              J.vget(j, "$.location")))).alias("location"),
        F.lit(True).alias("is_remote"),
        normalize_ws(J.text_of(J.vget(j, "$.category"))).alias("category"),
        date_raw.alias("_date_raw"),
        empty_to_null(normalize_ws(url_raw)).alias("job_url"),
        normalize_ws(J.text_of(J.vget(j, "$.description"))).alias("description"),
        _clock(clock).alias("ingested_at"), *[F.col(k) for k in (keep or [])])
    return _finish(df, True, keep or [], **rules)


def stream_message(postings: DataFrame, *, posting_col: str = "j", keep: list[str] | None = None) -> DataFrame:
    """Nested API postings -> 11-field stream messages (ISO text date, no enrichment)."""
    c = _api_common(F.col(posting_col))
    df = postings.select(
        c["job_id"].alias("job_id"), F.lit(R.API_SOURCE).alias("source"), c["title"].alias("title"),
        c["company"].alias("company"), c["location"].alias("location"),
        lower_contains(c["location"], "remote").alias("is_remote"), c["category"].alias("category"),
        c["date_raw"].alias("_date_raw"), c["job_url"].alias("job_url"), c["description"].alias("description"),
        *[F.col(k) for k in (keep or [])])
    df = with_iso_date(df, "_date_raw", None, "publication_date")
    df = df.withColumn("job_hash", job_key("job_url", "title", "company", "publication_date"))
    return df.select(*MESSAGE_FIELDS, *(keep or []))


def stream_payload(messages: DataFrame, *, value_col: str = "value", clock: Column | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """Decoded stream message -> stream-table row.

    source falsy -> 'api'; is_remote missing -> true, JSON null -> false, else
    truthiness; the date is re-parsed; text passes through untouched (may be NULL).
    """
    messages = messages.withColumn("_p", J.decode(F.col(value_col)))
    p = F.col("_p")

    def raw(name: str) -> Column:
        v = J.vget(p, f"$.{name}")
        return F.when(J.kind(v) == "BOOLEAN",
                      F.when(J.vget(v, "$", "string") == "true", F.lit("True")).otherwise(F.lit("False"))
                      ).otherwise(J.vget(v, "$", "string"))

    remote_v = J.vget(p, "$.is_remote")
    df = messages.select(
        raw("job_hash").alias("job_hash"), raw("job_id").alias("job_id"),
        F.coalesce(J.text_of(J.vget(p, "$.source")), F.lit(R.API_SOURCE)).alias("source"),
        raw("title").alias("title"), raw("company").alias("company"), raw("location").alias("location"),
        F.when(remote_v.isNull(), F.lit(True)).otherwise(J.truthy(remote_v)).alias("is_remote"),
        raw("category").alias("category"),
        J.text_of(J.vget(p, "$.publication_date")).alias("_date_raw"),
        raw("job_url").alias("job_url"), raw("description").alias("description"),
        _clock(clock).alias("ingested_at"), *[F.col(k) for k in (keep or [])])
    df = with_iso_date(df, "_date_raw", "publication_date", None)
    return df.select(*STREAM_COLUMNS, *(keep or []))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Concatenate normalised frames by column name (UNION ALL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

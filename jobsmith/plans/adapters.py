"""Driver tables -> posting-shaped data, so every operator runs on real rows.

``raw_postings``: one raw (CSV-shaped, all STRING) posting per document:
job_id = doc_id, source = document source, title = first text line,
description = the whole text, location = language, company = nation of the
order's customer (absent for pending orders), category = market segment,
is_remote = a segment-derived truthy/falsy text, publication_date = order date
rendered in a priority-dependent ISO form (low priority: a non-ISO form that
must parse to NULL), job_url = the page URL with the same id (absent for most).

Enrichment runs on the document side before any join, so the text itself never
crosses a shuffle when only derived columns are needed downstream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.functions.enrich import with_enrichment
from jobsmith.functions.text import normalize_ws
from jobsmith.operators.normalize import normalize_csv
from jobsmith.plans.tables import read, read_spread

# Keyword dictionary for the driver documents (the posting keywords never occur
# in that prose): common words, a domain word and two multi-word phrases.
DOC_KEYWORDS: list[str] = ["the", "and", "of", "to", "in", "is", "that", "with", "for", "this", "by",
                           "from", "de", "la", "der", "und", "el", "license", "apache license",
                           "mit license"]

# Fixed clock for reproducible results.
FIXED_CLOCK = "2026-01-01 00:00:00"

# Raw is_remote text per market segment (truthy, falsy, numeric, free text, missing).
REMOTE_TEXT = {"BUILDING": "true", "MACHINERY": "false", "AUTOMOBILE": "0", "FURNITURE": "yes"}


def clock() -> Column:
    return F.lit(FIXED_CLOCK).cast("timestamp")


def date_text(ts: Column, priority: Column) -> Column:
    """Order date as text, in a form chosen by the order priority."""
    return (F.when(priority == "1-URGENT", F.date_format(ts, "yyyy-MM-dd"))
            .when(priority == "2-HIGH", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(priority == "3-MEDIUM", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
            .when(priority == "4-NOT SPECIFIED", F.date_format(ts, "yyyyMMdd"))
            .otherwise(F.date_format(ts, "dd/MM/yyyy")))


def remote_text(segment: Column) -> Column:
    out = None
    for seg, txt in REMOTE_TEXT.items():
        out = F.when(segment == seg, F.lit(txt)) if out is None else out.when(segment == seg, F.lit(txt))
    return out


def order_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow per-order attributes: key, company, category, remote text, date text."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                             "o_orderpriority")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded.
    oc = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey, "left"))
    return oc.select(
        F.col("o_orderkey").alias("_key"),
        F.when(F.col("o_orderstatus") != "P", F.col("n_name")).alias("company"),
        F.col("c_mktsegment").alias("category"),
        remote_text(F.col("c_mktsegment")).alias("is_remote"),
        date_text(F.col("o_orderdate"), F.col("o_orderpriority")).alias("publication_date"))


def documents_side(spark: SparkSession, sf_dir: str, keywords: list[str] | None = DOC_KEYWORDS,
                   enrich: bool = True) -> DataFrame:
    d = read_spread(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", "lang", "source")
    out = d.select(F.col("doc_id"), F.col("doc_id").cast("string").alias("job_id"), "source",
                   F.substring_index("text", "\n", 1).alias("title"), F.col("lang").alias("location"),
                   F.col("text").alias("description"))
    if enrich:
        out = out.withColumns({c: normalize_ws(c) for c in ("title", "description")})
        out = with_enrichment(out, "title", "description", keywords=keywords)
    return out


def raw_postings(spark: SparkSession, sf_dir: str, *, keywords: list[str] | None = DOC_KEYWORDS,
                 enrich: bool = True) -> DataFrame:
    """Raw posting rows (plus ``doc_id``; plus enrichment columns when ``enrich``, of which title and description are
    normalised)."""
    docs = documents_side(spark, sf_dir, keywords, enrich)
    attrs = order_attributes(spark, sf_dir)
    urls = read(spark, sf_dir, "pages").select(F.col("page_id").alias("_pid"), F.col("url").alias("job_url"))
    return (docs.join(attrs, docs.doc_id == attrs._key, "left")
            .join(urls, docs.doc_id == urls._pid, "left")
            .drop("_key", "_pid"))


def postings(spark: SparkSession, sf_dir: str, *, keywords: list[str] | None = DOC_KEYWORDS) -> DataFrame:
    """Unified postings of the driver documents (plus ``doc_id``)."""
    raw = raw_postings(spark, sf_dir, keywords=keywords, enrich=True)
    return normalize_csv(raw, clock=clock(), enrich=False, normal=("title", "description"),
                         keep=["doc_id", "skills_extracted", "role_type", "seniority_level"])


def event_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posting-shaped rows for per-day metrics where top-k really cuts:
    day = event day, company = user, role = event type, skill = props.k."""
    from jobsmith.functions import json as J
    e = read(spark, sf_dir, "events").select("ts", "user_id", "event_type", "props")
    return e.select(F.col("ts").cast("timestamp").alias("publication_date"),
                    F.col("user_id").cast("string").alias("company"),
                    F.col("event_type").alias("role_type"),
                    F.array(J.vget(J.decode(F.col("props")), "$.k", "string")).alias("skills_extracted"))

"""Registered batch queries over the driver tables (one per operator key).

Spark side: library operators on ``adapters.postings`` (documents joined with
orders, customers, nations and pages), on ``events`` and on landed raw files.
SQL side: the same computation written directly in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsmith import rules as R
from jobsmith.functions import json as J
from jobsmith.functions.arrays import unnest
from jobsmith.functions.dates import sentinel_desc, with_iso_date
from jobsmith.functions.enrich import RUNS, extract_keywords_table, with_enrichment
from jobsmith.functions.hashing import sha256_hex
from jobsmith.functions.text import WORD_CHAR, cast_or_null, empty_to_null, lower_contains, normalize_ws, text_concat, \
    truthy_text
from jobsmith.operators import merge as M
from jobsmith.operators import metrics as MT
from jobsmith.operators import reports as RP
from jobsmith.operators.dedup import dedup_latest
from jobsmith.operators.normalize import normalize_csv, normalize_flat_api, normalize_paged_api, \
    union_sources
from jobsmith.plans import adapters as A
from jobsmith.plans import landing as L
from jobsmith.plans import oracle as O
from jobsmith.plans.batch import transform
from jobsmith.plans.registry import jtxt, ntz, query
from jobsmith.plans.store import PostingStore
from jobsmith.plans.tables import read, read_spread
from jobsmith.schema import CSV_COLUMNS, POSTING_SCHEMA, UNIFIED_COLUMNS, conform
from jobsmith.session import materialize, scratch_path
from jobsmith.sources.files import flat_results, paged_results, read_json_documents, read_postings_csv

# ---------------------------------------------------------------- shared pieces

def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RAW = O.raw_postings_cte()
POST = O.postings_ctes()
API_CLOCK = A.FIXED_CLOCK
STORE_BUCKETS = 16
CSV_CLOCK = "2026-01-01 00:00:01"
NA_LIST = ", ".join(O.q(t) for t in R.CSV_NA_TOKENS)
RAW_NA = "rawp_na AS (SELECT doc_id, " + ", ".join(
    f"CASE WHEN {c} IN ({NA_LIST}) THEN NULL ELSE {c} END AS {c}" for c in CSV_COLUMNS) + " FROM rawp)"
POSTING_OUT_SQL = ("job_hash, job_id, source, title, company, location, is_remote, category, publication_date, "
                   "job_url, description, to_json(skills_extracted)::VARCHAR AS skills_extracted, role_type, "
                   "seniority_level, ingested_at, doc_id")
EJOBS = O.event_jobs_cte()


def posting_out(df: DataFrame) -> DataFrame:
    return df.select(*[ntz(c) if c in ("publication_date", "ingested_at") else
                       jtxt(c) if c == "skills_extracted" else F.col(c) for c in UNIFIED_COLUMNS], "doc_id")


def postings(spark: SparkSession, sf: str) -> DataFrame:
    return A.postings(spark, sf)


def csv_postings(spark: SparkSession, sf: str, clock: str = CSV_CLOCK) -> DataFrame:
    """Postings through the real CSV path: land as CSV, read back, normalise."""
    rows = read_postings_csv(spark, L.land_csv(spark, sf))
    rows = rows.withColumn("doc_id", F.col("job_id").cast("bigint"))
    return normalize_csv(rows, clock=F.lit(clock).cast("timestamp"), keep=["doc_id"], keywords=A.DOC_KEYWORDS)


def api_postings(spark: SparkSession, sf: str, clock: str = API_CLOCK) -> DataFrame:
    """Postings through the paged-API path: land pages, read back, normalise."""
    res = paged_results(read_json_documents(spark, L.land_pages(spark, sf)))
    res = res.withColumn("doc_id", J.vget(F.col("j"), "$.id", "bigint"))
    return normalize_paged_api(res, clock=F.lit(clock).cast("timestamp"), keep=["doc_id"],
                               keywords=A.DOC_KEYWORDS)


CSV_POST = O.postings_ctes("rawp_na", "csv_postings", clock=f"TIMESTAMP '{CSV_CLOCK}'")
API_POST = O.api_postings_ctes("api_postings")
# target / source of the merge examples: English+French documents, then French+German+Spanish
# documents re-delivered with upper-cased titles and URLs dropped for non-remote rows.
TARGET_LANGS, SOURCE_LANGS = ("en", "fr"), ("fr", "de", "es")


def merge_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    # both sides come from one posting view: write it once to the shared folder
    # instead of re-running joins and whole-text work for each side
    p = materialize(postings(spark, sf), "postings")
    order = [F.col("doc_id").desc()]
    target = dedup_latest(p.filter(F.col("location").isin(*TARGET_LANGS)), tie_breakers=order)
    src = p.filter(F.col("location").isin(*SOURCE_LANGS)).withColumn("title", F.concat(F.lit("[updated] "), "title")) \
        .withColumn("job_url", F.when(F.col("is_remote"), F.col("job_url"))) \
        .withColumn("ingested_at", F.lit("2026-01-02 00:00:00").cast("timestamp"))
    # the merge reads its source twice (key check and join): stored, its dedup runs once
    return target, materialize(dedup_latest(src, tie_breakers=order), "merge_source")


TGT_SRC = f"""tgt AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_hash
    ORDER BY publication_date DESC NULLS LAST, ingested_at DESC, doc_id DESC) rn
    FROM postings WHERE location IN ('en','fr')) WHERE rn = 1
), src AS (
  SELECT * EXCLUDE (rn) FROM (SELECT * REPLACE ('[updated] ' || title AS title,
      CASE WHEN is_remote THEN job_url END AS job_url, TIMESTAMP '2026-01-02 00:00:00' AS ingested_at),
      row_number() OVER (PARTITION BY job_hash ORDER BY publication_date DESC NULLS LAST, doc_id DESC) rn
    FROM postings WHERE location IN ('fr','de','es')) WHERE rn = 1
)"""
MERGED = """merged AS (
  SELECT coalesce(s.job_hash, t.job_hash) AS job_hash,
    """ + ",\n    ".join(
    (f"CASE WHEN s.job_hash IS NOT NULL THEN coalesce(s.{c}, t.{c}) ELSE t.{c} END AS {c}" if c == "job_url"
     else f"CASE WHEN s.job_hash IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
    for c in UNIFIED_COLUMNS[1:] + ["doc_id"]) + """
  FROM tgt t FULL OUTER JOIN src s ON t.job_hash = s.job_hash
)"""
MERGE_CTES = [RAW, POST, TGT_SRC, MERGED]


def upserted(spark: SparkSession, sf: str) -> DataFrame:
    target, src = merge_inputs(spark, sf)
    return M.upsert(target, src, "job_hash", columns=UNIFIED_COLUMNS + ["doc_id"],
                    coalesce_new_old=("job_url",))


# ---------------------------------------------------------------- 2.1 sources

@query("src_csv", W(RAW, RAW_NA) + "SELECT " + ", ".join(CSV_COLUMNS) + " FROM rawp_na")
def src_csv(spark, sf):
    """Land postings as CSV (quoted, multi-line), read back as STRING with NA tokens -> NULL."""
    return read_postings_csv(spark, L.land_csv(spark, sf))


@query("src_paged_json", W(RAW) + """SELECT CAST(doc_id // 100 + 1 AS BIGINT) AS page,
  CAST(row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS INTEGER) AS pos,
  doc_id AS id, title FROM rawp""")
def src_paged_json(spark, sf):
    """Landed API pages -> postings in fetch order (start page 1, stop at the first empty page)."""
    res = paged_results(read_json_documents(spark, L.land_pages(spark, sf)))
    return res.select("page", "pos", J.vget(F.col("j"), "$.id", "bigint").alias("id"),
                      J.vget(F.col("j"), "$.title", "string").alias("title"))


@query("src_flat_json", W(RAW) + "SELECT doc_id AS id, company AS company_name, location AS candidate_required_location FROM rawp")
def src_flat_json(spark, sf):
    res = flat_results(read_json_documents(spark, L.land_flat(spark, sf)))
    j = F.col("j")
    return res.select(J.vget(j, "$.id", "bigint").alias("id"), J.vget(j, "$.company_name", "string").alias("company_name"),
                      J.vget(j, "$.candidate_required_location", "string").alias("candidate_required_location"))


@query("src_table", "SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2")
def src_table(spark, sf):
    """SQL over a stored table, named by an argument: no view is left in the session."""
    return spark.sql("SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n FROM {orders} GROUP BY 1, 2",
                     orders=read(spark, sf, "orders"))


# ---------------------------------------------------------------- 2.2 sinks (batch)

@query("sink_staging_overwrite", W(RAW, POST) + f"SELECT {POSTING_OUT_SQL} FROM postings")
def sink_staging_overwrite(spark, sf):
    """Overwrite a staging table twice; only the second load remains."""
    path = scratch_path(spark, "staging")
    postings(spark, sf).filter(F.col("location") == "en").write.mode("overwrite").parquet(path)
    postings(spark, sf).write.mode("overwrite").parquet(path)
    return posting_out(spark.read.parquet(path))


@query("sink_upsert_clean", W(*MERGE_CTES) + "SELECT " + POSTING_OUT_SQL.replace("job_hash,", "job_hash,", 1)
       + " FROM merged")
def sink_upsert_clean(spark, sf):
    """Insert-or-update by job_hash: all columns from the source, job_url = COALESCE(new, old); only the
    partitions that the source's keys fall into are read and replaced."""
    target, src = merge_inputs(spark, sf)
    store = PostingStore(spark, scratch_path(spark, "upsert"), STORE_BUCKETS, (T.StructField("doc_id", T.LongType()),),
                         with_metrics=False)
    store.load(target)
    store.load(src)
    return posting_out(store.postings())


@query("sink_full_refresh", W(*MERGE_CTES) + f"SELECT {POSTING_OUT_SQL} FROM src")
def sink_full_refresh(spark, sf):
    """Full refresh: the clean table is emptied, then the source is upserted."""
    _, src = merge_inputs(spark, sf)
    assert M.full_refresh_requested("YES")
    out = M.upsert(M.empty_like(spark, POSTING_SCHEMA).withColumn("doc_id", F.lit(None).cast("bigint")), src,
                   "job_hash", columns=UNIFIED_COLUMNS + ["doc_id"], coalesce_new_old=("job_url",))
    return posting_out(out)


@query("sink_upsert_metrics", W(*MERGE_CTES[:-1], O.metrics_sql("tgt").replace("metrics AS", "m_old AS"),
                                O.metrics_sql("src").replace("m_", "n_").replace("metrics AS", "m_new AS"))
       + """SELECT * FROM m_new UNION ALL
SELECT * FROM m_old WHERE metric_date NOT IN (SELECT metric_date FROM m_new)""")
def sink_upsert_metrics(spark, sf):
    """Metrics upsert after a full refresh: recomputed days replaced, vanished days keep their row."""
    target, src = merge_inputs(spark, sf)
    old = MT.daily_metrics(target, clock=A.clock())
    new = MT.daily_metrics(src, clock=A.clock())
    return MT.metrics_as_json(M.upsert_metrics(old, new)).drop("computed_at")


# ---------------------------------------------------------------- 2.3 projections and normalisers

@query("proj_unified_schema", W(RAW) + """SELECT NULL::VARCHAR AS job_hash, CAST(doc_id AS VARCHAR) AS job_id,
  source, title, NULL::VARCHAR AS company, location, NULL::BOOLEAN AS is_remote, NULL::VARCHAR AS category,
  NULL::TIMESTAMP AS publication_date, NULL::VARCHAR AS job_url, description,
  NULL::VARCHAR AS skills_extracted, NULL::VARCHAR AS role_type, NULL::VARCHAR AS seniority_level,
  NULL::TIMESTAMP AS ingested_at FROM rawp""")
def proj_unified_schema(spark, sf):
    """Missing columns added as typed NULLs, extras (n_chars, lang) dropped, unified order."""
    d = read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("job_id"), "source",
                                            F.substring_index("text", "\n", 1).alias("title"),
                                            F.col("lang").alias("location"), F.col("text").alias("description"),
                                            "n_chars", "lang")
    out = conform(d)
    return out.select(*[ntz(c) if c in ("publication_date", "ingested_at") else
                        jtxt(c) if c == "skills_extracted" else F.col(c) for c in UNIFIED_COLUMNS])


@query("norm_csv", W(RAW, RAW_NA, CSV_POST) + f"SELECT {POSTING_OUT_SQL} FROM csv_postings")
def norm_csv(spark, sf):
    return posting_out(csv_postings(spark, sf))


@query("norm_paged_api", W(RAW, API_POST) + f"SELECT {POSTING_OUT_SQL} FROM api_postings")
def norm_paged_api(spark, sf):
    return posting_out(api_postings(spark, sf))


@query("norm_flat_api", W(RAW, O.postings_ctes(
    "rawp", "flat_postings", source_expr="'api'", remote_expr="true",
    job_id_expr="CASE WHEN doc_id = 0 THEN NULL ELSE job_id END")) + f"SELECT {POSTING_OUT_SQL} FROM flat_postings")
def norm_flat_api(spark, sf):
    res = flat_results(read_json_documents(spark, L.land_flat(spark, sf)))
    res = res.withColumn("doc_id", J.vget(F.col("j"), "$.id", "bigint"))
    return posting_out(normalize_flat_api(res, clock=A.clock(), keep=["doc_id"], keywords=A.DOC_KEYWORDS))


@query("proj_latest_cols", W(RAW, POST) + "SELECT ingested_at, title, company, location, job_url FROM postings")
def proj_latest_cols(spark, sf):
    return postings(spark, sf).select(ntz("ingested_at"), "title", "company", "location", "job_url")


# ---------------------------------------------------------------- 2.4 filters and data quality

@query("flt_date_not_null", W(RAW, POST) + "SELECT doc_id, publication_date FROM postings WHERE publication_date IS NOT NULL")
def flt_date_not_null(spark, sf):
    return postings(spark, sf).filter(F.col("publication_date").isNotNull()).select("doc_id", ntz("publication_date"))


@query("flt_company_present", W(RAW, POST) + "SELECT doc_id, company FROM postings WHERE company IS NOT NULL AND company <> ''")
def flt_company_present(spark, sf):
    return postings(spark, sf).filter(MT.company_present()).select("doc_id", "company")


@query("flt_unseen_key", W(*MERGE_CTES[:-1]) + "SELECT job_hash, doc_id FROM src WHERE job_hash NOT IN (SELECT job_hash FROM tgt)")
def flt_unseen_key(spark, sf):
    """Skip keys already emitted (anti join against the seen set)."""
    target, src = merge_inputs(spark, sf)
    return src.join(target.select("job_hash"), "job_hash", "left_anti").select("job_hash", "doc_id")


@query("dq_unique_key", W(RAW, RAW_NA, CSV_POST, API_POST) + """SELECT job_hash, COUNT(*) AS n FROM
  (SELECT job_hash FROM api_postings UNION ALL SELECT job_hash FROM csv_postings) GROUP BY 1 HAVING COUNT(*) > 1""")
def dq_unique_key(spark, sf):
    """Keys held more than once (API and CSV copies of one document before dedup)."""
    u = union_sources(api_postings(spark, sf), csv_postings(spark, sf))
    return M.duplicate_keys(u, "job_hash")


@query("dq_unique_url", W(RAW, RAW_NA, CSV_POST, API_POST) + """SELECT job_url, COUNT(*) AS n FROM
  (SELECT job_url FROM api_postings UNION ALL SELECT job_url FROM csv_postings)
  WHERE job_url IS NOT NULL AND job_url <> '' GROUP BY 1 HAVING COUNT(*) > 1""")
def dq_unique_url(spark, sf):
    u = union_sources(api_postings(spark, sf), csv_postings(spark, sf))
    return M.duplicate_urls(u)


@query("dq_not_null", W(RAW, POST) + """SELECT COUNT(*) FILTER (WHERE job_hash IS NULL) AS job_hash_nulls,
  COUNT(*) FILTER (WHERE source IS NULL) AS source_nulls, COUNT(*) FILTER (WHERE ingested_at IS NULL) AS ingested_at_nulls,
  COUNT(*) FILTER (WHERE job_id IS NULL) AS job_id_nulls, COUNT(*) FILTER (WHERE publication_date IS NULL) AS publication_date_nulls,
  COUNT(*) FILTER (WHERE job_url IS NULL) AS job_url_nulls FROM postings""")
def dq_not_null(spark, sf):
    return M.null_counts(postings(spark, sf), ["job_hash", "source", "ingested_at", "job_id", "publication_date",
                                               "job_url"])


# ---------------------------------------------------------------- 2.5 joins

@query("join_left_totals", W(RAW, POST) + """SELECT d.metric_date, COALESCE(t.total_jobs, 0) AS total_jobs FROM
  (SELECT DISTINCT CAST(publication_date AS DATE) AS metric_date FROM postings WHERE publication_date IS NOT NULL) d
  LEFT JOIN (SELECT CAST(publication_date AS DATE) AS metric_date, COUNT(*) AS total_jobs FROM postings
             WHERE publication_date IS NOT NULL GROUP BY 1) t ON t.metric_date = d.metric_date""")
def join_left_totals(spark, sf):
    p = postings(spark, sf)
    dates = MT.dated(p).select("metric_date").distinct()
    return dates.join(MT.counts_by_day(p), "metric_date", "left") \
        .select("metric_date", F.coalesce("total_jobs", F.lit(0)).cast("long").alias("total_jobs"))


@query("join_lateral_unnest", W(RAW, POST) + "SELECT doc_id, unnest(skills_extracted) AS skill FROM postings")
def join_lateral_unnest(spark, sf):
    """Comma-lateral UNNEST: inner, so postings with no skills produce no row."""
    return unnest(postings(spark, sf), "skills_extracted", "skill", keep=["doc_id"])


@query("join_corr_topk", W(EJOBS, O.metrics_sql("ejobs")) + "SELECT metric_date, top_companies FROM metrics")
def join_corr_topk(spark, sf):
    """Per-day top-10 companies as ordered JSON ('[]' when none): window + collect, no correlated subquery."""
    return MT.metrics_as_json(MT.daily_metrics(A.event_jobs(spark, sf))).select("metric_date", "top_companies")


@query("join_corr_agg", W(EJOBS, O.metrics_sql("ejobs")) + "SELECT metric_date, role_counts FROM metrics")
def join_corr_agg(spark, sf):
    return MT.metrics_as_json(MT.daily_metrics(A.event_jobs(spark, sf))).select("metric_date", "role_counts")


@query("join_semi_keep", """SELECT event_id, user_id, event_type, ts FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def join_semi_keep(spark, sf):
    """Keep the winning row of each key directly (no driver-side id set)."""
    e = read(spark, sf, "events")
    w = Window.partitionBy("user_id", "event_type").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return e.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("event_id", "user_id", "event_type", "ts")


@query("join_upsert_match", W(*MERGE_CTES[:-1]) + "SELECT t.job_hash, t.doc_id AS old_doc, s.doc_id AS new_doc FROM tgt t JOIN src s USING (job_hash)")
def join_upsert_match(spark, sf):
    target, src = merge_inputs(spark, sf)
    return target.select("job_hash", F.col("doc_id").alias("old_doc")) \
        .join(src.select("job_hash", F.col("doc_id").alias("new_doc")), "job_hash")


# ---------------------------------------------------------------- 2.6 aggregations

@query("agg_total", W(RAW, POST) + "SELECT COUNT(*) AS c FROM postings")
def agg_total(spark, sf):
    return RP.total_rows(postings(spark, sf))


@query("agg_distinct_dates", W(RAW, POST) + "SELECT DISTINCT CAST(publication_date AS DATE) AS metric_date FROM postings WHERE publication_date IS NOT NULL")
def agg_distinct_dates(spark, sf):
    return MT.dated(postings(spark, sf)).select("metric_date").distinct()


@query("agg_by_day", W(RAW, POST) + "SELECT CAST(publication_date AS DATE) AS metric_date, COUNT(*) AS total_jobs FROM postings WHERE publication_date IS NOT NULL GROUP BY 1")
def agg_by_day(spark, sf):
    return MT.counts_by_day(postings(spark, sf))


@query("agg_by_day_company", W(EJOBS) + "SELECT CAST(publication_date AS DATE) AS metric_date, company, COUNT(*) AS jobs FROM ejobs WHERE publication_date IS NOT NULL AND company IS NOT NULL AND company <> '' GROUP BY 1, 2")
def agg_by_day_company(spark, sf):
    return MT.counts_by_day_company(A.event_jobs(spark, sf))


@query("agg_by_day_skill", W(RAW, POST) + "SELECT metric_date, skill, COUNT(*) AS jobs FROM (SELECT CAST(publication_date AS DATE) AS metric_date, unnest(skills_extracted) AS skill FROM postings WHERE publication_date IS NOT NULL) GROUP BY 1, 2")
def agg_by_day_skill(spark, sf):
    return MT.counts_by_day_skill(postings(spark, sf))


@query("agg_by_day_role", W(RAW, POST) + "SELECT CAST(publication_date AS DATE) AS metric_date, COALESCE(role_type, 'Unspecified') AS role_type, COUNT(*) AS jobs FROM postings WHERE publication_date IS NOT NULL GROUP BY 1, 2")
def agg_by_day_role(spark, sf):
    return MT.counts_by_day_role(postings(spark, sf))


STREAMISH_SQL = W(RAW, POST) + """SELECT role_type FROM postings UNION ALL SELECT NULL AS role_type FROM postings WHERE location = 'de'"""


def with_stream_rows(spark, sf) -> DataFrame:
    """Clean postings plus German postings as stream rows (which carry no role)."""
    p = postings(spark, sf)
    return union_sources(p.select("role_type"), p.filter(F.col("location") == "de").select(
        F.lit(None).cast("string").alias("role_type")))


@query("agg_role", "SELECT COALESCE(role_type, 'Unspecified') AS role_type, COUNT(*) AS jobs FROM (" + STREAMISH_SQL + ") GROUP BY 1")
def agg_role(spark, sf):
    return RP.jobs_by_role(with_stream_rows(spark, sf))


@query("agg_role_nullgroup", "SELECT role_type, COUNT(*) AS jobs FROM (" + STREAMISH_SQL + ") GROUP BY 1")
def agg_role_nullgroup(spark, sf):
    return RP.jobs_by_role(with_stream_rows(spark, sf), coalesce_role=False)


@query("agg_top_companies", W(RAW, POST) + "SELECT company, COUNT(*) AS jobs FROM postings WHERE company IS NOT NULL AND company <> '' GROUP BY 1 ORDER BY jobs DESC, company LIMIT 10")
def agg_top_companies(spark, sf):
    return RP.top_companies(postings(spark, sf))


@query("agg_top_skills", W(RAW, POST) + "SELECT skill, COUNT(*) AS jobs FROM (SELECT unnest(skills_extracted) AS skill FROM postings) GROUP BY 1 ORDER BY jobs DESC, skill LIMIT 10")
def agg_top_skills(spark, sf):
    return RP.top_skills(postings(spark, sf))


@query("agg_json_array", W(RAW, POST, O.metrics_sql("postings")) + "SELECT metric_date, top_skills FROM metrics")
def agg_json_array(spark, sf):
    return MT.metrics_as_json(MT.daily_metrics(postings(spark, sf))).select("metric_date", "top_skills")


@query("agg_json_object", W(RAW, POST, O.metrics_sql("postings")) + "SELECT metric_date, role_counts FROM metrics")
def agg_json_object(spark, sf):
    return MT.metrics_as_json(MT.daily_metrics(postings(spark, sf))).select("metric_date", "role_counts")


@query("daily_metrics", W(RAW, POST, O.metrics_sql("postings")) + "SELECT * FROM metrics")
def daily_metrics_q(spark, sf):
    """Flagship: per publication day total, top-10 companies, top-10 skills, role counts (JSON text)."""
    return MT.metrics_as_json(MT.daily_metrics(postings(spark, sf), clock=A.clock())).drop("computed_at")


@query("daily_metrics_events", W(EJOBS, O.metrics_sql("ejobs")) + "SELECT * FROM metrics")
def daily_metrics_events(spark, sf):
    """Flagship on events (about 330 rows a day), where both top-10 lists really cut."""
    return MT.metrics_as_json(MT.daily_metrics(A.event_jobs(spark, sf), clock=A.clock())).drop("computed_at")


# ---------------------------------------------------------------- 2.7 dedup

EVENT_POSTINGS_SQL = """ep AS (
  SELECT sha256(CAST(user_id AS VARCHAR) || '|' || event_type) AS job_hash, event_id, ts AS publication_date,
         TIMESTAMP '2026-01-01 00:00:00' AS ingested_at, 'api' AS source, CAST(user_id AS VARCHAR) AS company,
         event_type AS title, value FROM events
)"""


def event_postings(spark, sf) -> DataFrame:
    e = read(spark, sf, "events")
    return e.select(sha256_hex(F.concat_ws("|", F.col("user_id").cast("string"), "event_type")).alias("job_hash"),
                    "event_id", F.col("ts").cast("timestamp").alias("publication_date"), A.clock().alias("ingested_at"),
                    F.lit("api").alias("source"), F.col("user_id").cast("string").alias("company"),
                    F.col("event_type").alias("title"), "value")


@query("dedup_latest", W(EVENT_POSTINGS_SQL) + """SELECT job_hash, event_id, publication_date, company, title FROM
  (SELECT *, row_number() OVER (PARTITION BY job_hash ORDER BY publication_date DESC NULLS LAST, ingested_at DESC,
   event_id DESC) AS rn FROM ep) WHERE rn = 1""")
def dedup_latest_q(spark, sf):
    out = dedup_latest(event_postings(spark, sf), tie_breakers=[F.col("event_id").desc()])
    return out.select("job_hash", "event_id", ntz("publication_date"), "company", "title")


# ---------------------------------------------------------------- 2.8 sorts, limits, set operations

@query("sort_by_day", W(RAW, POST) + "SELECT CAST(publication_date AS DATE) AS day, COUNT(*) AS jobs FROM postings WHERE publication_date IS NOT NULL GROUP BY 1 ORDER BY 1", dates=("day",))
def sort_by_day(spark, sf):
    return RP.jobs_over_time(postings(spark, sf))


@query("topk_overall", W(EJOBS) + "SELECT company, COUNT(*) AS jobs FROM ejobs WHERE company <> '' GROUP BY 1 ORDER BY jobs DESC, company LIMIT 10")
def topk_overall(spark, sf):
    return RP.top_companies(A.event_jobs(spark, sf))


@query("topk_per_day", W(EJOBS) + """SELECT metric_date, company, jobs, rank FROM (SELECT *, row_number() OVER
  (PARTITION BY metric_date ORDER BY jobs DESC, company) AS rank FROM (SELECT CAST(publication_date AS DATE) AS metric_date,
  company, COUNT(*) AS jobs FROM ejobs GROUP BY 1, 2)) WHERE rank <= 10""")
def topk_per_day(spark, sf):
    c = MT.counts_by_day_company(A.event_jobs(spark, sf))
    return MT.top_k_per_group(c, ["metric_date"], "company").select("metric_date", "company", "jobs", "rank")


@query("limit_head", W(RAW) + "SELECT CAST(doc_id // 100 + 1 AS BIGINT) AS page, doc_id AS id FROM rawp ORDER BY doc_id LIMIT 250")
def limit_head(spark, sf):
    """Cap on collected postings (max_jobs=250): exactly the first 250 in page order."""
    res = paged_results(read_json_documents(spark, L.land_pages(spark, sf)), max_jobs=250)
    return res.select("page", J.vget(F.col("j"), "$.id", "bigint").alias("id"))


@query("set_union_all", W(RAW, RAW_NA, CSV_POST, API_POST) + """SELECT job_hash, source, doc_id FROM api_postings
  UNION ALL SELECT job_hash, source, doc_id FROM csv_postings""")
def set_union_all(spark, sf):
    u = union_sources(api_postings(spark, sf), csv_postings(spark, sf))
    return u.select("job_hash", "source", "doc_id")


# ---------------------------------------------------------------- 2.10 string and hash scalars

WS_DOC_SQL = "SELECT doc_id, {} AS norm FROM documents".format(O.nws("text"))


@query("str_normalize_ws", WS_DOC_SQL)
def str_normalize_ws(spark, sf):
    return read_spread(spark, sf, "documents", "doc_id").select("doc_id", normalize_ws("text").alias("norm"))


@query("hash_sha256", "SELECT doc_id, sha256(text) AS h FROM documents")
def hash_sha256(spark, sf):
    return read(spark, sf, "documents").select("doc_id", sha256_hex("text").alias("h"))


@query("key_job_hash", W(RAW, POST) + "SELECT doc_id, job_hash, _iso AS iso FROM postings")
def key_job_hash(spark, sf):
    raw = A.raw_postings(spark, sf, enrich=False)
    df = raw.select("doc_id", normalize_ws("title").alias("title"), normalize_ws("company").alias("company"),
                    empty_to_null(normalize_ws("job_url")).alias("job_url"), "publication_date")
    df = with_iso_date(df, "publication_date", None, "iso")
    from jobsmith.functions.hashing import job_key
    return df.select("doc_id", job_key("job_url", "title", "company", "iso").alias("job_hash"), "iso")


@query("str_lower_contains", "SELECT doc_id, contains(lower(text), 'license') AS has_license FROM documents")
def str_lower_contains(spark, sf):
    return read(spark, sf, "documents").select("doc_id", lower_contains("text", "License").alias("has_license"))


@query("str_cast_or_null", W(RAW) + "SELECT doc_id, CASE WHEN doc_id = 0 THEN NULL ELSE CAST(doc_id AS VARCHAR) END AS job_id, nullif(source, '') AS source FROM rawp")
def str_cast_or_null(spark, sf):
    """``str(id or '') or None``: a JSON number 0 is falsy; text '' becomes NULL."""
    res = paged_results(read_json_documents(spark, L.land_pages(spark, sf)))
    j = F.col("j")
    out = res.select(J.vget(j, "$.id", "bigint").alias("doc_id"), J.text_of(J.vget(j, "$.id")).alias("job_id"))
    docs = read(spark, sf, "documents").select("doc_id", cast_or_null("source").alias("source"))
    return out.join(docs, "doc_id")


@query("str_empty_to_null", W(RAW) + f"SELECT doc_id, nullif({O.nws('job_url')}, '') AS job_url FROM rawp")
def str_empty_to_null(spark, sf):
    raw = A.raw_postings(spark, sf, enrich=False)
    return raw.select("doc_id", empty_to_null(normalize_ws("job_url")).alias("job_url"))


@query("coalesce_default", "SELECT COALESCE(role_type, 'Unspecified') AS role_type FROM (" + STREAMISH_SQL + ")")
def coalesce_default(spark, sf):
    return with_stream_rows(spark, sf).select(F.coalesce("role_type", F.lit(R.UNSPECIFIED_ROLE)).alias("role_type"))


@query("coalesce_keep_old", W(*MERGE_CTES) + "SELECT job_hash, job_url FROM merged")
def coalesce_keep_old(spark, sf):
    return upserted(spark, sf).select("job_hash", "job_url")


@query("text_concat", W(RAW) + f"SELECT doc_id, lower({O.nws('title')} || chr(10) || {O.nws('description')}) AS hay FROM rawp")
def text_concat_q(spark, sf):
    raw = A.raw_postings(spark, sf, enrich=False)
    return raw.select("doc_id", text_concat(normalize_ws("title"), normalize_ws("description")).alias("hay"))


# ---------------------------------------------------------------- 2.11 dates, booleans, arrays, JSON

ORDER_DATES_SQL = f"""od AS (SELECT o_orderkey, {O.date_text_sql('o_orderdate', 'o_orderpriority')} AS raw FROM orders),
{O.date_ctes('od', 'raw', 'odp')}"""


def order_dates(spark, sf) -> DataFrame:
    o = read(spark, sf, "orders")
    d = o.select("o_orderkey", A.date_text(F.col("o_orderdate"), F.col("o_orderpriority")).alias("raw"))
    return with_iso_date(d, "raw", "ts", "iso")


@query("dt_parse", "WITH " + ORDER_DATES_SQL + " SELECT o_orderkey, raw, publication_date AS ts FROM odp3")
def dt_parse(spark, sf):
    return order_dates(spark, sf).select("o_orderkey", "raw", ntz("ts"))


@query("dt_isoformat", "WITH " + ORDER_DATES_SQL + " SELECT o_orderkey, _iso AS iso FROM odp3")
def dt_isoformat(spark, sf):
    return order_dates(spark, sf).select("o_orderkey", "iso")


WEEK_OFFSETS = {"1-URGENT": ("", 0), "2-HIGH": ("+05:30:15", 19815), "3-MEDIUM": ("-18:45", -67500)}


@query("dt_parse_week", "SELECT o_orderkey, raw, d + to_seconds(37230 - secs) AS ts, "
       "strftime(d, '%Y-%m-%d') || 'T10:20:30' || coalesce(nullif(off, ''), '+00:00') AS iso FROM (SELECT *, "
       "CASE WHEN off = '' THEN strftime(d, '%GW%V%uT102030') ELSE strftime(d, '%G-W%V-%uT10:20:30') || off END AS raw FROM "
       "(SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d, " + ", ".join(
           "CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN {v[i]!r}" for p, v in WEEK_OFFSETS.items()) + f" ELSE {e} END AS {n}"
           for i, e, n in ((0, "''", "off"), (1, "0", "secs"))) + " FROM orders))")
def dt_parse_week(spark, sf):
    """Order dates as ISO week dates, some with offsets of seconds or beyond 18 hours."""
    d, off = F.to_date("o_orderdate"), F.lit("")
    for priority, (text, _) in WEEK_OFFSETS.items():
        off = F.when(F.col("o_orderpriority") == priority, text).otherwise(off)
    year, week = F.lpad(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), 4, "0"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    day = (F.weekday(d) + 1).cast("string")
    raw = F.when(off == "", F.concat(year, F.lit("W"), week, day, F.lit("T102030"))) \
        .otherwise(F.concat(year, F.lit("-W"), week, F.lit("-"), day, F.lit("T10:20:30"), off))
    return with_iso_date(read(spark, sf, "orders").select("o_orderkey", raw.alias("raw")), "raw", "ts", "iso") \
        .select("o_orderkey", "raw", ntz("ts"), "iso")


@query("dt_to_date", "SELECT event_id, CAST(ts AS DATE) AS d FROM events", dates=("d",))
def dt_to_date(spark, sf):
    from jobsmith.functions.dates import day_of
    return read(spark, sf, "events").select("event_id", day_of(F.col("ts").cast("timestamp")).alias("d"))


@query("dt_sentinel_sort", W(RAW, POST) + """SELECT company, doc_id, publication_date FROM (SELECT *, row_number() OVER
  (PARTITION BY company ORDER BY coalesce(publication_date, TIMESTAMP '0001-01-01') DESC, doc_id) AS rn FROM postings)
  WHERE rn = 1""")
def dt_sentinel_sort(spark, sf):
    """Latest posting per company; missing dates sort last under DESC via the 0001-01-01 sentinel."""
    p = postings(spark, sf)
    w = Window.partitionBy("company").orderBy(sentinel_desc("publication_date"), F.col("doc_id"))
    return p.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("company", "doc_id",
                                                                               ntz("publication_date"))


@query("bool_truthy", W(RAW) + f"SELECT doc_id, is_remote AS raw, {O.truthy('is_remote')} AS is_remote FROM rawp")
def bool_truthy(spark, sf):
    raw = A.raw_postings(spark, sf, enrich=False)
    return raw.select("doc_id", F.col("is_remote").alias("raw"), truthy_text("is_remote").alias("is_remote"))


@query("arr_sort_distinct", W(RAW, POST) + "SELECT doc_id, to_json(skills_extracted)::VARCHAR AS skills FROM postings")
def arr_sort_distinct(spark, sf):
    return postings(spark, sf).select("doc_id", jtxt("skills_extracted", "skills"))


@query("arr_unnest", W(RAW, POST) + "SELECT doc_id, unnest(skills_extracted) AS skill FROM postings WHERE publication_date IS NOT NULL")
def arr_unnest(spark, sf):
    return unnest(MT.dated(postings(spark, sf)), "skills_extracted", "skill", keep=["doc_id"])


@query("json_build_object", W(EJOBS) + """SELECT metric_date, company, json_object('jobs', jobs, 'company', company)::VARCHAR AS obj
  FROM (SELECT CAST(publication_date AS DATE) AS metric_date, company, COUNT(*) AS jobs FROM ejobs GROUP BY 1, 2)""")
def json_build_object(spark, sf):
    c = MT.counts_by_day_company(A.event_jobs(spark, sf))
    return c.select("metric_date", "company", F.to_json(F.struct("jobs", "company")).alias("obj"))


@query("json_array", W(EJOBS, O.metrics_sql("ejobs")) + "SELECT metric_date, top_skills FROM metrics")
def json_array(spark, sf):
    return MT.metrics_as_json(MT.daily_metrics(A.event_jobs(spark, sf))).select("metric_date", "top_skills")


@query("json_object", W(RAW, POST, O.metrics_sql("postings")) + "SELECT metric_date, role_counts FROM metrics")
def json_object(spark, sf):
    return MT.metrics_as_json(MT.daily_metrics(postings(spark, sf))).select("metric_date", "role_counts")


@query("json_decode", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_decode(spark, sf):
    e = read(spark, sf, "events")
    return e.select("event_id", J.vget(J.decode(F.col("props")), "$.k", "bigint").alias("k"))


@query("json_encode", "SELECT event_id, to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type})::VARCHAR AS js FROM events")
def json_encode(spark, sf):
    e = read(spark, sf, "events")
    return e.select("event_id", J.encode(F.struct("event_id", "user_id", "event_type")).alias("js"))


@query("json_path", W(RAW) + f"SELECT doc_id, {O.nws('company')} AS company, {O.nws('category')} AS category FROM rawp")
def json_path(spark, sf):
    """company as object {display_name} or scalar (HOUSEHOLD rows), category as {label}."""
    res = paged_results(read_json_documents(spark, L.land_pages(spark, sf)))
    j = F.col("j")
    return res.select(J.vget(j, "$.id", "bigint").alias("doc_id"),
                      normalize_ws(J.object_or_scalar(J.vget(j, "$.company"), "display_name")).alias("company"),
                      normalize_ws(J.object_or_scalar(J.vget(j, "$.category"), "label")).alias("category"))


# ---------------------------------------------------------------- 2.12 enrichment

DOC_HAY = O.hay(O.nws("split_part(text, chr(10), 1)"), O.nws("text"))


def doc_frame(spark, sf) -> DataFrame:
    d = read_spread(spark, sf, "documents", "doc_id")
    return d.select("doc_id", normalize_ws(F.substring_index("text", "\n", 1)).alias("title"),
                    normalize_ws("text").alias("description"))


@query("text_extract_keywords", f"SELECT doc_id, to_json({O.skills(DOC_HAY, A.DOC_KEYWORDS)})::VARCHAR AS skills FROM documents")
def text_extract_keywords(spark, sf):
    out = with_enrichment(doc_frame(spark, sf), "title", "description", keywords=A.DOC_KEYWORDS,
                          outputs=("skills_extracted",))
    return out.select("doc_id", jtxt("skills_extracted", "skills"))


RUNS_SQL = "regexp_extract_all({}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+')"


@query("text_extract_keywords_table", f"""WITH b AS (SELECT {RUNS_SQL.format('lower(text)')} AS r FROM benchmark),
  k AS (SELECT DISTINCT array_to_string(r[i:i + n - 1], '') AS g FROM (SELECT r, unnest(generate_series(1, len(r))) AS i FROM b),
    (VALUES (1), (3)) AS lengths(n) WHERE i + n - 1 <= len(r) AND regexp_matches(r[i], '^[\\p{{L}}\\p{{N}}_]')),
  d AS (SELECT doc_id, {RUNS_SQL.format(DOC_HAY)} AS r FROM documents),
  hits AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, array_to_string(r[i:i + n - 1], '') AS g FROM
    (SELECT doc_id, r, unnest(generate_series(1, len(r))) AS i FROM d), (VALUES (1), (3)) AS lengths(n)) JOIN k USING (g))
  SELECT doc_id, CAST(COUNT(g) AS BIGINT) AS n, COALESCE(sha256(string_agg(g, '|' ORDER BY g COLLATE "binary")), '') AS digest
  FROM documents LEFT JOIN hits USING (doc_id) GROUP BY doc_id""")
def text_extract_keywords_table(spark, sf):
    """Keywords from a table: every word and two-word phrase of the benchmark's texts."""
    runs = read(spark, sf, "benchmark").select(F.regexp_extract_all(F.lower("text"), F.lit(RUNS), 0).alias("r"))
    words = F.transform("r", lambda w, i: F.array(w, F.when(i + 2 < F.size("r"), F.array_join(F.slice("r", i + 1, 3), ""))))
    keywords = runs.select(F.explode(F.flatten(words)).alias("keyword")).where(F.col("keyword").rlike(f"^{WORD_CHAR}"))
    out = extract_keywords_table(doc_frame(spark, sf), keywords, text_concat("title", "description"))
    return out.select("doc_id", F.size("skills_extracted").cast("bigint").alias("n"), F.when(
        F.size("skills_extracted") > 0, F.sha2(F.array_join("skills_extracted", "|"), 256)).otherwise("").alias("digest"))


@query("text_classify_first_match", f"SELECT doc_id, {O.role(DOC_HAY)} AS role_type FROM documents")
def text_classify_first_match(spark, sf):
    out = with_enrichment(doc_frame(spark, sf), "title", "description", outputs=("role_type",))
    return out.select("doc_id", "role_type")


# words that occur in these texts: the default rules' words hardly do
DOC_LEVELS = [("Rude", ["idiot", "stupid", "moron"]), ("French", ["les", "des"]), ("German", ["der", "und"]),
              ("Spanish", ["los", "el"]), ("Thing", ["thing"])]


@query("text_classify_word_match", f"SELECT doc_id, {O.seniority(DOC_HAY, DOC_LEVELS)} AS seniority_level FROM documents")
def text_classify_word_match(spark, sf):
    out = with_enrichment(doc_frame(spark, sf), "title", "description", outputs=("seniority_level",),
                          seniority_rules=DOC_LEVELS)
    return out.select("doc_id", "seniority_level")


CONV_HAY = O.hay(O.nws("role"), O.nws("text"))


TURN_SKILLS = ["thing", "that", "by", "von", "the of", "los"]
TURN_ROLES = [("Longing", ["thth", "inging"]), ("Ending", ["ction", "ention"]), ("Other tongue", ["ung ", "eau"])]


@query("text_enrich", f"""SELECT conv_id, turn, to_json({O.skills(CONV_HAY, TURN_SKILLS)})::VARCHAR AS skills,
  {O.role(CONV_HAY, TURN_ROLES)} AS role_type, {O.seniority(CONV_HAY, DOC_LEVELS)} AS seniority_level FROM conversations""")
def text_enrich(spark, sf):
    """All three rule tables on conversation turns, with rules that occur there."""
    c = read_spread(spark, sf, "conversations", "conv_id").select("conv_id", "turn", normalize_ws("role").alias("title"),
                                                normalize_ws("text").alias("description"))
    out = with_enrichment(c, "title", "description", keywords=TURN_SKILLS, role_rules=TURN_ROLES,
                          seniority_rules=DOC_LEVELS)
    return out.select("conv_id", "turn", jtxt("skills_extracted", "skills"), "role_type", "seniority_level")


# ---------------------------------------------------------------- 2.13 composite jobs

TRANSFORM_SQL_CTES = [RAW, RAW_NA, CSV_POST, API_POST, f"""unioned AS (
  SELECT {POSTING_OUT_SQL} FROM api_postings UNION ALL SELECT {POSTING_OUT_SQL} FROM csv_postings
), transformed AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_hash ORDER BY
    publication_date DESC NULLS LAST, ingested_at DESC NULLS LAST,
    CASE source WHEN 'csv' THEN 2 WHEN 'api' THEN 1 ELSE 0 END DESC, doc_id DESC) AS rn FROM unioned) WHERE rn = 1
)"""]


def transformed(spark, sf) -> DataFrame:
    pages = paged_results(read_json_documents(spark, L.land_pages(spark, sf)))
    pages = pages.withColumn("doc_id", J.vget(F.col("j"), "$.id", "bigint"))
    rows = read_postings_csv(spark, L.land_csv(spark, sf)).withColumn("doc_id", F.col("job_id").cast("bigint"))
    return transform(pages, rows, api_clock=F.lit(API_CLOCK).cast("timestamp"),
                     csv_clock=F.lit(CSV_CLOCK).cast("timestamp"), keep=["doc_id"],
                     tie_breakers=[F.col("doc_id").desc()], keywords=A.DOC_KEYWORDS)


@query("transform_batch", W(*TRANSFORM_SQL_CTES) + "SELECT * FROM transformed")
def transform_batch(spark, sf):
    """API pages + CSV -> normalise -> union -> latest per key."""
    return posting_out(transformed(spark, sf))


@query("load_batch", W(*MERGE_CTES[:-1], O.metrics_sql("tgt").replace("metrics AS", "m_old AS"), f"""cleaned AS (
  SELECT coalesce(s.job_hash, t.job_hash) AS job_hash, CASE WHEN s.job_hash IS NOT NULL THEN s.publication_date
    ELSE t.publication_date END AS publication_date, CASE WHEN s.job_hash IS NOT NULL THEN s.company ELSE t.company END
    AS company, CASE WHEN s.job_hash IS NOT NULL THEN s.role_type ELSE t.role_type END AS role_type,
    CASE WHEN s.job_hash IS NOT NULL THEN s.skills_extracted ELSE t.skills_extracted END AS skills_extracted
  FROM tgt t FULL OUTER JOIN src s ON t.job_hash = s.job_hash
)""", O.metrics_sql("cleaned").replace("m_", "n_").replace("metrics AS", "m_new AS"))
       + "SELECT * FROM m_new UNION ALL SELECT * FROM m_old WHERE metric_date NOT IN (SELECT metric_date FROM m_new)")
def load_batch(spark, sf):
    """Two loads into the posting store: the target rows, then the source rows
    (staging overwrite -> upsert of touched partitions -> metrics by signed counts)."""
    target, src = merge_inputs(spark, sf)
    store = PostingStore(spark, scratch_path(spark, "load"), STORE_BUCKETS)
    for batch in (target, src):
        store.load(batch, clock=A.clock())
    return MT.metrics_as_json(store.metrics.read()).drop("computed_at")


@query("batch_job", W(*TRANSFORM_SQL_CTES) + "SELECT job_hash, job_id, source, title, company, publication_date, job_url, role_type FROM transformed")
def batch_job(spark, sf):
    """Extract (landed pages + CSV) -> transform -> load into an empty posting store."""
    store = PostingStore(spark, scratch_path(spark, "job"), STORE_BUCKETS)
    store.load(transformed(spark, sf), full_refresh="1", clock=A.clock())
    return store.postings().select("job_hash", "job_id", "source", "title", "company", ntz("publication_date"), "job_url",
                                   "role_type")

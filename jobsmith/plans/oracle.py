"""DuckDB SQL for the oracle side of every registered query.

Built from the same rule tables as the Spark code, but written independently in
SQL (RE2 regexes with explicit Unicode classes instead of tokenisation, CASE
chains, FULL JOINs), so agreement is evidence rather than tautology.
"""

from __future__ import annotations

from jobsmith import rules as R
from jobsmith.functions.dates import ISO_CORE
from jobsmith.functions.text import WS_CLASS_RE2
from jobsmith.plans.adapters import DOC_KEYWORDS, FIXED_CLOCK, REMOTE_TEXT


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def nws(e: str) -> str:
    return f"trim(regexp_replace(coalesce(CAST({e} AS VARCHAR), ''), {q(WS_CLASS_RE2 + '+')}, ' ', 'g'))"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q('^' + WS_CLASS_RE2 + '+|' + WS_CLASS_RE2 + '+$')}, '', 'g')"


def truthy(e: str) -> str:
    return (f"CASE WHEN trim({e}) IS NULL THEN false WHEN trim({e}) IN ('true','True','TRUE') THEN true "
            f"WHEN trim({e}) IN ('false','False','FALSE') THEN false "
            f"WHEN try_cast(trim({e}) AS DOUBLE) IS NOT NULL THEN try_cast(trim({e}) AS DOUBLE) <> 0 "
            f"ELSE trim({e}) <> '' END")


def whole_word(needles: list[str]) -> str:
    """RE2 pattern of whole words, written apart from the library's: no letter, digit or underscore on either side."""
    edge = r"[^\p{L}\p{N}_]"
    return f"(^|{edge})({'|'.join(n.lower().replace('.', '[.]') for n in needles)})({edge}|$)"


def skills(hay: str, keywords: list[str] | None) -> str:
    kws = sorted({k.lower() for k in (R.SKILL_KEYWORDS if keywords is None else keywords)})
    items = ", ".join(f"CASE WHEN regexp_matches({hay}, {q(whole_word([k]))}) THEN {q(k)} END"
                      for k in kws)
    return f"list_sort(list_filter([{items}], lambda x: x IS NOT NULL))"


def role(hay: str, rules=None, default: str = R.ROLE_DEFAULT) -> str:
    parts = []
    for label, needles in (R.ROLE_RULES if rules is None else rules):
        cond = " OR ".join(f"contains({hay}, {q(n.lower())})" for n in needles)
        parts.append(f"WHEN {cond} THEN {q(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(default)} END"


def seniority(hay: str, rules=None, default: str = R.SENIORITY_DEFAULT) -> str:
    parts = []
    for label, needles in (R.SENIORITY_RULES if rules is None else rules):
        parts.append(f"WHEN regexp_matches({hay}, {q(whole_word(needles))}) "
                     f"THEN {q(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(default)} END"


def hay(title: str, desc: str) -> str:
    return f"lower({title} || chr(10) || {desc})"


def date_ctes(src: str, raw: str, prefix: str) -> str:
    """CTEs ``{prefix}1..3`` adding ``publication_date`` (naive UTC) and ``_iso`` to ``src``."""
    g = "^" + ISO_CORE + "$"
    ext = ", ".join(f"regexp_extract(_s, {q(g)}, {i}) AS _g{i}" for i in range(1, 10))
    return f"""{prefix}1 AS (
  SELECT *, regexp_matches(_s, {q(g)}) AS _ok, {ext}
  FROM (SELECT *, replace({strip(raw)}, 'Z', '+00:00') AS _s FROM {src})
), {prefix}2 AS (
  SELECT *,
    CASE WHEN length(_g1) = 8 THEN substr(_g1,1,4) || '-' || substr(_g1,5,2) || '-' || substr(_g1,7,2) ELSE _g1 END
      || 'T' || coalesce(nullif(_g2,''),'00') || ':' || coalesce(nullif(_g3,''), nullif(_g6,''), '00')
      || ':' || coalesce(nullif(_g4,''), nullif(_g7,''), '00') AS _local,
    rpad(substr(coalesce(nullif(_g5,''), nullif(_g8,''), ''), 1, 6), 6, '0') AS _frac,
    CASE WHEN _g9 = '' THEN '+00:00' WHEN length(_g9) = 3 THEN _g9 || ':00'
         WHEN length(_g9) = 5 THEN substr(_g9,1,3) || ':' || substr(_g9,4,2) ELSE _g9 END AS _off
  FROM {prefix}1
), {prefix}3 AS (
  SELECT *, CASE WHEN publication_date IS NOT NULL THEN
      _local || CASE WHEN _frac <> '000000' THEN '.' || _frac ELSE '' END || _off END AS _iso
  FROM (SELECT *, CASE WHEN _ok THEN try_cast(_local || '.' || _frac AS TIMESTAMP)
      - to_minutes((CASE WHEN substr(_off,1,1) = '-' THEN -1 ELSE 1 END)
                   * (CAST(substr(_off,2,2) AS INTEGER) * 60 + CAST(substr(_off,5,2) AS INTEGER))) END
      AS publication_date FROM {prefix}2)
)"""


def date_text_sql(ts: str, priority: str) -> str:
    return (f"CASE {priority} WHEN '1-URGENT' THEN strftime({ts}, '%Y-%m-%d') "
            f"WHEN '2-HIGH' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%SZ') "
            f"WHEN '3-MEDIUM' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '+02:00' "
            f"WHEN '4-NOT SPECIFIED' THEN strftime({ts}, '%Y%m%d') "
            f"ELSE strftime({ts}, '%d/%m/%Y') END")


def remote_text_sql(seg: str) -> str:
    return "CASE " + " ".join(f"WHEN {seg} = {q(k)} THEN {q(v)}" for k, v in REMOTE_TEXT.items()) + " END"


CLOCK = f"TIMESTAMP '{FIXED_CLOCK}'"


def raw_postings_cte() -> str:
    """``rawp``: raw CSV-shaped postings of the documents (mirrors adapters.raw_postings)."""
    return f"""oattr AS (
  SELECT o.o_orderkey AS _key,
         CASE WHEN o.o_orderstatus <> 'P' THEN n.n_name END AS company,
         c.c_mktsegment AS category,
         {remote_text_sql('c.c_mktsegment')} AS is_remote,
         {date_text_sql('o.o_orderdate', 'o.o_orderpriority')} AS publication_date
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
), rawp AS (
  SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS job_id, d.source,
         split_part(d.text, chr(10), 1) AS title, a.company, d.lang AS location, a.is_remote, a.category,
         a.publication_date, p.url AS job_url, d.text AS description
  FROM documents d LEFT JOIN oattr a ON d.doc_id = a._key LEFT JOIN pages p ON d.doc_id = p.page_id
)"""


def postings_ctes(src: str = "rawp", name: str = "postings", *, source_expr: str = "coalesce(source, 'csv')",
                  remote_expr: str | None = None, job_id_expr: str = "job_id", keywords=DOC_KEYWORDS,
                  clock: str = CLOCK, extra: str = "doc_id") -> str:
    """Normalise raw postings ``src`` into the unified posting CTE ``name``."""
    remote = remote_expr or truthy("is_remote")
    pre = f"{name}_n"
    return f"""{pre} AS (
  SELECT {extra}, {job_id_expr} AS job_id, {source_expr} AS source, {nws('title')} AS title,
         {nws('company')} AS company, {nws('location')} AS location, {remote} AS is_remote_b,
         {nws('category')} AS category, nullif({nws('job_url')}, '') AS job_url_n,
         {nws('description')} AS description_n, publication_date AS _raw_date
  FROM {src}
), {date_ctes(pre, '_raw_date', pre + '_d')}, {name} AS (
  SELECT sha256(coalesce(nullif(trim(coalesce(job_url_n, '')), ''),
                title || '|' || company || '|' || coalesce(_iso, ''))) AS job_hash,
         job_id, source, title, company, location, is_remote_b AS is_remote, category, publication_date,
         job_url_n AS job_url, description_n AS description,
         {skills(hay('title', 'description_n'), keywords)} AS skills_extracted,
         {role(hay('title', 'description_n'))} AS role_type,
         {seniority(hay('title', 'description_n'))} AS seniority_level,
         {clock} AS ingested_at, {extra}, _iso
  FROM {pre}_d3
)"""


def api_postings_ctes(name: str = "api_postings", clock: str = CLOCK) -> str:
    """Unified postings of the same documents through the paged-API normaliser."""
    return postings_ctes("rawp", name, source_expr="'api'",
                         remote_expr=f"contains(lower({nws('location')}), 'remote')",
                         job_id_expr="CASE WHEN doc_id = 0 THEN NULL ELSE job_id END", clock=clock)


def event_jobs_cte(name: str = "ejobs") -> str:
    return f"""{name} AS (
  SELECT ts AS publication_date, CAST(user_id AS VARCHAR) AS company, event_type AS role_type,
         [json_extract_string(props, '$.k')] AS skills_extracted
  FROM events
)"""


def metrics_sql(jobs: str, k: int = R.TOP_K) -> str:
    """daily metrics as JSON text, the correlated top-k written as window + string_agg."""
    return f"""m_base AS (
  SELECT CAST(publication_date AS DATE) AS metric_date, company, role_type, skills_extracted
  FROM {jobs} WHERE publication_date IS NOT NULL
), m_tot AS (
  SELECT metric_date, COUNT(*) AS total_jobs FROM m_base GROUP BY 1
), m_comp AS (
  SELECT metric_date, company, COUNT(*) AS jobs FROM m_base
  WHERE company IS NOT NULL AND company <> '' GROUP BY 1, 2
), m_skill AS (
  SELECT metric_date, skill, COUNT(*) AS jobs FROM (SELECT metric_date, unnest(skills_extracted) AS skill FROM m_base)
  GROUP BY 1, 2
), m_role AS (
  SELECT metric_date, COALESCE(role_type, 'Unspecified') AS role_type, COUNT(*) AS jobs FROM m_base GROUP BY 1, 2
), m_ctop AS (
  SELECT metric_date, '[' || string_agg(json_object('jobs', jobs, 'company', company)::VARCHAR, ','
         ORDER BY jobs DESC, company) || ']' AS top_companies
  FROM (SELECT *, row_number() OVER (PARTITION BY metric_date ORDER BY jobs DESC, company) AS rn FROM m_comp)
  WHERE rn <= {k} GROUP BY 1
), m_stop AS (
  SELECT metric_date, '[' || string_agg(json_object('jobs', jobs, 'skill', skill)::VARCHAR, ','
         ORDER BY jobs DESC, skill) || ']' AS top_skills
  FROM (SELECT *, row_number() OVER (PARTITION BY metric_date ORDER BY jobs DESC, skill) AS rn FROM m_skill)
  WHERE rn <= {k} GROUP BY 1
), m_rmap AS (
  SELECT metric_date, '{{' || string_agg(to_json(role_type)::VARCHAR || ':' || jobs, ','
         ORDER BY length(role_type), role_type) || '}}' AS role_counts
  FROM m_role GROUP BY 1
), metrics AS (
  SELECT t.metric_date, CAST(t.total_jobs AS BIGINT) AS total_jobs,
         COALESCE(c.top_companies, '[]') AS top_companies, COALESCE(s.top_skills, '[]') AS top_skills,
         COALESCE(r.role_counts, '{{}}') AS role_counts
  FROM m_tot t LEFT JOIN m_ctop c USING (metric_date) LEFT JOIN m_stop s USING (metric_date)
       LEFT JOIN m_rmap r USING (metric_date)
)"""

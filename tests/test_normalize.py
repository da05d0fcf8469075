"""Normalisers and sources: CSV, paged and flat API, stop rules."""

import hashlib
import json
import os


import pytest
from pyspark.sql import functions as F

from jobsmith.functions import json as J
from jobsmith.operators.normalize import normalize_csv, normalize_flat_api, normalize_paged_api, union_sources
from jobsmith.schema import UNIFIED_COLUMNS
from jobsmith.session import scratch_path
from jobsmith.sources.files import (flat_results, malformed_documents, paged_results, read_json_documents,
                                    read_postings_csv)

API_POSTING = {"id": 7041, "title": "Analytics Engineer, Data Platform", "company": {"display_name": "Birchwood Labs"},
               "location": {"display_name": "Fully remote, Lisbon"}, "category": {"label": "Analytics"},
               "created": "2025-11-04", "redirect_url": "https://jobs.test/p/7041",
               "description": "Airflow pipelines in Python on Kubernetes"}


def key(text):
    return hashlib.sha256(text.encode()).hexdigest()


def api_frame(spark, postings):
    df = spark.createDataFrame([(json.dumps(p),) for p in postings], "s string")
    return df.select(J.decode(F.col("s")).alias("j"))


def csv_frame(spark, rows):
    cols = ["job_id", "source", "title", "company", "location", "is_remote", "category", "publication_date",
            "job_url", "description"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_paged_api_row(spark):
    r = normalize_paged_api(api_frame(spark, [API_POSTING])).first()
    assert r["job_hash"] == key("https://jobs.test/p/7041")
    assert (r["is_remote"], r["role_type"], r["source"], r["company"], r["category"]) == \
        (True, "Data", "api", "Birchwood Labs", "Analytics")
    assert r["skills_extracted"] == ["airflow", "kubernetes", "python"]


def test_api_job_id_and_shapes(spark):
    ps = [dict(API_POSTING, id=0), dict(API_POSTING, id=""), {k: v for k, v in API_POSTING.items() if k != "id"},
          dict(API_POSTING, id="0"), dict(API_POSTING, company="Plain Co", location="Berlin", category=None)]
    out = normalize_paged_api(api_frame(spark, ps)).collect()
    assert [r["job_id"] for r in out] == [None, None, None, "0", "7041"]
    assert (out[4]["company"], out[4]["location"], out[4]["is_remote"], out[4]["category"]) == \
        ("Plain Co", "Berlin", False, "")


def test_api_fallback_chains(spark):
    p = {"title": "T", "company": "C", "created": "", "publication_date": "2026-03-02", "date": "2026-03-03",
         "redirect_url": "", "url": None, "job_url": "https://x/1"}
    r = normalize_paged_api(api_frame(spark, [p])).first()
    assert str(r["publication_date"])[:10] == "2026-03-02"
    assert r["job_url"] == "https://x/1"


def test_csv_row_and_union(spark):
    rows = [("row-9", "csv", "Backend Developer (Payments)", "Quayside", "Oslo", "false", "Fintech", "2025-12-19",
             "https://jobs.test/c/9", "AWS and dbt, some Spark")]
    c = normalize_csv(csv_frame(spark, rows))
    r = c.first()
    assert r["job_hash"] == key("https://jobs.test/c/9")
    assert (r["role_type"], r["skills_extracted"], r["is_remote"]) == ("Backend", ["aws", "dbt", "spark"], False)
    u = union_sources(normalize_paged_api(api_frame(spark, [API_POSTING])), c)
    assert u.columns == UNIFIED_COLUMNS
    assert {r["source"] for r in u.collect()} == {"api", "csv"}


def test_csv_defaults_and_missing_columns(spark):
    df = spark.createDataFrame([(None, None, "  Data   Engineer ")], "source string, company string, title string")
    r = normalize_csv(df).first()
    assert (r["source"], r["company"], r["title"], r["is_remote"], r["job_id"], r["job_url"]) == \
        ("csv", "", "Data Engineer", False, None, None)


def test_flat_api_remote(spark):
    p = {"id": 5, "title": "QA Engineer", "company_name": "", "company": "Fallback", "publication_date": "2026-03-05",
         "url": "https://r/5", "description": "selenium"}
    r = normalize_flat_api(api_frame(spark, [p])).first()
    assert (r["is_remote"], r["company"], r["role_type"], r["skills_extracted"]) == (True, "Fallback", "QA",
                                                                                     ["selenium"])


def write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def page(n, k):
    return json.dumps({"page": n, "results": [{"id": n * 100 + i} for i in range(k)]})


def ids(df):
    return [r[0] for r in df.select(J.vget(F.col("j"), "$.id", "bigint")).orderBy("page", "pos").collect()]


def test_paged_stop_rules(spark):
    path = scratch_path(spark, "pages")
    write_lines(path, [page(1, 2), page(2, 2), page(3, 0), page(4, 2), page(5, 1)])
    pages = read_json_documents(spark, path)
    assert ids(paged_results(pages)) == [100, 101, 200, 201]            # stop at the empty page 3
    assert ids(paged_results(pages, start_page=4)) == [400, 401, 500]    # the last landed page ends it
    assert ids(paged_results(pages, start_page=0, max_pages=1)) == [100, 101]
    assert ids(paged_results(pages, max_jobs=3)) == [100, 101, 200]      # trimmed to the target
    assert ids(paged_results(pages, max_jobs=0)) == [100, 101, 200, 201]  # <= 0: no cap
    assert ids(paged_results(pages, start_page=3)) == []


def test_missing_page_and_malformed_payload_fail(spark):
    """What lies behind a missing or broken page is not lost in silence."""
    path = scratch_path(spark, "pages")
    write_lines(path, [page(1, 2), page(3, 2)])
    with pytest.raises(Exception, match="missing pages: 1"):
        paged_results(read_json_documents(spark, path)).collect()
    assert ids(paged_results(read_json_documents(spark, path), max_pages=1)) == [100, 101]
    path = scratch_path(spark, "pages")
    write_lines(path, [page(1, 1), '{"page": 2, "results": [', page(3, 1)])
    with pytest.raises(Exception, match="(?i)malformed"):
        paged_results(read_json_documents(spark, path)).collect()
    assert [r["line"] for r in malformed_documents(spark, path).collect()] == ['{"page": 2, "results": [']


def test_csv_binds_by_name(spark):
    path = scratch_path(spark, "csv")
    os.makedirs(path)
    for name, text in {"a.csv": "title,job_id,company,extra\nWelder,42,Forge,z\n", "b.csv": "company,title\nMill,Miller\n"}.items():
        with open(os.path.join(path, name), "w") as f:
            f.write(text)
    got = {tuple(r) for r in read_postings_csv(spark, path).select("job_id", "title", "company", "source").collect()}
    assert got == {("42", "Welder", "Forge", None), (None, "Miller", "Mill", None)}
    with open(os.path.join(path, "c.csv"), "w") as f:
        f.write("title,company\nCook,Inn,one too many\n")
    with pytest.raises(Exception):
        read_postings_csv(spark, path).collect()


def test_flat_payloads(spark):
    path = scratch_path(spark, "flat")
    write_lines(path, [json.dumps({"jobs": [{"id": 1}, {"id": 2}]}), json.dumps([{"id": 9}]), json.dumps({"x": 1})])
    res = flat_results(read_json_documents(spark, path))
    assert sorted(r[0] for r in res.select(J.vget(F.col("j"), "$.id", "bigint")).collect()) == [1, 2]
    assert flat_results(read_json_documents(spark, path), limit=1).count() == 1


def test_csv_source_quoting_and_na_tokens(spark):
    path = scratch_path(spark, "csv")
    os.makedirs(path)
    with open(os.path.join(path, "jobs.csv"), "w") as f:
        f.write("job_id,source,title,company,location,is_remote,category,publication_date,job_url,description\n")
        f.write('1,csv,Dev,"Acme, Inc",NA,true,x,2026-03-01,,"line one\nline ""two"", three"\n')
        f.write("2,,QA,N/A,EU,,y,null,https://u/2,plain\n")
    df = read_postings_csv(spark, path).orderBy("job_id").collect()
    assert df[0]["company"] == "Acme, Inc" and df[0]["location"] is None
    assert df[0]["description"] == 'line one\nline "two", three' and df[0]["job_url"] is None
    assert (df[1]["source"], df[1]["company"], df[1]["is_remote"], df[1]["publication_date"]) == (None,) * 4


def test_non_string_fields_are_cast(spark):
    """T16: a numeric title or a boolean id does not fail the batch."""
    r = normalize_paged_api(api_frame(spark, [dict(API_POSTING, title=123, id=True)])).first()
    assert (r["title"], r["job_id"]) == ("123", "True")


def test_posting_texts_are_normalised_once(spark):
    """The posting view scanned every whole text for blanks twice: for the enrichment and for the normaliser."""
    from jobsmith.plans import adapters as A
    from tests.conftest import SF_SMALL
    raw = spark.createDataFrame([("  a \n b", None, " c  d ")], "title string, description string, company string")
    r = normalize_csv(raw, normal=("title",)).first()
    assert (r["title"], r["description"], r["company"]) == ("  a \n b", "", "c d")
    p = A.postings(spark, SF_SMALL).select("doc_id", "title", "description", "skills_extracted")
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(coalesce(description#") + plan.count("regexp_replace(coalesce(text#") == 1
    whole = normalize_csv(A.raw_postings(spark, SF_SMALL, enrich=False), clock=A.clock(), keep=["doc_id"], keywords=A.DOC_KEYWORDS)
    assert sorted(map(str, p.collect())) == sorted(map(str, whole.select(*p.columns).collect()))

"""Scalar column functions: whitespace, hashing, keys, word matching, dates."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from jobsmith.functions.dates import with_iso_date
from jobsmith.functions.enrich import with_enrichment
from jobsmith.functions.hashing import job_key, sha256_hex
from jobsmith.functions.text import normalize_ws, truthy_text


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {typ}")
    return [r["o"] for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]


def test_normalize_ws(spark):
    vals = [None, "", "  ", "a \u001cb　 c", "c​d", " x\n\ty "]
    assert one_col(spark, vals, normalize_ws) == ["", "", "", "a b c", "c​d", "x y"]


def test_sha256(spark):
    assert one_col(spark, ["héllo"], sha256_hex) == [hashlib.sha256("héllo".encode()).hexdigest()]


@pytest.mark.parametrize("url,date,text", [
    ("https://jobs.test/p/7041", "2025-11-04", "https://jobs.test/p/7041"),
    (None, "2025-11-04", "Tram Driver|Citylines|2025-11-04T00:00:00+00:00"),
    (None, None, "Tram Driver|Citylines|"),
    # same instant, other offset -> other key (the offset is part of the key text)
    (None, "2025-11-04T02:00:00+02:00", "Tram Driver|Citylines|2025-11-04T02:00:00+02:00"),
    (None, "2025-11-04T00:00:00-00:00", "Tram Driver|Citylines|2025-11-04T00:00:00+00:00"),
    ("", "2025-11-04", "Tram Driver|Citylines|2025-11-04T00:00:00+00:00"),
    # an unparseable date contributes '' (same key as no date)
    (None, "04/11/2025", "Tram Driver|Citylines|"),
])
def test_job_key(spark, url, date, text):
    df = spark.createDataFrame([(url, "Tram Driver", "Citylines", date)], "u string, t string, c string, d string")
    df = with_iso_date(df, "d", None, "iso")
    assert df.select(job_key("u", "t", "c", "iso")).first()[0] == hashlib.sha256(text.encode()).hexdigest()


PARSE_CASES = [
    ("2026-03-01", dt.datetime(2026, 3, 1), "2026-03-01T00:00:00+00:00"),
    ("2026-03-01T10:00:00Z", dt.datetime(2026, 3, 1, 10), "2026-03-01T10:00:00+00:00"),
    ("2026-03-01T10:00+0530", dt.datetime(2026, 3, 1, 4, 30), "2026-03-01T10:00:00+05:30"),
    ("20260301", dt.datetime(2026, 3, 1), "2026-03-01T00:00:00+00:00"),
    ("2026-03-01T10:00:00.123456789", dt.datetime(2026, 3, 1, 10, 0, 0, 123456), "2026-03-01T10:00:00.123456+00:00"),
    ("2026-03-01T10", dt.datetime(2026, 3, 1, 10), "2026-03-01T10:00:00+00:00"),
    ("2026-03-01T1000", dt.datetime(2026, 3, 1, 10), "2026-03-01T10:00:00+00:00"),
    ("2026-03-01 10:00:00,5+05", dt.datetime(2026, 3, 1, 5, 0, 0, 500000), "2026-03-01T10:00:00.500000+05:00"),
    (" 2026-03-10T02:00:00+02:00 ", dt.datetime(2026, 3, 10), "2026-03-10T02:00:00+02:00"),
    ("2026-03-01Z", dt.datetime(2026, 3, 1), "2026-03-01T00:00:00+00:00"),
    ("2026-03-01T10:00:00 +05:00", dt.datetime(2026, 3, 1, 5), "2026-03-01T10:00:00+05:00"),
    ("2026-03-01 10:00 Z", dt.datetime(2026, 3, 1, 10), "2026-03-01T10:00:00+00:00"),
    ("2026-03-01T10:00:00-00:00", dt.datetime(2026, 3, 1, 10), "2026-03-01T10:00:00+00:00"),
    ("2026-W10-1", dt.datetime(2026, 3, 2), "2026-03-02T00:00:00+00:00"),
    ("2026W10", dt.datetime(2026, 3, 2), "2026-03-02T00:00:00+00:00"),
    ("2026W533T10:00", dt.datetime(2026, 12, 30, 10), "2026-12-30T10:00:00+00:00"),
    ("2026-W10-10", dt.datetime(2026, 3, 2, 10), "2026-03-02T10:00:00+00:00"),   # a separator and an hour
    ("2026-03-01T10:00+05:30:15", dt.datetime(2026, 3, 1, 4, 29, 45), "2026-03-01T10:00:00+05:30:15"),
    ("2026-03-01T10:00-053015.25", dt.datetime(2026, 3, 1, 15, 30, 15, 250000), "2026-03-01T10:00:00-05:30:15.250000"),
    ("2026-03-01T10:00-00:00:00.1", dt.datetime(2026, 3, 1, 10), "2026-03-01T10:00:00+00:00"),
    ("2026-03-01T10:00+23:59", dt.datetime(2026, 2, 28, 10, 1), "2026-03-01T10:00:00+23:59"),
] + [(bad, None, None) for bad in ["2025-W53-1", "2026-W00-1", "2026-W10-8", "2026-W10-0", "2026-W10-", "2026-W101", "2026W10-1",
                                   "9999-W52-7", "0000-W10-1", "2026-03-01T10:00+24:00", "2026-03-01T10:00+0530:15", "2026", "2026-03", "2026-3-1", "2026-02-30", "now", "epoch", "nan", "", None,
                                   "01/03/2026", "2026-03-01T10:00:00.5 +05:00", "2026-03-01T10:00:00  +05:00", "0000-01-01"]]


def test_parse_and_iso(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(PARSE_CASES)], "i int, s string")
    out = with_iso_date(df, "s", "ts", "iso").withColumn("ts", F.col("ts").cast("timestamp_ntz")).orderBy("i")
    got = [(r["ts"], r["iso"]) for r in out.collect()]
    assert got == [(c[1], c[2]) for c in PARSE_CASES]


def test_truthy_text(spark):
    vals = [None, "true", "True", "TRUE", "false", "FALSE", "0", "1", "0.0", "2.5", "yes", "no", "tRUE"]
    assert one_col(spark, vals, truthy_text) == [False, True, True, True, False, False, False, True, False, True,
                                                 True, True, True]


def enrich(spark, title, desc, **kw):
    df = spark.createDataFrame([(title, desc)], "t string, d string")
    return with_enrichment(df, "t", "d", **kw).first()


def test_enrich_rows(spark):
    r = enrich(spark, "Analytics Engineer, Data Platform", "Airflow and Spark jobs; dashboards in Tableau, code in Python.")
    assert (r["role_type"], r["skills_extracted"]) == ("Data", ["airflow", "python", "spark", "tableau"])
    r = enrich(spark, "Lead Backend Developer", "AWS hosts, dbt, Spark services.")
    assert (r["role_type"], r["seniority_level"], r["skills_extracted"]) == ("Backend", "Senior",
                                                                             ["aws", "dbt", "spark"])


@pytest.mark.parametrize("title,desc,role", [
    ("Mobile Engineer", "Ship React Native apps", "Frontend"),        # react shadows react native
    ("Security Engineer", "Harden cloud infrastructure", "DevOps"),   # infrastructure before Security
    ("Frontend Engineer", "Consume REST APIs", "Backend"),            # 'api' inside 'APIs'
    ("Product Manager", "Own the data platform roadmap", "Data"),     # data platform wins
    ("Chef", "Cook pasta", "Other"),
])
def test_role_rule_order(spark, title, desc, role):
    assert enrich(spark, title, desc)["role_type"] == role


@pytest.mark.parametrize("desc,skills", [
    ("sqlé and pythonic and _python", []),            # Unicode \b: letters glue words
    ("postgres, postgresql", ["postgres", "postgresql"]),
    ("Power BI dashboards; power  bi", ["power bi"]),
    ("python3 py-thon Python!", ["python"]),
])
def test_keyword_word_boundaries(spark, desc, skills):
    assert enrich(spark, "", desc)["skills_extracted"] == skills


def test_keywords_with_symbols(spark):
    # \b next to a symbol needs a word character on its other side (as in Python)
    r = enrich(spark, "", "C++ and .NET devs", keywords=["c++", ".net", "go"])
    assert r["skills_extracted"] == []
    r = enrich(spark, "", "use c++x and a.net, not c++ alone", keywords=["c++", ".net", "go"])
    assert r["skills_extracted"] == [".net", "c++"]


@pytest.mark.parametrize("text,level", [
    ("Junior Senior", "Junior"), ("Staff engineer", "Senior"), ("mid-level", "Mid"),
    ("internal tools", "Unspecified"), ("Team LEAD", "Senior"), ("midfield", "Unspecified"),
])
def test_seniority_word_rules(spark, text, level):
    assert enrich(spark, text, "")["seniority_level"] == level

"""Dedup policies, keyed merges, data-quality checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobsmith.operators import merge as M
from jobsmith.operators.dedup import collapse_last_arrival, dedup_first_seen, dedup_latest, dedup_latest_agg
from jobsmith.session import materialize

D = dt.datetime


def frame(spark, rows):
    return spark.createDataFrame(rows, "job_hash string, publication_date timestamp, ingested_at timestamp, "
                                       "source string, pos int, title string")


def winners(df):
    return {r["job_hash"]: r["title"] for r in df.collect()}


def test_latest_wins(spark):
    df = frame(spark, [("q", D(2025, 12, 30), None, "api", 3, "third"), ("q", D(2026, 1, 9), None, "api", 1, "winner"),
                       ("q", D(2025, 7, 1), None, "csv", 2, "first"), ("r", None, None, "csv", 4, "undated")])
    assert winners(dedup_latest(df)) == {"q": "winner", "r": "undated"}


def test_tie_rules(spark):
    t0, t1 = D(2026, 1, 1), D(2026, 1, 2)
    df = frame(spark, [
        ("a", None, t1, "csv", 1, "null date"), ("a", D(2020, 1, 1), t0, "api", 2, "any date"),
        ("b", D(2026, 3, 1), t0, "csv", 1, "earlier ingest"), ("b", D(2026, 3, 1), t1, "api", 2, "later ingest"),
        ("c", D(2026, 3, 1), t0, "api", 9, "api"), ("c", D(2026, 3, 1), t0, "csv", 1, "csv"),
        ("d", D(2026, 3, 1), t0, "csv", 1, "first"), ("d", D(2026, 3, 1), t0, "csv", 2, "later position"),
    ])
    expect = {"a": "any date", "b": "later ingest", "c": "csv", "d": "later position"}
    assert winners(dedup_latest(df, tie_breakers=[F.col("pos").desc()])) == expect
    assert winners(dedup_latest_agg(df, tie_breakers=[F.col("pos")])) == expect


def test_first_seen(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", 5, "c")], "k string, seq int, v string")
    assert {r["k"]: r["v"] for r in dedup_first_seen(df, "k", [F.col("seq")]).collect()} == {"k": "a", "j": "c"}


def test_collapse_last_arrival(spark):
    df = spark.createDataFrame([
        ("k", 1, "u1", "api", "t1"), ("k", 2, None, "x", "t2"), ("k", 3, "u3", "y", "t3"), ("k", 4, None, "z", "t4"),
        ("m", 1, None, "api", "only")], "job_hash string, seq int, job_url string, source string, title string")
    got = {r["job_hash"]: (r["title"], r["job_url"], r["source"], r["seq"])
           for r in collapse_last_arrival(df, "job_hash", "seq").collect()}
    assert got == {"k": ("t4", "u3", "api", 4), "m": ("only", None, "api", 1)}


def tbl(spark, rows):
    return spark.createDataFrame(rows, "job_hash string, job_url string, title string, source string")


def test_upsert_rules(spark):
    target = tbl(spark, [("k1", "u1", "old", "api"), ("k2", "u2", "keep", "api")])
    source = tbl(spark, [("k1", None, "new", "csv"), ("k3", "u3", "ins", "csv")])
    out = {r["job_hash"]: (r["job_url"], r["title"], r["source"]) for r in
           M.upsert(target, source, "job_hash", coalesce_new_old=("job_url",)).collect()}
    assert out == {"k1": ("u1", "new", "csv"), "k2": ("u2", "keep", "api"), "k3": ("u3", "ins", "csv")}
    # stream table: source is never updated
    out = {r["job_hash"]: r["source"] for r in
           M.upsert(target, source, "job_hash", coalesce_new_old=("job_url",), keep_old=("source",)).collect()}
    assert out == {"k1": "api", "k2": "api", "k3": "csv"}


def test_upsert_duplicate_source_key_fails(spark):
    target = tbl(spark, [("k1", "u1", "old", "api")])
    source = tbl(spark, [("k1", None, "a", "csv"), ("k1", None, "b", "csv")])
    with pytest.raises(Exception, match="duplicate key"):
        M.upsert(target, source, "job_hash").collect()


def test_metrics_upsert_keeps_vanished_days(spark):
    old = spark.createDataFrame([(dt.date(2026, 3, 1), 5), (dt.date(2026, 3, 2), 7)], "metric_date date, total_jobs long")
    new = spark.createDataFrame([(dt.date(2026, 3, 2), 1), (dt.date(2026, 3, 3), 2)], "metric_date date, total_jobs long")
    got = sorted(tuple(r) for r in M.upsert_metrics(old, new).collect())
    assert got == [(dt.date(2026, 3, 1), 5), (dt.date(2026, 3, 2), 1), (dt.date(2026, 3, 3), 2)]


@pytest.mark.parametrize("flag,expect", [("1", True), ("TRUE", True), ("Yes", True), ("", False), (None, False),
                                         ("0", False), ("on", False)])
def test_full_refresh_flag(flag, expect):
    assert M.full_refresh_requested(flag) is expect


def test_data_quality(spark):
    df = tbl(spark, [("k1", "u", "a", "api"), ("k1", "", "b", "api"), ("k2", "", "c", None), ("k3", "u", "d", None)])
    assert [tuple(r) for r in M.duplicate_keys(df, "job_hash").collect()] == [("k1", 2)]
    assert [tuple(r) for r in M.duplicate_urls(df).collect()] == [("u", 2)]
    assert M.null_counts(df, ["source", "title"]).first().asDict() == {"source_nulls": 2, "title_nulls": 0}
    ok, bad = M.split_quarantine(df, ["source"])
    assert (ok.count(), bad.count()) == (2, 2)


def test_submit_batch_job_end_to_end(spark):
    """Landed pages + CSV -> transform -> load, twice; the second load upserts."""
    import json
    import os

    from jobsmith.operators.reports import dashboard
    from jobsmith.plans.submit import run
    from jobsmith.session import scratch_path
    base = scratch_path(spark, "submit")
    os.makedirs(base + "/pages")
    os.makedirs(base + "/csv")
    post = {"id": 1, "title": "Data Engineer", "company": {"display_name": "Acme"}, "created": "2026-03-10",
            "redirect_url": "https://x/1", "description": "Python"}
    with open(base + "/pages/p.json", "w") as f:
        f.write(json.dumps({"page": 1, "results": [post, dict(post, id=2, redirect_url="https://x/2")]}) + "\n")
    with open(base + "/csv/a.csv", "w") as f:
        f.write("job_id,source,title,company,location,is_remote,category,publication_date,job_url,description\n")
        f.write("c1,csv,Data Engineer,Acme,EU,true,x,2026-03-10,https://x/1,Python and SQL\n")
    clean, metrics = run(spark, base + "/pages", base + "/csv", base + "/out")
    got = {r["job_url"]: (r["source"], r["skills_extracted"]) for r in clean.collect()}
    assert got == {"https://x/1": ("csv", ["python", "sql"]), "https://x/2": ("api", ["python"])}
    assert metrics.first()["total_jobs"] == 2
    clean, _ = run(spark, base + "/pages", base + "/csv", base + "/out")
    assert clean.count() == 2
    d = dashboard(clean, clean.select("ingested_at", "title", "company", "location", "job_url", "job_hash"), metrics)
    assert d["top_skills"].first()["skill"] == "python"


def test_incremental_metrics_equal_full_recompute(spark):
    """Two loads (the second moves a posting to another day): recomputing only the
    touched days gives the same metrics table as recomputing every day."""
    import datetime as dt

    from pyspark.sql import functions as F

    from jobsmith.operators.metrics import metrics_as_json
    from jobsmith.plans.batch import load
    from jobsmith.plans.snapshots import Snapshot
    from jobsmith.schema import METRICS_SCHEMA, POSTING_SCHEMA, conform
    from jobsmith.session import scratch_path

    def batch(rows):
        df = spark.createDataFrame(rows, "job_hash string, publication_date timestamp, company string, "
                                         "role_type string, skills_extracted array<string>")
        return conform(df.withColumn("source", F.lit("csv")).withColumn("ingested_at", F.current_timestamp()))

    d = dt.datetime
    b1 = batch([("a", d(2026, 3, 1), "X", "Data", ["sql"]), ("b", d(2026, 3, 2), "Y", "QA", []),
                ("c", d(2026, 3, 3), "Z", "ML", ["python"])])
    b2 = batch([("a", d(2026, 3, 4), "X", "Data", ["sql"]), ("d", d(2026, 3, 2), "", None, ["go"])])
    out = {}
    for mode in (False, True):
        base = scratch_path(spark, "inc")
        clean = Snapshot(spark, base + "/clean", POSTING_SCHEMA)
        metrics = Snapshot(spark, base + "/metrics", METRICS_SCHEMA)
        for b in (b1, b2):
            _, m = load(spark, b, staging_path=base + "/staging", clean=clean, metrics=metrics,
                        clock=F.lit(None).cast("timestamp"), incremental_metrics=mode)
        out[mode] = sorted(tuple(r) for r in metrics_as_json(m).drop("computed_at").collect())
    assert out[True] == out[False]
    assert [r[0] for r in out[True]] == [dt.date(2026, 3, d) for d in (1, 2, 3, 4)]
    # day 1 lost its only posting to day 4, yet its row stays (as in the original upsert)
    assert out[True][0][1] == 1


def test_upsert_duplicate_key_fails_for_any_column(spark):
    target = tbl(spark, [("k1", "u1", "old", "api")])
    twice = tbl(spark, [("b", "u", "x", "csv"), ("b", "v", "y", "csv")])
    with pytest.raises(Exception, match="duplicate key"):
        M.upsert(target, twice, "job_hash").select("job_url").collect()
    with pytest.raises(Exception, match="NULL key"):
        M.upsert(target, tbl(spark, [(None, "u", "x", "csv")]), "job_hash").select("title").collect()


def test_upsert_is_one_join_of_two_scans(spark):
    target = materialize(tbl(spark, [(f"k{i}", f"u{i}", "old", "api") for i in range(20)]), "target")
    source = materialize(tbl(spark, [("k1", None, "new", "csv"), ("n1", None, "ins", "csv")]), "source")
    out = M.upsert(target, source, "job_hash", coalesce_new_old=("job_url",), keep_old=("source",))
    got = sorted(tuple(r) for r in out.collect())
    assert len(got) == 21 and ("k1", "u1", "new", "api") in got and ("n1", None, "ins", "csv") in got
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join ") == 1


def test_full_refresh_replaces_clean_keeps_vanished_metrics(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from jobsmith.plans.batch import load
    from jobsmith.plans.snapshots import Snapshot
    from jobsmith.schema import METRICS_SCHEMA, POSTING_SCHEMA, conform
    from jobsmith.session import scratch_path

    def batch(rows):
        df = spark.createDataFrame(rows, "job_hash string, publication_date timestamp, company string")
        return conform(df.withColumn("source", F.lit("csv")).withColumn("ingested_at", F.current_timestamp()))

    base = scratch_path(spark, "refresh")
    clean = Snapshot(spark, base + "/clean", POSTING_SCHEMA)
    metrics = Snapshot(spark, base + "/metrics", METRICS_SCHEMA)
    kw = dict(staging_path=base + "/staging", clean=clean, metrics=metrics)
    load(spark, batch([("a", dt.datetime(2026, 3, 1), "X"), ("b", dt.datetime(2026, 3, 2), "Y")]), **kw)
    c, m = load(spark, batch([("c", dt.datetime(2026, 3, 3), "Z")]), full_refresh="TRUE", **kw)
    assert [r["job_hash"] for r in c.collect()] == ["c"]
    assert sorted((r["metric_date"], r["total_jobs"]) for r in m.collect()) == [
        (dt.date(2026, 3, 1), 1), (dt.date(2026, 3, 2), 1), (dt.date(2026, 3, 3), 1)]
    c, _ = load(spark, batch([("d", dt.datetime(2026, 3, 3), "Z")]), full_refresh="no", **kw)
    assert sorted(r["job_hash"] for r in c.collect()) == ["c", "d"]

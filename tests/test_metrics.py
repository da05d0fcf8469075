"""Daily metrics: totals, per-day top-k with ties, empty lists, role map order."""

import datetime as dt

from pyspark.sql import functions as F

from jobsmith.operators import reports as RP
from jobsmith.operators.metrics import daily_metrics, metrics_as_json

D = dt.datetime


def jobs(spark, rows):
    return spark.createDataFrame(rows, "publication_date timestamp, company string, role_type string, "
                                       "skills_extracted array<string>")


def test_daily_metrics_shapes(spark):
    day1 = [(D(2026, 3, 1, 10), f"c{i % 12}", "Data", [f"s{i % 12}", "python"]) for i in range(24)]
    day2 = [(D(2026, 3, 2), "", None, []), (D(2026, 3, 2, 23, 59), None, "QA", [])]
    nodate = [(None, "ghost", "ML", ["rust"])]
    df = jobs(spark, day1 + day2 + nodate)
    m = {r["metric_date"]: r for r in metrics_as_json(daily_metrics(df, clock=F.lit(None).cast("timestamp"))).collect()}
    assert set(m) == {dt.date(2026, 3, 1), dt.date(2026, 3, 2)}
    d1 = m[dt.date(2026, 3, 1)]
    assert d1["total_jobs"] == 24
    # 12 companies with 2 each: top-10 cut, ties broken by label
    assert d1["top_companies"] == "[" + ",".join('{"jobs":2,"company":"%s"}' % c for c in
                                                sorted(f"c{i}" for i in range(12))[:10]) + "]"
    assert d1["top_skills"].startswith('[{"jobs":24,"skill":"python"},{"jobs":2,"skill":"s0"}')
    assert d1["role_counts"] == '{"Data":24}'
    d2 = m[dt.date(2026, 3, 2)]
    assert (d2["total_jobs"], d2["top_companies"], d2["top_skills"]) == (2, "[]", "[]")
    assert d2["role_counts"] == '{"QA":1,"Unspecified":1}'


def test_role_map_jsonb_key_order(spark):
    rows = [(D(2026, 3, 1), "c", r, []) for r in ["Security", "QA", "Backend", "ML", "Data"]]
    m = metrics_as_json(daily_metrics(jobs(spark, rows))).first()
    assert m["role_counts"] == '{"ML":1,"QA":1,"Data":1,"Backend":1,"Security":1}'


def test_reports(spark):
    rows = [(D(2026, 3, 1), "a", "Data", ["x"]), (D(2026, 3, 1), "b", None, ["x", "y"]), (None, "", "Data", [])]
    df = jobs(spark, rows)
    assert RP.total_rows(df).first()["c"] == 3
    assert [tuple(r) for r in RP.jobs_over_time(df).collect()] == [(dt.date(2026, 3, 1), 2)]
    assert dict(tuple(r) for r in RP.jobs_by_role(df).collect()) == {"Data": 2, "Unspecified": 1}
    assert dict(tuple(r) for r in RP.jobs_by_role(df, coalesce_role=False).collect()) == {"Data": 2, None: 1}
    assert [tuple(r) for r in RP.top_companies(df).collect()] == [("a", 1), ("b", 1)]
    assert [tuple(r) for r in RP.top_skills(df).collect()] == [("x", 2), ("y", 1)]

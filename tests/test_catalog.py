"""Registered queries against the DuckDB oracle (sf0.001) and plan-shape checks."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

SAMPLE = ["daily_metrics", "daily_metrics_events", "norm_csv", "norm_paged_api", "transform_batch",
          "sink_upsert_clean", "dedup_latest", "topk_per_day", "dt_parse", "text_enrich", "stream_upsert",
          "stream_resume", "dq_unique_key", "agg_role_nullgroup", "limit_head"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_key_has_oracle():
    own = set(E.queries()) - set(E.LLM_QUERIES)
    assert own == set(E.oracle_sql()) - set(E.LLM_SQL)
    assert len(own) >= 87


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, duck, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    o = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert digest(s) == digest(o)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["metric_date", "total_jobs", "top_companies", "top_skills", "role_counts"]
    assert df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_shape(spark):
    from jobsmith.operators.metrics import daily_metrics
    from jobsmith.plans import adapters as A
    p = plan(daily_metrics(A.postings(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p            # top-k cut map-side, before the shuffle
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BroadcastExchange" in p           # nation (25 rows) broadcast explicitly


def test_projection_pruned_to_scan(spark):
    from jobsmith.plans import adapters as A
    p = plan(A.postings(spark, SF_SMALL).select("company"))
    assert "n_name" in p and "html" not in p  # pages.html never read

"""Posting store: touched partitions only, counts by deltas, recovery."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from jobsmith.operators.merge import upsert_clean, upsert_metrics
from jobsmith.operators.metrics import daily_metrics, metrics_as_json
from jobsmith.plans.store import ConstraintError, PostingStore
from jobsmith.schema import POSTING_SCHEMA
from jobsmith.session import scratch_path

CLOCK = dt.datetime(2026, 1, 1)


def posting(key, day=None, company="c", role="r", skills=(), url=None, title="t", month=3):
    date = None if day is None else dt.datetime(2026, month, day, 5)
    return (key, None, "api", title, company, "", False, "", date, url, "", list(skills), role, "Mid", CLOCK)


def batch(spark, rows):
    return spark.createDataFrame(rows, POSTING_SCHEMA)


def files(store, table):
    fs = sorted({r[0] for r in table.read().select(F.col("_metadata.file_path")).distinct().collect()}) if table.read().count() else []
    return set(fs)


def metrics_rows(df):
    return {tuple(r) for r in metrics_as_json(df).drop("computed_at").collect()}


def test_small_batch_replaces_only_its_partitions(spark):
    store = PostingStore(spark, scratch_path(spark, "store"), 32)
    store.load(batch(spark, [posting(f"k{i}", 1 + i % 28, month=1 + i % 12) for i in range(1000)]))
    clean, counts = files(store, store.clean), files(store, store.counts)
    assert len(clean) == 32 and len(counts) == 12  # one file a partition
    store.load(batch(spark, [posting(f"k{i}", 3, month=3, title="new") for i in (3, 4)]))  # from April and May to March
    after, months = files(store, store.clean), files(store, store.counts)
    assert 1 <= len(clean - after) <= 2 and len(clean - after) == len(after - clean)
    assert {f.split("month=")[1][:6] for f in counts - months} == {"202603", "202604", "202605"}
    assert store.postings().count() == 1000
    assert {r["job_hash"] for r in store.postings().where("title = 'new'").collect()} == {"k3", "k4"}
    plan = store.clean.read().where(F.col("bucket").isin(1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan


def test_merge_shuffles_each_side_once(spark):
    store = PostingStore(spark, scratch_path(spark, "store"), 8)
    store.load(batch(spark, [posting(f"k{i}", 1) for i in range(50)]))
    src = batch(spark, [posting("k1", 2)])
    old = store.clean.read().where("bucket = 1")
    from jobsmith.operators.merge import upsert
    plan = upsert(old.repartition(8, "job_hash"), src.repartition(8, "job_hash"), "job_hash", columns=POSTING_SCHEMA.names,
                  check_unique=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_equal_full_recomputation(spark, seed):
    rng = random.Random(seed)
    store = PostingStore(spark, scratch_path(spark, "store"), 8)
    clean, metrics = batch(spark, []), daily_metrics(batch(spark, []), clock=F.lit(CLOCK))
    for step in range(4):
        keys = rng.sample(range(60), 25 if step else 40)
        rows = [posting(f"k{k}", rng.choice([None, 1, 2, 3, 20 + step]), rng.choice(["", "a", "b", None]), rng.choice(["x", None]),
                        rng.sample(["s1", "s2", "s3"], rng.randrange(4)), rng.choice([None, f"u{k}"])) for k in keys]
        src = batch(spark, rows)
        refresh = step == 3
        store.load(src, full_refresh="yes" if refresh else None, clock=F.lit(CLOCK))
        old = batch(spark, []) if refresh else clean
        clean = spark.createDataFrame(upsert_clean(old, src).collect(), POSTING_SCHEMA)
        new = upsert_metrics(metrics, daily_metrics(clean, clock=F.lit(CLOCK)))
        metrics = spark.createDataFrame(new.collect(), new.schema)
        assert {str(r) for r in store.postings().collect()} == {str(r) for r in clean.collect()}
        assert metrics_rows(store.metrics.read()) == metrics_rows(metrics)


def test_day_that_loses_its_last_posting_keeps_its_row(spark):
    store = PostingStore(spark, scratch_path(spark, "store"), 4)
    store.load(batch(spark, [posting("k", 1), posting("m", 2)]))
    store.load(batch(spark, [posting("k", 2)]))
    assert {(r["metric_date"].day, r["total_jobs"]) for r in store.metrics.read().collect()} == {(1, 1), (2, 2)}
    store.load(batch(spark, [posting("n", 1)]))  # the day comes back with what it holds now
    assert {(r["metric_date"].day, r["total_jobs"]) for r in store.metrics.read().collect()} == {(1, 1), (2, 2)}
    store.load(batch(spark, []))
    assert store.postings().count() == 3


def test_bad_batch_changes_nothing_and_broken_load_is_finished(spark, monkeypatch):
    store = PostingStore(spark, scratch_path(spark, "store"), 4)
    store.load(batch(spark, [posting("k", 1)]))
    for bad in ([posting("k", 2), posting("k", 3)], [posting(None, 2)]):
        with pytest.raises(Exception, match="duplicate key or NULL key"):
            store.load(batch(spark, bad))
    assert not store.recover()
    assert [r["publication_date"].day for r in store.postings().collect()] == [1]
    # a driver lost between the two swaps: the clean table is new, the counts are old
    write = type(store.counts).write
    monkeypatch.setattr(store.counts, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.load(batch(spark, [posting("k", 4), posting("m", 4)]))
    monkeypatch.setattr(store.counts, "write", lambda rows, whole: write(store.counts, rows, whole))
    assert store.recover() and not store.recover()
    got = {(r["metric_date"].day, r["total_jobs"]) for r in store.metrics.read().collect()}
    assert got == {(1, 1), (4, 2)} and store.postings().count() == 2
    store.load(batch(spark, [posting("m", 5)]))
    assert {(r["metric_date"].day, r["total_jobs"]) for r in store.metrics.read().collect()} == {(1, 1), (4, 1), (5, 1)}


def test_constraints_are_checked_in_the_staging_pass(spark):
    store = PostingStore(spark, scratch_path(spark, "store"), 4, with_metrics=False, unique_url=True)
    urls = lambda: {(r["job_url"], r["job_hash"]) for r in store.urls.read().where("job_hash IS NOT NULL").collect()}
    store.load(batch(spark, [posting("a", url="u1"), posting("b", url="u2"), posting("c", url=""), posting("d", url=""), posting("e")]))
    assert urls() == {("u1", "a"), ("u2", "b")}
    for bad in ([posting("f", url="u1")],                          # held by a row that the batch does not touch
                [posting("f", url="u3"), posting("g", url="u3")],  # twice in the batch
                [posting("b", url="u1"), posting("e", url="u5")]):
        with pytest.raises(ConstraintError, match="job_url under two keys: 1 rows"):
            store.load(batch(spark, bad))
        assert urls() == {("u1", "a"), ("u2", "b")} and store.postings().count() == 5 and not store.recover()
    store.load(batch(spark, [posting("a", url="u4"), posting("b")]))               # u1 is free again; b keeps its own
    store.load(batch(spark, [posting("f", url="u1"), posting("a", url="u2"), posting("b", url="u4")]))  # two swap theirs
    assert urls() == {("u1", "f"), ("u2", "a"), ("u4", "b")}
    for missing in ("source", "ingested_at"):
        row = batch(spark, [posting("z", url="u9")]).withColumn(missing, F.lit(None).cast(POSTING_SCHEMA[missing].dataType))
        with pytest.raises(ConstraintError, match=f"{missing} is null: 1 rows"):
            store.load(row)
    store.load(batch(spark, []))
    assert store.postings().count() == 6 and len(urls()) == 3
    store.load(batch(spark, [posting("k", url="u2")]), full_refresh=True)
    assert urls() == {("u2", "k")} and store.postings().count() == 1


def test_url_index_equals_the_clean_table(spark):
    rng, store, clean = random.Random(9), PostingStore(spark, scratch_path(spark, "store"), 4, with_metrics=False, unique_url=True), {}
    for _ in range(4):
        new = {f"k{k}": rng.choice([None, "", f"u{rng.randrange(25)}"]) for k in rng.sample(range(20), 6)}
        after = clean | {k: clean.get(k) if u is None else u for k, u in new.items()}
        held = [u for u in after.values() if u]
        if len(held) > len(set(held)):
            with pytest.raises(ConstraintError):
                store.load(batch(spark, [posting(k, url=u) for k, u in new.items()]))
        else:
            store.load(batch(spark, [posting(k, url=u) for k, u in new.items()]))
            clean = after
        index = store.urls.read().where("job_hash IS NOT NULL").collect()
        assert {(r["job_hash"], r["job_url"]) for r in index} == {(k, u) for k, u in clean.items() if u}


def test_staged_folders_are_moved_in_not_copied(spark, monkeypatch):
    """Before, the clean table and the URL index were written once more from what a load had staged."""
    store = PostingStore(spark, scratch_path(spark, "store"), 4, with_metrics=False, unique_url=True)
    for t in (store.clean, store.urls):
        monkeypatch.setattr(t, "write", lambda *a: (_ for _ in ()).throw(AssertionError("written again")))
    store.load(batch(spark, [posting(f"k{i}", 1, url=f"u{i}") for i in range(20)]))
    store.load(batch(spark, [posting("k1", 2, url="u1"), posting("n", 2, url="u30")]))
    assert store.postings().count() == 21 and store.urls.read().where("job_hash IS NOT NULL").count() == 21
    # a driver lost between the two swaps of a whole and of a partial load
    for refresh, rows, count in ((False, [posting("k2", 3, url="u40")], 21), (True, [posting("z", 3, url="u50")], 1)):
        with monkeypatch.context() as m:
            m.setattr(store.urls, "take", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                store.load(batch(spark, rows), full_refresh=refresh)
        assert store.recover() and not store.recover()
        urls = {r["job_url"] for r in store.urls.read().where("job_hash IS NOT NULL").collect()}
        assert store.postings().count() == len(urls) == count and rows[0][9] in urls


def test_move_that_broke_off_is_finished(spark):
    from jobsmith.plans.store import Partitioned
    base = scratch_path(spark, "moved")
    schema = "k string, bucket int"
    table = Partitioned(spark, base + "/t", spark.createDataFrame([], schema).schema)
    table.write(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], schema), True)
    spark.createDataFrame([("A", 1), ("B", 2)], schema).write.partitionBy("bucket").parquet(base + "/s")
    spark.createDataFrame([("A", 1)], schema).write.partitionBy("bucket").parquet(base + "/first")
    table.take(base + "/first", False)  # as far as a lost driver came
    table.take(base + "/s", False)
    table.take(base + "/s", False)
    assert sorted(map(tuple, table.read().collect())) == [("A", 1), ("B", 2), ("c", 3)]
    spark.createDataFrame([("x", 7)], schema).write.partitionBy("bucket").parquet(base + "/w")
    for _ in range(2):
        table.take(base + "/w", True)
        assert [tuple(r) for r in table.read().collect()] == [("x", 7)]


def test_stored_texts_are_compressed(spark):
    """Landed text and what a load stages: before, plain text and Snappy."""
    from jobsmith.plans import landing as L
    import os
    raw = spark.createDataFrame([("1", "s", "t", "c", "l", "true", "x", "2026-01-01", None, "a \"b\",\nc " * 200)], ", ".join(
        f"{c} string" for c in ("job_id", "source", "title", "company", "location", "is_remote", "category", "publication_date",
                                "job_url", "description")))
    path = L.write_csv(raw, scratch_path(spark, "csv"))
    assert all(f.endswith(".csv.gz") for f in os.listdir(path) if f.startswith("part-"))
    from jobsmith.sources.files import read_postings_csv
    assert [tuple(r) for r in read_postings_csv(spark, path).collect()] == [tuple(r) for r in raw.collect()]
    store = PostingStore(spark, scratch_path(spark, "store"), 4)
    store.load(batch(spark, [posting("k", 1)]))
    assert all(".zstd." in f for f in files(store, store.clean))

"""Streaming: payload rules, upsert across micro-batches, quarantine, bounded dedup,
and batch/stream equivalence."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from jobsmith.functions import json as J
from jobsmith.operators.normalize import stream_payload
from jobsmith.session import scratch_path
from jobsmith.streaming import jobs as S


def payload_rows(spark, payloads):
    df = spark.createDataFrame([(json.dumps(p),) for p in payloads], "value string")
    return stream_payload(df).collect()


def test_payload_rules(spark):
    base = {"job_hash": "h", "title": "T"}
    out = payload_rows(spark, [base, dict(base, is_remote=None), dict(base, is_remote="false"),
                               dict(base, is_remote=0), dict(base, source=""), dict(base, source=None),
                               dict(base, source="x", publication_date="2026-03-01T10:00:00+02:00")])
    assert [r["is_remote"] for r in out] == [True, False, True, False, True, True, True]
    assert [r["source"] for r in out] == ["api"] * 6 + ["x"]
    assert str(out[6]["publication_date"]) == "2026-03-01 08:00:00"
    assert out[0]["company"] is None  # text passes through untouched


def land(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for key, value, seq in records:
            f.write(json.dumps({"key": key, "value": json.dumps(dict(value, seq=seq))}) + "\n")


def test_stream_upsert_across_batches(spark):
    base = scratch_path(spark, "stream")
    records = base + "/records"
    land(records, "a.json", [("k", {"job_hash": "k", "job_url": "u1", "source": "api", "title": "t1"}, 1),
                             ("k", {"job_hash": "k", "job_url": None, "source": "x", "title": "t2"}, 2),
                             ("", {"title": "no key"}, 3)])
    table = S.StreamTable(spark, base + "/table")
    seq = J.vget(J.decode(F.col("value")), "$.seq", "bigint")

    def run():
        q = S.start(S.record_stream(spark, records, max_files_per_trigger=1), checkpoint=base + "/ckpt",
                    foreach_batch=S.upsert_batch_fn(table, seq=seq, quarantine=base + "/quarantine"))
        q.awaitTermination()

    run()
    land(records, "b.json", [("k", {"job_hash": "k", "job_url": None, "source": "y", "title": "t3"}, 4),
                             ("m", {"job_hash": "m", "title": "m1"}, 5)])
    run()  # resumes from the checkpoint: only b.json is read
    got = {r["job_hash"]: (r["title"], r["job_url"], r["source"]) for r in table.read().collect()}
    assert got == {"k": ("t3", "u1", "api"), "m": ("m1", None, "api")}
    assert spark.read.parquet(base + "/quarantine").count() == 1


def test_publish_dedups_keys(spark):
    base = scratch_path(spark, "pub")
    land_dir = base + "/in"
    os.makedirs(land_dir)
    p = {"id": 1, "title": "Dev", "company": {"display_name": "Acme"}, "redirect_url": "https://x/1"}
    with open(os.path.join(land_dir, "p.json"), "w") as f:
        f.write(json.dumps(p) + "\n" + json.dumps(dict(p, title="Dev again")) + "\n"
                + json.dumps(dict(p, redirect_url="https://x/2")) + "\n")
    stream = spark.readStream.schema("value string").text(land_dir).select(J.decode(F.col("value")).alias("j"))
    S.start(S.publish(stream), checkpoint=base + "/ckpt", sink=base + "/out").awaitTermination()
    out = spark.read.schema(S.RECORD_SCHEMA).json(base + "/out").collect()
    assert len(out) == 2 and len({r["key"] for r in out}) == 2
    v = json.loads(out[0]["value"])
    assert set(v) == {"job_hash", "job_id", "source", "title", "company", "location", "is_remote", "category",
                      "publication_date", "job_url", "description"}


def test_batch_stream_equivalence(spark):
    """The streamed stream table equals the one-shot batch collapse of the same records."""
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    q = E.queries()
    a = q["stream_upsert"](spark, SF_SMALL)
    b = q["dedup_last_arrival"](spark, SF_SMALL)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bounded_dedup_forgets_after_delay(spark):
    """dropDuplicatesWithinWatermark: a repeat within the delay is dropped; once the
    watermark passes first-seen + delay the key is forgotten (evicted at the end of
    the next micro-batch) and a later occurrence is emitted again."""
    base = scratch_path(spark, "bounded")
    rec = base + "/in"

    def put(name, rows):
        os.makedirs(rec, exist_ok=True)
        with open(os.path.join(rec, name), "w") as f:
            for key, ts in rows:
                f.write(json.dumps({"key": key, "value": json.dumps({"ts": ts})}) + "\n")

    put("1.json", [("k", "2026-03-01T00:00:00"), ("k", "2026-03-01T01:00:00")])
    put("2.json", [("m", "2026-03-05T00:00:00")])
    put("3.json", [("n", "2026-03-05T02:00:00")])
    put("4.json", [("k", "2026-03-05T03:00:00")])
    # the file source orders by modification time: make it explicit
    for i, n in enumerate(["1.json", "2.json", "3.json", "4.json"]):
        os.utime(os.path.join(rec, n), (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    stream = S.record_stream(spark, rec, max_files_per_trigger=1)
    ts = J.vget(J.decode(F.col("value")), "$.ts", "string").try_cast("timestamp")
    out = S.dedup_within(stream.withColumn("ts", ts), ["key"], F.col("ts"), "1 day")
    S.start(out, checkpoint=base + "/ckpt", sink=base + "/out", fmt="parquet").awaitTermination()
    got = sorted((r["key"], str(r["ts"])) for r in spark.read.parquet(base + "/out").collect())
    assert got == [("k", "2026-03-01 00:00:00"), ("k", "2026-03-05 03:00:00"), ("m", "2026-03-05 00:00:00"),
                   ("n", "2026-03-05 02:00:00")]


def test_daily_counts_late_rows_and_resume(spark):
    """Rows for an open day count however late; a closed day's do not; a second run goes on from the first."""
    base = scratch_path(spark, "days")
    out = S.LatestTable(spark, base + "/out", ["day", "k"], "day date, k string, n long")

    def land_and_run(*rows):
        spark.createDataFrame(rows, "ts string, k string").coalesce(1).write.mode("append").json(base + "/in")
        events = spark.readStream.schema("ts string, k string").option("maxFilesPerTrigger", 1).json(base + "/in")
        S.start(S.daily_counts(events, F.col("ts").try_cast("timestamp"), ["k"], "1 day"), checkpoint=base + "/cp",
                output_mode="update", foreach_batch=out.write).awaitTermination()
        return {(str(r["day"]), r["k"]): r["n"] for r in out.read().collect()}

    assert land_and_run(("2026-03-01T10:00:00", "a"), ("2026-03-01T11:00:00", "a"), ("2026-03-02T01:00:00", None), ("bad", "a")) == \
        {("2026-03-01", "a"): 2, ("2026-03-02", None): 1}
    # the watermark is 03-01 01:00: the first of March is open
    assert land_and_run(("2026-03-01T00:30:00", "a"), ("2026-03-05T00:00:00", "a"))[("2026-03-01", "a")] == 3
    # the watermark is 03-04 00:00: the first and the second are closed, the fourth is not
    got = land_and_run(("2026-03-01T12:00:00", "a"), ("2026-03-02T12:00:00", "b"), ("2026-03-04T12:00:00", "b"))
    assert got == {("2026-03-01", "a"): 3, ("2026-03-02", None): 1, ("2026-03-05", "a"): 1, ("2026-03-04", "b"): 1}


def test_chunks_land_in_many_files_and_arrive_as_one_batch_each(spark, monkeypatch):
    """Before, a chunk was one file of one task. A chunk without events and one of fewer events than files are batches too."""
    from jobsmith.plans import catalog_stream as C
    sf = scratch_path(spark, "events")
    days = [1] * 40 + [9] * 2 + [None]
    spark.createDataFrame([(i, None if d is None else dt.datetime(2024, 1, d, 5), i % 3, "click" if i % 2 else "view", float(i), None)
                           for i, d in enumerate(days)],
                          "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .write.parquet(sf + "/events.parquet")
    monkeypatch.setattr(C, "FILE_RECORDS", 2)
    files = C.chunk_files(spark, sf)
    path = C.land_event_records(spark, sf, files)
    sizes = [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-")]
    assert files == 8 and len(sizes) == 3 * files and sum(s > 100 for s in sizes) > files // 2
    got = spark.read.schema(S.RECORD_SCHEMA).option("mode", "FAILFAST").json(path).collect()
    want = C.event_messages(spark, sf).where("chunk IS NOT NULL").select("key", "value").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 42
    seen = {}
    S.start(C.landed_stream(spark, sf), checkpoint=scratch_path(spark, "ckpt"),
            foreach_batch=lambda df, n: seen.update({n: df.count()})).awaitTermination()
    assert seen == {0: 40, 1: 0, 2: 2}
    assert {(r["batch_id"], r["n"]) for r in C.stream_microbatch(spark, sf).collect()} == {(0, 40), (2, 2)}

"""Re-runs and partial failures: snapshots ignore unfinished versions, a replayed
micro-batch rewrites the same stream-table version, materialised inputs cut lineage."""

import os

from pyspark.sql import functions as F

from jobsmith.plans.snapshots import Snapshot
from jobsmith.session import materialize, scratch_path
from jobsmith.streaming import jobs as S


def test_snapshot_ignores_unfinished_version(spark):
    base = scratch_path(spark, "snap")
    snap = Snapshot(spark, base, "k string, v long")
    snap.write(spark.createDataFrame([("a", 1)], "k string, v long"))
    # a crashed writer leaves files but no _SUCCESS marker
    os.makedirs(base + "/v000002")
    with open(base + "/v000002/part-0.parquet", "w") as f:
        f.write("garbage")
    assert snap.versions() == [1]
    assert [tuple(r) for r in snap.read().collect()] == [("a", 1)]
    snap.write(spark.createDataFrame([("b", 2)], "k string, v long"))   # overwrites the broken v000002
    assert snap.versions() == [1, 2]
    assert [tuple(r) for r in snap.read().collect()] == [("b", 2)]


def test_stream_batch_replay_is_idempotent(spark):
    import json
    base = scratch_path(spark, "replay")
    table = S.StreamTable(spark, base + "/t")
    seq = F.get_json_object("value", "$.seq").cast("bigint")
    fn = S.upsert_batch_fn(table, seq=seq)
    batch = spark.createDataFrame([("k", json.dumps({"job_hash": "k", "job_url": "u", "title": "t", "seq": 1}))],
                                  "key string, value string")
    fn(batch, 0)
    first = sorted(tuple(r) for r in table.read().drop("ingested_at").collect())
    fn(batch, 0)   # the same batch id delivered again after a failure
    assert sorted(tuple(r) for r in table.read().drop("ingested_at").collect()) == first


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2).groupBy((F.col("id") % 3).alias("g")).count()
    m = materialize(df, "m")
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Relation" in plan
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())


def test_stream_table_takes_batch_sequence_type(spark):
    """A (partition, offset) sequence, as from a broker, works from the first batch."""
    import json
    table = S.StreamTable(spark, scratch_path(spark, "kseq"))
    fn = S.upsert_batch_fn(table, seq=F.struct(F.col("partition"), F.col("offset")))
    rows = [("k", json.dumps({"job_hash": "k", "title": t}), 0, o) for o, t in [(5, "a"), (7, "b")]]
    fn(spark.createDataFrame(rows, "key string, value string, partition int, offset long"), 0)
    fn(spark.createDataFrame([("k", json.dumps({"job_hash": "k", "title": "c"}), 0, 9)],
                             "key string, value string, partition int, offset long"), 1)
    assert [r["title"] for r in table.read().collect()] == ["c"]


def test_new_checkpoint_appends_to_an_existing_stream_table(spark):
    """Another query starts at batch 0 again: nothing that is there is lost or hidden, compacted or not."""
    import json
    table = S.StreamTable(spark, scratch_path(spark, "again") + "/t")
    seq = F.get_json_object("value", "$.seq").cast("bigint")

    def put(query, batch_id, *keys):
        rows = [(k, json.dumps({"job_hash": k, "title": query, "seq": i})) for i, k in enumerate(keys)]
        S.upsert_batch_fn(table, seq=seq, query=query)(spark.createDataFrame(rows, "key string, value string"), batch_id)

    put("one", 0, "k1", "k2")
    put("two", 0, "k3", "k2")
    put("two", 0, "k3", "k2")
    expect = [("k1", "one"), ("k2", "two"), ("k3", "two")]
    assert sorted((r["job_hash"], r["title"]) for r in table.read().collect()) == expect
    assert len(table.parts()) == 2
    table.compact()
    put("two", 1, "k4")
    assert sorted((r["job_hash"], r["title"]) for r in table.read().collect()) == expect + [("k4", "two")]


def test_quarantine_keeps_the_record(spark):
    base = scratch_path(spark, "bad")
    table = S.StreamTable(spark, base + "/t")
    batch = spark.createDataFrame([("a", "{not json"), ("b", '{"title": "no key"}'), ("c", '{"job_hash": "c"}')],
                                  "key string, value string")
    S.upsert_batch_fn(table, seq=F.lit(1), query="q")(batch, 0)
    got = sorted((r["key"], r["value"], r["reason"]) for r in spark.read.parquet(base + "/t-quarantine").collect())
    assert got == [("a", "{not json", "not JSON"), ("b", '{"title": "no key"}', "no key")]
    assert [r["job_hash"] for r in table.read().collect()] == ["c"]


def test_batch_that_lands_while_the_table_is_compacted_stays(spark, monkeypatch):
    table = S.StreamTable(spark, scratch_path(spark, "race") + "/t")
    rows = lambda *keys: spark.createDataFrame([(k, 1) for k in keys], "job_hash string, _seq long").select(
        *[F.col(c) if c == "job_hash" else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.schema.names], "_seq")
    table.append("q", 0, rows("a"))
    table.append("q", 1, rows("b"))
    fold = table._fold

    def folded_while_another_lands(parts):
        out = fold(parts)
        table.append("q", 2, rows("c"))
        return out
    monkeypatch.setattr(table, "_fold", folded_while_another_lands)
    table.compact()
    monkeypatch.setattr(table, "_fold", fold)
    assert sorted(r["job_hash"] for r in table.read().collect()) == ["a", "b", "c"]
    assert not table.append("q", 2, rows("c")) and [p[:1] for p in table.parts()] == ["b", "b", "c", "b"]
    table.compact()
    table.compact()  # nothing new: nothing to do
    assert sorted(r["job_hash"] for r in table.read().collect()) == ["a", "b", "c"] and len(table.parts()) == 5


def test_upsert_folds_the_table_now_and_then(spark):
    table = S.StreamTable(spark, scratch_path(spark, "folded") + "/t")
    run = S.upsert_batch_fn(table, seq=F.lit(1), query="q", compact_every=3)
    for i in range(7):
        run(spark.createDataFrame([(f"k{i % 4}", '{"job_hash": "k%d", "title": "t%d"}' % (i % 4, i))], "key string, value string"), i)
    assert sum(p.startswith("c") for p in table.parts()) == 2
    assert {r["title"] for r in table.read().collect()} == {"t4", "t5", "t6", "t3"}

"""Classifiers, embeddings, rollups and the pipeline against brute force or held-out rows."""

import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobsmith.llm import embed_dedup, quality_gam, queries, token_rollup, toxicity_pu
from jobsmith.llm.common import held_out, learnable
from jobsmith.session import scratch_path

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


def test_learnable_rows(spark):
    rows = spark.range(300).select("id", learnable("id").alias("a"), held_out("id").alias("b")).collect()
    assert all(r["b"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) == (not r["a"]) for r in rows)


def corpus(n, seed):
    """Plain sentences; every third is junk, every fourth of the others has a marker word."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ba", "do", "mi", "ter", "sol") for b in ("lan", "ver", "no", "rith", "es")]
    texts, quality, toxic = [], [], []
    for i in range(n):
        ws = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 120))]
        good, bad = i % 3 != 0, i % 3 != 0 and i % 4 == 0
        if not good:
            ws = [ws[0]] * len(ws) if i % 2 else [w.upper() + "!!" for w in ws]
        if bad:
            for _ in range(3):
                ws.insert(rng.randrange(len(ws)), rng.choice(["grobnik", "snarlwit"]))
        texts.append(" ".join(ws) + ".")
        quality.append(int(good))
        toxic.append(int(bad))
    return texts, quality, toxic


@pytest.fixture(scope="module")
def labelled(spark):
    texts, quality, toxic = corpus(600, 1)
    labels = [(i, q, t) for i, (q, t) in enumerate(zip(quality, toxic))] + [(None, 1, 1), (3, None, None), (9999, 1, 0)]
    return docs(spark, texts + [None, "", texts[1]]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_gam_held_out_accuracy(spark, labelled):
    d, labels = labelled
    model = quality_gam.train(d, labels)
    assert model.pairs and len(model.tables) == len(quality_gam.FEATURES)
    rows = d.select("*", quality_gam.score("text", model).alias("score")).join(labels.where("quality IS NOT NULL"), "doc_id") \
        .where(held_out("doc_id")).collect()
    assert np.mean([(r["score"] >= 0.5) == bool(r["quality"]) for r in rows]) >= 0.97
    scores = {r["doc_id"]: r["s"] for r in d.select("doc_id", quality_gam.score("text", model).alias("s")).collect()}
    assert len(scores) == 603 and all(0 <= s <= 1 for s in scores.values())
    assert scores[600] == scores[601] and scores[602] == scores[1]
    none = quality_gam.train(d, labels.where("quality = 1"))
    assert len({r[0] for r in d.select(quality_gam.score("text", none)).collect()}) == 1


def test_gam_score_is_a_sum_of_table_cells(labelled):
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal((400, 3)), None
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)     # an interaction that no single table can hold
    model = quality_gam.fit(x, y)
    assert np.mean((model.scores(x) >= 0.5) == y) > 0.9 and (0, 1) in [(i, j) for i, j, *_ in model.pairs]
    bins = [np.searchsorted(e, x[0, k]) for k, e in enumerate(model.edges)]
    z = model.intercept + sum(t[b] for t, b in zip(model.tables, bins)) + sum(
        t[ci[bins[i]], cj[bins[j]]] for i, j, ci, cj, t in model.pairs)
    assert abs(z - model.logits(x[:1])[0]) < 1e-12


def test_pu_held_out(spark, labelled):
    d, labels = labelled
    model = toxicity_pu.train(d, labels)
    rows = d.select("*", toxicity_pu.score("text", model).alias("score")).join(labels.where("toxic IS NOT NULL"), "doc_id") \
        .where(held_out("doc_id")).collect()
    toxic = [r["score"] >= 0.7 for r in rows if r["toxic"]]
    clean = [r["score"] >= 0.7 for r in rows if not r["toxic"]]
    assert np.mean(toxic) >= 0.95 and np.mean(clean) <= 0.02
    scores = {r["doc_id"]: r["s"] for r in d.select("doc_id", toxicity_pu.score("text", model).alias("s")).collect()}
    assert len(scores) == 603 and scores[600] == scores[601] < 0.7
    untaught = toxicity_pu.train(d, labels.where("toxic = 0"))
    assert all(r[0] < 0.7 for r in d.select(toxicity_pu.score("text", untaught)).collect())


@pytest.mark.parametrize("n", [1, 2])
def test_pu_with_few_toxic_labels(spark, labelled, n):
    d, labels = labelled
    few = labels.where("toxic = 1 AND doc_id < 600").where(learnable("doc_id")).orderBy("doc_id").limit(n)
    model = toxicity_pu.train(d, few.unionByName(labels.where("toxic = 0")))
    scores = [r[0] for r in d.select(toxicity_pu.score("text", model)).collect()]
    assert len(scores) == 603 and len(set(scores)) == 1 and scores[0] < 0.7


def test_pu_risk_never_steps_on_negative_unlabelled_risk():
    """With a prior far too high the corrected term goes negative; training must not push it down further."""
    rng = np.random.default_rng(3)
    positive = np.arange(200) < 60
    cells = [(i, j) for i in range(200) for j in range(5) if rng.random() < (0.9 if positive[i] and j == 0 else 0.2)]
    rows, cols = map(np.array, zip(*cells))
    b, w = toxicity_pu.fit(rows, cols, 200, 5, positive, prior=0.6)
    assert np.isfinite(w).all() and w[0] > max(w[1:]) and np.isfinite(b)


def test_grams_are_whole(monkeypatch):
    text = "Zeit, idiot! " * 500
    whole = toxicity_pu.present(text)
    monkeypatch.setattr(toxicity_pu, "CHUNK", 64)
    assert (toxicity_pu.present(text) == whole).all()


def vectors(rng):
    """Singles, pairs about the threshold, exact copies, a dense group, and rows that take no part."""
    rows = [rng.standard_normal(32) for _ in range(150)]
    for x in rows[:40]:
        y = rng.standard_normal(32)
        y -= y @ x / (x @ x) * x
        c = rng.uniform(0.86, 0.99)
        rows.append(c * x / np.linalg.norm(x) + np.sqrt(1 - c * c) * y / np.linalg.norm(y))
    centre = rng.standard_normal(32)
    rows += [centre + 0.12 * rng.standard_normal(32) for _ in range(90)]
    rows += [rows[0]] * 4 + [rows[-1] * 3]
    return [np.float32(x).tolist() for x in rows] + [None, [0.0] * 32, [float("nan")] + [1.0] * 31, [], [None] * 32, [1.0, 2.0]]


@pytest.mark.parametrize("tile", [16, 512])
def test_embedding_links_equal_brute_force(spark, tile):
    rows = vectors(np.random.default_rng(4))
    df = spark.createDataFrame([(i, x, 1, 2) for i, x in enumerate(rows)], "vec_id long, embedding array<float>, rep int, v int")
    caps = embed_dedup.Caps(32, 3, 0.3, codes=24)    # every pair of these rows shares a filter
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near_duplicates(
        df.where("embedding IS NULL OR size(embedding) <> 2"), tile=tile, caps=caps).collect()}
    n = len(rows) - 1
    ok = [i for i in range(n) if rows[i] and None not in rows[i] and np.isfinite(rows[i]).all() and any(rows[i])]
    x = np.array([rows[i] for i in ok], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = (x @ x.T >= 0.9) & ~np.eye(len(ok), dtype=bool)
    label = np.array(ok)
    while True:
        new = np.minimum(label, np.where(close, label[None, :], n).min(axis=1))
        if (new == label).all():
            break
        label = new
    expect = {i: (0, i, True) for i in range(n)} | {
        i: (int(close[k].sum()), int(label[k]), bool(label[k] == i)) for k, i in enumerate(ok)}
    assert got == expect


def test_embedding_recall_of_the_default_plan():
    rng = np.random.default_rng(5)
    for n in (500, 50_000, 1_000_000, 3_000_000):
        caps = embed_dedup.plan(n, 64)
        x = rng.standard_normal((600, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.standard_normal((600, 64))
        y -= (x * y).sum(1, keepdims=True) * x
        y = 0.9 * x + np.sqrt(0.19) * y / np.linalg.norm(y, axis=1, keepdims=True)
        a, b = embed_dedup.decode(x, caps), embed_dedup.decode(y, caps)
        assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)]) >= 0.95


def test_default_plan_against_brute_force(spark):
    """Links found with the default plan: none below the floor, nearly all at or above it; every length is compared."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 24))
    near = [0.95 * a / np.linalg.norm(a) + 0.2 * b / np.linalg.norm(b) for a, b in zip(x, rng.standard_normal((400, 24)))]
    rows = np.float32([*x, *near]).tolist() + [[float(i + 1)] * d for d in range(30, 100) for i in (0, 1)]  # 70 lengths
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(df).collect()}
    y = np.array(rows[:800], np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    n = ((y @ y.T >= 0.9) & ~np.eye(800, dtype=bool)).sum(axis=1)
    assert all(got[i] <= n[i] for i in range(800)) and sum(got[i] for i in range(800)) >= 0.95 * n.sum() > 300
    assert all(got[i] == 1 for i in range(800, len(rows)))


def test_list_decoding_equals_all_filters():
    caps = embed_dedup.Caps(10, 3, 0.3, codes=2)
    x = np.random.default_rng(6).standard_normal((20, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = embed_dedup.decode(x, caps)
    for row, found in zip(x, got):
        expect = []
        for which in range(2):
            turn, codes = caps.blocks(which)
            parts = np.split(turn @ row, np.cumsum([c.shape[1] for c in codes])[:-1])
            dots = [c @ p for c, p in zip(codes, parts)]
            for f in range(81):
                i = (f // 27, f // 9 % 3, f // 3 % 3, f % 3)
                if sum(d[k] for d, k in zip(dots, i)) >= 0.3:
                    expect.append(which * 81 + f)
        assert found.tolist() == expect


def test_empty_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.near_duplicates(df).count() == 0


KEYED = "id long, source string, lang string, tokens long, chars long"


def totals(rollup):
    return sorted((tuple(r) for r in rollup.totals().collect()), key=str)


def test_rollup_batches(spark):
    path = scratch_path(spark, "rollup")
    rollup = token_rollup.Rollup(spark, path)
    assert totals(rollup) == []
    one = spark.createDataFrame([(1, "a", "en", 10, 50), (2, "a", None, None, 7), (3, None, "fr", 5, 9)], KEYED)
    put = token_rollup.signed(one, 1, "v1", F.col("tokens"))
    assert rollup.apply("b1", put) and not rollup.apply("b1", put)
    assert token_rollup.Rollup(spark, path).apply("b1", put) is False       # another driver
    expect = [("a", "en", "v1", 1, 10, 50), ("a", None, "v1", 1, 0, 7), (None, "fr", "v1", 1, 5, 9)]
    assert totals(rollup) == sorted(expect, key=str)
    # a batch whose driver died before its commit row counts for nothing, and may come again
    put.select(F.lit("b2").alias("batch_id"), F.lit("lost").alias("attempt"), "*") \
        .write.mode("append").parquet(f"{path}/deltas")
    assert totals(rollup) == sorted(expect, key=str)
    two = spark.createDataFrame([(1, "a", "en", 12, 50), (2, "a", None, None, 7), (4, "b", "en", 1, 1)], KEYED)
    assert rollup.apply("b2", token_rollup.changes(one, two, "id", "v1"))
    expect = [("a", "en", "v1", 1, 12, 50), ("a", None, "v1", 1, 0, 7), ("b", "en", "v1", 1, 1, 1)]
    assert totals(rollup) == sorted(expect, key=str)
    rollup.compact()
    assert rollup.apply("b2", put) is False and totals(rollup) == sorted(expect, key=str)
    assert rollup.apply("b3", token_rollup.revised(two.where("id = 1"), ("v1", F.col("tokens")), ("v2", F.lit(99))))
    expect = [("a", "en", "v2", 1, 99, 50), ("a", None, "v1", 1, 0, 7), ("b", "en", "v1", 1, 1, 1)]
    assert totals(rollup) == sorted(expect, key=str)
    assert rollup.apply("empty", put.limit(0)) and totals(rollup) == sorted(expect, key=str)


def test_batch_that_comes_in_while_the_rollup_is_compacted_counts_once(spark, tmp_path, monkeypatch):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "race"))
    put = spark.createDataFrame([("s", "en", "t", 1, 5, 9)], "source string, lang string, tokenizer string, docs long, tokens long, chars long")
    rollup.apply("one", put)
    write = rollup._write

    def another_first(batch_id, deltas, replaces):
        if batch_id.startswith("compacted"):
            rollup.apply("two", put)
        write(batch_id, deltas, replaces)
    monkeypatch.setattr(rollup, "_write", another_first)
    rollup.compact()
    assert [r["docs"] for r in rollup.totals().collect()] == [2]


def test_rollup_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    expect = con.execute(queries.SQL["op8_token_rollup"]).fetchall()
    cols = "source", "lang", "tokenizer", "docs", "tokens", "chars"
    got = [tuple(r[c] for c in cols) for r in queries.op8_token_rollup(spark, SMALL).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)


def test_stages(spark, tmp_path, labelled):
    """Every filter drops what it should, keeps the rest, and passes extra columns on."""
    d, labels = labelled
    sf = str(tmp_path)
    texts = [r["text"] for r in d.orderBy("doc_id").collect()]
    rng = random.Random(12)
    item = " ".join(rng.choice(["kor", "vel", "tam", "pim", "rud", "zek"]) + str(rng.randrange(50)) for _ in range(30))
    texts += ["solver mino " * 3 + item + " dones teres", item.upper()]
    spark.createDataFrame([(i, t, "en", "s", 0, "more") for i, t in enumerate(texts)], DOCS + ", score string") \
        .write.parquet(os.path.join(sf, "documents.parquet"))
    labels.write.parquet(os.path.join(sf, "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(os.path.join(sf, "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "simhash near-dedup",
                                                      "benchmark decontamination", "sentencepiece encoding and decoding"]
    whole = spark.read.parquet(os.path.join(sf, "documents.parquet"))
    kept = {name: {r["doc_id"] for r in f(spark, whole, sf).collect()} for name, f in corpus_pipeline.STAGES}
    junk, toxic = {i for i in range(600) if i % 3 == 0}, {i for i in range(600) if i % 3 and i % 4 == 0}
    assert len(kept["quality classifier"] & junk) <= 4 and len(kept["quality classifier"] - junk) >= 398
    assert len(kept["toxicity"] & toxic) <= 4 and len(kept["toxicity"] - toxic) >= 496
    assert 602 not in kept["simhash near-dedup"] and 1 in kept["simhash near-dedup"]    # 602 is a copy of 1
    assert kept["benchmark decontamination"] == set(range(len(texts))) - {603, 604}
    assert kept["sentencepiece encoding and decoding"] == set(range(len(texts)))
    first = corpus_pipeline.STAGES[0][1](spark, whole, sf)
    assert first.columns == whole.columns
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "ids", "decoded_crc32"] and 0 < out.count() < len(texts)
    assert all(r["decoded_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode()) for r in out.collect())
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, whole.limit(0), sf).count() == 0


def test_filters_judge_rows_with_null_or_repeated_ids_one_by_one(spark, tmp_path):
    rng = random.Random(15)
    text = lambda k: " ".join(f"{k}{rng.randrange(90)}" for _ in range(60))
    item, copied, alone, one, two = (text(k) for k in ("kor", "vel", "tam", "rud", "zek"))
    rows = [(None, alone), (5, copied), (5, copied), (None, copied), (7, copied), (8, one), (8, two)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    make = lambda rows: spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    held = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert held(corpus_pipeline.near_duplicates(spark, make(rows), str(tmp_path))) == sorted(
        [(None, alone), (5, copied), (8, one), (8, two)], key=str)
    leaks = [(None, item), (None, alone), (8, one), (8, f"{two} {item}")]
    assert held(corpus_pipeline.decontamination(spark, make(leaks), str(tmp_path))) == sorted(
        [(None, alone), (8, one)], key=str)


def test_queries_registered():
    import __spark_entry__ as E
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in E.LLM_QUERIES if q != "pipeline"}
    assert "pipeline" in E.queries()

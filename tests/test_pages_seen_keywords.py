"""Page cursor source, first-seen sink, keyword tables."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from jobsmith.functions.enrich import extract_keywords, extract_keywords_table, joined_runs, tokens
from jobsmith.session import scratch_path
from jobsmith.sources.pages import PageReader, page_stream
from jobsmith.streaming import jobs as S


def land(base, page, results):
    os.makedirs(f"{base}/page={page}", exist_ok=True)
    with open(f"{base}/page={page}/part-0.json", "w") as f:
        f.write(json.dumps({"page": page, "results": results}) + "\n\n")


def test_page_cursor_goes_on_and_back_across_restarts(spark):
    base = scratch_path(spark, "cursor")
    for page in (1, 2, 3):
        land(base, page, [page])

    def poll():
        before = len(spark.read.parquet(base + "-out").collect()) if os.path.exists(base + "-out") else 0
        S.start(page_stream(spark, base, pages_per_poll=2), checkpoint=base + "-ckpt", sink=base + "-out",
                fmt="parquet").awaitTermination()  # a new query each time: the cursor comes from the checkpoint
        return len(spark.read.parquet(base + "-out").collect()) - before

    assert [poll() for _ in range(2)] == [2, 1]   # 1-2, then 3 and nothing behind it
    assert poll() == 0                            # page 5: nothing, back to the start
    land(base, 4, [])                             # a page without results ends a poll too
    assert [poll() for _ in range(3)] == [2, 1, 0]
    got = [r.page for r in spark.read.parquet(base + "-out").collect()]
    assert sorted(got) == [1, 1, 2, 2, 3, 3]


def test_page_cursor_replays_an_unfinished_poll(tmp_path):
    base = str(tmp_path)
    land(base, 1, [1])
    land(base, 2, [2])
    first = PageReader(base, 1, 1)
    start, end = first.initialOffset(), first.latestOffset()
    again = PageReader(base, 1, 1)               # restart: told the last offset, then the batch in the log
    assert again.partitions(end, end) == []
    assert [p.page for p in again.partitions(start, end)] == [1]
    assert again.latestOffset() == {"poll": 2, "page": 3}
    assert again.latestOffset() == {"poll": 3, "page": 1}
    assert again.partitions({"poll": 2, "page": 3}, {"poll": 3, "page": 1}) == []
    land(base, 3, [3])                           # landed after the poll that found nothing: still nothing in its replay
    assert again.partitions({"poll": 2, "page": 3}, {"poll": 3, "page": 1}) == []


def test_first_seen_replay_nulls_and_new_checkpoint(spark):
    path = scratch_path(spark, "seen")
    schema = spark.createDataFrame([], "key string, value string, n int").schema

    def batch(*rows):
        return spark.createDataFrame(rows, schema)

    s = S.FirstSeen(spark, path, schema, order=[F.col("n")], query="a")
    assert s.read().count() == 0
    s.write(batch(("x", "late", 2), ("x", "early", 1), (None, "null", 1)), 0)
    for _ in range(2):                            # the second time is a replay
        s.write(batch(("x", "again", 0), ("y", "y", 3), (None, "null again", 0)), 1)
    S.FirstSeen(spark, path, schema, query="b").write(batch(("y", "no", 0), ("z", "z", 0)), 0)
    s.write(batch(), 2)
    assert sorted((r.key or "", r.value) for r in s.read().collect()) == [
        ("", "null"), ("x", "early"), ("y", "y"), ("z", "z")]


def test_first_seen_hot_key_is_combined_before_the_shuffle(spark):
    path = scratch_path(spark, "hot")
    rows = spark.range(0, 300_000, 1, 6).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
                                                .alias("key"), F.col("id").alias("n"))
    one = rows.groupBy("key").agg(F.min(F.struct("n")).alias("r"))
    text = one._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_min") == 1 and text.index("Exchange") < text.index("partial_min")  # below the exchange
    s = S.FirstSeen(spark, path, rows.schema, order=[F.col("n")], query="q")
    s.write(rows, 0)
    s.write(rows, 1)
    got = s.read()
    assert got.count() == 200_001 and got.where("key = 'hot'").first().n == 0


def literal(df, keywords):
    hay = F.lower(F.col("text"))
    return {r.doc_id: r.k for r in df.select("doc_id", extract_keywords(hay, tokens(hay), keywords).alias("k")).collect()}


def by_table(spark, df, keywords):
    table = spark.createDataFrame([(k,) for k in keywords], "keyword string")
    return {r.doc_id: r.skills_extracted for r in extract_keywords_table(df, table, F.col("text")).collect()}


def test_keyword_table_equals_literal_form(spark):
    rnd = random.Random(3)
    parts = ["go", "c", "++", " ", "power", "bi", "-", ".net", "é", "_x", "\n", "R", "."]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 14))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate([*texts, "", "++", "c++", "a c++b"])), "doc_id long, text string")
    keywords = ["go", "C++", "power bi", ".net", "++", "c", "é", "go-power bi", "_x", "r", "power", ". ", "bi\nr", " "]
    want = literal(df, keywords)
    assert by_table(spark, df, [*keywords, *keywords, "GO"]) == want
    assert sum(map(len, want.values())) > 300 and any("c++" in k for k in want.values())


def test_keyword_table_edge_cases(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "sql"), (3, "go"), (4, "sql " * 60_000)], "doc_id long, text string")
    assert by_table(spark, df, ["sql", "go", "", None]) == {1: [], 2: [], 3: ["go", "sql"], 4: ["sql"]}
    assert by_table(spark, df, []) == {1: [], 2: [], 3: [], 4: []}
    assert by_table(spark, df.limit(0), ["sql"]) == {}


def test_keyword_table_with_100_000_keywords(spark):
    table = spark.range(100_000).select(F.concat(F.lit("w"), F.col("id"), F.when(F.col("id") % 2 == 1, F.concat(
        F.lit(" v"), F.col("id"))).otherwise(F.lit(""))).alias("keyword"))
    df = spark.createDataFrame([(i, f"w{2 * i} w{2 * i + 1} v{2 * i + 1}, w{2 * i + 3} v1") for i in range(500)],
                               "doc_id long, text string")
    out = extract_keywords_table(df, table, F.col("text"))
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000  # the dictionary is not in the plan
    assert {r.doc_id: r.skills_extracted for r in out.collect()} == {
        i: sorted([f"w{2 * i}", f"w{2 * i + 1} v{2 * i + 1}"]) for i in range(500)}


def test_keyword_table_takes_time_by_the_length_of_a_text(spark):
    """A text of 60,000 different words (before, its places were compared each with each: hours)."""
    words = [f"w{i}" for i in range(60_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "w1 w3"), (3, "... w7 ...")], "doc_id int, text string")
    keywords = [*words[::1000], "w5 w6", "w5 w7", "w8 w9 w10 w11", ". w7"]
    began = time.monotonic()
    got = by_table(spark, df, keywords)
    assert time.monotonic() - began < 60
    assert got == {1: sorted([*words[::1000], "w5 w6", "w8 w9 w10 w11"]), 2: [], 3: []}


@pytest.mark.parametrize("width", range(1, 12))
def test_joined_runs_of_every_width(spark, width):
    texts = [[], ["a"], list("abcdefgh"), list("ab" * 9), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, runs array<string>")
    got = {r.id: r.wide for r in joined_runs(df, width).collect()}
    assert got == {i: t and ["".join(t[k:k + width]) for k in range(len(t))] if t is not None else None for i, t in enumerate(texts)}

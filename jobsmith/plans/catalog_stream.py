"""Registered streaming queries: event rows delivered as keyed JSON records in
ordered chunks, consumed with availableNow triggers; results read back from
the sinks. Batch-form operators of the stream path are registered here too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.functions import json as J
from jobsmith.functions.hashing import sha256_hex
from jobsmith.operators import reports as RP
from jobsmith.operators.dedup import collapse_last_arrival
from jobsmith.operators.merge import upsert_stream
from jobsmith.operators.normalize import stream_message, stream_payload
from jobsmith.plans import landing as L
from jobsmith.plans.catalog_batch import API_POST, RAW, W
from jobsmith.plans.registry import ntz, query
from jobsmith.plans.tables import read
from jobsmith.schema import MESSAGE_FIELDS, STREAM_COLUMNS
from jobsmith.session import materialize, scratch_path
from jobsmith.sources.files import paged_results, read_json_documents
from jobsmith.sources.pages import page_stream
from jobsmith.streaming import jobs as S

CHUNKS = 3
FILE_RECORDS = 100_000

# ---------------------------------------------------------------- landing of event records


def chunked_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with ``chunk``: the third of the days that they fall into."""
    e = read(spark, sf, "events")
    lo = e.agg(F.min(F.to_date("ts"))).scalar()
    span = e.agg(F.datediff(F.max(F.to_date("ts")), F.min(F.to_date("ts"))) + 1).scalar()
    return e.withColumn("chunk", F.floor(F.datediff(F.to_date("ts"), F.lit(lo)) * CHUNKS / F.lit(span)).cast("int"))


def event_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as stream messages (plus ``chunk``): key per (user, event type);
    'view' sends an empty source, 'click' omits is_remote, 'signup' sends it as null."""
    return chunked_events(spark, sf).select(*message_columns(), "chunk")


def message_columns() -> list[F.Column]:
    """(key, value) of an event's message."""
    key = sha256_hex(F.concat_ws("|", F.col("user_id").cast("string"), "event_type"))
    fields = {
        "job_hash": key,
        "job_id": F.col("event_id").cast("string"),
        "source": F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.lit("api")),
        "title": F.col("event_type"),
        "company": F.col("user_id").cast("string"),
        "location": F.when(F.col("event_type") == "purchase", F.lit("Remote")).otherwise(F.lit("Onsite")),
        "is_remote": F.when(F.col("event_type") != "signup", F.col("value") > 10),
        "category": F.lit("events"),
        "publication_date": F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")),
        "job_url": F.when(F.col("value") > 25, F.concat(F.lit("https://jobs.example/"),
                                                        F.col("event_id").cast("string"))),
        "description": F.col("props"),
    }
    with_remote = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})
    no_remote = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items() if k != "is_remote"]),
                          {"ignoreNullFields": "false"})
    return [key.alias("key"), F.when(F.col("event_type") == "click", no_remote).otherwise(with_remote).alias("value")]


def chunk_files(spark: SparkSession, sf: str) -> int:
    """Files a chunk is landed in: one for every ``FILE_RECORDS`` of an average chunk."""
    return max(1, -(-read(spark, sf, "events").count() // (CHUNKS * FILE_RECORDS)))


def land_event_records(spark: SparkSession, sf: str, files: int, chunks: range | None = None, path: str | None = None) -> str:
    """Append the record chunks in event-time order, one write per chunk of ``files`` files, so the
    file source sees them in that order (maxFilesPerTrigger=``files`` -> one batch each).

    This only lands test input: a fixed number of files per chunk makes the arrival order of a
    file source explicit. Every file begins with an empty line, which JSON readers pass over: a task
    without a record writes its file too. In production the records come from a broker, whose
    per-key order is the partition offset (``record_stream(fmt="kafka")``).
    """
    path = path or scratch_path(spark, "records")
    events = chunked_events(spark, sf)
    columns = [c for c in events.columns if c != "chunk"]
    dealt = events.withColumn("file", F.pmod(F.xxhash64(*columns), F.lit(files)).cast("int")).withColumn("empty", F.lit(False))
    starts = spark.range(files).select(F.col("id").cast("int").alias("file"), F.lit(True).alias("empty"))
    for i in (chunks if chunks is not None else range(CHUNKS)):
        dealt.filter(F.col("chunk") == i).unionByName(starts, allowMissingColumns=True) \
            .repartitionById(files, F.col("file")).select("empty", *message_columns()) \
            .select(F.when(F.col("empty"), "").otherwise(F.to_json(F.struct("key", "value"))).alias("value")) \
            .write.mode("append").option("compression", "none").text(path)
    return path


def landed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """All chunks landed, as a stream of one micro-batch a chunk."""
    files = chunk_files(spark, sf)
    return S.record_stream(spark, land_event_records(spark, sf, files), max_files_per_trigger=files)


def seq_of(value: F.Column) -> F.Column:
    """Arrival sequence of a record: (event time, event id) from the payload."""
    p = J.decode(value)
    return F.struct(J.vget(p, "$.publication_date", "string").try_cast("timestamp").alias("a"),
                    J.vget(p, "$.job_id", "string").try_cast("bigint").alias("b"))


def clock_of_seq(seq_col: str = "_seq") -> F.Column:
    """Deterministic ingest clock for the registered queries: the record's event time."""
    return F.col(seq_col)["a"]


def run_upsert(spark: SparkSession, sf: str) -> S.StreamTable:
    base = scratch_path(spark, "stream_table")
    table = S.StreamTable(spark, base + "/jobs_stream")
    stream = landed_stream(spark, sf)
    q = S.start(stream, checkpoint=base + "/_checkpoint",
                foreach_batch=S.upsert_batch_fn(table, seq=seq_of(F.col("value")), clock=clock_of_seq(),
                                                quarantine=base + "/quarantine"))
    q.awaitTermination()
    return table


def stream_out(df: DataFrame) -> DataFrame:
    return df.select(*[ntz(c) if c in ("publication_date", "ingested_at") else F.col(c) for c in STREAM_COLUMNS])


# ---------------------------------------------------------------- SQL pieces

EM = """em AS (
  SELECT sha256(CAST(user_id AS VARCHAR) || '|' || event_type) AS job_hash, CAST(event_id AS VARCHAR) AS job_id,
         'api' AS source, event_type AS title, CAST(user_id AS VARCHAR) AS company,
         CASE WHEN event_type = 'purchase' THEN 'Remote' ELSE 'Onsite' END AS location,
         CASE WHEN event_type = 'click' THEN true WHEN event_type = 'signup' THEN false ELSE value > 10 END AS is_remote,
         'events' AS category, ts AS publication_date,
         CASE WHEN value > 25 THEN 'https://jobs.example/' || CAST(event_id AS VARCHAR) END AS job_url,
         props AS description, ts AS ingested_at, ts, event_id
  FROM events
)"""
STREAM_COLS_SQL = ", ".join(STREAM_COLUMNS)
LAST_SQL = W(EM) + f""", last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_hash ORDER BY ts DESC, event_id DESC) AS rn FROM em)
  WHERE rn = 1
), url AS (
  SELECT job_hash, job_url AS last_url FROM (SELECT *, row_number() OVER (PARTITION BY job_hash
    ORDER BY ts DESC, event_id DESC) AS rn FROM em WHERE job_url IS NOT NULL) WHERE rn = 1
), stream_table AS (
  SELECT l.* REPLACE (u.last_url AS job_url) FROM last l LEFT JOIN url u USING (job_hash)
)
"""
STREAM_TABLE_SQL = LAST_SQL + f"SELECT {STREAM_COLS_SQL} FROM stream_table"
LATEST_SQL = LAST_SQL + """SELECT ingested_at, title, company, location, job_url FROM stream_table
  ORDER BY ingested_at DESC, job_hash LIMIT 20"""
DAY_COUNTS_SQL = "SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, COUNT(*) AS n FROM events GROUP BY 1"


# ---------------------------------------------------------------- registered stream queries

@query("src_kafka", "SELECT sha256(CAST(user_id AS VARCHAR) || '|' || event_type) AS key, "
                    "CAST(event_id AS VARCHAR) AS job_id, event_type AS title FROM events")
def src_kafka(spark, sf):
    """Keyed JSON records read as a stream (the broker source is a swappable format)."""
    base = scratch_path(spark, "src_kafka")
    stream = landed_stream(spark, sf)
    S.start(stream, checkpoint=base + "/_checkpoint", sink=base + "/out", fmt="parquet").awaitTermination()
    out = spark.read.parquet(base + "/out")
    p = J.decode(F.col("value"))
    return out.select("key", J.vget(p, "$.job_id", "string").alias("job_id"),
                      J.vget(p, "$.title", "string").alias("title"))


@query("sink_kafka", W(RAW, API_POST) + "SELECT job_hash AS key, job_hash, job_id, title, company, _iso AS publication_date, job_url FROM api_postings")
def sink_kafka(spark, sf):
    """Postings published as keyed records (value = JSON message), read back and decoded."""
    base = scratch_path(spark, "sink_kafka")
    pages = L.land_pages(spark, sf)
    posts = spark.readStream.option("singleVariantColumn", "v").format("json").load(pages) \
        .select(F.posexplode(J.vget(F.col("v"), "$.results", "array<variant>")).alias("pos", "j"))
    recs = S.encode_records(stream_message(posts))
    S.start(recs, checkpoint=base + "/_checkpoint", sink=base + "/out", fmt="json").awaitTermination()
    out = spark.read.schema(S.RECORD_SCHEMA).json(base + "/out")
    p = J.decode(F.col("value"))
    return out.select("key", *[J.vget(p, f"$.{c}", "string").alias(c) for c in
                               ("job_hash", "job_id", "title", "company", "publication_date", "job_url")])


@query("stream_publish", W(RAW, API_POST) + "SELECT DISTINCT job_hash AS key, CAST(1 AS BIGINT) AS n FROM api_postings")
def stream_publish(spark, sf):
    """Postings delivered twice (a full delivery, then French postings again);
    each key is published exactly once (first seen, combined before the shuffle)."""
    base = scratch_path(spark, "publish")
    land = base + "/landing"
    res = paged_results(read_json_documents(spark, L.land_pages(spark, sf)))
    posts = res.select(F.to_json(F.col("j")).alias("value"), J.vget(F.col("j"), "$.location.display_name",
                                                                     "string").alias("lang"))
    posts.select("value").write.mode("append").text(land)
    posts.filter(F.col("lang") == "fr").select("value").write.mode("append").text(land)
    stream = spark.readStream.option("singleVariantColumn", "j").option("maxFilesPerTrigger", "4") \
        .format("json").load(land)
    records = S.publish(stream, dedup=False)
    first = S.FirstSeen(spark, base + "/out", records.schema, fmt="json")
    S.start(records, checkpoint=base + "/_checkpoint", foreach_batch=first.write).awaitTermination()
    return first.read().groupBy("key").agg(F.count("*").alias("n"))


@query("stream_dedup_bounded", """SELECT DISTINCT sha256(CAST(user_id AS VARCHAR) || '|' || event_type) AS key,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events""")
def stream_dedup_bounded(spark, sf):
    """Per (key, day) first occurrence with state bounded by a one-day watermark."""
    base = scratch_path(spark, "bounded")
    stream = landed_stream(spark, sf)
    seq = seq_of(F.col("value"))
    s = stream.select("key", seq["a"].alias("ts")).withColumn("day", F.to_date("ts"))
    out = S.dedup_within(s, ["key", "day"], F.col("ts"), "1 day")
    S.start(out, checkpoint=base + "/_checkpoint", sink=base + "/out", fmt="parquet").awaitTermination()
    return spark.read.parquet(base + "/out").select("key", F.col("day").cast("timestamp_ntz").alias("day"))


@query("stream_microbatch", """SELECT CAST(floor(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) * 3
  / (date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events)) + 1)) AS BIGINT)
  AS batch_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def stream_microbatch(spark, sf):
    """One micro-batch per landed chunk (maxFilesPerTrigger: the files of a chunk), each committed by
    its own foreachBatch write keyed by batch id."""
    base = scratch_path(spark, "microbatch")
    stream = landed_stream(spark, sf)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        (df.select(F.to_date(seq_of(F.col("value"))["a"]).alias("day"))
         .groupBy("day").agg(F.count("*").alias("n")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}"))

    S.start(stream, checkpoint=base + "/_checkpoint", foreach_batch=per_batch).awaitTermination()
    return spark.read.parquet(base + "/out").select("batch_id", F.col("day").cast("timestamp_ntz").alias("day"), "n")


@query("stream_resume", DAY_COUNTS_SQL)
def stream_resume(spark, sf):
    """Run, land more data, run again on the same checkpoint: every record once."""
    base = scratch_path(spark, "resume")
    records, files = base + "/records", chunk_files(spark, sf)

    def run() -> None:
        stream = S.record_stream(spark, records, max_files_per_trigger=files)
        S.start(stream.select(F.to_date(seq_of(F.col("value"))["a"]).alias("day")),
                checkpoint=base + "/_checkpoint", sink=base + "/out", fmt="parquet").awaitTermination()

    land_event_records(spark, sf, files, range(0, CHUNKS - 1), records)
    run()
    land_event_records(spark, sf, files, range(CHUNKS - 1, CHUNKS), records)
    run()
    return spark.read.parquet(base + "/out").groupBy(F.col("day").cast("timestamp_ntz").alias("day")) \
        .agg(F.count("*").alias("n"))


@query("stream_page_cursor", """SELECT doc_id AS job_id, CAST(floor(doc_id / 100) + 1 AS BIGINT) AS page,
  CASE WHEN floor(doc_id / 100) + 1 <= ceil((SELECT max(floor(doc_id / 100) + 1) FROM documents) / 2) THEN 2 ELSE 1 END
  AS deliveries FROM documents""")
def stream_page_cursor(spark, sf):
    """Four polls, a run each on one checkpoint: both halves of the pages, nothing (the cursor goes back), the
    first half again."""
    base = scratch_path(spark, "page_cursor")
    pages = L.land_pages(spark, sf, by_page=True)
    half = -(-spark.read.text(pages).agg(F.max("page")).first()[0] // 2)
    posts = page_stream(spark, pages, pages_per_poll=half) \
        .select("page", F.explode(J.vget(F.try_parse_json("value"), "$.results", "array<variant>")).alias("j")) \
        .select("page", J.vget(F.col("j"), "$.id", "bigint").alias("job_id"))
    for _ in range(4):
        S.start(posts, checkpoint=base + "/_checkpoint", sink=base + "/out", fmt="parquet").awaitTermination()
    return spark.read.parquet(base + "/out").groupBy("job_id", "page").agg(F.count("*").alias("deliveries"))


@query("stream_daily_counts", """SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, event_type, COUNT(*) AS n
  FROM events GROUP BY 1, 2""")
def stream_daily_counts(spark, sf):
    """Event-time day windows with a watermark, in two runs on one checkpoint: the second goes on from the
    counts of the first."""
    base = scratch_path(spark, "daily_counts")
    records, files = base + "/records", chunk_files(spark, sf)
    out = S.LatestTable(spark, base + "/out", ["day", "event_type"], "day date, event_type string, n long")

    def run() -> None:
        stream = S.record_stream(spark, records, max_files_per_trigger=files)
        rows = stream.select(seq_of(F.col("value"))["a"].alias("ts"),
                             J.vget(J.decode(F.col("value")), "$.title", "string").alias("event_type"))
        S.start(S.daily_counts(rows, "ts", ["event_type"], "2 days"), checkpoint=base + "/_checkpoint", output_mode="update",
                foreach_batch=out.write).awaitTermination()

    land_event_records(spark, sf, files, range(0, CHUNKS - 1), records)
    run()
    land_event_records(spark, sf, files, range(CHUNKS - 1, CHUNKS), records)
    run()
    return out.read().select(F.col("day").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query("stream_upsert", STREAM_TABLE_SQL)
def stream_upsert(spark, sf):
    """Consume keyed records batch by batch; merge each into the stream table
    (last message wins, job_url = COALESCE(new, old), source never updated)."""
    return stream_out(run_upsert(spark, sf).read())


@query("stream_latest", LATEST_SQL)
def stream_latest(spark, sf):
    """Newest 20 rows of the streamed table."""
    return RP.latest_stream(run_upsert(spark, sf).read()).select(ntz("ingested_at"), "title", "company",
                                                                  "location", "job_url")


@query("dedup_first_seen", "SELECT DISTINCT sha256(CAST(user_id AS VARCHAR) || '|' || event_type) AS key FROM events")
def dedup_first_seen(spark, sf):
    """Streaming first-seen dedup, combined before the shuffle; only order-independent columns are returned."""
    base = scratch_path(spark, "first_seen")
    stream = landed_stream(spark, sf)
    first = S.FirstSeen(spark, base + "/out", stream.schema, order=[seq_of(F.col("value"))])
    S.start(stream, checkpoint=base + "/_checkpoint", foreach_batch=first.write).awaitTermination()
    return first.read().select("key")


def event_payload_rows(spark, sf) -> DataFrame:
    msgs = event_messages(spark, sf).drop("chunk").withColumn("_seq", seq_of(F.col("value")))
    return stream_payload(msgs, clock=clock_of_seq(), keep=["_seq"])


@query("dedup_last_arrival", STREAM_TABLE_SQL)
def dedup_last_arrival(spark, sf):
    """Collapse all messages per key as sequential upserts would (batch form)."""
    return stream_out(collapse_last_arrival(event_payload_rows(spark, sf), "job_hash", "_seq"))


@query("sink_upsert_stream", STREAM_TABLE_SQL)
def sink_upsert_stream(spark, sf):
    """Stream-table merge in batch form: the last chunk merged into the table built from the others."""
    rows = stream_payload(event_messages(spark, sf).withColumn("_seq", seq_of(F.col("value"))), clock=clock_of_seq(),
                          keep=["_seq", "chunk"])
    first = collapse_last_arrival(rows.filter(F.col("chunk") < CHUNKS - 1).drop("chunk"), "job_hash", "_seq")
    last = materialize(collapse_last_arrival(rows.filter(F.col("chunk") == CHUNKS - 1).drop("chunk"), "job_hash", "_seq"),
                       "last_chunk")
    return stream_out(upsert_stream(first, last, STREAM_COLUMNS + ["_seq"]))


@query("topk_latest_stream", LATEST_SQL)
def topk_latest_stream(spark, sf):
    """Batch report: newest 20 rows by ingest time (ties by key) of the stream table."""
    table = collapse_last_arrival(event_payload_rows(spark, sf), "job_hash", "_seq")
    return RP.latest_stream(table).select(ntz("ingested_at"), "title", "company", "location", "job_url")


@query("norm_stream_message", W(RAW, API_POST) + """SELECT job_hash, job_id, source, title, company, location, is_remote,
  category, _iso AS publication_date, job_url, description FROM api_postings""")
def norm_stream_message(spark, sf):
    """Raw API postings -> 11-field messages (ISO date text with its offset, no enrichment)."""
    res = paged_results(read_json_documents(spark, L.land_pages(spark, sf)))
    return stream_message(res).select(*MESSAGE_FIELDS)


@query("norm_stream_payload", W(EM) + f"SELECT {STREAM_COLS_SQL} FROM em")
def norm_stream_payload(spark, sf):
    """Messages -> stream rows: missing is_remote -> true, JSON null -> false, falsy source -> 'api'."""
    return stream_out(event_payload_rows(spark, sf))

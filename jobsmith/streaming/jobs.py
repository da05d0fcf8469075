"""Structured Streaming jobs: publish postings as keyed messages, and upsert
consumed messages into the stream table.

Delivery: checkpoints record source progress; the upsert appends every
micro-batch, folded per key, as a part named by (query, batch). A retried batch
finds its finished part and adds nothing; a new checkpoint on an existing table
is another query and appends after what is there. No path that is being read is
ever overwritten, and a batch costs what it holds, not what the table holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from jobsmith.operators.dedup import collapse_last_arrival
from jobsmith.operators.merge import split_quarantine
from jobsmith.operators.normalize import stream_message, stream_payload
from jobsmith.schema import MESSAGE_FIELDS, STREAM_COLUMNS, STREAM_SCHEMA

RECORD_SCHEMA = "key STRING, value STRING"


def encode_records(messages: DataFrame, key: str = "job_hash") -> DataFrame:
    """Messages -> (key, value JSON) records, explicit nulls kept in the JSON."""
    return messages.select(F.col(key).alias("key"),
                           F.to_json(F.struct(*MESSAGE_FIELDS), {"ignoreNullFields": "false"}).alias("value"))


def record_stream(spark: SparkSession, path: str, *, fmt: str = "json", max_files_per_trigger: int | None = None,
                  options: dict[str, str] | None = None) -> DataFrame:
    """Keyed records as a stream. ``fmt='kafka'`` reads a broker (options carry
    ``kafka.bootstrap.servers``/``subscribe``; needs the Kafka connector jar);
    any file format reads landed ``key, value`` records from ``path``."""
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset")
    r = spark.readStream.schema(RECORD_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def start(df: DataFrame, *, checkpoint: str, sink: str | None = None, fmt: str = "json",
          trigger: dict | None = None, output_mode: str = "append",
          foreach_batch: Callable[[DataFrame, int], None] | None = None, options: dict[str, str] | None = None
          ) -> StreamingQuery:
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    return w.format(fmt).start(sink)


def publish(postings: DataFrame, *, posting_col: str = "j", event_time: str | None = None,
            dedup_delay: str | None = None, keep: Sequence[str] = (), dedup: bool = True) -> DataFrame:
    """Raw API postings (streaming, VARIANT ``posting_col``) -> keyed records,
    each key published once.

    Without ``dedup_delay`` the state store keeps every key ever seen (exact
    first-seen dedup). With it, ``dropDuplicatesWithinWatermark`` bounds the
    state: a key is suppressed for ``dedup_delay`` of event time after its first
    occurrence, then forgotten — a defined bound instead of an arbitrary cut. A
    first occurrence later than the watermark is left out by it as well; where
    that may happen use the exact form. ``dedup=False`` leaves it to the sink:
    ``FirstSeen`` is exact too and combines a hot key before it is shuffled.
    Postings that are not JSON (NULL) are not published: see ``malformed``.
    """
    postings = postings.filter(F.col(posting_col).isNotNull())
    msgs = stream_message(postings, posting_col=posting_col, keep=list(keep))
    if dedup_delay:
        ts = F.col(event_time).cast("timestamp")
        msgs = msgs.withColumn("_et", ts).withWatermark("_et", dedup_delay) \
            .dropDuplicatesWithinWatermark(["job_hash"]).drop("_et")
    elif dedup:
        msgs = msgs.dropDuplicates(["job_hash"])
    return encode_records(msgs)


def malformed(postings: DataFrame, *, posting_col: str = "j") -> DataFrame:
    """The rows that ``publish`` leaves out, with whatever other columns they carry."""
    return postings.filter(F.col(posting_col).isNull())


class FirstSeen:
    """Sink that keeps the first row of every key: one folder a micro-batch, which is the output and, for later
    batches, the table of keys seen.

    A batch is reduced to a row a key with partial aggregates, so a key with a third of the rows ships one row a
    map task. Of the table only the keys that the batch holds are kept, by a semi join on the key column alone:
    a small batch is broadcast (AQE's size check) and the table is not shuffled. Within a batch the first row is
    the smallest by ``order`` (then by its columns). Null keys are one key. A replayed batch writes its own folder
    again and does not look at it; a new checkpoint is another ``query`` and goes on after what is there."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "key",
                 order: Sequence[Column] = (), fmt: str = "parquet", query: str | None = None):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.order, self.fmt, self.query = list(order), fmt, query

    def write(self, batch: DataFrame, batch_id: int) -> None:
        own = self.query or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        rest = F.struct(*[F.col(c) for c in self.schema.names])
        rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(self.order)], rest.alias("row"))
        one = batch.groupBy(self.key).agg(F.min(rank).alias("_r")).select("_r.row.*").persist()
        try:
            keys = one.select(F.col(self.key).alias("_k"))
            before = self._rows().where(~((F.col("query") == own) & (F.col("batch_id") >= batch_id)))
            known = before.select(F.col(self.key).alias("_s")).join(keys, F.expr("_s <=> _k"), "left_semi")
            one.join(known, F.col(self.key).eqNullSafe(F.col("_s")), "left_anti") \
                .write.mode("overwrite").format(self.fmt).save(f"{self.path}/query={own}/batch_id={batch_id}")
        finally:
            one.unpersist()

    def read(self) -> DataFrame:
        return self._rows().select(*self.schema.names)

    def _rows(self) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        full = StructType(list(self.schema)).add("query", "string").add("batch_id", "long")
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).format(self.fmt).load(self.path)


class StreamTable:
    """Stream table under ``base``: one part a micro-batch, ``b{n}-{query}-{batch}``, and now and then a
    compacted part ``c{n}-`` that holds the fold of all parts up to number n and hides only those: a batch that
    lands while the fold is written has a later number and stays. Only parts with ``_SUCCESS`` count."""

    def __init__(self, spark: SparkSession, base: str, schema: StructType = STREAM_SCHEMA, seq: str = "_seq"):
        self.spark, self.base, self.schema, self.seq = spark, base.rstrip("/"), schema, seq

    def parts(self) -> list[str]:
        """Names of the finished parts, in order."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.base}/[bc]*/_SUCCESS")
        found = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
        return sorted((st.getPath().getParent().getName() for st in found), key=lambda n: (int(n[1:10]), n))

    def append(self, query: str, batch_id: int, rows: DataFrame) -> bool:
        """Add a batch (one row per key, with the sequence column); False if this query's batch is there already."""
        parts, tail = self.parts(), f"{query}-{batch_id}"
        if any(n.startswith("b") and n[11:] == tail for n in parts):
            return False
        n = int(parts[-1][1:10]) + 1 if parts else 1
        rows.select(*self.schema.names, self.seq).write.mode("overwrite").parquet(f"{self.base}/b{n:09d}-{tail}")
        return True

    def read(self) -> DataFrame:
        """One row per key: the parts folded in order, as one upsert after the other would."""
        return self._fold(self.parts()).drop(self.seq)

    def compact(self) -> None:
        """Write the fold of all parts as one; later reads start from it. Parts stay until ``base`` is cleaned."""
        parts = self.parts()
        if parts and parts[-1].startswith("b"):
            self._fold(parts).write.mode("overwrite").parquet(f"{self.base}/c{parts[-1][1:10]}-all")

    def _fold(self, parts: list[str]) -> DataFrame:
        last = max((i for i, n in enumerate(parts) if n.startswith("c")), default=0)
        live = parts[last:]
        if not live:
            return self.spark.createDataFrame([], self.schema).withColumn(self.seq, F.lit(None).cast("string"))
        part = F.regexp_extract(F.col("_metadata.file_path"), "/[bc]([0-9]{9})-[^/]*/[^/]*$", 1).cast("long")
        rows = self.spark.read.parquet(*[f"{self.base}/{n}" for n in live]) \
            .withColumn("_order", F.struct(part.alias("part"), F.col(self.seq).alias("seq"))).drop(self.seq)
        return collapse_last_arrival(rows, "job_hash", "_order") \
            .select(*self.schema.names, F.col("_order.seq").alias(self.seq))


def upsert_batch_fn(table: StreamTable, *, seq: Column, clock: Column | None = None, quarantine: str | None = None,
                    query: str | None = None, compact_every: int = 64) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: payload -> quarantine rows without a key -> collapse per key
    (last message wins, job_url last non-null, source first) -> append to the table.

    Quarantined records keep every column they came with (key and value text,
    partition and offset from a broker) and a reason; they go to ``quarantine``,
    by default a folder beside the table. ``query`` names the writer; by default
    it is the streaming query's id, which its checkpoint keeps. Every ``compact_every``-th batch folds the
    table's parts into one, so that a read does not grow with the batches.
    """
    where = quarantine or f"{table.base}-quarantine"

    def run(batch: DataFrame, batch_id: int) -> None:
        own = query or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        came = [c for c in batch.columns if c not in STREAM_COLUMNS]
        # decoded once: the micro-batch feeds both the quarantine and the table
        rows = stream_payload(batch.withColumn(table.seq, seq), clock=clock, keep=[table.seq, *came]).persist()
        try:
            good, bad = split_quarantine(rows, ["job_hash"])
            reason = F.when(F.try_parse_json("value").isNull(), "not JSON").otherwise("no key")
            bad.select(*came, table.seq, reason.alias("reason")).write.mode("overwrite") \
                .parquet(f"{where}/query={own}/batch_id={batch_id}")
            table.append(own, batch_id, collapse_last_arrival(good.drop(*came), "job_hash", table.seq))
        finally:
            rows.unpersist()
        if batch_id % compact_every == compact_every - 1:
            table.compact()
    return run


def dedup_within(records: DataFrame, keys: Sequence[str], event_time: Column, delay: str) -> DataFrame:
    """Bounded-state dedup: drop repeats of a key seen within ``delay`` of event time.

    Rows later than the watermark are dropped by it, first occurrences too; where
    they must be kept use ``dropDuplicates(keys)``, whose state keeps every key."""
    return (records.withColumn("_et", event_time.cast("timestamp")).withWatermark("_et", delay)
            .dropDuplicatesWithinWatermark(list(keys)).drop("_et"))


def daily_counts(events: DataFrame, event_time: str | Column, keys: Sequence[str] = (), delay: str = "1 day") -> DataFrame:
    """Rows a day (tumbling event-time window) and key: (day, *keys, n), kept in the state store.

    A row counts if its day has not been closed: a day closes once the watermark, the latest event time of
    the batches before less ``delay``, has passed its end. Later rows for it are left out, and its state goes,
    so the state holds the days within ``delay`` of the newest. Rows without an event time belong to no day."""
    ts = F.col(event_time) if isinstance(event_time, str) else event_time
    return (events.withColumn("_et", ts.cast("timestamp")).where("_et IS NOT NULL").withWatermark("_et", delay)
            .groupBy(F.window("_et", "1 day").alias("w"), *keys).agg(F.count("*").alias("n"))
            .select(F.to_date(F.col("w.start")).alias("day"), *keys, "n"))


class LatestTable:
    """Updates of a stateful query (output mode ``update``), one folder a micro-batch; reading gives the last
    update of every key. A replayed batch overwrites its own folder."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        rows = self.spark.read.schema(f"{self.schema}, batch_id long").parquet(self.path)
        rest = [c for c in rows.columns if c not in (*self.keys, "batch_id")]
        return rows.groupBy(*self.keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])

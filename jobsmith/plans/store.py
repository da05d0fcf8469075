"""Posting tables of which a load rewrites only what it touches.

* Clean table: Parquet in ``buckets`` hash partitions of the key. A load reads and
  replaces the partitions that its keys fall into (dynamic partition overwrite); m
  keys touch at most m of them. The partition is ``pmod(hash(key), buckets)``, the
  one that ``repartition(buckets, key)`` deals by, so the merge shuffles each side
  once and every task writes one partition.
* Metric counts: (day, kind, label, n) in month partitions, changed by the load's
  signed entries: plus the incoming rows', minus those of the rows they replace.
  Only the months of those entries are read and replaced; the clean table is not.
* Metrics: a row a day, of the changed months from their counts. A day that loses
  its last posting keeps its row, as with a recomputation of the days that are there.

* URL index (``unique_url``): (job_url, job_hash) in hash partitions of the URL, changed
  like the clean table. A URL under two keys fails the load.

Constraints are checked by metrics observed while the new contents are staged
(``DataFrame.observe``), without a scan of their own: columns of ``REQUIRED`` may not
be null, and with ``unique_url`` a non-empty URL belongs to one key of the whole table.

A load first stages the new contents of all partitions it will replace and marks
them ready, then swaps them in: the clean table's and the URL index's by moving the
staged folders. Replacing a partition twice gives the same table, so a load that broke off after the mark is finished by the next one (``recover``),
and one that broke off before it has changed nothing. One writer at a time;
a frame read before a load is not to be used after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsmith.operators.merge import empty_like, full_refresh_requested, upsert, upsert_metrics
from jobsmith.operators.metrics import metric_entries, metrics_of_counts
from jobsmith.plans.snapshots import Snapshot, _fs
from jobsmith.schema import METRICS_SCHEMA, POSTING_SCHEMA
from jobsmith.session import materialize

COUNT_SCHEMA = T.StructType([T.StructField("metric_date", T.DateType()), T.StructField("kind", T.StringType()),
                             T.StructField("label", T.StringType()), T.StructField("n", T.LongType()),
                             T.StructField("month", T.IntegerType())])

URL_SCHEMA = T.StructType([T.StructField("job_url", T.StringType()), T.StructField("job_hash", T.StringType()),
                           T.StructField("bucket", T.IntegerType())])
REQUIRED = ("job_hash", "source", "ingested_at")


class ConstraintError(ValueError):
    """A load whose rows break a constraint; it has changed nothing."""


def month_of(day: str = "metric_date") -> Column:
    return F.year(day) * 100 + F.month(day)


class Partitioned:
    """A Parquet table in partitions of one column (the schema's last)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema, self.column = spark, path, schema, schema.names[-1]

    def read(self) -> DataFrame:
        fs, p, _ = _fs(self.spark, self.path)
        if not fs.exists(p):
            return empty_like(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def write(self, rows: DataFrame, whole: bool) -> None:
        """Replace the partitions that ``rows`` has, or all of them."""
        rows.select(*self.schema.names).write.mode("overwrite").partitionBy(self.column) \
            .option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(self.path)

    def take(self, staged: str, whole: bool) -> None:
        """``write`` of rows that are stored in the table's form: their folders are moved in, not copied. What a
        move that broke off has left is moved by the next call; a ``whole`` table is moved in one."""
        fs, table, jvm = _fs(self.spark, self.path)
        source = jvm.org.apache.hadoop.fs.Path(staged)
        if not fs.exists(source):
            return
        names = [st.getPath().getName() for st in fs.listStatus(source) if st.isDirectory()]
        moves = [(source, table)] if whole else [(jvm.org.apache.hadoop.fs.Path(source, n), jvm.org.apache.hadoop.fs.Path(table, n))
                                                 for n in names]
        for a, b in moves:
            fs.delete(b, True)
            fs.mkdirs(b.getParent())
            if not fs.rename(a, b):
                raise OSError(f"{a} can't be moved to {b}")


class PostingStore:
    """``extra``: fields that a clean row carries besides the posting's; ``with_metrics=False``: the clean table alone;
    ``unique_url``: no non-empty URL under two keys (a table is made with or without it)."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = 64, extra: tuple[T.StructField, ...] = (),
                 with_metrics: bool = True, unique_url: bool = False):
        self.spark, self.base, self.buckets, self.with_metrics = spark, base.rstrip("/"), buckets, with_metrics
        self.unique_url = unique_url
        self.schema = T.StructType([*POSTING_SCHEMA.fields, *extra])
        bucket = T.StructField("bucket", T.IntegerType())
        # the number of partitions is part of the path: a table is never read under another one
        self.clean = Partitioned(spark, f"{self.base}/jobs_clean_{buckets}", T.StructType([*self.schema.fields, bucket]))
        self.urls = Partitioned(spark, f"{self.base}/job_urls_{buckets}", URL_SCHEMA)
        self.counts = Partitioned(spark, f"{self.base}/metric_counts", COUNT_SCHEMA)
        self.metrics = Snapshot(spark, f"{self.base}/daily_metrics", METRICS_SCHEMA)
        self.staging_path, self.log = f"{self.base}/jobs_staging", f"{self.base}/_load"

    def bucket(self, key: str = "job_hash") -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def postings(self) -> DataFrame:
        return self.clean.read().select(*self.schema.names)

    def load(self, postings: DataFrame, *, full_refresh: bool | str | None = False, clock: Column | None = None) -> None:
        """Staging overwrite -> clean upsert -> metrics upsert, each only where the batch reaches.

        A full refresh empties the clean table and the counts first; the metrics of days that the batch does
        not hold stay. A key twice in the batch, a null key or a broken constraint fails the load and nothing is
        changed."""
        refresh = full_refresh if isinstance(full_refresh, bool) else full_refresh_requested(full_refresh)
        self.recover()
        self._forget()
        postings.select(*self.schema.names).write.mode("overwrite").option("compression", "zstd").parquet(self.staging_path)
        staging = self.spark.read.schema(self.schema).parquet(self.staging_path)
        touched = sorted(r[0] for r in staging.select(self.bucket()).distinct().collect())  # at most ``buckets``
        old = empty_like(self.spark, self.clean.schema) if refresh else self.clean.read().where(F.col("bucket").isin(touched))
        merged = upsert(old.repartition(self.buckets, "job_hash"), staging.repartition(self.buckets, "job_hash"), "job_hash",
                        columns=self.schema.names, coalesce_new_old=("job_url",))
        self._stage(merged.withColumn("bucket", self.bucket()), "clean", {f"{c} is null": F.col(c).isNull() for c in REQUIRED})
        replaced = old.join(staging.select("job_hash"), "job_hash", "left_semi")
        if self.unique_url:
            self._stage(self._new_urls(staging, replaced, refresh), "urls", {"job_url under two keys": F.col("_low") < F.col("job_hash")})
        if self.with_metrics:
            self._new_counts(staging, replaced, refresh).withColumn("month", month_of()).hint("rebalance", "month") \
                .write.mode("overwrite").partitionBy("month").parquet(f"{self.log}/counts")
        self._mark("whole" if refresh else "touched")
        self._apply(refresh, clock)

    def _stage(self, rows: DataFrame, name: str, broken: dict[str, Column]) -> None:
        """Write what replaces partitions of a table, counting the rows that break a constraint in the same pass."""
        seen = Observation()
        rows.observe(seen, *[F.count_if(c).alias(n) for n, c in broken.items()]).drop("_low") \
            .write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.log}/{name}")
        found = {n: k for n, k in seen.get.items() if k}
        if found:
            raise ConstraintError("; ".join(f"{n}: {k} rows" for n, k in found.items()))

    def _new_urls(self, staging: DataFrame, replaced: DataFrame, refresh: bool) -> DataFrame:
        """Index rows of the partitions that hold a URL which the load brings, keeps or takes from a key. A URL that
        nobody holds any more stays with a null key, so that its partition is replaced; the next change drops it."""
        before = replaced.select("job_hash", F.col("job_url").alias("was"))
        change = materialize(staging.select("job_hash", "job_url").join(before, "job_hash", "left").select(
            "job_hash", F.coalesce("job_url", "was").alias("job_url"), "was"), "url_changes")
        mine = change.select("job_url", "job_hash").unionByName(change.select(F.col("was").alias("job_url"), F.lit(None).alias("job_hash"))) \
            .where("job_url <> ''").withColumn("bucket", self.bucket("job_url"))
        if not refresh:
            touched = [r[0] for r in mine.select("bucket").distinct().collect()]  # at most ``buckets``
            kept = self.urls.read().where(F.col("bucket").isin(touched) & F.col("job_hash").isNotNull())
            mine = mine.unionByName(kept.join(change.select("job_hash"), "job_hash", "left_anti"))
        return mine.groupBy("job_url", "bucket").agg(F.min("job_hash").alias("_low"), F.max("job_hash").alias("job_hash"))

    def _new_counts(self, added: DataFrame, gone: DataFrame, refresh: bool) -> DataFrame:
        """Counts of the months that the signed entries change. A total stays, also at zero: its month's partition
        is replaced like the others, and its day is known as one without postings."""
        signed = metric_entries(added).withColumn("n", F.lit(1)).unionByName(metric_entries(gone).withColumn("n", F.lit(-1)))
        change = materialize(signed.groupBy("metric_date", "kind", "label").agg(F.sum("n").alias("n")).where("n <> 0"),
                             "metric_changes")
        if not refresh:
            months = change.select(month_of().alias("month")).distinct()
            low, high = months.agg(F.min("month"), F.max("month")).first()
            kept = self.counts.read().where(F.col("month").between(F.lit(low), F.lit(high))).join(months, "month", "left_semi")
            change = change.unionByName(kept.select(*change.columns))
        return change.groupBy("metric_date", "kind", "label").agg(F.sum("n").alias("n")).where("n <> 0 OR kind = 't'")

    def recover(self, clock: Column | None = None) -> bool:
        """Finish a load that broke off after all it replaces was staged; True if there was one."""
        fs, p, jvm = _fs(self.spark, self.log)
        for how in ("whole", "touched"):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(p, f"ready-{how}")):
                self._apply(how == "whole", clock)
                return True
        return False

    def _mark(self, how: str) -> None:
        fs, p, jvm = _fs(self.spark, self.log)
        fs.create(jvm.org.apache.hadoop.fs.Path(p, f"ready-{how}"), True).close()

    def _apply(self, whole: bool, clock: Column | None) -> None:
        staged = lambda t, name: self.spark.read.schema(t.schema).parquet(f"{self.log}/{name}")
        self.clean.take(f"{self.log}/clean", whole)
        if self.unique_url:
            self.urls.take(f"{self.log}/urls", whole)
        if self.with_metrics:
            counts = staged(self.counts, "counts")
            self.counts.write(counts.hint("rebalance", "month"), whole)
            fresh = metrics_of_counts(counts.where("n <> 0"), clock=clock)
            self.metrics.write(upsert_metrics(self.metrics.read(), fresh).select(*METRICS_SCHEMA.names))
        self._forget()

    def _forget(self) -> None:
        fs, p, _ = _fs(self.spark, self.log)
        fs.delete(p, True)

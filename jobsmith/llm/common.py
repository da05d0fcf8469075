"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.session import scratch_path

#: translate table: ASCII letters and digits (lower-cased) and every non-ASCII byte stay, all else is a blank
WORD_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b > 127)
                   else 32 for b in range(256))
#: translate table: lower-case A-Z only
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z-lower-cased text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, read by Spark from any store it can reach."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: the session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def learnable(doc_id: str | Column) -> Column:
    """Rows a model may learn labels from: crc32 of the id as text, mod 3, is not 1."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % 3 != 1


def held_out(doc_id: str | Column) -> Column:
    """The rest of them (a null id is held out of learning but is not in the held-out set)."""
    return F.coalesce(~learnable(doc_id), F.lit(False))


class Stored:
    """A DataFrame written once as Parquet in the shared folder, droppable after use.

    Unlike ``checkpoint()`` the files are columnar and later readers prune them;
    unlike a cached table they survive the loss of every executor.
    """

    def __init__(self, df: DataFrame, name: str, path: str | None = None):
        self.spark, self.path = df.sparkSession, path or scratch_path(df.sparkSession, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest id reachable from every id that occurs in ``edges(a, b)``: rows (id, component).

    Alternating large-star and small-star rounds; each round is two partially
    aggregated minima and two joins, whose result is written to the shared folder
    (lineage cut, lost executors recompute one round at most). A hub never
    gathers its neighbours in one task: its minimum is pre-aggregated and joined
    back, and the join's large side can be split. Self-links and null ids are
    ignored; an empty input gives an empty result.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    cur = Stored(e, "cc")
    before = None
    for _ in range(max_rounds):
        large = Stored(_star(cur.df, large=True), "cc")
        cur.drop()
        cur = Stored(_star(large.df, large=False), "cc")
        large.drop()
        # sum of hashes: equal link sets give equal sums; a fixed point is a set of stars
        now = cur.df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    stars = cur.df
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")) \
        .unionByName(stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One star round over links a > b. Large: every larger neighbour of u points to the
    smallest of u and its neighbours. Small: every smaller neighbour of u, and u, does."""
    if large:
        nb = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        nb = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
    low = nb.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = (nb.where("v > u") if large else nb).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def upper_tail(z: float) -> float:
    """P(N(0,1) > z)."""
    return 0.5 * math.erfc(z / math.sqrt(2))

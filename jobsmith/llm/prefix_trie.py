"""Conversation prefix trie by truncation peeling.

A node is a distinct sequence of first d turns (role, text); the root is the empty
one. A conversation's turns become a chain of digests: the SHA-256 of the one
before and the turn's own, so the d-th stands for the first d turns.

Peeling descends from the longest conversation. At depth d the conversations that
end there, grouped by their whole sequence, meet the nodes that the level below
has left, stripped of their last turn; both are grouped by what is left of the
chain. That one aggregation finds the level's nodes and sums up their subtrees;
stripped again, they go up. A level is written to the shared folder (lineage cut)
and every aggregation is partial first, so a turn that a third of all conversations
share is a row a map task. Nodes deeper than any that two different sequences
share hold one sequence each: they are written out at once, and peeling begins at
the deepest shared node (found by one partially aggregated count of the prefixes).

A node's ended conversations are hashed in id order: range-partitioned tasks
join runs of ids into strings, and the last task of a node streams those.

Turns ascend by turn number (null first), then role and digest; null roles and texts
are empty; repeated rows are turns of their own; rows with a null conversation belong to
none and are left out. A text of any length is a digest and a length; a
conversation is one array of 32 bytes a turn. Other columns, whatever their names,
are not looked at. With no conversation there is no root: an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import Stored, width
from jobsmith.session import scratch_path

SIZE = 32
CHUNK_IDS = 4096


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, as (digest, bytes of its text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    own = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("k"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    return own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("k", "role", "digest", "bytes"))).alias("x")) \
        .select("conv_id", F.transform("x", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(convs: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations that share beginnings: each takes the first h turns of the one whose id is the next
    multiple of ``every`` below its own (none if there is none), then its own turns after its first h;
    h is the CRC-32 of its decimal id modulo ``most``."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % most).cast("int")
    base = convs.select(F.col("conv_id").alias("base"), F.slice("turns", F.lit(1), F.lit(most - 1)).alias("start"))
    none = F.array().cast(convs.schema["turns"].dataType)
    return convs.withColumn("base", c - F.pmod(c, F.lit(every))).withColumn("h", h).join(base, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("start", none), F.lit(1), F.col("h")),
                            F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns"))


def _chain(digests: Column) -> Column:
    """The prefixes' digests, one after the other, of an array of turn digests."""
    @F.arrow_udf("binary")
    def run(col: pa.Array) -> pa.Array:
        out = []
        for x in col:
            prefix, chain = b"", []
            for d in x.as_py():
                prefix = hashlib.sha256(prefix + d).digest()
                chain.append(prefix)
            out.append(b"".join(chain))
        return pa.array(out, pa.binary())
    return run(digests)


def _ends(ended: DataFrame) -> DataFrame:
    """(chain, ends_sha256) of rows (chain, conv_id): SHA-256 of the ids, ascending, comma-joined."""
    n = width(ended.sparkSession)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids = None, []
        rows = ((k.as_py(), i.as_py()) for b in batches for k, i in zip(b.column("chain"), b.column("conv_id")))
        out = []

        def close():
            out.append({"chain": at, "low": ids[0], "ids": ",".join(map(str, ids))})
        for k, i in rows:
            if ids and (k != at or len(ids) >= CHUNK_IDS):
                close()
                ids = []
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
            at = k
            ids.append(i)
        if ids:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    schema = pa.schema([("chain", pa.binary()), ("low", pa.int64()), ("ids", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for b in batches:
            keys, sums = [], []
            for k, ids in zip(b.column("chain"), b.column("ids")):
                k, ids = k.as_py(), ids.as_py().encode()
                if state is not None and k == at:
                    state.update(b"," + ids)
                else:
                    if state is not None:
                        keys.append(at)
                        sums.append(state.hexdigest())
                    at, state = k, hashlib.sha256(ids)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], names=["chain", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], names=["chain", "ends_sha256"])
    runs = ended.repartitionByRange(n, "chain", "conv_id").sortWithinPartitions("chain", "conv_id") \
        .mapInArrow(join, "chain binary, low long, ids string")
    return runs.repartition(n, "chain").sortWithinPartitions("chain", "low").mapInArrow(hashed, "chain binary, ends_sha256 string")


SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def _prefix(depth: Column) -> Column:
    """Digest of the chain's prefix of that depth; of the empty one, the empty string."""
    return F.when(depth > 0, F.substring("chain", F.lit(1) + (depth - 1) * SIZE, F.lit(SIZE))).otherwise(F.lit(b""))


def _named(nodes: DataFrame) -> DataFrame:
    """Nodes with their own and their parent's prefix digest."""
    return nodes.withColumn("id", _prefix(F.col("depth"))).withColumn("up", _prefix(F.col("depth") - 1))


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the conversations (conv_id, turns): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs`` (members), ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree: members less one, times the
    bytes of the last text) and ``ends_sha256`` (of the members that end there)."""
    spark, zero = convs.sparkSession, F.lit(0).cast("long")
    rows = Stored(convs.select("conv_id", F.size("turns").alias("depth"), _chain(F.transform("turns", lambda t: t["digest"]))
                               .alias("chain"), F.transform("turns", lambda t: t["bytes"]).alias("bytes")), "trie-chains")
    grouped = rows.df.groupBy("depth", "chain", "bytes").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    ended = Stored(grouped.select("depth", "chain", "bytes", "conv_id", "n_convs", zero.alias("n_children"),
                                  zero.alias("n_leaves"), zero.alias("saved_tokens")), "trie-ended").df
    each = ended.select("chain", F.explode(F.sequence(F.lit(0), "depth")).alias("d"))
    shared = each.groupBy("d", _prefix(F.col("d")).alias("id")).agg(F.count("*").alias("c")).where("c > 1") \
        .agg(F.max("d")).first()[0] or 0
    long_ = F.col("depth") > shared
    tails = _tails(ended.where(long_), shared)
    left = _stripped(ended.where(long_).withColumn("n_leaves", F.lit(1).cast("long")).withColumn("saved_tokens", _saved(F.lit(shared + 1))),
                     shared)
    path = scratch_path(spark, "trie-levels")
    for d in range(shared, -1, -1):
        level = _level(ended.where(F.col("depth") == d).drop("depth").unionByName(left), d)
        left = _stripped(Stored(level, "trie-level", f"{path}/depth={d}").df, d - 1)
    levels = spark.read.schema(f"{LEVEL}, depth long").parquet(path).drop("chain", "bytes")
    nodes = levels.unionByName(tails)
    parents = nodes.where("n_children > 0").select(F.col("depth").alias("above"), F.col("id").alias("up"),
                                                   F.col("conv_id").alias("parent_conv_id"))
    ends = _ends(rows.df.select(_prefix(F.col("depth")).alias("chain"), "conv_id")).select(F.col("chain").alias("id"), "ends_sha256")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.withColumn("above", F.col("depth") - 1).join(parents, ["above", "up"], "left").join(ends, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", *SUMS, F.coalesce("ends_sha256", empty).alias("ends_sha256"))


LEVEL = ("chain binary, bytes array<bigint>, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "id binary, up binary")


def _saved(depth: Column) -> Column:
    """Bytes that an unshared sequence's copies save from that depth on."""
    return F.when(F.col("n_convs") > 1, (F.col("n_convs") - 1) * F.aggregate(
        F.slice("bytes", depth, F.greatest(F.size("bytes") - depth + 1, F.lit(0))), F.lit(0).cast("long"), lambda a, b: a + b)) \
        .otherwise(F.lit(0).cast("long"))


def _tails(ended: DataFrame, shared: int) -> DataFrame:
    """Nodes deeper than any that two different sequences share: each sequence's own, without a round a level."""
    d = F.col("d")
    own = ended.withColumn("d", F.explode(F.sequence(F.lit(shared + 1), "depth"))) \
        .withColumn("n_children", (d < F.col("depth")).cast("long")).withColumn("n_leaves", F.lit(1).cast("long")) \
        .withColumn("saved_tokens", _saved(d)).withColumn("depth", d.cast("long"))
    return _named(own).select("conv_id", *SUMS, "id", "up", "depth")


def _stripped(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes cut to their first ``depth`` turns, each one child of what is left."""
    return nodes.select(F.substring("chain", 1, depth * SIZE).alias("chain"), F.slice("bytes", 1, max(depth, 0)).alias("bytes"),
                        "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")


def _level(rows: DataFrame, d: int) -> DataFrame:
    """Nodes of depth d, from the sequences that end there and the deeper nodes stripped to it."""
    sums = rows.groupBy("chain", "bytes").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS])
    last = F.element_at("bytes", d) if d else F.lit(0)
    level = sums.withColumn("n_leaves", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long")) \
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * last)
    return _named(level.withColumn("depth", F.lit(d))).drop("depth")

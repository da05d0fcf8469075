"""Embedding near-duplicates by spherical-cap filters.

The filters are random directions that form a product code: the dimensions are
cut into ``PARTS`` blocks, each with its own random code, and a filter is one code
vector a block. A vector belongs to every filter whose inner product exceeds the
threshold; because a filter's product is a sum over blocks, those filters are
listed ("list-decoded") from the blocks' products without visiting all of them.
Vectors that share a filter are compared exactly, in double precision.

Exact copies are grouped first. In a filter's group, members meet in tiles of at
most ``tile`` x ``tile`` (a large group is many tiles in many tasks; a task reads
its tiles in order and holds one at a time), and a tile
gives one row a member: its links and its tile component, never the pairs. A
pair is counted in the smallest filter that its two vectors share.

Null, zero and non-finite vectors link with nothing; vectors of several lengths
only meet their own length; repeated rows count as vectors of their own. An empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import Stored, connected_components, upper_tail, width

PARTS = 4


@dataclass(frozen=True)
class Caps:
    """Product codes of filters and their threshold, from a seed and a few numbers."""
    dim: int
    code: int              # code vectors a block
    threshold: float       # least inner product with a filter of norm one
    codes: int = 1         # independent product codes, each with its own rotation
    seed: int = 7

    def blocks(self, which: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """A random rotation and the blocks' code vectors (norm 1 / sqrt(PARTS) each)."""
        rng = np.random.default_rng((self.seed, which))
        turn = np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0]
        codes = []
        for part in np.array_split(np.arange(self.dim), PARTS):
            c = rng.standard_normal((self.code, max(1, len(part))))
            codes.append(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(PARTS))
        return turn, codes


def plan(n: int, dim: int, floor: float = 0.9, group: float = 48.0, shared: float = 1.7, recall: float = 0.97) -> Caps:
    """Code size, threshold and number of codes for n vectors: random vectors fall into a filter ``group`` at
    a time, and codes are added until a ``recall`` share of simulated pairs at cosine ``floor`` meet in one."""
    p = min(0.05, group / max(n, 1))
    lo, hi = 0.0, 12.0
    while hi - lo > 1e-6:
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if upper_tail(mid) > p else (lo, mid)
    z = np.linspace(lo, lo + 8, 4000)  # a filter's product beyond the threshold, given one vector's
    w = np.exp(-z * z / 2)
    both = np.array([upper_tail((lo - floor * a) / math.sqrt(1 - floor * floor)) for a in z])
    filters = shared / (p * float((w * both).sum() / w.sum()))  # of one code: a pair shares ``shared`` on average
    caps = Caps(dim, max(2, math.ceil(filters ** (1 / PARTS))), lo / math.sqrt(dim))
    rng = np.random.default_rng(caps.seed)
    x, y = rng.standard_normal((2, 400, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = floor * x + math.sqrt(1 - floor * floor) * y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    best = sum(d.max(axis=1) for d in _dots(x, caps, 0))  # in few dimensions no filter may come so near
    caps = replace(caps, threshold=min(caps.threshold, 0.95 * float(np.quantile(best, 0.95))))
    met = np.zeros(len(x), bool)
    for which in range(1000):
        met |= [len(np.intersect1d(a, b)) > 0 for a, b in zip(_decode(x, caps, which), _decode(y, caps, which))]
        if met.mean() >= recall:
            break
    return replace(caps, codes=which + 1)


def decode(x: np.ndarray, caps: Caps) -> list[np.ndarray]:
    """Filters (ascending numbers) that each unit vector exceeds."""
    found = [_decode(x, caps, which) for which in range(caps.codes)]
    return [np.concatenate(parts) for parts in zip(*found)]


def _dots(x: np.ndarray, caps: Caps, which: int) -> list[np.ndarray]:
    """Inner products with every block's code vectors."""
    turn, codes = caps.blocks(which)
    y, at, dots = x @ turn.T, 0, []
    for c, part in zip(codes, np.array_split(np.arange(caps.dim), PARTS)):
        dots.append(y[:, at:at + len(part)] @ c[:, :len(part)].T)
        at += len(part)
    return dots


def _decode(x: np.ndarray, caps: Caps, which: int) -> list[np.ndarray]:
    dots, k = _dots(x, caps, which), caps.code
    left = (dots[0][:, :, None] + dots[1][:, None, :]).reshape(len(x), -1)
    right = (dots[2][:, :, None] + dots[3][:, None, :]).reshape(len(x), -1)
    row, i = np.nonzero(left >= caps.threshold - right.max(axis=1, keepdims=True))  # halves that can still make it
    found = []
    step = max(1, (1 << 21) // (k * k))
    for lo in range(0, len(row), step):
        r, h = row[lo:lo + step], i[lo:lo + step]
        at, j = np.nonzero(right[r] >= (caps.threshold - left[r, h])[:, None])
        found.append(np.stack([r[at], (which * k * k + h[at]) * k * k + j]))
    rows, filters = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return np.split(filters, np.searchsorted(rows, np.arange(1, len(x))))


def _filters(vector: str, caps: Caps) -> Column:
    """Struct of the vector's filters: ``fs`` as an array, ``packed`` as the bytes of its numbers."""
    @F.arrow_udf("fs array<long>, packed binary")
    def run(col: pa.Array) -> pa.Array:
        out: list = []
        some = max(16, min(2048, (1 << 20) // caps.code ** 2))  # the blocks' pairwise sums of so many vectors at a time
        for i in range(0, len(col), some):
            part = col.slice(i, some)
            x = np.array(part.flatten(), np.float64).reshape(len(part), caps.dim)
            out += decode(x / np.linalg.norm(x, axis=1, keepdims=True), caps)
        return pa.StructArray.from_arrays([pa.array(out, pa.list_(pa.int64())),
                                           pa.array([f.astype("<i8").tobytes() for f in out], pa.binary())], ["fs", "packed"])
    return run(vector)


def _packed(vector: str, kind: str) -> Column:
    """Components as bytes, in the input's own precision."""
    @F.arrow_udf("binary")
    def run(col: pa.Array) -> pa.Array:
        return pa.array([np.array(x.values, kind).tobytes() for x in col], pa.binary())
    return run(vector)


def _compare(floor: float, kind: str):
    """mapInArrow-style comparison of tiles, whose members come one after the other: rows (f, i, j, side, rep,
    copies, v, fs) -> (rep, n, low). Only the tile at hand is held."""
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            key = np.stack([np.array(batch.column(c), np.int64) for c in ("f", "i", "j")])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                at = tuple(key[:, lo].tolist())
                if held and held[0] != at:
                    yield from one(*held)
                    held = []
                held = [at, [*(held[1] if held else []), batch.slice(lo, hi - lo)]]
        if held:
            yield from one(*held)

    def one(at: tuple, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        f, same = at[0], at[1] == at[2]
        left = np.array(rows.column("side"), bool)
        a = _members(rows, left, kind)
        b = a if same else _members(rows, ~left, kind)
        if not (len(a[0]) and len(b[0])):
            return
        close = a[1] @ b[1].T >= floor
        if same:
            np.fill_diagonal(close, False)
        if not close.any():
            return
        # pairs that share a smaller filter are counted there
        seen = np.unique(np.concatenate([a[3], b[3]]))
        if len(seen):
            close &= (_holds(a, seen) @ _holds(b, seen).T) == 0
        if not close.any():
            return
        rep = a[0] if same else np.concatenate([a[0], b[0]])
        n = close @ b[2] if same else np.concatenate([close @ b[2], close.T @ a[2]])
        low = _lowest(a[0], b[0], close, same)
        hit = n > 0
        yield pa.RecordBatch.from_arrays([pa.array(rep[hit], pa.int64()), pa.array(n[hit].astype(np.int64)),
                                          pa.array(low[hit], pa.int64())], names=["rep", "n", "low"])
    return tiles


def _members(rows: pa.RecordBatch, mine: np.ndarray, kind: str) -> tuple:
    """ids, unit vectors, copies, smaller filters (flat) and their number per member of one chunk."""
    at = np.flatnonzero(mine).tolist()
    v, fs = ([col[k].as_buffer() for k in at] for col in (rows.column("v"), rows.column("fs")))
    x = np.frombuffer(b"".join(v), kind).astype(np.float64).reshape(len(at), -1)
    return (np.array(rows.column("rep"), np.int64)[mine], x / np.linalg.norm(x, axis=1, keepdims=True),
            np.array(rows.column("copies"), np.float64)[mine], np.frombuffer(b"".join(fs), "<i8"),
            np.array([len(y) // 8 for y in fs], np.int64))


def _holds(m: tuple, seen: np.ndarray) -> np.ndarray:
    """0/1 matrix: member holds filter."""
    out = np.zeros((len(m[0]), len(seen)), np.float32)
    at = np.minimum(np.searchsorted(seen, m[3]), len(seen) - 1)
    ok = seen[at] == m[3]
    out[np.repeat(np.arange(len(m[0])), m[4])[ok], at[ok]] = 1
    return out


def _lowest(a: np.ndarray, b: np.ndarray, close: np.ndarray, same: bool) -> np.ndarray:
    """Smallest id of each member's component within the tile."""
    la, lb = a.copy(), (a if same else b).copy()
    while True:
        big = np.iinfo(np.int64).max
        na = np.minimum(la, np.where(close, lb[None, :], big).min(axis=1))
        nb = na if same else np.minimum(lb, np.where(close, na[:, None], big).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            return la if same else np.concatenate([la, lb])
        la, lb = na, nb


def usable(vector: str) -> Column:
    """The vector takes part: not null, finite, not zero."""
    c = F.col(vector)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & fine & F.exists(c, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", floor: float = 0.9,
                    tile: int = 512, caps: Caps | None = None) -> DataFrame:
    """One row per vector: ``n_links`` (others linked directly at cosine >= floor), ``component_id``
    (smallest id reachable) and ``kept`` (the component's smallest id is its own)."""
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("v"))
    ok = rows.where(usable("v"))
    classes = Stored(ok.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "embed-classes")
    dims = [r.d for r in classes.df.select(F.size("v").alias("d")).distinct().orderBy("d").collect()]
    links = None
    for d in dims:
        mine = classes.df.where(F.size("v") == d)
        part = _links(mine, caps or plan(mine.count(), d, floor), floor, tile, kind)
        links = part if links is None else links.unionByName(part)
    if links is None:
        links = spark.createDataFrame([], "rep long, n long, low long")
    found = Stored(links, "embed-links")
    comp = connected_components(found.df.select(F.col("rep").alias("a"), F.col("low").alias("b")).where("a <> b"))
    n = found.df.groupBy("rep").agg(F.sum("n").alias("n"))
    per_class = classes.df.join(n, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    named = ok.join(per_class, "v").select("id", "n_links", "component_id")
    rest = rows.where(~usable("v")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return named.unionByName(rest).select(F.col("id").alias(id_col), "n_links", "component_id",
                                          (F.col("id") == F.col("component_id")).alias("kept"))


def _links(classes: DataFrame, caps: Caps, floor: float, tile: int, kind: str) -> DataFrame:
    """Per class and tile: links counted there, smallest id of the tile component."""
    filtered = Stored(classes.select("rep", "copies", _packed("v", kind).alias("v"), _filters("v", caps).alias("x"))
                      .select("rep", "copies", "v", "x.*"), "embed-filters").df
    sizes = filtered.select(F.explode("fs").alias("f")).groupBy("f").agg(F.count("*").alias("m")).where("m > 1")
    # a member goes to chunk c of its filter's k chunks by a hash of its id, and to tiles (c, o) for every chunk o
    member = filtered.select(F.posexplode("fs").alias("p", "f"), "rep", "copies", "v", "packed").join(sizes, "f") \
        .withColumn("k", F.ceil(F.col("m") / tile)).withColumn("c", F.pmod(F.xxhash64("rep"), F.col("k"))) \
        .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    tiles = member.select("f", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), (F.col("c") <= F.col("o")).alias("side"),
                          "rep", "copies", "v", F.substring("packed", F.lit(1), F.col("p") * 8).alias("fs"))
    key = ["f", "i", "j"]
    return tiles.repartition(width(classes.sparkSession), *key).sortWithinPartitions(*key) \
        .mapInArrow(_compare(floor, kind), "rep long, n long, low long")

"""SimHash near-duplicates: fingerprint, pigeonhole blocks, verified Hamming links, components.

* ``fingerprints`` - one 64-bit SimHash a document over hashed word shingles.
* ``links`` - links between *different* fingerprints within ``max_bits``. The 64
  bits are cut into ``blocks`` equal blocks; two fingerprints that differ in at
  most ``max_bits`` bits agree on at least ``blocks - max_bits`` of them, so the
  join is on every combination of that many blocks, and each candidate's
  distance is verified in the join condition.
* ``near_duplicates`` - the component (smallest document id) of every document.

Equal fingerprints are grouped first, so copies never meet in pairs. A block
value shared by more than ``hot_block`` fingerprints (a large group of near
copies) is not joined with itself: its members are cut again by the same
pigeonhole rule into finer blocks, whose values few fingerprints can share.

Null text counts as empty; an empty document has fingerprint zero and links like
any other; repeated rows and ids keep their rows; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import LOWER_BYTES, Stored, connected_components

BITS = 64


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned SimHash of the text: words between blanks, ``shingle``-word shingles with
    repeats (fewer words: the whole sequence), XXH64; a bit is 1 if set in over half."""
    ws = text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split() if text else []
    if not ws:
        return 0
    joined, k = b" ".join(ws), min(shingle, len(ws))
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = [0, *(ends[:len(ws) - k] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    count, ones = 0, np.zeros(BITS, np.int64)
    stops = ends[k - 1:].tolist()
    for i in range(0, len(stops), 1 << 15):  # bounded: 32k shingles at a time
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[i:i + (1 << 15)], stops[i:i + (1 << 15)])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        count += len(h)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprint(text: str | Column, shingle: int = 3, seed: int = 42) -> Column:
    """Fingerprint column (LONG, the unsigned value's two's complement)."""
    @F.arrow_udf("long")
    def fp(col: pa.Array) -> pa.Array:
        out = np.array([simhash(t.as_py(), shingle, seed) for t in col], np.uint64)
        return pa.array(out.view(np.int64))
    return fp(text)


def _cut(width_bits: int, n: int) -> list[tuple[int, int]]:
    """``n`` blocks (offset, bits) over ``width_bits`` bits, as equal as can be."""
    edges = [round(i * width_bits / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _keys(blocks: list[tuple[int, int]], agree: int) -> list[int]:
    """Bit masks of every combination of ``agree`` blocks."""
    masks = [((1 << n) - 1) << a for a, n in blocks]
    return [sum(c) for c in combinations(masks, agree)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def links(distinct_fp: DataFrame, max_bits: int = 2, blocks: int = 4, hot_block: int = 64,
          fine_blocks: int = 16) -> DataFrame:
    """Links (a, b), a > b, between fingerprints within ``max_bits`` bits: all of them.

    ``distinct_fp`` has one column ``fp`` of distinct values. A block value that
    at most ``hot_block`` of them share is joined with itself. The members of
    hotter values (every pair of them) are cut into ``fine_blocks`` blocks
    instead: such a value leaves only ``max_bits`` blocks free, so at most
    2**(max_bits * 64 / fine_blocks) fingerprints (256 by default) can share it,
    however many copies a group has.
    """
    coarse = Stored(_shared(distinct_fp.select("fp"), blocks, max_bits), "simhash-blocks")
    cool = coarse.df.where(F.col("n") <= hot_block).drop("n")
    found = _pairs(_keyed(distinct_fp, blocks, max_bits).join(cool, ["k", "v"]), max_bits)
    hot = Stored(_keyed(distinct_fp, blocks, max_bits).join(coarse.df.where(F.col("n") > hot_block).drop("n"), ["k", "v"])
                 .select("fp").distinct(), "simhash-hot")
    fine = _keyed(hot.df, fine_blocks, max_bits).join(_shared(hot.df, fine_blocks, max_bits).drop("n"), ["k", "v"])
    return found.unionByName(_pairs(fine, max_bits))


def _keyed(fps: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    """(fp, k, v): the fingerprint's value under each combination k of blocks that must agree."""
    masks = _keys(_cut(BITS, blocks), blocks - max_bits)
    return fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))) \
        .withColumnsRenamed({"pos": "k", "col": "v"})


def _shared(fps: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    return _keyed(fps, blocks, max_bits).groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")


def _pairs(keyed: DataFrame, max_bits: int) -> DataFrame:
    """Verified pairs of one block value, each pair once."""
    x, y = keyed.alias("x"), keyed.alias("y")
    return x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.v") == F.col("y.v")) & (F.col("x.fp") > F.col("y.fp"))
                  & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits)) \
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, seed: int = 42) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``
    (smallest id reachable over links of at most ``max_bits`` bits, its own included)."""
    fps = Stored(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle, seed).alias("fp")),
                 "simhash-fp")
    groups = Stored(fps.df.groupBy("fp").agg(F.min("id").alias("low")), "simhash-groups")
    comp = Stored(connected_components(links(groups.df, max_bits)), "simhash-cc")
    named = groups.df.join(comp.df.withColumnRenamed("id", "fp"), "fp", "left") \
        .select("fp", "low", F.coalesce("component", "fp").alias("component"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_fp = Stored(named.join(lows, "component").select("fp", "component_id"), "simhash-ids")
    return fps.df.join(by_fp.df, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""SentencePiece encoding and decoding as a relational lattice.

1. Blanks become the model's ``\\u2581`` (one is put in front), and the text falls
   into units that no piece of the model crosses. Distinct units are found by one
   shuffle, after every task has made its own distinct.
2. Lattice: every unit is exploded into its substrings of at most the longest
   piece's length, equi-joined to the piece table; every character also has an
   edge of its own (its piece, or the unknown edge that stands for its bytes).
3. The edges are grouped by unit and folded from left to right in the tasks (those
   of long units with Spark's ``aggregate``): the best way to each place is the best
   over the edges that end there (Viterbi). Highest total score wins; of equals the
   one whose last piece is longest.
4. Documents take their units' ids in order. The unit table is sent to the tasks
   if it is at most ``SEND_UNITS`` rows and the texts have at most ``SENT_CHARS``
   characters. Beyond that documents are cut once, into blocks that are kept as
   numbers of their own runs of text; a block sends its different units, packed, to
   buckets of hashes, where they become the distinct units of 1., and the buckets
   send their ids back to the blocks that have them. Units are told apart by their
   text. What a task holds is a block or a bucket, however many documents there are.

Decoding joins the pieces' texts, byte pieces as bytes, and takes off the blank
in front. Null and empty texts have no ids and decode to the empty text; very long
texts and units are whole. A unit of over ``LONG_CHARS`` characters is cut into
stretches before its substrings are taken, and its fold keeps only the last places
in the state it copies, so it costs little more than its length times the longest
piece; its lattice lies in one task. Other columns are left out; repeated rows are encoded alike; an empty table gives no rows.

Scores are the model file's own. For a file of kind unigram that is exactly the
library's segmentation; a file of kind BPE is read as the same pieces and scores
under the best-sum rule, which need not be the library's order of merges.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.llm.common import Stored, width
from jobsmith.llm.lm_score import CODEC, _pack, _slices, _unpack
from jobsmith.session import scratch_path

SPACE = "\u2581"
SEND_UNITS = 4_000_000
SENT_CHARS = 1 << 26
BLOCK_CHARS = 1 << 23
BLOCK_RUNS = 400_000
BUCKET_UNITS = 1 << 20     # units of all blocks that meet in one group, some
BUCKET_CHARS = 1 << 24     # and their characters
BODY = "ids array<long>, lens binary, tokens binary, parts binary, places binary"
UNITS = "units binary, n_units long, n_chars long"
PART_CHARS = 250_000
LONG_CHARS = 512
STRETCH = 256


@contextmanager
def _gathered_in_memory(spark: SparkSession):
    """While a bounded lattice is gathered: keep Spark's list aggregate on its hash map (by default it turns
    to sorting after 128 groups, which would write every edge to disk)."""
    key = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(10 * PART_CHARS))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@lru_cache(maxsize=4)
def model(path: str):
    """The library's model file, read for its pieces."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def pieces(path: str) -> list[tuple[int, str, float]]:
    """(id, piece, score) of the ordinary pieces."""
    m = model(path)
    return [(i, m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]


def unit_pattern(rows: list[tuple[int, str, float]]) -> str:
    """Regex whose matches, one after the other, are a text's units.

    A unit is blanks with a word or with other characters, blanks alone, a digit
    with other characters, or a line break. If a piece crosses such a unit, units
    are blanks with all up to the next blank; if one crosses those, whole texts.
    """
    odd = "".join(sorted({c for _, p, _ in rows for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()}))
    letter = rf"[^\W\d_{odd}]"  # numerals such as superscripts are no letters
    other = rf"(?:(?!{letter})[^0-9\n{SPACE}])"
    kind = lambda c: "L" if re.match(letter, c) else c if c in f"\n{SPACE}" else "D" if c in "0123456789" else "O"
    within = {(SPACE, SPACE), (SPACE, "L"), (SPACE, "O"), ("L", "L"), ("O", "O"), ("D", "O")}
    pairs = {ab for _, p, _ in rows for ab in zip(p, p[1:])}
    if {(kind(a), kind(b)) for a, b in pairs} <= within:
        return rf"{SPACE}*(?:{letter}+|{other}+)|{SPACE}+|[0-9]{other}*|\n"
    return "(?s).+" if any(b == SPACE != a for a, b in pairs) else rf"{SPACE}*[^{SPACE}]+|{SPACE}+"


def units(text: str | None, pattern: re.Pattern) -> list[str]:
    """The text's units in order: joined they are the text with a blank in front, blanks as U+2581."""
    return pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []


def runs(text: str | None, pattern: str) -> list[str]:
    """The text cut before its blanks, where every unit ends: a run's units are those of ``SPACE + run``, one run
    after the other they are the text's. The same runs come again and again, so most need no pattern."""
    if not text:
        return []
    text = text.replace(" ", SPACE)
    if pattern.startswith("(?s)"):  # units are whole texts
        return [text]
    if text[0] != SPACE and SPACE * 2 not in text:
        return text.split(SPACE)
    return [x[1:] for x in re.findall(rf"{SPACE}+[^{SPACE}]*", SPACE + text)]


def distinct_units(docs: DataFrame, text_col: str, pattern: str) -> DataFrame:
    """(h, unit): every task's distinct units, then distinct over all; h is the unit's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen, known = re.compile(pattern), set(), set()
        for batch in batches:
            for t in batch.column("t"):
                new = set(runs(t.as_py(), pattern)) - known
                for r in new:
                    seen.update(cut.findall(SPACE + r))
                known |= new
                if len(seen) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["unit"])
                    seen = set()
                if len(known) > 300_000 or len(new) > 100_000:
                    known = set()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["unit"])
    return docs.select(F.col(text_col).alias("t")).mapInArrow(run, "unit string").distinct() \
        .select(F.xxhash64("unit").alias("h"), "unit")


def piece_table(spark: SparkSession, path: str) -> tuple[DataFrame, int, float]:
    """(id, piece, score) as a table (the model's pieces: a fixed number), the longest piece's length, the lowest score."""
    rows = pieces(path)
    table = spark.createDataFrame(pa.table({"id": [r[0] for r in rows], "piece": [r[1] for r in rows],
                                            "score": [r[2] for r in rows]}))
    return table, max(len(p) for _, p, _ in rows), min(s for *_, s in rows)


def lattice(words: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Edges (h, unit, start, end, id) of every unit; id -1 is the unknown character's edge."""
    table, longest, _ = piece_table(spark, path)
    n = F.char_length("unit")
    spans = words.select("h", "unit", F.explode(F.sequence(F.lit(1), n)).alias("start")).select(
        "h", "unit", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("start") + 1))).alias("len"))
    sub = F.substring(F.col("unit"), F.col("start"), F.col("len"))
    edges = spans.withColumn("piece", sub).join(F.broadcast(table.drop("score")), "piece", "left")
    return edges.where("id IS NOT NULL OR len = 1").select(
        "h", "unit", (F.col("start") - 1).alias("start"), (F.col("start") + F.col("len") - 1).alias("end"),
        F.coalesce("id", F.lit(-1)).cast("int").alias("id"))


def best_path(starts: list[int], ends: list[int], gains: list[float]) -> tuple[list[int], float]:
    """(places of the best path's edges in the lists, its score); the edges come ordered by end and start, so that of
    equal ways to a place the one whose last edge is longest is the first."""
    best, last = [0.0], [0]
    for k, (start, end, gain) in enumerate(zip(starts, ends, gains)):
        way = best[start] + gain
        if end == len(best):  # the first edge that ends here
            best.append(way)
            last.append(k)
        elif way > best[end]:
            best[end], last[end] = way, k
    path, at = [], len(best) - 1
    while at:
        path.append(last[at])
        at = starts[last[at]]
    return path[::-1], best[-1]


def encode_units(words: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """(h, unit, ids, score): unknown characters as their bytes' pieces. An edge is gathered as one number."""
    m, rows, field = model(path), pieces(path), (1 << 21) - 1  # units and the model are far smaller
    byte = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    score = np.full(m.get_piece_size() + 1, min(s for *_, s in rows) - 10.0)  # by id + 1, the unknown edge's first
    score[[i + 1 for i, *_ in rows]] = [s for *_, s in rows]
    number = F.shiftleft(F.col("end").cast("long"), 42) + F.shiftleft(F.col("start").cast("long"), 21) + F.col("id") + 1

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            texts, lists = batch.column("unit").to_pylist(), batch.column("e")
            e = np.array(lists.flatten(), np.int64)
            cuts = (np.array(lists.offsets) - lists.offsets[0].as_py()).tolist()
            starts, ends = ((e >> 21) & field).tolist(), (e >> 42).tolist()
            ids, gains = (e & field).tolist(), score[e & field].tolist()
            found, totals = [], []
            for unit, lo, hi in zip(texts, cuts, cuts[1:]):
                taken, total = best_path(starts[lo:hi], ends[lo:hi], gains[lo:hi])
                out = []
                for k in taken:
                    if ids[lo + k]:
                        out.append(ids[lo + k] - 1)
                    else:
                        out.extend(byte[b] for b in unit[starts[lo + k]].encode())
                found.append(out)
                totals.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("unit"), pa.array(found, pa.list_(pa.int32())),
                                              pa.array(totals, pa.float64())], names=["h", "unit", "ids", "score"])
    return lattice(words, spark, path).groupBy("h", "unit").agg(F.sort_array(F.collect_list(number)).alias("e")) \
        .mapInArrow(fold, "h long, unit string, ids array<int>, score double")


def encode_long_units(words: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """(h, unit, ids) of long units: the same lattice and fold, without a copy of the unit in every edge, and with
    the places that no edge reaches back to any more put away as text, a stretch at a time."""
    m = model(path)
    table, longest, low = piece_table(spark, path)
    keep = max(STRETCH, longest)
    words = words.withColumn("key", F.sha2("unit", 256))
    cut = F.regexp_extract_all("unit", F.lit(f"(?s).{{1,{keep}}}"), F.lit(0))
    tail = lambda i: F.coalesce(F.substring(F.get("cut", i + 1), 1, longest - 1), F.lit(""))
    parts = words.select("h", "key", cut.alias("cut")).select("h", "key", F.posexplode(F.transform(
        "cut", lambda c, i: F.struct(F.char_length(c).alias("own"), F.concat(c, tail(i)).alias("text"))))
        .alias("part", "x")).select("h", "key", "part", "x.own", "x.text")
    spans = parts.select("h", "key", "part", "text", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("at")).select(
        "h", "key", "part", "text", "at", F.explode(F.sequence(F.lit(1), F.least(
            F.lit(longest), F.char_length("text") - F.col("at") + 1))).alias("len"))
    start = F.col("part") * keep + F.col("at") - 1
    edges = spans.withColumn("piece", F.substring(F.col("text"), F.col("at"), F.col("len"))) \
        .join(F.broadcast(table), "piece", "left").where("id IS NOT NULL OR len = 1") \
        .select("h", "key", F.struct((start + F.col("len")).cast("int").alias("end"), start.cast("int").alias("start"),
                                     F.coalesce("id", F.lit(-1)).cast("int").alias("id"),
                                     F.coalesce("score", F.lit(low - 10.0)).alias("score"),
                                     F.when(F.col("id").isNull(), F.col("piece")).alias("char")).alias("e"))
    # ``aggregate`` copies its state at every step, but not binaries. ``done`` holds the places from ``base`` on up to
    # before ``at``; those before them are put away as text, "start,id" or "start,x" and an unknown character's bytes.
    way = "struct<s:double,back:int,id:int,char:string>"
    kind = f"struct<away:binary,done:array<{way}>,base:int,cur:{way},at:int>"
    none = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("back"), F.lit(-2).alias("id"), F.lit(None).cast("string").alias("char"))
    first = F.struct(F.lit("").cast("binary").alias("away"), F.array().alias("done"), F.lit(0).alias("base"),
                     none.alias("cur"), F.lit(0).alias("at"))
    said = lambda w: F.when(w["id"] != -1, w["id"].cast("string")).otherwise(
        F.concat(F.lit("x"), F.hex(F.encode(w["char"], "UTF-8"))))
    text = lambda ws: F.concat(F.array_join(F.transform(ws, lambda w: F.concat(
        (-w["back"]).cast("string"), F.lit(","), said(w))), ";"), F.lit(";")).cast("binary")

    def fold(acc, e):
        before = F.when(e["start"] == acc["at"], acc["cur"]["s"]).otherwise(
            F.get(acc["done"], e["start"] - acc["base"])["s"])
        here = F.struct((before + e["score"]).alias("s"), (-e["start"]).alias("back"), e["id"].alias("id"),
                        e["char"].alias("char"))
        new = e["end"] > acc["at"]
        full = new & (F.size(acc["done"]) >= 2 * longest)
        more = F.concat(F.when(full, F.slice(acc["done"], longest + 1, longest)).otherwise(acc["done"]), F.array(acc["cur"]))
        return F.struct(
            F.when(full, F.concat(acc["away"], text(F.slice(acc["done"], 1, longest)))).otherwise(acc["away"]).alias("away"),
            F.when(new, more).otherwise(acc["done"]).alias("done"),
            F.when(full, acc["base"] + longest).otherwise(acc["base"]).alias("base"),
            F.when(new, here).otherwise(F.greatest(acc["cur"], here)).alias("cur"), e["end"].alias("at"))
    places = edges.groupBy("h", "key").agg(F.sort_array(F.collect_list("e")).alias("e")).select(
        "h", "key", F.aggregate("e", first.cast(kind), fold, lambda x: F.concat(
            x["away"], text(F.concat(x["done"], F.array(x["cur"]))))).alias("t")) \
        .select("h", "key", F.transform(F.split(F.col("t").cast("string"), ";"), lambda w: F.split(w, ",")).alias("p"))
    n = F.size("p") - 2  # the last part is empty, the first place has no edge
    # the ids from the last to the first; a stretch of them at a time joins the binary
    walk = F.aggregate(
        F.sequence(n, F.lit(1)), F.struct(n.alias("at"), F.lit("").cast("binary").alias("away"), F.lit("").alias("part")),
        lambda acc, i: F.when(i == acc["at"], F.struct(
            F.element_at(F.col("p"), i + 1)[0].cast("int").alias("at"),
            F.when(F.octet_length(acc["part"]) > 1000, F.concat(acc["away"], acc["part"].cast("binary")))
            .otherwise(acc["away"]).alias("away"),
            F.concat(F.when(F.octet_length(acc["part"]) > 1000, F.lit("")).otherwise(acc["part"]),
                     F.element_at(F.col("p"), i + 1)[1], F.lit(",")).alias("part"))).otherwise(acc),
        lambda x: F.concat(x["away"], x["part"].cast("binary")).cast("string"))
    byte = F.array(*[F.lit(m.piece_to_id(f"<0x{b:02X}>")) for b in range(256)])
    raw = lambda w: F.transform(F.sequence(F.lit(1), F.length(w).cast("int") - 2, F.lit(2)), lambda i: F.element_at(
        byte, F.conv(F.substring(w, i + 1, F.lit(2)), 16, 10).cast("int") + 1))
    ids = places.select("h", "key", walk.alias("path")).select("h", "key", F.flatten(F.transform(
        F.reverse(F.split(F.rtrim("path", F.lit(",")), ",")),
        lambda w: F.when(w.startswith("x"), raw(w)).otherwise(F.array(w.try_cast("int"))))).alias("ids"))
    return words.join(ids, ["h", "key"]).select("h", "unit", "ids")


def id_kind(path: str) -> str:
    """Bytes of an id in the packed table: two if the model's numbers fit."""
    return "<u2" if model(path).get_piece_size() <= 1 << 16 else "<i4"


def packed(table: DataFrame, kind: str) -> DataFrame:
    """(low, n, same, hashes, lens, ids) of rows (h, ids): runs of units in order of their hashes, as bytes, with
    the number of hashes that two units of a run share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            h = np.array(batch.column("h"), np.int64)
            lists = batch.column("ids")
            if len(h):
                same = int((h[1:] == h[:-1]).sum()) + int(last == h[0])
                last = h[-1]
                yield pa.RecordBatch.from_pydict({
                    "low": [int(h[0])], "n": [len(h)], "same": [same], "hashes": [h.tobytes()],
                    "lens": [np.diff(np.array(lists.offsets)).astype("<u4").tobytes()],
                    "ids": [np.array(lists.flatten()).astype(kind).tobytes()]})
    return table.select("h", "ids").repartitionByRange(width(table.sparkSession), "h").sortWithinPartitions("h") \
        .mapInArrow(run, "low long, n long, same long, hashes binary, lens binary, ids binary")


class Held:
    """Units' ids by the units' hashes, compact enough to be sent to every task, behind a bounded memo of runs."""

    MOST = 200_000

    def __init__(self, hashes: bytes, lens: bytes, ids: bytes, kind: str, pattern: str):
        self.cut = re.compile(pattern)
        self.hashes, self.ids, self.size = np.frombuffer(hashes, np.int64), ids, np.dtype(kind).itemsize  # sorted by hash
        self.offsets = np.concatenate(([0], np.cumsum(np.frombuffer(lens, "<u4"), dtype=np.uint32))).astype(np.uint32)
        self.memo: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        parts = [self.cut.findall(SPACE + r) for r in new]
        h = np.array([xxhash.xxh64_intdigest(u.encode(), 42) for us in parts for u in us], np.uint64).view(np.int64)
        i = np.searchsorted(self.hashes, h)
        lo, hi = ((self.offsets[at].astype(np.int64) * self.size).tolist() for at in (i, i + 1))
        at, ids, memo = 0, self.ids, self.memo
        for r, us in zip(new, parts):
            if len(us) == 1:
                memo[r] = ids[lo[at]:hi[at]]
            else:
                memo[r] = b"".join([ids[lo[k]:hi[k]] for k in range(at, at + len(us))])
            at += len(us)

    def encode(self, text: str | None) -> bytes:
        if len(self.memo) > self.MOST:
            self.memo = {}
        out, parts = [], runs(text, self.cut.pattern)
        for i in range(0, len(parts), 1 << 16):
            part = parts[i:i + (1 << 16)]
            new = [u for u in set(part) if u not in self.memo]
            if new:
                self.learn(new)
            out.append(b"".join(map(self.memo.__getitem__, part)))
        return b"".join(out)


COLUMNS = {"ids": "array<int>", "n_tokens": "long", "ids_crc32": "long", "decoded_crc32": "long"}


def spellings(path: str) -> list[bytes]:
    """Text of every id: a byte piece's byte, U+2581 as a blank, nothing for a control piece."""
    m = model(path)
    return [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else
            b"" if m.is_control(i) else m.id_to_piece(i).replace(SPACE, " ").encode() for i in range(m.get_piece_size())]


def spell(ids: list[int], raw: list[bytes]) -> str:
    text = b"".join(map(raw.__getitem__, ids))
    return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


def _rows(docs: Iterator[tuple], encode_one, columns: tuple[str, ...], raw: list[bytes]) -> Iterator[pa.RecordBatch]:
    """(id, columns) batches of a bounded number of ids; ``encode_one`` gives a text's ids as an array."""
    out, held = {c: [] for c in ("id", *columns)}, 0

    def close():
        arrays = [pa.array(out["id"], pa.int64())]
        for c in columns:
            if c == "ids":
                ends = np.concatenate(([0], np.cumsum([len(x) for x in out[c]]))).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out[c]))))
            else:
                arrays.append(pa.array(out[c], pa.int64()))
        return pa.RecordBatch.from_arrays(arrays, names=["id", *columns])
    for i, t in docs:
        ids = encode_one(t).astype("<i4")
        out["id"].append(i)
        for c in columns:
            out[c].append(ids if c == "ids" else len(ids) if c == "n_tokens" else zlib.crc32(ids.tobytes()) if c == "ids_crc32"
                          else zlib.crc32(spell(ids.tolist(), raw).encode()))
        held += 4 * len(ids) + 64
        if held > 1 << 22:
            yield close()
            out, held = {c: [] for c in out}, 0
    if out["id"]:
        yield close()


def _coded(words: DataFrame, chars: int, most: int, long_chars: int, path: str) -> Stored:
    """(h, unit, ids) of all units of ``words``, which have so many characters in all and at most."""
    spark, n = words.sparkSession, F.char_length("unit")
    short = words if most <= long_chars else words.where(n <= long_chars)
    parts = short.repartition(int(chars // PART_CHARS) + 1, "h")  # a task's lattice fits in its memory
    coded = encode_units(parts, spark, path).select("h", "unit", "ids")
    if most > long_chars:
        coded = coded.unionByName(encode_long_units(words.where(n > long_chars), spark, path))
    with _gathered_in_memory(spark):
        return Stored(coded, "coded-units")


def _pack_texts(texts: pa.Array) -> bytes:
    """Texts (without nulls) as one compressed run of bytes behind their packed lengths."""
    raw = texts.cast(pa.binary())
    lens = _pack(pc.binary_length(raw).to_numpy(zero_copy_only=False))
    data = b"".join(raw.to_pylist())
    return b"".join((len(lens).to_bytes(5, "little"), lens, len(data).to_bytes(5, "little"), CODEC.compress(data, asbytes=True) if data else b""))


def _unpack_texts(packed_: bytes) -> pa.Array:
    at = 5 + int.from_bytes(packed_[:5], "little")
    lens, size = _unpack(packed_[5:at]), int.from_bytes(packed_[at:at + 5], "little")
    offsets = np.concatenate(([0], np.cumsum(lens))).astype("<i4")
    data = CODEC.decompress(packed_[at + 5:], size) if size else pa.py_buffer(b"")
    return pa.StringArray.from_buffers(len(lens), pa.py_buffer(offsets), data)


def _by_hash(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, the texts' order by hash and text): the order of units everywhere."""
    h = np.array([xxhash.xxh64_intdigest(u.encode(), 42) for u in texts], np.uint64)
    order = np.argsort(h, kind="stable")
    if (h[order][1:] == h[order][:-1]).any():
        order = np.array(sorted(range(len(texts)), key=lambda i: (h[i], texts[i])), np.int64)
    return h, order


def _lists_at(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The lists ``flat[starts[i]:starts[i] + lens[i]]`` of the indices, one behind the other."""
    out = [flat[:0]]
    for k in range(0, len(index), 1 << 20):
        i = index[k:k + (1 << 20)]
        n = lens[i]
        ends = np.cumsum(n)
        out.append(flat[np.arange(ends[-1]) + np.repeat(starts[i] - (ends - n), n)])
    return out[1] if len(out) == 2 else np.concatenate(out)


def _blocks(own: DataFrame, pattern: str, block_chars: int) -> DataFrame:
    """Rows BODY and UNITS, two for a block of rows (id, t). ``tokens`` number a text's runs by falling frequency, ``parts``
    is how many units each run has, ``places`` where these are among the block's units."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, block = re.compile(pattern), TaskContext.get().partitionId() << 32
        ids, tokens, numbers = [], [], defaultdict(count().__next__)
        held = 0

        def flush():
            names, flat, parts = defaultdict(count().__next__), [], []  # no cycle: gone at once
            for r in numbers:
                us = unit.findall(SPACE + r)
                parts.append(len(us))
                flat.extend(map(names.__getitem__, us))
            us = list(names)
            _, order = _by_hash(us)
            place = np.empty(len(us), np.int64)
            place[order] = np.arange(len(us))
            text = np.concatenate([np.zeros(0, np.int32), *tokens])
            often = np.argsort(-np.bincount(text, minlength=len(parts)), kind="stable")
            number = np.empty(len(parts), np.int64)
            number[often] = np.arange(len(parts))
            parts = np.array(parts, np.int64)
            each = _lists_at(place[np.array(flat, np.int64)], np.cumsum(parts) - parts, parts, often)
            out = pa.RecordBatch.from_pylist([
                {"kind": "body", "block": block, "ids": ids, "lens": _pack(np.array([len(x) for x in tokens])),
                 "tokens": _pack(number[text]), "parts": _pack(parts[often]), "places": _pack(each)},
                {"kind": "units", "block": block, "units": _pack_texts(pa.array(us, pa.string()).take(pa.array(order))),
                 "n_units": len(us), "n_chars": sum(map(len, us))}], schema)
            for x in (ids, tokens, numbers):
                x.clear()
            numbers.default_factory = count().__next__
            return out
        for batch in batches:
            for i, t in zip(batch.column("id"), batch.column("t")):
                rs = runs(t.as_py(), pattern)
                ids.append(i.as_py())
                tokens.append(np.fromiter(map(numbers.__getitem__, rs), np.int32, len(rs)))
                held += sum(map(len, rs)) + len(rs)
                if held >= block_chars or len(numbers) >= BLOCK_RUNS or len(ids) >= 1 << 16:
                    yield flush()
                    block, held = block + 1, 0
        if ids:
            yield flush()
    schema = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), *[(c, pa.binary()) for c in (
        "lens", "tokens", "parts", "places", "units")], ("n_units", pa.int64()), ("n_chars", pa.int64())])
    return own.mapInArrow(cut, f"kind string, block long, {BODY}, {UNITS}")


def _keep_blocks(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame, str]:
    """The blocks' bodies and units, stored, and the folder of the units. The bodies lie in n buckets of their blocks, so
    that a grouping by block need not move them. Only a table can have buckets; its entry in the catalog goes at once
    and the files stay. Without the right to make one, they are stored without buckets."""
    spark = rows.sparkSession
    path, table = scratch_path(spark, "blocks"), f"jobsmith_{uuid.uuid4().hex}"
    body, units = f"{path}/kind=body", f"{path}/kind=units"
    try:
        rows.write.partitionBy("kind").bucketBy(n, "block").option("path", path).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE TABLE {table} (block long, {BODY}) USING parquet CLUSTERED BY (block) INTO {n} BUCKETS LOCATION :at", {"at": body})
        bodies = spark.table(table)
        spark.sql(f"DROP TABLE {table}")
    except AnalysisException:
        path = scratch_path(spark, "blocks")
        body, units = f"{path}/kind=body", f"{path}/kind=units"
        rows.write.partitionBy("kind").parquet(path)
        _folder(spark, body)
        bodies = spark.read.schema(f"block long, {BODY}").parquet(body)
    _folder(spark, units)  # an empty table has none
    return bodies, spark.read.schema(f"block long, {UNITS}").parquet(units), units


def _folder(spark: SparkSession, path: str, keep: bool = True) -> None:
    """Makes or deletes a folder of the shared store."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p) if keep else fs.delete(p, True)


def _bucket_units(units: DataFrame, n: int) -> DataFrame:
    """(bucket, block, places) for every block, and for each bucket without a block its different units, sorted by hash
    and text (``units``; how many, their characters, the most of one), which the places number."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            us = _unpack_texts(row["units"])
            h, _ = _by_hash(us.to_pylist())
            cuts = _slices(h, 64, n)
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _, _ in cuts], pa.int32()), pa.array([row["block"]] * len(cuts), pa.int64()),
                pa.array([_pack_texts(us.slice(a, b - a)) for _, a, b in cuts], pa.binary())], names=["bucket", "block", "units"])

    def merge(t: pa.Table) -> pa.Table:
        sent = [_unpack_texts(x) for x in t["units"].to_pylist()]
        every = pa.concat_arrays(sent)
        us = every.unique()
        us = us.take(pa.array(_by_hash(us.to_pylist())[1]))
        places = pc.index_in(every, value_set=us).to_numpy().astype(np.int64)
        ends = np.cumsum([len(x) for x in sent])
        chars = pc.utf8_length(us)
        own = {"block": None, "places": None, "units": _pack_texts(us), "n": len(us), "chars": pc.sum(chars).as_py(), "most": pc.max(chars).as_py()}
        bucket = t["bucket"][0].as_py()
        return pa.Table.from_pylist([{"bucket": bucket} | r for r in [own, *(
            {"block": b, "places": _pack(p, True)} for b, p in zip(t["block"].to_pylist(), np.split(places, ends[:-1])))]], kind)
    kind = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("places", pa.binary()), ("units", pa.binary()),
                      ("n", pa.int64()), ("chars", pa.int64()), ("most", pa.int64())])
    return units.select("block", "units").mapInArrow(send, "bucket int, block long, units binary") \
        .groupBy("bucket").applyInArrow(merge, "bucket int, block long, places binary, units binary, n long, chars long, most long")


def _unit_rows(merged: DataFrame) -> DataFrame:
    """(h, unit) of the buckets' units; h is the unit's own number: bucket and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            us = _unpack_texts(row["units"])
            for k in range(0, len(us), 10_000):
                part = us.slice(k, 10_000)
                yield pa.RecordBatch.from_arrays([pa.array((row["bucket"] << 32) + np.arange(k, k + len(part), dtype=np.int64)), part], names=["h", "unit"])
    return merged.where("block IS NULL").select("bucket", "units").mapInArrow(run, "h long, unit string")


def _answers(merged: DataFrame, coded: DataFrame, kind: str) -> DataFrame:
    """(block, bucket, lens, ids): the ids of a block's units in every bucket."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("lens", pa.binary()), ("ids", pa.binary())])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["place"].to_numpy())
        assert (right["place"].to_numpy()[order] == np.arange(len(order))).all(), "a unit without ids"
        lists = right["ids"].combine_chunks()
        flat, offsets = lists.values.to_numpy().astype(kind), np.array(lists.offsets, np.int64)
        starts, lens = offsets[:-1][order], np.diff(offsets)[order]
        out = []
        for r in left.to_pylist():
            at = _unpack(r["places"], True).astype(np.int64)
            out.append({"block": r["block"], "bucket": r["bucket"], "lens": _pack(lens[at]), "ids": _pack(_lists_at(flat, starts, lens, at))})
        return pa.Table.from_pylist(out, schema)
    numbered = coded.select(F.shiftright("h", 32).cast("int").alias("bucket"), F.expr("cast(h & 4294967295L as int)").alias("place"), "ids")
    return merged.where("block IS NOT NULL").select("bucket", "block", "places").groupBy("bucket").cogroup(numbered.groupBy("bucket")) \
        .applyInArrow(answer, "block long, bucket int, lens binary, ids binary")


def _encode_blocks(own: DataFrame, chars: int, path: str, pattern: str, columns: tuple[str, ...], long_chars: int, schema: str) -> DataFrame:
    """``encode`` for any number of units: blocks of documents ask the units' buckets for the ids they need."""
    spark, kind, raw = own.sparkSession, id_kind(path), spellings(path)
    blocks, units, folder = _keep_blocks(_blocks(own, pattern, BLOCK_CHARS), min(max(chars // BLOCK_CHARS, width(spark)), 100_000))
    sent, long = units.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_units", "n_chars")]).first()
    buckets = max(-(-sent // BUCKET_UNITS), -(-long // BUCKET_CHARS), min(width(spark), sent >> 16), 1)
    merged = Stored(_bucket_units(units, buckets), "bucket-units").df
    _folder(spark, folder, keep=False)
    total, most = merged.agg(F.coalesce(F.sum("chars"), F.lit(0)), F.coalesce(F.max("most"), F.lit(0))).first()
    coded = _coded(_unit_rows(merged), total, most, long_chars, path).df
    result = pa.schema([("id", pa.int64()), *[(c, pa.list_(pa.int32()) if c == "ids" else pa.int64()) for c in columns]])

    def write(left: pa.Table, right: pa.Table) -> pa.Table:
        back = sorted(right.to_pylist(), key=lambda r: r["bucket"])  # buckets are ranges of hashes
        lens = np.concatenate([np.zeros(0, np.int64), *[_unpack(r["lens"]).astype(np.int64) for r in back]])
        flat = np.concatenate([np.zeros(0, kind), *[_unpack(r["ids"]).astype(kind) for r in back]])
        out = []
        for row in left.to_pylist():
            places, parts = (_unpack(row[c]).astype(np.int64) for c in ("places", "parts"))
            bounds = np.concatenate(([0], np.cumsum(parts)))
            ends = np.concatenate(([0], np.cumsum(lens[places])))[bounds]
            run_ids, starts, n = _lists_at(flat, np.cumsum(lens) - lens, lens, places), ends[:-1], np.diff(ends)
            tokens = _unpack(row["tokens"]).astype(np.int64)
            texts = np.split(tokens, np.cumsum(_unpack(row["lens"]).astype(np.int64))[:-1])
            out += _rows(zip(row["ids"], texts), lambda t: _lists_at(run_ids, starts, n, t), columns, raw)
        return pa.Table.from_batches(out, result)
    return blocks.groupBy("block").cogroup(_answers(merged, coded, kind).groupBy("block")) \
        .applyInArrow(write, schema)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           send_units: int = SEND_UNITS, columns: tuple[str, ...] = ("ids",), long_chars: int = LONG_CHARS) -> DataFrame:
    """One row per document: its id and ``columns`` of ``ids`` (array of int), ``n_tokens``, ``ids_crc32`` (ids as
    little-endian uint32) and ``decoded_crc32`` (of the text decoded from them again), all made in one pass."""
    spark = docs.sparkSession
    pattern = unit_pattern(pieces(path))
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    schema = ", ".join(["id long", *[f"{c} {COLUMNS[c]}" for c in columns]])
    chars = own.agg(F.coalesce(F.sum(F.char_length("t").cast("long")), F.lit(0))).first()[0]
    sent = _sent_units(own, path, pattern, send_units, long_chars) if send_units and chars <= SENT_CHARS else None
    if sent is None:
        return _encode_blocks(own, chars, path, pattern, columns, long_chars, schema).withColumnRenamed("id", id_col)
    kind, raw = id_kind(path), spellings(path)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Held(*sent.value, kind, pattern)
        yield from _rows(((i.as_py(), t.as_py()) for b in batches for i, t in zip(b.column("id"), b.column("t"))),
                         lambda t: np.frombuffer(known.encode(t), kind), columns, raw)
    return own.mapInArrow(look_up, schema).withColumnRenamed("id", id_col)


def _sent_units(own: DataFrame, path: str, pattern: str, send_units: int, long_chars: int):
    """The packed unit table, sent to the tasks: some 20 bytes a unit. None if it is too large."""
    words = Stored(distinct_units(own, "t", pattern), "units")
    n = F.char_length("unit")
    number, chars, most = words.df.agg(F.count("*"), F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.max(n), F.lit(0))).first()
    if number > send_units:
        words.drop()
        return None
    table = _coded(words.df, chars, most, long_chars, path)
    words.drop()
    runs = sorted(packed(table.df, id_kind(path)).collect(), key=lambda r: r["low"])
    table.drop()
    if sum(r["same"] for r in runs):  # two units of one hash
        return None
    return own.sparkSession.sparkContext.broadcast([b"".join(r[c] for r in runs) for c in ("hashes", "lens", "ids")])


def decode(ids: str | Column, path: str) -> Column:
    """Text of an id array: pieces joined, byte pieces as bytes, U+2581 as blanks, the first one off."""
    raw = spellings(path)

    @F.arrow_udf("string")
    def run(col: pa.Array) -> pa.Array:
        return pa.array([spell(np.array(x.values).tolist(), raw) if x.is_valid else "" for x in col], pa.string())
    return run(ids)


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_tokens, ids_crc32 and the decoded text's crc32."""
    return encode(docs, path, id_col, text_col, columns=("n_tokens", "ids_crc32", "decoded_crc32"))

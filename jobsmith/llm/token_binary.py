"""Token ids as Simple-8b words: encode documents, write ordered shards, read them back.

Coding. Every 64-bit word starts with a 4-bit selector; selector s > 0 packs
``COUNTS[s]`` ids of ``WIDTHS[s]`` bits into the low 60 bits (first id lowest).
Selector 0 is the escape: the word after it is one raw 64-bit id (60 bits and
more). Each document's ids start on a word of their own.

File format. A folder of Parquet part files; one row is one block of whole
documents: ``shard``, ``block``, ``first_id`` (ids of the shard before the
block), ``n_ids``, ``doc_ids``, ``doc_lens`` (ids per document), ``offsets``
(ids before every ``STRIDE``-th word: decoding may start at any of them) and
``words`` (little-endian). Sorted by (shard, block), documents ascend by id.

Spark's own writer commits the files, so a lost executor's tasks are simply run
again. Null texts count as empty (just the end id). Rows that repeat an id are
kept side by side, in order of their texts; rows with a null id come first. An
empty table writes no blocks and reads back no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import LOWER_BYTES, width

COUNTS = (1, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
WIDTHS = (64, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
STRIDE = 4096
BLOCK_IDS = 1 << 18
TOKEN_ID = attrgetter("id")
READ = ["shard", "id", "start", "ids"]

BLOCK_SCHEMA = ("shard int, block int, first_id long, n_ids long, doc_ids array<long>, doc_lens array<long>, "
                "offsets array<long>, words binary")


def encode(ids: np.ndarray) -> np.ndarray:
    """uint64 ids -> Simple-8b words, each as full as its ids allow."""
    return encode_many([ids])[0]


def encode_many(lists: list[np.ndarray]) -> list[np.ndarray]:
    """Words of every id list, all lists coded in one go (no word spans two lists)."""
    lens = np.array([len(x) for x in lists], np.int64)
    ids = np.concatenate([np.asarray(x, np.uint64) for x in lists]) if len(lists) else np.zeros(0, np.uint64)
    n = len(ids)
    if not n:
        return [np.zeros(0, np.uint64) for _ in lists]
    ends = np.cumsum(lens)
    left = np.minimum(np.repeat(ends, lens) - np.arange(n), 255).astype(np.uint8)  # ids to the list's end
    bits = np.ones(n, np.uint8)  # narrowest width that holds the id
    for narrow, wide in zip(WIDTHS[:0:-1], (*WIDTHS[-2:0:-1], 64)):
        big = ids >= np.uint64(1 << narrow)
        if not big.any():
            break
        bits[big] = wide
    best = (bits <= 60).astype(np.uint8)  # selector of the fullest word that starts at each id
    widest, have = bits, 1  # widest of the ``have`` ids from each place on
    for s in range(2, len(COUNTS)):
        k = COUNTS[s]
        if k > n:
            break
        while have < k:
            step = min(have, k - have)
            widest, have = np.maximum(widest[:n - have - step + 1], widest[step:n - have + 1]), have + step
        fits = (widest <= WIDTHS[s]) & (left[:n - k + 1] >= k)
        if not fits.any():
            break
        best[:n - k + 1][fits] = s
    jumps, at, i = bytes(np.array(COUNTS, np.uint8)[best]), [], 0
    add = at.append
    while i < n:
        add(i)
        i += jumps[i]
    starts = np.array(at, np.int64)
    chosen = best[starts]
    place = np.cumsum(1 + (chosen == 0)) - 1 - (chosen == 0)  # an escape takes two words
    out = np.zeros(place[-1] + 1 + (chosen[-1] == 0), np.uint64)
    for s in np.unique(chosen).tolist():
        mine, to = starts[chosen == s], place[chosen == s]
        if s == 0:
            out[to + 1] = ids[mine]
            continue
        word = np.full(len(mine), s << 60, np.uint64)
        for j in range(COUNTS[s]):
            word |= ids[mine + j] << np.uint64(j * WIDTHS[s])
        out[to] = word
    firsts = np.append(place, len(out))[np.searchsorted(starts, ends - lens)]  # word of each list's first id
    return [out[a:b] for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(out)])]


def decode(words: np.ndarray) -> np.ndarray:
    """Simple-8b words -> uint64 ids, all words of one selector at a time."""
    words = np.ascontiguousarray(words, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)  # words that are raw ids, not codes
    for i in np.flatnonzero(sel == 0).tolist():
        if not raw[i]:
            raw[i + 1] = True
    counts = np.where(raw, 0, np.array(COUNTS + (0,))[sel])
    at = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(at[-1], np.uint64)
    codes = np.where(raw, 15, sel)
    for s in np.unique(codes):
        i = np.flatnonzero(codes == s)
        if s == 0:
            out[at[i]] = words[i + 1]
        elif s < 15:
            mask = np.uint64((1 << WIDTHS[s]) - 1)
            for j in range(COUNTS[s]):
                out[at[i] + j] = (words[i] >> np.uint64(j * WIDTHS[s])) & mask
    return out


def word_offsets(words: np.ndarray, stride: int = STRIDE) -> np.ndarray:
    """Ids before every ``stride``-th word (a raw word after an escape counts as none)."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS + (0,))[sel]
    for i in np.flatnonzero(sel == 0).tolist():
        if counts[i]:
            counts[i + 1] = 0
    return np.concatenate(([0], np.cumsum(counts)))[:-1][::stride]


def decode_span(words: np.ndarray, offsets, first: int, n: int, stride: int = STRIDE) -> np.ndarray:
    """Ids ``first`` to ``first + n`` of the words, decoded from the last offset before them to the first one after.

    An offset's word may be the raw one of an escape, whose id is counted before it. The word before tells:
    raw words are ids of over 60 bits, so selector 0 is always an escape."""
    escape = lambda i: 0 < i < len(words) and int(words[i - 1]) >> 60 == 0
    a, b = np.searchsorted(offsets, first, "right") - 1, np.searchsorted(offsets, first + n, "left")
    low, high = int(a) * stride, min(int(b) * stride, len(words)) if b < len(offsets) else len(words)
    skip = first - offsets[a]
    return decode(words[low + escape(low):high + escape(high)])[skip:skip + n]


class Encoder:
    """The tokenizers library behind a bounded memo of blank-separated words.

    A pre-token of this tokenizer never spans a blank, so a text's ids are its
    words' ids joined; trailing ASCII punctuation but the apostrophe is split off
    where the library itself starts a pre-token there (after a letter or digit; a
    symbol, mark or apostrophe before it is one pre-token with it). Words of Latin-1
    letters are one pre-token and go straight to the library's BPE model, all others
    through its whole encoder.
    The memo keeps two generations of words, so its size is bounded.
    """

    MOST = 200_000
    LATIN = re.compile("[a-zß-öø-ÿÀ-ÖØ-Þ]+")  # composed letters that lower-case to one letter each
    PUNCTUATION = b".,;:!?\"#$%&()*+-/<=>@[\\]^_`{|}~"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: these bytes stand for themselves
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}
        spec = json.loads(self.whole.to_str())
        pre = spec["pre_tokenizer"]
        self.by_word = spec["normalizer"]["type"] == "Sequence" and pre["type"] == "Sequence" and \
            pre["pretokenizers"][0]["type"] == "Split" and "[\\p{L}]+" in pre["pretokenizers"][0]["pattern"]["Regex"]
        self.parted = frozenset(b for b in b"abcdefghijklmnopqrstuvwxyz0123456789" if self.by_word and self.parts(chr(b)))

    def text(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if not self.by_word:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        raw = text.encode("utf-8", "surrogatepass")
        if b"<|" in raw:  # may spell a special token, which may span anything
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        ws = raw.translate(LOWER_BYTES).split()
        out: list[bytes] = []
        for i in range(0, len(ws), 1 << 16):  # a bounded number of words at a time, however long the text
            part = ws[i:i + (1 << 16)]
            if len(self.new) > self.MOST:
                self.old, self.new = self.new, {}
            new = self.new
            missing = {w for w in part if w not in new}
            self.letters_only([w for w in missing if w.isalpha() and w not in self.old])
            for w in missing:
                if w not in new:
                    self.learn(w)
            out.append(b"".join(map(new.__getitem__, part)))
        return np.frombuffer(b"".join(out), np.uint32)

    def letters_only(self, words: list[bytes]) -> None:
        """Learn words of ASCII letters (lower case), one pre-token each, in one go."""
        found = list(map(self.whole.model.tokenize, map(bytes.decode, words)))
        ids, at = array("I", map(TOKEN_ID, chain.from_iterable(found))).tobytes(), 0
        for word, tokens in zip(words, found):
            end = at + 4 * len(tokens)
            self.new[word], at = ids[at:end], end

    def learn(self, word: bytes) -> bytes:
        """The word's ids, from the memo or encoded now."""
        ids = self.new.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is None:
                stem = word.rstrip(self.PUNCTUATION)
                if len(stem) == len(word) or stem and stem[-1] not in self.parted and \
                        not self.parts(stem.decode("utf-8", "replace")[-1]):
                    ids = self.letters(word.decode("utf-8", "surrogatepass"))
                else:
                    ids = (self.learn(stem) if stem else b"") + self.library(word[len(stem):])
            self.new[word] = ids
        return ids

    def letters(self, word: str) -> bytes:
        if self.LATIN.fullmatch(word):
            shown = word if word.isascii() else word.lower().encode().decode("latin-1").translate(self.alphabet)
            return array("I", [t.id for t in self.whole.model.tokenize(shown)]).tobytes()
        return self.library(word.encode("utf-8", "replace"))

    @lru_cache(maxsize=10_000)  # noqa: B019 - one encoder a worker; last characters repeat
    def parts(self, char: str) -> bool:
        """Punctuation after the character is a pre-token of its own, also when it is normalised to several."""
        shown = self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(char + "."))
        return len(shown) > 1 and shown[-1][0] == "."

    @lru_cache(maxsize=10_000)  # noqa: B019 - one encoder a worker; punctuation repeats
    def library(self, text: bytes) -> bytes:
        return array("I", self.whole.encode(text.decode(), add_special_tokens=False).ids).tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def coded_ids(text: str | Column, tokenizer_path: str, end_id: int | None = 1) -> Column:
    """Struct column: ``n`` ids and their Simple-8b ``words`` for every text."""
    kind = pa.struct([("n", pa.int64()), ("words", pa.binary())])

    @F.arrow_udf("struct<n:long,words:binary>")
    def run(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc, tail = encoder(tokenizer_path), np.array([] if end_id is None else [end_id], np.uint32)
        for col in cols:
            out, part, n = [], [], 0
            for i, t in enumerate(col, 1):
                part.append(np.concatenate((enc.text(t.as_py()), tail)))
                n += len(part[-1])
                if i == len(col) or n > 1 << 18:
                    out += [{"n": len(x), "words": w.tobytes()} for x, w in zip(part, encode_many(part))]
                    part, n = [], 0
            yield pa.array(out, kind)
    return run(text)


def _blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (shard, id, n, words) rows of one task -> blocks of whole documents."""
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("doc_lens", pa.list_(pa.int64())),
                        ("offsets", pa.list_(pa.int64())), ("words", pa.binary())])
    shard, block, first, docs, lens, words, n = None, 0, 0, [], [], [], 0

    def close():
        nonlocal block, first, docs, lens, words, n
        raw = b"".join(words)
        batch = pa.RecordBatch.from_pylist([{
            "shard": shard, "block": block, "first_id": first, "n_ids": n, "doc_ids": docs, "doc_lens": lens,
            "offsets": word_offsets(np.frombuffer(raw, "<u8")).tolist(), "words": raw}], schema)
        block, first, docs, lens, words, n = block + 1, first + n, [], [], [], 0
        return batch
    for batch in rows:
        for s, d, k, w in zip(*(batch.column(c) for c in ("shard", "id", "n", "words"))):
            s, k = s.as_py(), k.as_py()
            if docs and (s != shard or n + k > BLOCK_IDS):
                yield close()
            if s != shard:
                shard, block, first = s, 0, 0
            docs.append(d.as_py())
            lens.append(k)
            words.append(w.as_buffer().to_pybytes())
            n += k
    if docs:
        yield close()


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int | None = 1, shards: int | None = None) -> None:
    """Encode whole texts and write them in ascending id order as ``shards`` shards.

    Shard borders are quantiles of the ids alone (a scan of one column), so the
    texts are read and encoded once and only their coded words are shuffled.
    """
    spark = docs.sparkSession
    shards = shards or width(spark)
    cuts = docs.agg(F.percentile_approx(id_col, [i / shards for i in range(1, shards)], 10_000)).first()[0] if shards > 1 else []
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<long>")
    coded = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"),
                        coded_ids(F.col(text_col), tokenizer_path, end_id).alias("c"))
    rows = coded.select(F.coalesce(F.size(F.filter(cuts, lambda c: c < F.col("id"))), F.lit(0)).alias("shard"), "id", "tie",
                        F.col("c.n").alias("n"), F.col("c.words").alias("words"))
    rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "id", "tie", "words").drop("tie") \
        .mapInArrow(_blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(path)


def _documents(b: dict, which: list[int] | None = None) -> tuple[list, list, list, list[np.ndarray]]:
    """Shards, ids, starts in the shard and token ids of a block's documents: all of them from one decoding, or
    those at the places ``which``, each decoded from the offset next before it."""
    words, lens = np.frombuffer(b["words"], "<u8"), np.array(b["doc_lens"], np.int64)
    starts = np.cumsum(lens) - lens
    if which is None:
        which, whole = range(len(lens)), decode(words).astype("<u4")
        ids = [whole[s:s + n] for s, n in zip(starts.tolist(), lens.tolist())]
    else:
        ids = [decode_span(words, b["offsets"], starts[i], lens[i]).astype("<u4") for i in which]
    return [b["shard"]] * len(ids), [b["doc_ids"][i] for i in which], [b["first_id"] + int(starts[i]) for i in which], ids


def read_tokens(spark, path: str) -> DataFrame:
    """(shard, id, start in shard, ids as uint32 bytes) of every document in the files."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                shard, doc, start, ids = _documents(b)
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
                                                  pa.array([x.tobytes() for x in ids], pa.binary())], names=READ)
    return spark.read.schema(BLOCK_SCHEMA).parquet(path).mapInArrow(rows, "shard int, id long, start long, ids binary")


def read_chosen(spark, path: str, chosen: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``read_tokens`` of the documents whose ids ``chosen`` holds: of a block with such documents only the words from
    the offset before each are decoded. Repeated ids in the files all come back; ids not there and null ids do not."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                shard, doc, start, ids = _documents(b, sorted(b["places"]))
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
                                                  pa.array([x.tobytes() for x in ids], pa.binary())], names=READ)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    places = blocks.select("shard", "block", F.posexplode("doc_ids").alias("place", "id")) \
        .join(chosen.select(F.col(id_col).cast("long").alias("id")), "id", "left_semi") \
        .groupBy("shard", "block").agg(F.collect_list("place").alias("places"))  # a block's documents: BLOCK_IDS at most
    return blocks.join(places, ["shard", "block"]).mapInArrow(rows, "shard int, id long, start long, ids binary")


def shard_starts(spark, path: str) -> DataFrame:
    """Ids in all shards before each (one row a shard: some thousands at most are ordered)."""
    sizes = spark.read.schema(BLOCK_SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    from pyspark.sql import Window as W
    return sizes.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("before"))


def token_digest(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the token files, read them back: one row per document with ``start``
    (ids of all documents before it), ``n_tokens`` and ``ids_crc32``."""
    from jobsmith.session import scratch_path
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_tokens(docs, path, tokenizer_path, id_col, text_col, end_id)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                shard, doc, start, ids = _documents(b)
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard, pa.int32()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                    names=["shard", "id", "start", "n_tokens", "ids_crc32"])
    back = spark.read.schema(BLOCK_SCHEMA).parquet(path) \
        .mapInArrow(rows, "shard int, id long, start long, n_tokens long, ids_crc32 long")
    return back.join(F.broadcast(shard_starts(spark, path)), "shard").select(
        F.col("id").alias(id_col), (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")

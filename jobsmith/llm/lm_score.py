"""Cross-entropy difference scores from matched n-gram models.

Two interpolated bigram models, of a target and of a background corpus, share one
vocabulary, order, smoothing and the same set of bigrams. A document's score is
the mean over its words of  log p_target - log p_background  (its background loss
less its target loss per word): the higher, the more it reads like the target.

Counts come from every document of both corpora. The shared vocabulary holds the
words that at least ``min_docs`` documents of either corpus have, all others are
one unknown word; bigrams are cut off by the same number (one with an unknown word
counts a document once for each different pair of words behind it). The cut-off is
the same however large the corpora are, so the model grows with them: it stays in
Spark tables. Documents are kept in blocks; a block's different words and bigrams
go to buckets, where all blocks' counts are added up, and the sums come back to the
blocks that have them. Words are told apart by 64-bit hashes there, bigrams by
exact numbers. A text is held whole by its task. ``min_share`` (0: none) asks for a
share of the documents on top. ``train`` gathers the same model on the driver, for
small corpora.

    p(w | v) = L c(vw) / c(v)  +  (1 - L K(v)) p(w),    K(v): kept bigrams' share of c(v)
    p(w)     = (c(w) + 1) / (N + V)

A text starts from a start symbol. Null and empty texts have no words and score
0; an empty corpus has uniform counts; repeated rows count and score as often as
they come; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import Stored, union_all, width, words

LAMBDA = 0.6


@dataclass
class Models:
    """Both models over one vocabulary; ids: 0 unknown, 1.. words, start symbol last."""
    vocabulary: dict[bytes, int]
    keys: np.ndarray        # sorted bigram keys v * size + w
    seen: np.ndarray        # (2, bigrams): log p of kept bigrams, target and background
    back: np.ndarray        # (2, size): log(1 - L K(v))
    single: np.ndarray      # (2, size): log p(w)

    @property
    def size(self) -> int:
        return len(self.vocabulary) + 2

    def ids(self, text: str | None) -> np.ndarray:
        ws = words(text)
        return np.fromiter(map(self.vocabulary.get, ws, repeat(0)), np.int64, len(ws))

    def losses(self, text: str | None) -> tuple[int, float, float]:
        """(words, target loss, background loss), summed over the words."""
        w = self.ids(text)
        if not len(w):
            return 0, 0.0, 0.0
        v = np.concatenate(([self.size - 1], w[:-1]))
        logp = self.back[:, v] + self.single[:, w]
        if len(self.keys):
            key = v * self.size + w
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            logp[:, hit] = self.seen[:, at[hit]]
        t, b = -logp.sum(axis=1)
        return len(w), float(t), float(b)


def _word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, docs, n) of a corpus; every task adds up its own texts first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[bytes, int] = {}
        df: dict[bytes, int] = {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in n], pa.string()),
                                              pa.array([df[w] for w in n], pa.int64()),
                                              pa.array(n.values(), pa.int64())], names=["word", "docs", "n"])
            n.clear()
            df.clear()
            return out
        for batch in batches:
            for t in batch.column("t"):
                ws = words(t.as_py())
                for w in ws:
                    n[w] = n.get(w, 0) + 1
                for w in set(ws):
                    df[w] = df.get(w, 0) + 1
                if len(n) > 400_000:
                    yield flush()
        if n:
            yield flush()
    return docs.select(F.col(text_col).alias("t")).mapInArrow(count, "word string, docs long, n long") \
        .groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def _bigram_counts(docs: DataFrame, text_col: str, sent) -> DataFrame:
    """(key, docs, n) of a corpus' bigrams over the shared vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        size = len(vocabulary) + 2
        model = Models(vocabulary, *[None] * 4)
        keys: list[np.ndarray] = []
        first: list[np.ndarray] = []
        held = 0

        def flush():
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            df = np.zeros(len(key), np.int64)
            u, c = np.unique(np.concatenate(first), return_counts=True)
            df[np.searchsorted(key, u)] = c
            keys.clear()
            first.clear()
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(df), pa.array(n.astype(np.int64))],
                                              names=["key", "docs", "n"])
        for batch in batches:
            for t in batch.column("t"):
                w = model.ids(t.as_py())
                if len(w):
                    key = np.concatenate(([size - 1], w[:-1])) * size + w
                    keys.append(key)
                    ws = words(t.as_py())
                    once = dict(zip(zip([None, *ws], ws), key.tolist()))  # a document's different pairs of words
                    first.append(np.array(list(once.values()), np.int64))
                    held += len(key)
                    if held > 1 << 22:
                        yield flush()
                        held = 0
        if keys:
            yield flush()
    return docs.select(F.col(text_col).alias("t")).mapInArrow(count, "key long, docs long, n long") \
        .groupBy("key").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def train(target: DataFrame, background: DataFrame, text_col: str = "text", min_share: float = 0.0,
          min_docs: int = 2) -> Models:
    """Both models, from all texts of both corpora, on the driver: for small corpora."""
    spark = background.sparkSession
    corpora = (target, background)
    tables = [Stored(_word_counts(c, text_col), "lm-words") for c in corpora]
    sizes = [max(1, c.count()) for c in corpora]
    both = tables[0].df.select("word", F.col("docs").alias("dt"), F.col("n").alias("t")).join(
        tables[1].df.select("word", F.col("docs").alias("db"), F.col("n").alias("b")), "word", "full_outer").fillna(0)
    common = _common(both, sizes, min_share, min_docs)
    kept = common.orderBy("word").toArrow()
    vocabulary = {w.as_py().encode(): i + 1 for i, w in enumerate(kept["word"])}
    size = len(vocabulary) + 2
    totals = [t.df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for t in tables]
    for t in tables:
        t.drop()
    single = np.zeros((2, size))
    n_word = np.zeros((2, size))
    for c, name in enumerate(("t", "b")):
        n_word[c, 1:-1] = np.array(kept[name], np.float64)
        n_word[c, 0] = totals[c] - n_word[c].sum()
        single[c] = np.log((n_word[c] + 1) / (totals[c] + size))
    sent = spark.sparkContext.broadcast(vocabulary)
    pairs = [Stored(_bigram_counts(c, text_col, sent), "lm-bigrams") for c in corpora]
    both = pairs[0].df.select("key", F.col("docs").alias("dt"), F.col("n").alias("t")).join(
        pairs[1].df.select("key", F.col("docs").alias("db"), F.col("n").alias("b")), "key", "full_outer").fillna(0)
    kept = _common(both, sizes, min_share, min_docs).orderBy("key").toArrow()
    keys = np.array(kept["key"], np.int64)
    # c(v): words that follow v; from all bigrams of the corpus, kept or not
    after = [np.zeros(size) for _ in corpora]
    for c, p in enumerate(pairs):
        for r in p.df.groupBy(F.expr(f"key div {size}").alias("v")).agg(F.sum("n").alias("n")).toArrow().to_pylist():
            after[c][r["v"]] = r["n"]
        p.drop()
    seen, back = np.zeros((2, len(keys))), np.zeros((2, size))
    v, w = keys // size, keys % size
    for c, name in enumerate(("t", "b")):
        share = np.array(kept[name], np.float64) / np.maximum(after[c][v], 1)
        back[c] = np.log(1 - LAMBDA * np.minimum(1, np.bincount(v, share, size)))
        seen[c] = np.log(LAMBDA * share + np.exp(back[c][v] + single[c][w]))
    return Models(vocabulary, keys, seen, back, single)


def _common(both: DataFrame, sizes: list[int], min_share: float, min_docs: int) -> DataFrame:
    """What at least ``min_share`` (and ``min_docs``) of the documents of either corpus have."""
    least = [max(min_docs, min_share * n) for n in sizes]
    return both.where((F.col("dt") >= least[0]) | (F.col("db") >= least[1]))


def score(text: str | Column, models: Models, spark) -> Column:
    """Struct column: ``n_words`` and both losses per word; their difference is the score."""
    sent = spark.sparkContext.broadcast(models)

    @F.arrow_udf("struct<n_words:long,target:double,background:double>")
    def run(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        for col in cols:
            n, t, b = np.array([m.losses(x.as_py()) for x in col], np.float64).reshape(-1, 3).T
            yield pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), pa.array(t / np.maximum(n, 1)),
                                              pa.array(b / np.maximum(n, 1))], ["n_words", "target", "background"])
    return run(text)


TARGET, BACKGROUND, SCORED = 1, 2, 4   # roles of a document
BUCKET_KEYS = 1 << 21      # keys that meet in one group, at most some
MIX = 0x9E3779B97F4A7C15   # odd
CODEC = pa.Codec("zstd", 1)


def _pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers from 0 (of any shape) as compressed planes of bytes; of their differences, if they rise."""
    values = np.ascontiguousarray(values, np.uint64).reshape(-1)
    if rising:
        values = np.diff(values, prepend=np.uint64(0))
    wide = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes()
    return len(values).to_bytes(5, "little") + bytes([wide]) + (CODEC.compress(planes, asbytes=True) if planes else b"")


def _unpack(data: bytes, rising: bool = False) -> np.ndarray:
    n, wide = int.from_bytes(data[:5], "little"), data[5]
    out = np.zeros((n, 8), np.uint8)
    if n and wide:
        out[:, :wide] = np.frombuffer(CODEC.decompress(data[6:], n * wide), np.uint8).reshape(wide, n).T
    values = out.reshape(-1).view("<u8").astype(np.uint64)
    return np.cumsum(values, dtype=np.uint64) if rising else values


def _counts(data: list[bytes], rows: int) -> np.ndarray:
    """Packed tables of so many rows, side by side."""
    return np.concatenate([np.zeros((rows, 0), np.int64), *[_unpack(x).astype(np.int64).reshape(rows, -1) for x in data]], axis=1)


def _buckets(spark, keys: int) -> int:
    return max(min(width(spark), keys >> 16), -(-keys // BUCKET_KEYS), 1)


def _slices(keys: np.ndarray, bits: int, n: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys: n equal ranges of 2**bits."""
    cuts = np.searchsorted(keys, np.array([(i << bits) // n for i in range(n)], np.uint64)).tolist() + [len(keys)]
    return [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def _mix(keys: np.ndarray, bits: int, back: bool = False) -> np.ndarray:
    """The numbers below 2**bits in another, even order; and back."""
    half, mask = np.uint64((bits + 1) // 2), np.uint64((1 << bits) - 1)
    by = np.uint64(pow(MIX, -1, 1 << bits) if back else MIX & ((1 << bits) - 1))
    keys = keys ^ (keys >> half)
    keys = (keys * by) & mask
    return keys ^ (keys >> half)


def _blocks(rows: DataFrame, block_words: int) -> DataFrame:
    """(block, ids, roles, lens, tokens, places, hashes, and how many) from rows (id, t, role): runs of documents as numbers of the
    run's own words. Tokens number the words by falling frequency; places: where these are among the sorted hashes."""
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, roles, tokens, numbers = [], [], [], defaultdict()
        numbers.default_factory = numbers.__len__
        held = docs = 0

        def flush():
            hashes = np.array([xxhash.xxh64_intdigest(w.decode("utf-8", "replace").encode(), 42) for w in numbers], np.uint64)
            hashes, at = np.unique(hashes, return_inverse=True)
            text = at[np.concatenate([np.zeros(0, np.int64), *tokens])]
            places = np.argsort(-np.bincount(text, minlength=len(hashes)), kind="stable")
            number = np.empty(len(places), np.int64)
            number[places] = np.arange(len(places))
            each = pa.concat_arrays(ids)
            out = pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(each)], pa.int32()), each),
                *[pa.array([x], pa.binary()) for x in (
                    _pack(np.concatenate(roles)), _pack(np.array([len(x) for x in tokens])), _pack(number[text]), _pack(places),
                    _pack(hashes, True))], pa.array([len(hashes)]), pa.array([len(text)])],
                names=["block", "ids", "roles", "lens", "tokens", "places", "hashes", "n_hashes", "n_words"])
            for x in (ids, roles, tokens, numbers):
                x.clear()
            return out
        for batch in batches:
            begin, role = 0, batch.column("role").to_numpy()
            for i, t in enumerate(batch.column("t"), 1):
                ws = words(t.as_py())
                tokens.append(np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)))
                held += len(ws)
                docs += 1
                full = held >= block_words or docs >= 1 << 16
                if full or i == len(batch):
                    ids.append(batch.column("id").slice(begin, i - begin))
                    roles.append(role[begin:i])
                    begin = i
                if full:
                    yield flush()
                    block, held, docs = block + 1, 0, 0
        if ids:
            yield flush()
    return rows.mapInArrow(cut, f"block long, ids array<{id_type}>, roles binary, lens binary, tokens binary, places binary, "
                                "hashes binary, n_hashes long, n_words long")


class _Block:
    """A block's texts: every token's document and word (a place among the sorted hashes), and roles by document."""

    def __init__(self, row: dict):
        self.lens = _unpack(row["lens"]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.lens)), self.lens)
        places = _unpack(row["places"]).astype(np.int64)
        self.n = len(places)
        self.word = places[_unpack(row["tokens"]).astype(np.int64)]
        roles = _unpack(row["roles"]).astype(np.int64)
        if row.get("chosen"):
            roles[row["chosen"]] |= TARGET
        self.scored, self.roles = roles & SCORED > 0, [roles & x > 0 for x in (TARGET, BACKGROUND)]
        self.first, self.last = (np.ones(len(self.doc), bool) for _ in range(2))
        self.first[1:] = self.last[:-1] = self.doc[1:] != self.doc[:-1]

    def add_up(self, at: np.ndarray, doc: np.ndarray, size: int) -> list[np.ndarray]:
        """How often each of the numbers occurs, in the target and in the background."""
        return [np.bincount(at[role[doc]], minlength=size) for role in self.roles]

    def pairs(self, known: "_Known", size: int) -> None:
        """The bigrams over the known words: ``keys``, sorted as mixed, each token's (``at``) and one of its pairs of places."""
        v = np.where(self.first, self.n, np.concatenate(([self.n], self.word[:-1]))[:len(self.word)])
        raw, self.raw_at = np.unique(v * (self.n + 1) + self.word, return_inverse=True)
        v, w = raw // (self.n + 1), raw % (self.n + 1)
        self.n_raw = len(raw)
        keys = np.append(known.id, size - 1)[v].astype(np.uint64) * np.uint64(size) + known.id[w].astype(np.uint64)
        self.keys, one, self.raw_key = np.unique(_mix(keys, _bits(size)), return_index=True, return_inverse=True)
        self.v, self.w = v[one], w[one]
        self.at = self.raw_key[self.raw_at]


class _Known:
    """What the word buckets answered to a block: ids (0: unknown) and counts by place."""

    def __init__(self, rows: list[dict], offsets: np.ndarray):
        rows = sorted(rows, key=lambda r: r["bucket"])  # ranges of hashes
        ranks = [_unpack(r["keys"], True).astype(np.int64) + offsets[r["bucket"]] for r in rows]
        is_known, *self.n = _counts([r["counts"] for r in rows], 5)
        self.known = is_known > 0
        self.id = np.where(self.known, np.concatenate([np.zeros(0, np.int64), *ranks]), 0)


def _bits(size: int) -> int:
    return max(2, (size * size - 1).bit_length())


def _merged(t: pa.Table, rows: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """A bucket's different keys, where each block's keys are among them, and the sums of all blocks' counts."""
    keys = [_unpack(x, True) for x in t["keys"].to_pylist()]
    u, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.array([np.bincount(at, c, len(u)) for c in _counts(t["counts"].to_pylist(), rows)]).astype(np.int64)
    return u, np.split(at, np.cumsum([len(k) for k in keys])[:-1]), sums


RUN = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
ANSWER = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
                    ("stats", pa.list_(pa.int64()))])
RUN_ROWS, ANSWER_ROWS = "bucket int, block long, keys binary, counts binary", \
    "block long, bucket int, keys binary, counts binary, stats array<long>"


def _runs(block: int, keys: np.ndarray, counts: np.ndarray, bits: int, n: int) -> list[dict]:
    return [{"bucket": i, "block": block, "keys": _pack(keys[a:b], True), "counts": _pack(counts[:, a:b])}
            for i, a, b in _slices(keys, bits, n)]


def _word_answers(blocks: DataFrame, least: list[float], n: int) -> DataFrame:
    """Every block's words with rank among their bucket's known ones and counts (known, words and histories of both
    corpora); a bucket's first row has its sums. Blocks send sorted runs of hashes to the buckets."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            b, hashes = _Block(row), _unpack(row["hashes"], True)
            once = np.unique(b.doc * b.n + b.word) if b.n else b.word
            doc, word = np.divmod(once, max(b.n, 1))
            counts = np.array([*b.add_up(b.word, b.doc, b.n), *b.add_up(word, doc, b.n),
                               *b.add_up(b.word[b.last], b.doc[b.last], b.n)])
            yield pa.RecordBatch.from_pylist(_runs(row["block"], hashes, counts, 64, n), RUN)

    def answer(t: pa.Table) -> pa.Table:
        u, at, (nt, nb, dt, db, et, eb) = _merged(t, 6)
        known = (dt >= least[0]) | (db >= least[1])
        told = np.array([nt, nb, nt - et, nb - eb])
        stats = [int(known.sum()), *told.sum(axis=1).tolist(), *told[:, known].sum(axis=1).tolist()]
        rank, told = np.cumsum(known), np.array([known, *told]) * known
        return pa.Table.from_pylist([
            {"block": block, "bucket": t["bucket"][0].as_py(), "keys": _pack(rank[a], True), "counts": _pack(told[:, a]),
             "stats": None if k else stats} for k, (block, a) in enumerate(zip(t["block"].to_pylist(), at))], ANSWER)
    return blocks.mapInArrow(send, RUN_ROWS).groupBy("bucket").applyInArrow(answer, ANSWER_ROWS)


def _pair_answers(blocks: DataFrame, known: DataFrame, offsets: np.ndarray, size: int, least: list[float], n: int) -> DataFrame:
    """Every block's bigrams with both corpora's counts, 0 if not kept; and, without a block, the kept bigrams' sums
    by history, for the history's word bucket. A bucket's first row has the sums after unknown words and the start."""
    bits = _bits(size)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            b = _Block(row)
            b.pairs(_Known(right.to_pylist(), offsets), size)
            doc, raw = np.divmod(np.unique(b.doc * max(b.n_raw, 1) + b.raw_at), max(b.n_raw, 1))
            counts = np.array([*b.add_up(b.at, b.doc, len(b.keys)), *b.add_up(b.raw_key[raw], doc, len(b.keys))])
            out += _runs(row["block"], b.keys, counts, bits, n)
        return pa.Table.from_pylist(out, RUN)

    def answer(t: pa.Table) -> pa.Table:
        u, at, (nt, nb, dt, db) = _merged(t, 4)
        kept = (dt >= least[0]) | (db >= least[1])
        told = np.array([nt, nb]) * kept
        v, of = np.unique((_mix(u[kept], bits, back=True) // np.uint64(size)).astype(np.int64), return_inverse=True)
        sums = np.array([np.bincount(of, c[kept], len(v)) for c in told]).astype(np.int64)
        stats = [int(c[v == x].sum()) for x in (0, size - 1) for c in sums]
        out = [{"block": block, "bucket": t["bucket"][0].as_py(), "counts": _pack(told[:, a]), "stats": None if k else stats}
               for k, (block, a) in enumerate(zip(t["block"].to_pylist(), at))]
        cuts = np.searchsorted(v, np.append(offsets + 1, size - 1))
        out += [{"bucket": i, "keys": _pack(v[a:b] - offsets[i], True), "counts": _pack(sums[:, a:b])}
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        return pa.Table.from_pylist(out, ANSWER)
    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(send, RUN_ROWS) \
        .groupBy("bucket").applyInArrow(answer, ANSWER_ROWS)


def _history_answers(known: DataFrame, sums: DataFrame) -> DataFrame:
    """Every block's words with the sums of the kept bigrams behind them."""
    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(right):
            rank, _, total = _merged(right, 2)
        for r in left.to_pylist():
            mine, is_known = _unpack(r["keys"], True), _counts([r["counts"]], 5)[0] > 0
            told = np.zeros((2, len(mine)), np.int64)
            if len(right):
                at = np.minimum(np.searchsorted(rank, mine), len(rank) - 1)
                told = total[:, at] * (is_known & (rank[at] == mine))
            out.append({"block": r["block"], "bucket": r["bucket"], "counts": _pack(told)})
        return pa.Table.from_pylist(out, ANSWER)
    return known.groupBy("bucket").cogroup(sums.groupBy("bucket")).applyInArrow(answer, ANSWER_ROWS)


def cross_entropy_difference(docs: DataFrame, target: DataFrame, background: DataFrame, id_col: str = "doc_id",
                             text_col: str = "text", min_share: float = 0.0, min_docs: int = 2,
                             block_words: int = 1 << 20) -> DataFrame:
    """One row per document: n_words, both losses in nats per word, and the score.

    A target without ``text_col`` names, by ``id_col``, the documents of the background that it consists of.
    Documents are kept in blocks of some ``block_words`` words. Blocks, buckets of words and buckets of bigrams send
    each other sorted, packed runs: a block's different words and bigrams once, not a row for each document that has them.
    """
    spark, chosen = docs.sparkSession, text_col not in target.columns
    if chosen and background is not docs:
        target, chosen = background.join(target, id_col, "left_semi"), False
    id_type = docs.schema[id_col].dataType

    def rows(df: DataFrame, role: int) -> DataFrame:
        own = F.col(id_col) if role & SCORED else F.lit(None).cast(id_type)
        return df.select(own.alias("id"), F.col(text_col).alias("t"), F.lit(role).alias("role"))
    frames = [rows(docs, SCORED | BACKGROUND if background is docs else SCORED)]
    if not chosen:
        frames.append(rows(target, TARGET))
    if background is not docs:
        frames.append(rows(background, BACKGROUND))
    blocks = Stored(_blocks(union_all(frames), block_words), "lm-blocks")
    texts = blocks.df
    if chosen:
        picked = Stored(texts.select("block", F.posexplode("ids").alias("at", "id"))
                        .join(target.select(F.col(id_col).alias("id")), "id", "left_semi").groupBy("block")
                        .agg(F.sort_array(F.collect_list("at")).alias("chosen")), "lm-target")
        texts = texts.join(picked.df, "block", "left")
    least = [float(min_docs)] * 2
    if min_share:
        n_target = picked.df.agg(F.coalesce(F.sum(F.size("chosen")), F.lit(0))).first()[0] if chosen else target.count()
        least = [max(min_docs, min_share * max(1, n)) for n in (n_target, background.count())]
    n_hashes, n_words = blocks.df.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_hashes", "n_words")]).first()

    n = _buckets(spark, n_hashes)
    known = Stored(_word_answers(texts.drop("ids"), least, n), "lm-words")
    stats = np.zeros((n, 9), np.int64)
    for r in known.df.where("stats IS NOT NULL").select("bucket", "stats").toLocalIterator():
        stats[r["bucket"]] = r["stats"]
    offsets, total = np.cumsum(stats[:, 0]) - stats[:, 0], stats[:, 1:].sum(axis=0).reshape(2, 4)
    size = int(stats[:, 0].sum()) + 2
    if size > 3_000_000_000:
        raise ValueError("bigrams of so many words have no 64-bit numbers")
    texts, told = texts.drop("hashes"), known.df.drop("stats")
    pairs = Stored(_pair_answers(texts.drop("ids"), told, offsets, size, least, _buckets(spark, n_words)), "lm-pairs")
    behind = pairs.df.where("stats IS NOT NULL").agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(4)]).first()
    after = _history_answers(told, pairs.df.where("block IS NULL").drop("stats"))
    # words, words that are histories: all, less the known ones
    words_all, after_all = total[0].reshape(2, 2)
    unknown = total[0] - total[1]
    other = {"words": unknown[:2], "after": unknown[2:], "start": words_all - after_all, "sums": behind[:2], "start_sums": behind[2:]}

    def losses(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, out = [[], [], []], []
        for r in right.to_pylist():
            answers[r["kind"]].append(r)
        for row in left.drop_columns(["ids"]).to_pylist():
            b, mine = _Block(row), _Known(answers[0], offsets)
            b.pairs(mine, size)
            kept, sums = (_counts([r["counts"] for r in sorted(a, key=lambda r: r["bucket"])], 2) for a in answers[1:])
            both = []
            for c in range(2):
                n_after = np.maximum(np.append(np.where(mine.known, mine.n[2 + c], other["after"][c]), other["start"][c]), 1)
                share = np.append(np.where(mine.known, sums[c], other["sums"][c]), other["start_sums"][c]) / n_after
                back = np.log(1 - LAMBDA * np.minimum(share, 1))
                single = np.log((np.where(mine.known, mine.n[c], other["words"][c]) + 1) / (words_all[c] + size))
                logp = back[b.v] + single[b.w]
                seen = kept.sum(axis=0) > 0
                logp[seen] = np.log(LAMBDA * kept[c][seen] / n_after[b.v][seen] + np.exp(logp[seen]))
                both.append(-np.bincount(b.doc, logp[b.at], len(b.lens)) / np.maximum(b.lens, 1))
            t, back_loss = (x[b.scored] for x in both)
            ids = left["ids"].combine_chunks().flatten().filter(pa.array(b.scored))
            out.append(pa.table([ids, pa.array(b.lens[b.scored]), pa.array(t), pa.array(back_loss), pa.array(back_loss - t)],
                                ["id", "n_words", "target_loss", "background_loss", "score"]))
        return pa.concat_tables(out)
    answered = union_all([a.select(F.lit(i).alias("kind"), "block", "bucket", "keys", "counts")
                          for i, a in enumerate((told, pairs.df.where("block IS NOT NULL"), after))])
    scores = texts.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        losses, f"id {id_type.simpleString()}, n_words long, target_loss double, background_loss double, score double")
    return scores.withColumnRenamed("id", id_col)

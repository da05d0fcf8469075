"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Texts are sequences of words. A window of a document as long as an item is a
leak if its word edit distance to the item is at most ``max_edits`` x the item's
length. To find such windows:

1. CGK random walk: a pointer walks over the sequence; at each of 3n steps it
   writes the word under it and moves on by a random bit that depends on the
   step and the word. Windows a few edits apart write mostly the same words, so
   edit distance becomes Hamming distance.
2. Bit-sampling LSH: each of the length's walks is sampled at ``keys`` random sets of
   ``sample`` positions; windows and items that agree on a set are candidates.
3. Candidates are verified by exact edit distance.

Words that no item has are one symbol. A window within k edits of an item keeps
all but k of its words, so it holds at least n - k words that some item has, and
all but k of the item's rare words (in few items); windows with fewer are passed
over before step 1, which loses none. Only words of items as long as the window
count for that. Overlapping windows of one item are one leak, reported at the
closest one.

The items are the query set: their table is sent to every task in blocks of at
most ``BLOCK`` items (a proven bound), one pass over the documents a block.
Items of fewer than ``min_words`` words leak only as they are, without an edit.
Items of more than ``whole_words`` words are looked for by their parts: of m parts
one holds at most an m-th of the edits. A window like a part (twice its edits: the
window may be cut off otherwise than the part) gives the place where the item would
begin, and all windows as long as the item within ``max_edits`` of it are compared.

Null and empty texts hold no leak, items without a word leak nowhere; very long
texts are searched whole; repeated items give a row each; repeated documents each
give their rows; an empty table on either side gives no rows. Other columns, also
such with names of the result's, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import union_all, words

BLOCK = 20_000
CHUNK_WORDS = 1 << 19
RARE_SHARE = 0.02
TOGETHER = 1 << 16


@dataclass(frozen=True)
class Lsh:
    """Search parameters: at least ``walks`` x ``keys`` position sets of ``sample`` positions each. Longer
    items lose more walks to edits: each length gets so many that a ``recall`` share of simulated windows at
    the largest distance is found (the tests ask for 0.9 at that distance; an exact passage always)."""
    max_edits: float = 0.2
    walks: int = 4
    keys: int = 8
    sample: int = 4
    min_words: int = 8
    seed: int = 11
    recall: float = 0.95
    most_walks: int = 48
    whole_words: int = 100
    part_words: int = 64

    def most(self, n: int) -> int:
        """Edits that a leak of an item of n words may have."""
        return int(self.max_edits * n) if n >= self.min_words else 0

    def parts(self, n: int) -> list[tuple[int, int]]:
        """(first word, words) of the stretches by which an item of n words is looked for: all of it, or equal parts."""
        m = -(-n // self.part_words) if n > self.whole_words else 1
        return [(i * (n // m), n // m) for i in range(m)] if n else []

    @lru_cache(maxsize=10_000)  # noqa: B019 - frozen, and asked for again for every chunk of text
    def positions(self, walk: int, n: int, sample: int) -> np.ndarray:
        """Sampled steps of a walk over n words, a row a key; the last third of the 3n steps is
        left out, where most walks are past the end and all write the same."""
        rng = np.random.default_rng((self.seed, walk, n))
        return np.array([rng.choice(2 * n, min(sample, 2 * n), replace=False) for _ in range(self.keys)])

    def plan(self, n: int) -> tuple[int, int]:
        """(walks, sample) for items of n words, simulated for the next multiple of 4 (longer is harder)."""
        return self._plan(-(-n // 4) * 4) if self.most(n) else (1, self.sample)  # without edits all walks agree

    @lru_cache(maxsize=10_000)  # noqa: B019 - frozen, asked for once a length
    def _plan(self, n: int) -> tuple[int, int]:
        most, trials, other = int(self.max_edits * n), 400, 1000
        rng = np.random.default_rng((self.seed, n))
        x, y = [], []
        while len(x) < trials:
            a = rng.integers(1, other, n).tolist()
            b, pairs = list(a), min(most // 2, int(rng.binomial(most, 1 / 3)))
            for kind in rng.permutation([0] * (most - 2 * pairs) + [1, 2] * pairs).tolist():
                p = int(rng.integers(len(b)))
                b[p:p + 1] = [[other], [], [other, b[p]]][kind]  # replace, leave out, put in
            if edit_distance(a, b, n) == most:
                x.append(a)
                y.append(b)
        ids = np.array([*np.ravel(x), 0, *np.ravel(y), *[0] * (n + 1)], np.int32)
        starts = np.arange(trials) * n
        for sample in range(self.sample, 0, -1):
            met = np.zeros(trials, bool)
            for walk in range(self.most_walks):
                bits = rng.integers(0, 1 << 63, (other + 1, n * 2 // 64 + 1), np.uint64, endpoint=True)
                bits |= rng.integers(0, 2, bits.shape, np.uint64) << np.uint64(63)
                at = self.positions(walk, n, sample)
                same = np.equal(*(cgk(ids, s, n, bits, at.ravel()) for s in (starts, starts + trials * n + 1)))
                met |= same.reshape(*at.shape, trials).all(axis=1).any(axis=0)
                if walk + 1 >= self.walks and met.mean() >= self.recall:
                    return walk + 1, sample
        raise ValueError(f"no search of {self.most_walks} walks finds items of {n} words within {most} edits")


def cgk(ids: np.ndarray, starts: np.ndarray, n: int, bits: np.ndarray, wanted: np.ndarray,
        first: np.ndarray | int = 0) -> np.ndarray:
    """CGK walks over the windows ids[start:start + n]: the ids written at the ``wanted`` steps, a row a
    step (0 past the end). ``bits`` holds a random bit per word and step, 64 steps a column; a window's
    words begin at its row ``first``, so that several walks go at once."""
    out = np.zeros((len(wanted), len(starts)), np.int32)
    rows: dict[int, list[int]] = {}
    for r, step in enumerate(wanted.tolist()):
        rows.setdefault(step, []).append(r)
    at = np.zeros(len(starts), np.int64)
    for step in range(max(rows) + 1):
        here = ids[starts + at]
        here[at >= n] = 0
        for r in rows.get(step, ()):
            out[r] = here
        at += ((bits[here + first, step >> 6] >> np.uint64(step & 63)) & np.uint64(1)).astype(np.int64)
        np.minimum(at, n, out=at)
    return out


def edit_distance(a: list[int], b: list[int], most: int) -> int:
    """Exact word edit distance if it is at most ``most``, else ``most`` + 1 (bit-parallel rows)."""
    n = len(a)
    if abs(n - len(b)) > most or not n:
        return min(max(n, len(b)), most + 1)
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, d = full, 0, n
    for y in b:
        eq = places.get(y, 0)
        diag = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(diag | plus) & full, plus & diag
        d += bool(up & top) - bool(down & top)
        up = up << 1 | 1
        plus, minus = ((down << 1) | ~(diag | up)) & full, up & diag & full
    return min(d, most + 1)


class Index:
    """One block of items: vocabulary, rare words, and per length the items' keys."""

    def __init__(self, items: list[tuple[int, str]], lsh: Lsh, plans: dict[int, tuple[int, int]] | None = None):
        self.lsh, self.vocabulary = lsh, {}
        self.whole: list[tuple[int, list[int], int]] = []  # item, its words, most edits
        by_length: dict[int, list[tuple[int, int, list[int]]]] = {}  # (place in ``whole``, first word, words)
        for item, text in items:
            seq = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for at, n in lsh.parts(len(seq)):
                by_length.setdefault(n, []).append((len(self.whole), at, seq[at:at + n]))
            self.whole.append((item, seq, lsh.most(len(seq))))
        held = np.zeros(len(self.vocabulary) + 1, np.int64)  # items that hold a word
        for _, seq, _ in self.whole:
            held[np.unique(np.array(seq, np.int32))] += 1
        self.rare = (held <= max(2, RARE_SHARE * held.max(initial=0), RARE_SHARE * len(items))) & (held > 0)
        longest = max(by_length, default=0)
        self.longest = max((len(seq) for _, seq, _ in self.whole), default=0)
        self.gap = int(lsh.max_edits * self.longest) + 1  # unknown words between texts, more than any window may hold
        self.plans = {n: plans[n] if plans else lsh.plan(n) for n in by_length}
        rng = np.random.default_rng(lsh.seed)
        self.bits = rng.integers(0, 1 << 63, (max((w for w, _ in self.plans.values()), default=0), len(held), longest * 2 // 64 + 1), np.uint64, endpoint=True)
        self.bits |= rng.integers(0, 2, self.bits.shape, np.uint64) << np.uint64(63)
        self.mixers = rng.integers(1 << 62, 1 << 63, lsh.sample, np.uint64) | np.uint64(1)  # key: a sum of products
        self.items, self.needs, self.own, self.keys = {}, {}, {}, {}
        for n, group in sorted(by_length.items()):
            seqs = np.array([seq for *_, seq in group], np.int32)
            mosts = [self.whole[o][2] // len(lsh.parts(len(self.whole[o][1]))) for o, *_ in group]
            self.items[n] = ([(o, at) for o, at, _ in group], seqs, mosts)
            self.needs[n] = (n - max(mosts), int((self.rare[seqs].sum(axis=1) - mosts).min()))
            self.own[n] = np.unique(seqs)
            for walk, key in self._keys(np.append(seqs.ravel(), 0), np.arange(len(seqs)) * n, n):
                order = np.argsort(key, kind="stable")
                self.keys[n, walk] = key[order], order

    def _keys(self, ids: np.ndarray, starts: np.ndarray, n: int) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        """((walk, set), 64-bit key per window)."""
        with np.errstate(over="ignore"):
            walks, sample = self.plans[n]
            at = np.array([self.lsh.positions(walk, n, sample) for walk in range(walks)])
            some = max(1, TOGETHER // max(1, len(starts)))  # few windows: all their walks at once
            for lo in range(0, walks, some):
                bits = self.bits[lo:min(lo + some, walks)]
                count, known, columns = bits.shape
                steps, where = np.unique(at[lo:lo + count], return_inverse=True)
                seen = cgk(ids, np.tile(starts, count), n, bits.reshape(-1, columns), steps,
                           np.repeat(np.arange(count) * known, len(starts))).astype(np.uint64)
                seen = seen.reshape(len(steps), count, len(starts))
                for walk, sets in enumerate(where.reshape(at[lo:lo + count].shape)):
                    for k, rows in enumerate(sets):
                        yield (lo + walk, k), sum(seen[r, walk] * m for r, m in zip(rows, self.mixers))

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """Per text: (item, first word, words, distance) of every leak."""
        out: list[list] = [[] for _ in texts]
        part: list[tuple[int, np.ndarray]] = []
        size, get = 0, self.vocabulary.get
        for t, text in enumerate(texts):
            ws = words(text)
            part.append((t, np.fromiter(map(get, ws, repeat(0)), np.int32, len(ws))))
            size += len(ws)
            if size > CHUNK_WORDS or t == len(texts) - 1:
                self._search(part, out)
                part, size = [], 0
        return out

    def _search(self, part: list[tuple[int, np.ndarray]], out: list[list]) -> None:
        gap = np.zeros(self.gap, np.int32)
        ids = np.concatenate([gap, *(x for _, seq in part for x in (seq, gap)), np.zeros(self.longest + 1, np.int32)])
        firsts = np.cumsum([self.gap] + [len(seq) + self.gap for _, seq in part])
        known = np.concatenate(([0], np.cumsum(ids > 0, dtype=np.int32)))
        rare = np.concatenate(([0], np.cumsum(self.rare[ids], dtype=np.int32)))
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (text, place in ``whole``): (distance, start)
        hints: dict[tuple[int, int], set[int]] = {}  # the same: where it would begin

        def text_of(last: int) -> int:
            return int(np.searchsorted(firsts, last, side="right")) - 1
        for n, (group, seqs, mosts) in self.items.items():
            need, need_rare = self.needs[n]
            ok = known[n:] - known[:-n] >= need
            if need_rare > 0:
                ok &= rare[n:] - rare[:-n] >= need_rare
            starts = self._own_words(ids, np.flatnonzero(ok[:len(ids) - n]), n)
            for lo in range(0, len(starts), 1 << 16):
                for s, j in self._candidates(ids, starts[lo:lo + (1 << 16)], n):
                    o, at = group[j]
                    most = mosts[j] if n == len(self.whole[o][1]) else 2 * mosts[j]
                    d = edit_distance(seqs[j].tolist(), ids[s:s + n].tolist(), most)
                    if d <= most and n == len(self.whole[o][1]):
                        found.setdefault((text_of(s + n - 1), o), []).append((d, s))
                    elif d <= most:
                        hints.setdefault((text_of(s + n - 1), o), set()).add(s - at)
        for (t, o), places in hints.items():
            _, seq, most = self.whole[o]
            near = {s for p in places for s in range(max(0, p - most), min(p + most, len(ids) - len(seq)) + 1)}
            for s in sorted(near):
                if known[s + len(seq)] - known[s] >= len(seq) - most:
                    d = edit_distance(seq, ids[s:s + len(seq)].tolist(), most)
                    if d <= most:
                        found.setdefault((t, o), []).append((d, s))
        for (t, o), places in found.items():
            taken: list[int] = []
            item, seq, _ = self.whole[o]
            for d, s in sorted(places):
                if all(abs(s - u) >= len(seq) for u in taken):
                    taken.append(s)
                    out[part[t][0]].append((item, max(0, s - int(firsts[t])), len(seq), d))
        for t, _ in part:
            out[t].sort()

    def _own_words(self, ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        """Those of the starts whose window has as many words, and rare words, of the items of length n as a leak keeps."""
        own = np.zeros(len(self.rare), bool)
        own[self.own[n]] = True
        for need, word in zip(self.needs[n], (own, own & self.rare)):
            if need > 0 and len(starts):
                held = np.concatenate(([0], np.cumsum(word[ids], dtype=np.int32)))
                starts = starts[held[starts + n] - held[starts] >= need]
        return starts

    def _candidates(self, ids: np.ndarray, starts: np.ndarray, n: int) -> list[tuple[int, int]]:
        """Distinct (window start, item of length n) that share a key."""
        pairs = set()
        for which, key in self._keys(ids, starts, n):
            table, order = self.keys[n, which]
            lo = np.searchsorted(table, key, "left")
            hits = np.flatnonzero(table[np.minimum(lo, len(table) - 1)] == key)
            for s, hi in zip(hits.tolist(), np.searchsorted(table, key[hits], "right").tolist()):
                pairs.update((int(starts[s]), int(order[t])) for t in range(lo[s], hi))
        return sorted(pairs)


LEAK = "array<struct<item:long,first:long,words:int,distance:int>>"


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", lsh: Lsh | None = None) -> DataFrame:
    """One row per leak: document id, item id, first word, words of the window, edit distance, similarity."""
    spark, lsh = docs.sparkSession, lsh or Lsh()
    frames = []
    for block in _blocks(items.select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t"))):
        plans = {n: lsh.plan(n) for _, t in block for _, n in lsh.parts(len(words(t)))}
        find = _finder(spark.sparkContext.broadcast(block), lsh, plans)  # at most BLOCK items
        frames.append(docs.select(F.col(id_col).alias("d"), F.explode(find(F.col(text_col))).alias("x")).select(
            F.col("d").alias(id_col), F.col("x.item").alias(item_col), F.col("x.first").alias("first_word"),
            F.col("x.words").alias("n_words"), F.col("x.distance").alias("distance"),
            (1 - F.col("x.distance") / F.col("x.words")).alias("similarity")))
    empty = docs.select(F.col(id_col), F.lit(0).cast("long").alias(item_col), F.lit(0).cast("long").alias("first_word"),
                        F.lit(0).alias("n_words"), F.lit(0).alias("distance"), F.lit(0.0).alias("similarity")).limit(0)
    return union_all(frames) if frames else empty


def _finder(sent, lsh: Lsh, plans: dict[int, tuple[int, int]]):
    """UDF: leaks of the sent items in each text. A worker builds the index once a task."""
    kind = pa.list_(pa.struct([("item", pa.int64()), ("first", pa.int64()), ("words", pa.int32()),
                               ("distance", pa.int32())]))

    @F.arrow_udf(LEAK)
    def find(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(sent.value, lsh, plans)
        for col in cols:
            yield pa.array([[dict(zip(("item", "first", "words", "distance"), x)) for x in found]
                            for found in index.search(col.to_pylist())], kind)
    return find


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most BLOCK, one block in memory at a time."""
    block: list[tuple[int, str]] = []
    for r in items.where("i IS NOT NULL AND t IS NOT NULL").orderBy("i", "t").toLocalIterator():
        block.append((r.i, r.t))
        if len(block) == BLOCK:
            yield block
            block = []
    if block:
        yield block

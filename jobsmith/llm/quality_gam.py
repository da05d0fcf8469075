"""Quality classifier: a generalised additive model with pairwise interactions.

Text features are cut into quantile bins; cyclic gradient boosting visits the
features in turn and adds a shallow tree over one feature's bins to that
feature's lookup table, then does the same over the bin pairs of the strongest
interactions. A document's score is the sigmoid of an intercept plus one table
cell a feature and a pair: vectorised additions, no tree is walked.

Labels come from a bounded sample of learnable rows (``max_rows``); features and
scores cover whole texts of every row. Null and empty texts have all-zero
features and a defined score; a table without usable labels of both classes
scores every row with the intercept (share of positives, 0.5 if none); repeated
rows are scored alike; other columns, of any name, pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import LOWER_BYTES, learnable

FEATURES = ("log_words", "word_length", "longest_word", "distinct_share", "repeat_share", "longest_run", "top_share",
            "upper_share", "capital_share", "digit_share", "punct_share", "symbol_share", "pipe_share", "bang_share",
            "stop_share", "newline_share", "line_repeat_share", "line_words", "wide_share", "edge_punct_share",
            "worst_line_pipe", "worst_line_repeat", "worst_line_symbol", "worst_line_upper")

_KIND = np.zeros(256, np.uint8)  # 1 letter A-Z, 2 letter a-z, 3 digit, 4 other ASCII punctuation, 5 symbol, 6 beyond ASCII
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
for _c in range(33, 127):
    if not _KIND[_c]:
        _KIND[_c] = 5 if chr(_c) in "#$%&*+<=>@^_~\\" else 4


def features(text: str | None) -> np.ndarray:
    """The text's feature vector (all zeros for a text without words)."""
    f = np.zeros(len(FEATURES), np.float32)
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    ws = raw.translate(LOWER_BYTES).split()
    n = len(ws)
    if not n:
        return f
    size = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=7)
    chars = max(1, int(size[1:].sum()))
    again = np.fromiter(map(bytes.__eq__, ws, ws[1:]), bool, n - 1)
    breaks = np.flatnonzero(~again)
    runs = np.diff(np.concatenate(([-1], breaks, [n - 1])))
    count: dict[bytes, int] = {}
    get = count.get
    for w in ws:
        count[w] = get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = _KIND[np.frombuffer(bytes([w[-1] for w in ws]), np.uint8)]
    capital = sum(1 for w in raw.split() if len(w) > 1 and w.isupper())
    f[:20] = (np.log1p(n), chars / n, min(100, max(map(len, ws))), len(count) / n, again.sum() / n, min(100, runs.max()),
              max(count.values()) / n, size[1] / chars, capital / n, size[3] / chars, (size[4] + size[5]) / chars,
              size[5] / chars, raw.count(b"|") / n, raw.count(b"!") / n, (raw.count(b".") + raw.count(b"?")) / n,
              len(lines) / n, 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), size[6] / chars,
              (ends >= 4).sum() / n - (ends == 6).sum() / n)
    worst = np.zeros(4)
    for x in lines:
        k = len(x)
        if k >= 40:  # shares of a very short line say little
            w = x.split()
            kinds = len(set(w)) / len(w)
            part = np.bincount(_KIND[np.frombuffer(x, np.uint8)], minlength=7)
            worst = np.maximum(worst, (x.count(b"|") / len(w), 1 - kinds if len(w) > 4 else 0, part[5] / k, part[1] / k))
    f[20:] = worst
    return f


@dataclass
class Gam:
    """Bin edges per feature, a table per feature, a table per interacting pair."""
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]  # i, j, coarse bin maps of i and j, table

    def logits(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)]
        z = np.full(len(x), self.intercept)
        for b, t in zip(bins, self.tables):
            z += t[b]
        for i, j, ci, cj, t in self.pairs:
            z += t[ci[bins[i]], cj[bins[j]]]
        return z

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, lam: float) -> np.ndarray:
    """Shallow regression tree over ordered bins with gradient sums g and hessian sums h: value per bin."""
    out = np.zeros(len(g))
    spans = [(0, len(g))]
    gain = lambda a, b: a * a / (b + lam)
    while len(spans) < leaves:
        best = None
        for at, (lo, hi) in enumerate(spans):
            if hi - lo < 2:
                continue
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
            gains = gain(gl, hl) + gain(gt - gl, ht - hl) - gain(gt, ht)
            gains[(hl < 1e-3) | (ht - hl < 1e-3)] = 0
            k = int(gains.argmax())
            if gains[k] > 1e-9 and (best is None or gains[k] > best[0]):
                best = (gains[k], at, lo + k + 1)
        if best is None:
            break
        lo, hi = spans.pop(best[1])
        spans[best[1]:best[1]] = [(lo, best[2]), (best[2], hi)]
    for lo, hi in spans:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + lam)
    return out


def _tree2(g: np.ndarray, h: np.ndarray, lam: float) -> np.ndarray:
    """Depth-two tree over a bin grid: one cut of either side, then one cut of each half along the other."""
    best, out = -1.0, np.zeros_like(g)
    gain = lambda a, b: a * a / (b + lam)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for cut in range(1, a.shape[0]):
            total, value = 0.0, np.zeros_like(a)
            for part in (slice(0, cut), slice(cut, None)):
                ga, ha = a[part].sum(0), b[part].sum(0)
                gl, hl = np.cumsum(ga)[:-1], np.cumsum(ha)[:-1]
                gains = gain(gl, hl) + gain(ga.sum() - gl, ha.sum() - hl)
                k = int(gains.argmax())
                total += gains[k]
                value[part, :k + 1] = gl[k] / (hl[k] + lam)
                value[part, k + 1:] = (ga.sum() - gl[k]) / (ha.sum() - hl[k] + lam)
            if total > best:
                best, out = total, value.T if flip else value
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse: int = 8, rounds: int = 150, pair_rounds: int = 40,
        n_pairs: int = 6, rate: float = 0.15, leaves: int = 4, lam: float = 2.0) -> Gam:
    """Cyclic boosting of single-feature tables, then of the ``n_pairs`` strongest interactions."""
    ones = float(y.sum())
    share = 0.5 if not len(y) else (ones + 0.5) / (len(y) + 1)
    model = Gam(float(np.log(share / (1 - share))), [np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1], [])
    if not 0 < ones < len(y):
        return model
    model.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    at = [np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(model.edges)]
    z = np.full(len(y), model.intercept)
    for _ in range(rounds):
        for k, b in enumerate(at):
            if len(model.edges[k]):
                p = 1 / (1 + np.exp(-z))
                m = len(model.tables[k])
                step = rate * _tree(np.bincount(b, y - p, m), np.bincount(b, p * (1 - p), m), leaves, lam)
                model.tables[k] += step
                z += step[b]
    grids = [(np.arange(len(t)) * coarse // len(t)) for t in model.tables]
    p = 1 / (1 + np.exp(-z))
    strength = {}
    for i, j in combinations([k for k, e in enumerate(model.edges) if len(e) > 1], 2):
        g, h = _grid(grids, at, i, j, y - p, coarse), _grid(grids, at, i, j, p * (1 - p), coarse)
        strength[i, j] = float((g * g / (h + lam)).sum())
    chosen = sorted(strength, key=lambda ij: (-strength[ij], ij))[:n_pairs]
    model.pairs = [(i, j, grids[i], grids[j], np.zeros((coarse, coarse))) for i, j in chosen]
    for _ in range(pair_rounds):
        for i, j, ci, cj, t in model.pairs:
            p = 1 / (1 + np.exp(-z))
            step = rate * _tree2(_grid(grids, at, i, j, y - p, coarse), _grid(grids, at, i, j, p * (1 - p), coarse), lam)
            t += step
            z += step[ci[at[i]], cj[at[j]]]
    return model


def _grid(grids, at, i: int, j: int, w: np.ndarray, coarse: int) -> np.ndarray:
    return np.bincount(grids[i][at[i]] * coarse + grids[j][at[j]], w, coarse * coarse).reshape(coarse, coarse)


def feature_vector(text: str | Column) -> Column:
    @F.arrow_udf("array<float>")
    def run(col: pa.Array) -> pa.Array:
        flat = np.concatenate([features(t.as_py()) for t in col]) if len(col) else np.zeros(0, np.float32)
        return pa.FixedSizeListArray.from_arrays(pa.array(flat, pa.float32()), len(FEATURES)).cast(pa.list_(pa.float32()))
    return run(text)


def learning_rows(labels: DataFrame, id_col: str, label_col: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` learnable labelled ids (a hash order picks them): (id, y)."""
    return labels.where(learnable(id_col) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")) \
        .agg(F.max(F.col(label_col).cast("int")).alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = 20_000) -> Gam:
    """Fit on at most ``max_rows`` labelled documents; only their feature vectors reach the driver."""
    picked = learning_rows(labels, id_col, label_col, max_rows)  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(picked), "id") \
        .select("id", "y", feature_vector("t").alias("f")).toArrow()
    rows = rows.sort_by([("id", "ascending")])
    x = np.array(rows["f"].combine_chunks().flatten()).reshape(-1, len(FEATURES)) if len(rows) else \
        np.zeros((0, len(FEATURES)), np.float32)
    return fit(x.astype(np.float64), np.array(rows["y"], np.float64))


def score(text: str | Column, model: Gam) -> Column:
    """Score column of a fitted model."""
    @F.arrow_udf("double")
    def run(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in cols:
            x = np.array([features(t.as_py()) for t in col], np.float64).reshape(-1, len(FEATURES))
            yield pa.array(model.scores(x))
    return run(text)

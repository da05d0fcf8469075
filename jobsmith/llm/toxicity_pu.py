"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the positives; everything else is unlabelled text
that may hide more of them. With class prior pi the risk is

    pi * R_p(+)  +  max(0, R_u(-) - pi * R_p(-)),

the second term being the unlabelled risk as negatives, corrected for the
positives hidden in it; when it turns negative, training steps back on it. The
classifier is a sparse linear model in numpy over presence of hashed byte
5-grams of the whole normalised text.

Training reads a bounded sample (``max_positive``, ``max_unlabelled``); gram
counts of the sample are summed by Spark and only ``n_grams`` grams reach the
driver. Scores cover whole texts of every row. Null and empty texts have the
intercept's score; without a learnable positive, or with too few for any gram to
stand out, every score is the prior's logistic floor (all zero weights); repeated rows score alike; other columns pass
through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.llm.common import WORD_BYTES, Stored, learnable

GRAM, BINS_LOG2 = 5, 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 1 << 21


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Hashed 5-grams of the normalised text (words joined by blanks, a blank at both ends), a bounded
    number at a time."""
    if not text:
        return
    norm = b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()) + b" "
    raw = np.frombuffer(norm, np.uint8)
    for i in range(0, len(raw) - GRAM + 1, CHUNK):
        part = raw[i:i + CHUNK + GRAM - 1].astype(np.uint64)
        code = part[:len(part) - GRAM + 1].copy()
        for k in range(1, GRAM):
            code |= part[k:len(part) - GRAM + 1 + k] << np.uint64(8 * k)
        yield ((code * _MIX) >> np.uint64(64 - BINS_LOG2)).astype(np.int32)


def present(text: str | None) -> np.ndarray:
    """Distinct gram bins of the text."""
    parts = [np.unique(g) for g in grams(text)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int32)


@dataclass
class Model:
    bias: float
    bins: np.ndarray       # sorted bins with a weight
    weights: np.ndarray

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BINS_LOG2, np.int32)  # place of each bin's weight, 0: none
        table[self.bins] = np.arange(1, len(self.bins) + 1)
        return table

    def logit(self, text: str | None, table: np.ndarray) -> float:
        seen = [np.unique(k[k > 0]) for k in (table[g] for g in grams(text))]
        at = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        return self.bias + float(self.weights[at - 1].sum())


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit(rows: np.ndarray, cols: np.ndarray, n: int, d: int, positive: np.ndarray, prior: float, epochs: int = 1000,
        rate: float = 0.05, l1: float = 1e-4, beta: float = 0.0) -> tuple[float, np.ndarray]:
    """Non-negative PU risk by Adam with soft-thresholded weights; (rows, cols) are the set cells of
    the n x d presence matrix."""
    w, b = np.zeros(d), float(np.log(prior / (1 - prior)))
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    m, v, mb, vb = np.zeros(d), np.zeros(d), 0.0, 0.0
    for t in range(1, epochs + 1):
        z = b + np.bincount(rows, w[cols], n)
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        r_p_neg = _softplus(z[positive]).mean()
        r_u_neg = _softplus(z[~positive]).mean()
        # gradients of the logistic losses by z: positive label s - 1, negative label s
        up_pos = np.where(positive, prior * (s - 1) / n_p, 0.0)
        down = np.where(positive, -prior * s / n_p, s / n_u)
        gz = up_pos + down if r_u_neg - prior * r_p_neg >= -beta else -down
        g, gb = np.bincount(cols, gz[rows], d), gz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        step = rate / (1 - 0.9 ** t)
        root = np.sqrt(v / (1 - 0.999 ** t)) + 1e-8
        w = w - step * m / root
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * l1 / root)
        b -= step * mb / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    return b, w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          prior: float | None = None, max_positive: int = 4_000, max_unlabelled: int = 12_000,
          n_grams: int = 2_048) -> Model:
    """Learn from at most ``max_positive`` confirmed examples and ``max_unlabelled`` other rows.

    ``prior``: share of toxic text; by default the learnable labels' share. Rows
    that are held out are neither positives nor unlabelled examples.
    """
    spark = docs.sparkSession
    known = labels.where(learnable(id_col) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")) \
        .agg(F.max(F.col(label_col).cast("int")).alias("y"))
    n_known, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n_toxic:
        return Model(-4.0, np.zeros(0, np.int64), np.zeros(0))
    prior = prior or min(0.9, n_toxic / n_known)
    order = (F.xxhash64("id"), F.col("id"))
    confirmed = known.where("y = 1").select("id").orderBy(*order).limit(max_positive)
    others = docs.where(learnable(id_col)).select(F.col(id_col).alias("id")).join(known.where("y = 1"), "id", "left_anti") \
        .distinct().orderBy(*order).limit(max_unlabelled)
    picked = confirmed.select("id", F.lit(True).alias("p")).unionByName(others.select("id", F.lit(False).alias("p")))

    @F.arrow_udf("array<int>")
    def bins(col: pa.Array) -> pa.Array:
        return pa.array([present(t.as_py()) for t in col], pa.list_(pa.int32()))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(picked), "id")
    sample = Stored(texts.groupBy(F.xxhash64("t").alias("h")).agg(F.max("p").alias("p"), F.min("id").alias("id"),
                                                                  F.first("t").alias("t"))  # a copied text counts once
                    .select("id", "p", bins("t").alias("bins")), "toxicity-sample")
    n_p, n_u = sample.df.agg(F.count_if(F.col("p")), F.count_if(~F.col("p"))).first()
    if not n_p or not n_u:  # nothing to tell apart
        sample.drop()
        return Model(-4.0, np.zeros(0, np.int64), np.zeros(0))
    # document shares of every gram: a among positives, b among unlabelled, q among clean text if a share
    # ``prior`` of the unlabelled is toxic; markers are far more common in a than in q
    seen = sample.df.select("p", F.explode("bins").alias("bin")).groupBy("bin") \
        .agg(F.count_if(F.col("p")).alias("a"), F.count_if(~F.col("p")).alias("b")).where("a >= 3")
    a, b, pool = F.col("a") / n_p, F.col("b") / n_u, (F.col("a") + F.col("b")) / (n_p + n_u)
    q = F.greatest(F.lit(0.0), b - prior * a) / (1 - prior)
    z = (a - q) / F.sqrt(pool * (1 - pool) * (1 / n_p + 1 / n_u) + 1e-12)
    odds = (F.col("a") + 0.5) / (n_p + 1) / ((q * n_u + 0.5) / (n_u + 1))
    share = seen.withColumn("s", z).where((z > 4) & (odds > 8))
    chosen = np.array(sorted(r.bin for r in share.orderBy(F.desc("s"), "bin").limit(n_grams).select("bin").collect()), np.int64)
    if not len(chosen):  # no gram tells them apart
        sample.drop()
        return Model(-4.0, np.zeros(0, np.int64), np.zeros(0))
    table = spark.sparkContext.broadcast(chosen)

    @F.arrow_udf("array<int>")
    def kept(col: pa.Array) -> pa.Array:
        out = []
        for x in col:
            x = np.array(x.values, np.int64)
            at = np.minimum(np.searchsorted(table.value, x), len(table.value) - 1)
            out.append(at[table.value[at] == x].astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))
    cells = sample.df.select("id", "p", kept("bins").alias("k")).toArrow().sort_by([("id", "ascending")])
    sample.drop()
    lists = cells["k"].combine_chunks()
    lens = np.diff(np.array(lists.offsets))
    rows = np.repeat(np.arange(len(lens)), lens)
    bias, w = fit(rows, np.array(lists.flatten(), np.int64), len(lens), len(chosen), np.array(cells["p"], bool), prior)
    used = w != 0
    return Model(bias, chosen[used], w[used])


def score(text: str | Column, model: Model) -> Column:
    """Score column: probability that the text is toxic."""
    @F.arrow_udf("double")
    def run(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.dense()
        for col in cols:
            z = np.array([model.logit(t.as_py(), table) for t in col], float)
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return run(text)

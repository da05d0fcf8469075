"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas. A
batch of changes holds inserts (+new), deletes (-old) and revised counts (-old,
+new); it is pre-aggregated to one delta a key and appended under its own
attempt, then a commit row names that attempt. Readers add up the deltas of the
first committed attempt of every batch, so

* a batch applied twice, or retried after a crash, counts once;
* deltas without a commit row (a lost driver) count for nothing;
* totals cost the size of the deltas, not of the corpus. ``compact`` folds them.

Null sources and languages are keys of their own; null counts count as zero; an
empty batch commits and changes nothing; keys whose documents have all gone keep
no row. Repeated documents are counted as often as they come: the store adds, it
does not deduplicate.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("docs", "tokens", "chars")
DELTA = "batch_id string, attempt string, source string, lang string, tokenizer string, docs long, tokens long, chars long"
COMMIT = "batch_id string, attempt string, replaces array<string>"


class Rollup:
    """A rollup in a folder that the driver and the executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        for name, schema in (("deltas", DELTA), ("commits", COMMIT)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def commits(self) -> DataFrame:
        """(batch_id, attempt) that count: the first attempt of every batch that no compaction has replaced."""
        rows = self._read("commits", COMMIT)
        gone = rows.select(F.explode("replaces").alias("batch_id")).distinct()
        return rows.groupBy("batch_id").agg(F.min("attempt").alias("attempt")).join(gone, "batch_id", "left_anti")

    def committed(self, batch_id: str) -> bool:
        return not self._read("commits", COMMIT).where(F.col("batch_id") == batch_id).isEmpty()

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit a batch of signed rows (KEYS + MEASURES); False if it was committed before."""
        if self.committed(batch_id):
            return False
        self._write(batch_id, changes.groupBy(*KEYS).agg(*[F.sum(m).cast("long").alias(m) for m in MEASURES]), [])
        return True

    def compact(self) -> str:
        """Fold the deltas committed so far into one batch that replaces them. The commits are read once: a batch
        that comes in meanwhile is neither in the fold nor replaced by it."""
        live = self.commits().collect()  # one row a batch since the last compaction
        batch_id = f"compacted-{uuid.uuid4().hex}"
        self._write(batch_id, self._sums(self.spark.createDataFrame(live, "batch_id string, attempt string")),
                    [r.batch_id for r in live])
        return batch_id

    def _write(self, batch_id: str, deltas: DataFrame, replaces: list[str]) -> None:
        attempt = uuid.uuid4().hex
        deltas.select(F.lit(batch_id).alias("batch_id"), F.lit(attempt).alias("attempt"), *KEYS, *MEASURES) \
            .write.mode("append").parquet(f"{self.path}/deltas")
        self.spark.createDataFrame([(batch_id, attempt, replaces)], COMMIT).coalesce(1) \
            .write.mode("append").parquet(f"{self.path}/commits")

    def totals(self) -> DataFrame:
        """Additive totals by key, without keys that have come down to nothing."""
        return self._sums(self.commits())

    def _sums(self, commits: DataFrame) -> DataFrame:
        sums = self._read("deltas", DELTA).join(commits, ["batch_id", "attempt"], "left_semi") \
            .groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        return sums.where(" OR ".join(f"{m} <> 0" for m in MEASURES))


def signed(rows: DataFrame, sign: int, tokenizer: str, tokens: Column, chars: Column | None = None) -> DataFrame:
    """Counted documents as signed rows: +1 inserts them, -1 takes them back."""
    zero = F.lit(0).cast("long")
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("docs"),
                       (sign * F.coalesce(tokens.cast("long"), zero)).alias("tokens"),
                       (sign * F.coalesce((F.col("chars") if chars is None else chars).cast("long"), zero)).alias("chars"))


def revised(rows: DataFrame, old: tuple[str, Column], new: tuple[str, Column]) -> DataFrame:
    """Documents whose counts changed: the old count taken back, the new one added."""
    return signed(rows, -1, *old).unionByName(signed(rows, 1, *new))


def changes(before: DataFrame, after: DataFrame, id_col: str, tokenizer: str) -> DataFrame:
    """Signed rows that lead from one counted snapshot (id, source, lang, tokens, chars) to the next.

    A document in both with the same key and counts gives no row; ids must be unique in each."""
    kept = ["source", "lang", "tokens", "chars"]
    b, a = before.select(id_col, F.struct(*kept).alias("b")), after.select(id_col, F.struct(*kept).alias("a"))
    both = b.join(a, id_col, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    out = [signed(both.where(F.col(s).isNotNull()).select(f"{s}.*"), n, tokenizer, F.col("tokens"))
           for s, n in (("b", -1), ("a", 1))]
    return out[0].unionByName(out[1])


#: tokenizer versions by the pattern of one token
TOKENIZERS = {"blank-1": r"[^\x20\x09-\x0D]+", "word-2": r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]"}


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, source, lang, chars, one count per tokenizer version) over whole texts, in one scan."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), "source", "lang", F.char_length(text).cast("long").alias("chars"),
                       *[F.regexp_count(text, F.lit(p)).cast("long").alias(name) for name, p in TOKENIZERS.items()])

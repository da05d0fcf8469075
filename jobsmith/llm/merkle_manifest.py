"""Merkle manifest of a dataset: a hash tree a group (source), and one over the groups' roots.

Every row is a leaf. In a group the leaves ascend by the order column; while there
are several nodes, every ``ARITY`` consecutive ones are a run and become the hash
of their digests (the last run may be shorter, even one). The groups' roots,
ordered by group, make a tree of the same kind, whose root stands for the dataset.

* ``positions`` - a row's place in its group by range partitioning: rows are dealt
  by (group, order), counted a partition, and shifted by the counts before. No
  group meets in one task, however many of the rows it holds.
* ``_climb`` - ``LEVELS`` levels in one stage. A block of ``ARITY ** LEVELS``
  consecutive nodes is one window; a node of level l stays on its first
  descendant's row, so its siblings are at the fixed offsets of ``lag`` and
  ``lead`` by ``ARITY ** l`` rows, masked by its slot in the run and the run's
  length. First-child rows hash the parents. Siblings reach the rows below by the
  last value that is not null.
* Stages repeat on the blocks' digests (1/729 of the rows each time) until every
  group has one node. Paths are joined downwards; at most 729 rows share a key.

Null groups come first and are a group of their own, null orders come first in a
group. Rows of equal group and order follow by leaf digest; rows equal in all
are interchangeable. Null fields count as ``-`` and differ from empty ones. Texts
are hashed whole, on the JVM. Other columns of the input, whatever their names,
are not looked at. An empty table has no root and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsmith.llm.common import Stored, width

ARITY = 3
LEVELS = 6
BLOCK = ARITY ** LEVELS
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """A value with its UTF-8 length in front, ``-`` for null: no two records spell alike."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """A row's digest over its fields."""
    return digest(*[field(c) for c in columns])


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (place in the group, from 0) and ``n`` (the group's rows)."""
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()) \
        .repartitionByRange(width(rows.sparkSession), group, *order, "_tie") \
        .sortWithinPartitions(group, *order, "_tie").drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    placed = Stored(dealt, "merkle-dealt").df.withColumn("_part", F.shiftright("_at", 33))
    spans = placed.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_c"))
    w = Window.partitionBy(group)  # a row a partition
    before = F.coalesce(F.sum("_c").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(F.col("_part").alias("_p"), F.col(group).alias("_g"), (before - F.col("_first")).alias("_shift"),
                         F.sum("_c").over(w).alias("n"))
    return placed.join(spans, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))) \
        .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_p", "_g", "_shift")


def _climb(nodes: DataFrame) -> DataFrame:
    """Nodes (g, n, pos, digest) with ``path`` (siblings of ``LEVELS`` levels, from below) and ``top``
    (on a block's first row: the digest that the block comes to)."""
    out = nodes.withColumn("block", F.expr(f"pos div {BLOCK}")).withColumn("d0", F.col("digest"))
    w = Window.partitionBy("g", "block").orderBy("pos")
    for level in range(LEVELS):
        step, d = ARITY ** level, f"d{level}"
        here = F.expr(f"pos % {step} = 0")  # a node's first row
        index, left_over = F.expr(f"pos div {step}"), F.expr(f"(n + {step - 1}) div {step}")
        slot = index % ARITY
        run = F.least(F.lit(ARITY), left_over - index + slot)
        near = {k: (F.lag(d, -k * step) if k < 0 else F.lead(d, k * step)).over(w).alias(f"near{k}")
                for k in range(1 - ARITY, ARITY) if k}
        out = out.select("*", *near.values())
        none = F.lit("")
        left = F.concat(*[F.when(slot >= k, F.col(f"near{-k}")).otherwise(none) for k in range(ARITY - 1, 0, -1)])
        right = F.concat(*[F.when(slot + k < run, F.col(f"near{k}")).otherwise(none) for k in range(1, ARITY)])
        several = left_over > 1
        out = out.withColumn(f"side{level}", F.when(here & several, F.struct(left.alias("left"), right.alias("right")))) \
            .withColumn(f"d{level + 1}", F.when(here & several & (slot == 0), digest(F.col(d), right))
                        .when(here & ~several, F.col(d))).drop(*[f"near{k}" for k in near], d)
    above = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.array(*[F.last(f"side{level}", ignorenulls=True).over(above) for level in range(LEVELS)])
    return out.withColumn("path", F.array_compact(path)).withColumnRenamed(f"d{LEVELS}", "top") \
        .drop("block", *[f"side{level}" for level in range(LEVELS)])


def _tree(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of nodes (g, n, pos, digest, more): the rows (g, pos, digest, more, path up to their group's root),
    and the groups (g, root)."""
    stages = [Stored(_climb(rows), "merkle-level").df]
    while True:
        tops = stages[-1].where("top IS NOT NULL").select(
            "g", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.expr(f"pos div {BLOCK}").alias("pos"),
            F.col("top").alias("digest"))
        if (tops.agg(F.max("n")).first()[0] or 0) <= 1:
            break
        stages.append(Stored(_climb(tops), "merkle-level").df)
    for k in range(len(stages) - 1, 0, -1):
        upper = stages[k].select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), F.col("path").alias("_path"))
        low = stages[k - 1]
        stages[k - 1] = low.join(upper, F.col("g").eqNullSafe(F.col("_g")) & (F.expr(f"pos div {BLOCK}") == F.col("_pos"))) \
            .withColumn("path", F.concat("path", "_path")).drop("_g", "_pos", "_path")
    return stages[0], tops.select("g", F.col("digest").alias("root"))


def manifest(rows: DataFrame, leaf_digest: Column, group: str, order: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row: group, order, the carried columns, ``leaf``, ``subroot`` (the group's root), ``root``
    and ``path`` (left and right siblings, level by level up to the root)."""
    more = F.struct(*[c.alias(k) for k, c in (carry or {"_": F.lit(0)}).items()])
    leaves = Stored(rows.select(F.col(group).alias("g"), F.col(order).alias("o"), leaf_digest.alias("digest"),
                                more.alias("more")), "merkle-leaves")
    low, groups = _tree(positions(leaves.df, "g", ["o", "digest"]))
    leaves.drop()
    subroots = Stored(groups, "merkle-subroots").df
    one = positions(subroots.select(F.lit(0).alias("g"), F.col("g").alias("o"), F.col("root").alias("digest")), "g", ["o"])
    high, top = _tree(one)
    root = top.select(F.col("root")).first()
    high = high.select(F.col("o").alias("_g"), F.col("digest").alias("subroot"), F.col("path").alias("_path"),
                       F.lit(root and root[0]).cast("string").alias("root"))
    names = [f"more.{k}" for k in (carry or {})]
    return low.join(high, F.col("g").eqNullSafe(F.col("_g"))).select(
        F.col("g").alias(group), F.col("o").alias(order), *names, F.col("digest").alias("leaf"), "subroot", "root",
        F.concat("path", "_path").alias("path"))


def fold(start: Column, path: str | Column) -> Column:
    """The root that a leaf digest comes to by its siblings."""
    return F.aggregate(path, start, lambda acc, x: digest(x["left"], acc, x["right"]))


def proof_digest(path: str | Column) -> Column:
    """One digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def tamper_report(docs: DataFrame, id_col: str = "doc_id", group: str = "source", text_col: str = "text",
                  fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """The manifest's digests, and a check of every row's proof after the line breaks of the texts of half
    the rows (2 divides the id's CRC-32; a null id is in the other half) have been deleted."""
    altered = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    now = F.when(altered, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))
    found = leaf(*[now if f == text_col else F.col(f) for f in fields])
    m = manifest(docs, leaf(*[F.col(f) for f in fields]), group, id_col, {"found": found})
    return m.select(id_col, "leaf", "subroot", "root", proof_digest("path").alias("proof_sha256"),
                    fold(F.col("found"), "path").alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))

"""Registry of named queries: Spark builder + optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    build: Builder
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, note: str = "", dates: tuple[str, ...] = ()):
    """Register ``fn`` under ``name``.

    Day columns leave both engines as TIMESTAMP (midnight): DATE values come
    back from the two engines as different Python types, timestamps do not.
    ``metric_date`` is handled automatically; other day columns are named in ``dates``.
    """
    if sql and "metric_date" in sql and "metric_date" not in dates:
        dates = dates + ("metric_date",)
    if sql and dates:
        sql = ("SELECT * REPLACE (" + ", ".join(f"CAST({d} AS TIMESTAMP) AS {d}" for d in dates)
               + ") FROM (\n" + sql + "\n)")

    def deco(fn: Builder) -> Builder:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = fn(spark, sf_dir)
            return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                               if f.dataType.typeName() == "date" else F.col(f.name) for f in df.schema.fields])
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, wrapped, sql, note)
        return wrapped
    return deco


def ntz(c: Column | str, name: str | None = None) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock) for engine-neutral output."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz").alias(name or (c if isinstance(c, str) else "ts"))


def jtxt(c: Column | str, name: str | None = None) -> Column:
    """Array/struct/map -> compact JSON text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.to_json(col).alias(name or (c if isinstance(c, str) else "json"))

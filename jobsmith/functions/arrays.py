"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: Column | str, alias: str, keep: list[str | Column] | None = None) -> DataFrame:
    """Inner UNNEST (rows with a NULL or empty array produce nothing; NULL
    elements are kept), written as ``posexplode_outer`` + ``pos IS NOT NULL``.

    Same rows as ``explode``, but the optimizer infers no ``size(array) > 0``
    filter for an outer generator, so an expensive array expression (keyword
    extraction over whole texts) is not copied into a pushed-down filter and
    evaluated twice.
    """
    arr = F.col(array) if isinstance(array, str) else array
    cols = [F.col(c) if isinstance(c, str) else c for c in (keep or [])]
    return (df.select(*cols, F.posexplode_outer(arr).alias("_pos", alias))
            .filter(F.col("_pos").isNotNull()).drop("_pos"))

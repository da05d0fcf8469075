"""Content keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsmith.functions.text import as_col


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(as_col(c).cast("string"), 256)


def job_key(url: Column | str, title: Column | str, company: Column | str, iso: Column | str) -> Column:
    """sha256(url) or, when the URL is empty, sha256('title|company|iso-date-or-empty')."""
    base = F.coalesce(
        F.nullif(F.trim(F.coalesce(as_col(url), F.lit(""))), F.lit("")),
        F.concat_ws("|", F.coalesce(as_col(title), F.lit("")), F.coalesce(as_col(company), F.lit("")),
                    F.coalesce(as_col(iso), F.lit(""))))
    return F.sha2(base, 256)

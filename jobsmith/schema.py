"""Schemas of the posting data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSTING_FIELDS: list[tuple[str, T.DataType]] = [
    ("job_hash", T.StringType()),
    ("job_id", T.StringType()),
    ("source", T.StringType()),
    ("title", T.StringType()),
    ("company", T.StringType()),
    ("location", T.StringType()),
    ("is_remote", T.BooleanType()),
    ("category", T.StringType()),
    ("publication_date", T.TimestampType()),
    ("job_url", T.StringType()),
    ("description", T.StringType()),
    ("skills_extracted", T.ArrayType(T.StringType())),
    ("role_type", T.StringType()),
    ("seniority_level", T.StringType()),
    ("ingested_at", T.TimestampType()),
]
UNIFIED_COLUMNS: list[str] = [n for n, _ in POSTING_FIELDS]
POSTING_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in POSTING_FIELDS])

# The stream table has no enrichment columns.
STREAM_COLUMNS: list[str] = [c for c in UNIFIED_COLUMNS
                             if c not in ("skills_extracted", "role_type", "seniority_level")]
STREAM_SCHEMA = T.StructType([f for f in POSTING_SCHEMA.fields if f.name in STREAM_COLUMNS])

# Raw CSV columns; read as strings, never inferred.
CSV_COLUMNS: list[str] = ["job_id", "source", "title", "company", "location", "is_remote",
                          "category", "publication_date", "job_url", "description"]
CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CSV_COLUMNS])

# Message published to the stream: ISO text date, no enrichment, no ingest time.
MESSAGE_FIELDS: list[str] = ["job_hash", "job_id", "source", "title", "company", "location",
                             "is_remote", "category", "publication_date", "job_url", "description"]

METRICS_SCHEMA = T.StructType([
    T.StructField("metric_date", T.DateType(), False),
    T.StructField("total_jobs", T.LongType(), False),
    T.StructField("top_companies", T.ArrayType(T.StructType([
        T.StructField("jobs", T.LongType()), T.StructField("company", T.StringType())]))),
    T.StructField("top_skills", T.ArrayType(T.StructType([
        T.StructField("jobs", T.LongType()), T.StructField("skill", T.StringType())]))),
    T.StructField("role_counts", T.MapType(T.StringType(), T.LongType())),
    T.StructField("computed_at", T.TimestampType()),
])


def conform(df: DataFrame, schema: T.StructType = POSTING_SCHEMA, keep: list[str] | None = None) -> DataFrame:
    """Add missing columns as typed NULLs, order them as ``schema``, drop extras
    (except the ``keep`` columns, which follow at the end)."""
    present = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in present else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    names = {f.name for f in schema.fields}
    return df.select(*cols, *[F.col(k) for k in (keep or []) if k not in names])

"""File sources: CSV postings, landed API pages (paged and flat), tables."""

from __future__ import annotations

import csv
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith import rules as R
from jobsmith.functions import json as J
from jobsmith.schema import CSV_SCHEMA
from jobsmith.session import materialize


def null_tokens(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Turn CSV NA tokens into NULL in every string column."""
    toks = R.CSV_NA_TOKENS if tokens is None else tokens
    return df.select(*[F.when(F.col(c).isin(toks), F.lit(None)).otherwise(F.col(c)).alias(c)
                       for c in df.columns])


def csv_headers(spark: SparkSession, files: list[str], threads: int = 16) -> list[tuple[str, ...]]:
    """Column names of each file's header, read through Hadoop's file systems: no Spark job, whatever the number
    of files. Names as the CSV source makes them: an empty one is ``_c{i}``, repeated ones carry their place."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(file: str) -> tuple[str, ...]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = path.getFileSystem(conf).open(path)
        try:
            codec = codecs.getCodec(path)
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
                codec.createInputStream(stream) if codec else stream, "UTF-8"))
            text = line = reader.readLine()
            while line is not None and text.count('"') % 2:  # a quoted name goes on in the next line
                line = reader.readLine()
                text += "\n" + (line or "")
        finally:
            stream.close()
        names = next(csv.reader([(text or "").removeprefix("\ufeff")]), [])
        often = Counter(n.lower() for n in names)
        return tuple(f"_c{i}" if not n else f"{n}{i}" if often[n.lower()] > 1 else n for i, n in enumerate(names))
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(header, files))


def read_postings_csv(spark: SparkSession, path: str, schema=CSV_SCHEMA, na_tokens=None, multi_line: bool = True,
                      mode: str = "FAILFAST") -> DataFrame:
    """Header CSV, quoted fields may hold commas and newlines; every column STRING.

    Columns are bound by the names in each file's header (files may differ);
    columns of ``schema`` that a file lacks are NULL, others are left out. A row
    whose fields don't match its header fails the read (``mode="PERMISSIVE"``:
    Spark's repair). With ``multi_line`` a file is one task: write many files, or
    switch it off where no field holds a line break, and files are split.
    """
    names = schema.fieldNames() if hasattr(schema, "fieldNames") else \
        spark.createDataFrame([], schema).columns
    options = {"header": "true", "multiLine": str(multi_line).lower(), "escape": '"', "mode": mode}
    by_header: dict[tuple[str, ...], list[str]] = {}
    files = sorted(spark.read.schema("c string").options(**options).csv(path).inputFiles())
    for f, header in zip(files, csv_headers(spark, files)):
        by_header.setdefault(header, []).append(f)
    by_header.pop((), None)  # files without a line
    out = spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))
    for header, files in by_header.items():
        df = spark.read.options(**options).schema(", ".join(f"`{h}` string" for h in header)).csv(files)
        out = out.unionByName(df.select(*[(F.col(f"`{n}`") if n in header else F.lit(None).cast("string")).alias(n)
                                          for n in names]))
    return null_tokens(out, na_tokens)


def read_json_documents(spark: SparkSession, path: str, one_per_file: bool = False,
                        on_malformed: str = "fail") -> DataFrame:
    """JSON payloads as VARIANT ``v``: one per line, or one per file.

    The JSON source builds the VARIANT during the scan, so later filters on
    fields of ``v`` do not parse the text again. A malformed payload fails the
    job; ``on_malformed="drop"`` leaves it out (see ``malformed_documents``).
    """
    reader = spark.read.option("singleVariantColumn", "v").option("multiLine", one_per_file) \
        .option("mode", "PERMISSIVE" if on_malformed == "drop" else "FAILFAST")
    return reader.json(path).filter(F.col("v").isNotNull())


def malformed_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of the one-per-line payloads that are not JSON."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return lines.filter((F.trim("line") != "") & F.expr("try_parse_json(line)").isNull())


def paged_results(pages: DataFrame, *, start_page: int = 1, max_pages: int | None = None,
                  max_jobs: int | None = None, default_max_jobs: int = 0) -> DataFrame:
    """Postings of landed API pages ``{page, results: [...]}`` in fetch order.

    Same stop rules as a paging client: begin at ``start_page`` (>= 1), stop
    before the first page >= start that is landed and empty, or after the last
    landed page, stop after ``max_pages`` pages, and once ``max_jobs`` postings are held keep exactly
    that many in (page, position) order. ``max_jobs`` <= 0 means no cap; None
    falls back to ``default_max_jobs`` with the same rule. A page missing in
    between fails the job: what lies behind it must not be lost in silence.
    Returns (page, pos, j) with ``j`` the posting as VARIANT.
    """
    start = max(1, int(start_page))
    target = max_jobs if max_jobs is not None else default_max_jobs
    target = None if target is None or target <= 0 else int(target)
    p = pages.select(J.vget(F.col("v"), "$.page", "bigint").alias("page"),
                     F.coalesce(J.vget(F.col("v"), "$.results", "array<variant>"),
                                F.array().cast("array<variant>")).alias("results"))
    p = p.filter(F.col("page") >= start)
    if max_pages is not None:
        p = p.filter(F.col("page") <= start + max(1, int(max_pages)) - 1)
    # One row per page, written once to the shared folder so that the stop page
    # does not re-parse the landed pages.
    index = materialize(p.groupBy("page").agg(F.max(F.size("results")).alias("n")), "page_index")
    last = F.coalesce(index.filter("n = 0").agg(F.min("page") - 1).scalar(), index.agg(F.max("page")).scalar())
    held = index.filter(F.col("page") <= last).agg(F.count(F.lit(1))).scalar()
    missing = F.when(held < last - start + 1, F.raise_error(F.concat(
        F.lit("missing pages: "), (last - start + 1 - held).cast("string"))).cast("boolean")).otherwise(F.lit(True))
    out = (p.filter(F.col("page") <= last).filter(missing)
           .select("page", F.posexplode_outer("results").alias("pos", "j")).filter(F.col("pos").isNotNull()))
    if target is not None:
        out = out.orderBy("page", "pos").limit(target)
    return out


def flat_results(payloads: DataFrame, limit: int | None = None) -> DataFrame:
    """Postings of flat payloads ``{jobs: [...]}``; a non-object payload has none.

    Returns (doc, pos, j); ``limit`` keeps the first postings in that order.
    """
    jobs = F.when(J.is_object(F.col("v")), J.vget(F.col("v"), "$.jobs", "array<variant>"))
    # outer form + pos filter = inner explode without an inferred size() filter
    out = (payloads.withColumn("doc", F.monotonically_increasing_id())
           .select("doc", F.posexplode_outer(jobs).alias("pos", "j")).filter(F.col("pos").isNotNull()))
    if limit is not None:
        out = out.orderBy("doc", "pos").limit(limit)
    return out


def table(spark: SparkSession, path_or_name: str) -> DataFrame:
    """A stored table by path (Parquet) or by catalog name."""
    if "/" in path_or_name:
        return spark.read.parquet(path_or_name)
    return spark.table(path_or_name)

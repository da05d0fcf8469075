"""Land driver-table data in the raw formats the sources read (CSV, API pages,
flat payloads, stream messages), under the session's shared folder.

Pages and payloads hold at most ``per_page`` postings, so no group is unbounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.plans import adapters as A
from jobsmith.schema import CSV_COLUMNS
from jobsmith.session import scratch_path

PER_PAGE = 100


def write_csv(raw: DataFrame, path: str) -> str:
    (raw.select(*CSV_COLUMNS).write.option("compression", "gzip").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def land_csv(spark: SparkSession, sf_dir: str) -> str:
    raw = A.raw_postings(spark, sf_dir, enrich=False)
    return write_csv(raw, scratch_path(spark, "csv"))


def api_posting_json(scalar_company: Column) -> Column:
    """One raw API posting as JSON text: objects for company/location/category,
    except a scalar company where ``scalar_company`` holds."""
    common = dict(id=F.col("doc_id"), title=F.col("title"),
                  location=F.struct(F.col("location").alias("display_name")),
                  category=F.struct(F.col("category").alias("label")),
                  created=F.col("publication_date"), redirect_url=F.col("job_url"),
                  description=F.col("description"))

    def obj(company: Column) -> Column:
        fields = [common["id"].alias("id"), common["title"].alias("title"), company.alias("company")]
        fields += [v.alias(k) for k, v in common.items() if k not in ("id", "title")]
        return F.to_json(F.struct(*fields))

    return F.when(scalar_company, obj(F.col("company"))).otherwise(
        obj(F.struct(F.col("company").alias("display_name"))))


def land_pages(spark: SparkSession, sf_dir: str, by_page: bool = False) -> str:
    """JSON lines ``{"page": n, "results": [...]}``, ``PER_PAGE`` postings per page; ``by_page``: a folder
    ``page={n}`` each."""
    raw = A.raw_postings(spark, sf_dir, enrich=False)
    posts = raw.select((F.floor(F.col("doc_id") / PER_PAGE) + 1).cast("bigint").alias("page"), "doc_id",
                       api_posting_json(F.col("category") == "HOUSEHOLD").alias("js"))
    pages = posts.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("doc_id", "js"))).alias("p"))
    line = F.concat(F.lit('{"page":'), F.col("page").cast("string"), F.lit(',"results":['),
                    F.array_join(F.transform("p", lambda x: x["js"]), ","), F.lit("]}"))
    path = scratch_path(spark, "pages")
    if by_page:
        pages.select("page", line.alias("value")).write.partitionBy("page").text(path)
    else:
        pages.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return path


def land_flat(spark: SparkSession, sf_dir: str) -> str:
    """JSON lines ``{"jobs": [...]}`` per (source, block of ``PER_PAGE`` ids)."""
    raw = A.raw_postings(spark, sf_dir, enrich=False)
    js = F.to_json(F.struct(F.col("doc_id").alias("id"), "title", F.col("company").alias("company_name"),
                            F.col("location").alias("candidate_required_location"), "category",
                            "publication_date", F.col("job_url").alias("url"), "description"))
    posts = raw.select("source", (F.floor(F.col("doc_id") / PER_PAGE)).alias("blk"), "doc_id", js.alias("js"))
    grp = posts.groupBy("source", "blk").agg(F.sort_array(F.collect_list(F.struct("doc_id", "js"))).alias("p"))
    line = F.concat(F.lit('{"jobs":['), F.array_join(F.transform("p", lambda x: x["js"]), ","), F.lit("]}"))
    path = scratch_path(spark, "flat")
    grp.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return path

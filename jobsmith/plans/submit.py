"""spark-submit entry for the batch job: landed API pages + CSV -> transform ->
load into the posting store under ``--out``. Exit code 1 on any failure.

    spark-submit -m jobsmith.plans.submit --pages P --csv C --out O [--full-refresh 1]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from jobsmith.plans.batch import transform
from jobsmith.plans.store import PostingStore
from jobsmith.sources.files import paged_results, read_json_documents, read_postings_csv


def run(spark: SparkSession, pages: str, csv: str, out: str, *, full_refresh: str | None = None,
        start_page: int = 1, max_pages: int | None = None, max_jobs: int | None = None, buckets: int = 64):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    api = paged_results(read_json_documents(spark, pages), start_page=start_page, max_pages=max_pages,
                        max_jobs=max_jobs)
    # the API frame is stamped before the CSV frame, as when read in that order
    api_clock = F.current_timestamp()
    csv_clock = F.current_timestamp() + F.expr("INTERVAL 1 MICROSECOND")
    rows = read_postings_csv(spark, csv)
    api = api.withColumn("_pos", F.struct(F.lit(0), "page", "pos"))
    rows = rows.withColumn("_pos", F.struct(F.lit(1), F.lit(0).cast("bigint"), F.monotonically_increasing_id()))
    postings = transform(api, rows, api_clock=api_clock, csv_clock=csv_clock, keep=["_pos"],
                         tie_breakers=[F.col("_pos").desc()])
    store = PostingStore(spark, out, buckets, unique_url=True)
    store.load(postings.drop("_pos"), full_refresh=full_refresh)
    return store.postings(), store.metrics.read()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--pages", required=True)
    ap.add_argument("--csv", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--full-refresh", default=None)
    ap.add_argument("--start-page", type=int, default=1)
    ap.add_argument("--max-pages", type=int, default=None)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("jobsmith-batch").getOrCreate()
    try:
        run(spark, a.pages, a.csv, a.out, full_refresh=a.full_refresh, start_page=a.start_page,
            max_pages=a.max_pages)
        return 0
    except Exception as e:  # noqa: BLE001 - any failure fails the job
        print(f"batch job failed: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())

"""CSV headers: no job for each file, names as the CSV source makes them."""

import gzip

from jobsmith.sources.files import csv_headers, read_postings_csv


def test_headers_of_many_files_take_no_job_a_file(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"f{i:03d}.csv").write_text("job_id,title\n%d,t\n" % i if i % 2 else "title,job_id\nt,%d\n" % i)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = read_postings_csv(spark, str(tmp_path))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before
    assert jobs <= 2  # Spark lists the files of each of the two headers
    assert sorted(int(r["job_id"]) for r in df.where("title = 't'").collect()) == list(range(300))


def test_header_names(spark, tmp_path):
    texts = {"a.csv": 'job_id,,"ti,tle","two\nlines"\n1,2,3,4\n', "b.csv": "﻿a,A,b\n", "c.csv": "", "d.csv": 'q""x,"say ""hi"""\n'}
    for name, t in texts.items():
        (tmp_path / name).write_text(t, encoding="utf-8")
    with gzip.open(tmp_path / "e.csv.gz", "wt") as f:
        f.write("title,job_id\nx,7\n")
    got = csv_headers(spark, [f"file://{tmp_path}/{n}" for n in (*texts, "e.csv.gz")])
    assert got[0] == ("job_id", "_c1", "ti,tle", "two\nlines")
    assert got[1] == ("a0", "A1", "b") and got[2] == () and got[3][1] == 'say "hi"' and got[4] == ("title", "job_id")
    rows = read_postings_csv(spark, f"{tmp_path}/e.csv.gz").collect()
    assert [(r["job_id"], r["title"], r["company"]) for r in rows] == [("7", "x", None)]

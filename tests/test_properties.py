"""Property checks against Python's own semantics (the behaviour to match):
whitespace collapse = re.sub(r"\\s+"), keyword hits = re.search(r"\\b..\\b"),
ISO parsing = datetime.fromisoformat on the accepted grammar."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from jobsmith.functions.dates import with_iso_date
from jobsmith.functions.enrich import with_enrichment
from jobsmith.functions.text import normalize_ws

WS = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", " ", "\x85", "\xa0", " ", " ",
      " ", " ", " ", " ", " ", " ", "　"]
NOT_WS = ["​", "᠎", "﻿", "a", "é", "Z", "9", "_", "-", "+", ".", "ß", "İ", "́"]


def py_ws(s):
    return re.sub(r"\s+", " ", s).strip() if s else ""


def test_whitespace_matches_python(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(WS + NOT_WS) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r["i"]: r["o"] for r in df.select("i", normalize_ws("s").alias("o")).collect()}
    assert [got[i] for i in range(len(texts))] == [py_ws(t) for t in texts]


WORDS = ["sql", "python", "power bi", "postgres", "postgresql", "c++", ".net", "data_eng", "r2d2"]
PIECES = ["sql", "python", "power", "bi", "postgres", "ql", "c++", ".net", "net", "data_eng", "r2d2", "é", "_",
          " ", " ", "\n", ",", ".", "-", "+", "x", "9", "ß", "日本"]


def test_keywords_match_python_word_boundaries(spark):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 12))) for _ in range(500)]
    df = spark.createDataFrame([(i, "", t) for i, t in enumerate(texts)], "i int, t string, d string")
    out = with_enrichment(df, "t", "d", keywords=WORDS, outputs=("skills_extracted",))
    got = {r["i"]: r["skills_extracted"] for r in out.collect()}
    for i, t in enumerate(texts):
        hay = ("\n" + t).strip().lower()
        want = sorted({k for k in WORDS if re.search(r"\b" + re.escape(k) + r"\b", hay)})
        assert got[i] == want, (t, got[i], want)


def iso_samples(rnd, n):
    out = []
    for _ in range(n):
        y, mo, d = rnd.randint(1990, 2030), rnd.randint(1, 12), rnd.randint(1, 31)
        h, mi, s = rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59)
        w, wd = rnd.randint(0, 54), rnd.randint(0, 8)
        date = rnd.choice([f"{y:04d}-{mo:02d}-{d:02d}", f"{y:04d}{mo:02d}{d:02d}", f"{y:04d}-W{w:02d}-{wd}", f"{y:04d}W{w:02d}{wd}",
                           f"{y:04d}-W{w:02d}", f"{y:04d}W{w:02d}"])
        frac = rnd.choice(["", "." + "".join(rnd.choice("0123456789") for _ in range(rnd.randint(1, 9)))])
        time = rnd.choice(["", f"T{h:02d}", f"T{h:02d}:{mi:02d}", f"T{h:02d}:{mi:02d}:{s:02d}{frac}",
                           f" {h:02d}{mi:02d}{s:02d}{frac}"])
        off = rnd.choice(["", "Z", "+05:30", "-0800", "+01", "-18:45", "+05:30:15", "-000001", "+05:30:15.1234567"]) if time else ""
        out.append(date + time + off)
    return out


def py_parse(s):
    try:
        v = dt.datetime.fromisoformat(s.replace("Z", "+00:00"))
    except ValueError:
        return None, None
    v = v if v.tzinfo else v.replace(tzinfo=dt.timezone.utc)
    return v.astimezone(dt.timezone.utc).replace(tzinfo=None), v.isoformat()


def test_iso_parse_matches_python(spark):
    rnd = random.Random(5)
    texts = iso_samples(rnd, 400)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    out = with_iso_date(df, "s", "ts", "iso").select("i", F.col("ts").cast("timestamp_ntz").alias("ts"), "iso")
    got = {r["i"]: (r["ts"], r["iso"]) for r in out.collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_parse(t), t

"""ISO-8601 date parsing that keeps the source offset.

Accepted (as by the upstream parser): ``YYYY-MM-DD`` or ``YYYYMMDD``, or an ISO week date
``YYYY-Www-D``, ``YYYYWwwD`` (without the day: its Monday), optionally
followed by any one separator character and a time ``HH``, ``HH:MM``,
``HH:MM:SS``, ``HH:MM:SS.f+`` (``.`` or ``,``), or the basic forms ``HHMM``,
``HHMMSS``, ``HHMMSS.f+``; an optional offset ``+HH``, ``+HHMM``, ``+HH:MM``, ``+HHMMSS.f+``, ``+HH:MM:SS.f+`` of
less than a day (minutes and seconds up to 59), with a blank before it at most; ``Z`` means UTC; a naive value is UTC. Anything else,
or an impossible date, is NULL. Fractions beyond microseconds are truncated.

``with_iso_date`` adds the instant (TIMESTAMP) and/or Python's
``isoformat()`` of the aware value *with the original offset*, which is part of
the content key of URL-less postings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith.functions.text import as_col, strip_ws

# group 1 date | 2 hour | 3,4,5 min/sec/frac (extended) | 6,7,8 (basic) | 9 offset
# A blank may stand before the offset unless a fraction does (texts are stripped, so none can end one).
def _core(date: str, offset: str) -> str:
    return ("(" + date + r")"
            r"(?:[\s\S](\d{2})"
            r"(?::(\d{2})(?::(\d{2})(?:[.,](\d+)|\s)?|\s)?|(\d{2})(?:(\d{2})(?:[.,](\d+)|\s)?|\s)?|\s)?"
            "(" + offset + r")?)?")


DATE = r"\d{4}-\d{2}-\d{2}|\d{8}"
ISO_CORE = _core(DATE, r"[+-]\d{2}(?::?\d{2})?")  # calendar dates and offsets of minutes, without lookaheads
# A digit after the week is its day unless it begins the time: a dash and two digits are a separator and an hour; a run
# of digits after a basic week holds a day if it is one digit or an even number of them.
WEEK_DATE = r"\d{4}-W\d{2}(?:-\d(?!\d))?+|\d{4}W\d{2}(?:\d(?=(?:\d(?:\d\d)*)?(?!\d)))?+"
OFFSET = r"[+-]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
# Always matches the whole text: an ISO text fills the groups, anything else
# matches the second branch and leaves every group empty.
ISO_ANY = r"(?s)^" + _core(DATE + "|" + WEEK_DATE, OFFSET) + r"\z|^.*\z"
# 'date|hh|mm|ss|frac|offset'; groups that did not take part expand to ''.
CANONICAL = "$1|$2|$3$6|$4$7|$5$8|$9"


def _week_day(d: Column) -> Column:
    """``YYYYWww[D]`` -> calendar date text; NULL if there is no such week or day."""
    year, week, day = F.substring(d, 1, 4), F.substring(d, 6, 2).cast("int"), F.substring(F.concat(d, F.lit("1")), 8, 1).cast("int")
    monday = F.date_add(F.date_trunc("week", F.concat(year, F.lit("-01-04")).try_cast("timestamp")).cast("date"), (week - 1) * 7)
    on = F.date_add(monday, day - 1)
    return F.when((F.weekofyear(monday) == week) & day.between(1, 7) & (F.year(on) <= 9999), on.cast("string"))


UTC = "0" * 12


def _calendar(a: Column) -> Column:
    """Canonical parts -> struct: date as ``YYYY-MM-DD`` (of a basic or week date too), offset as the digits
    HHMMSSffffff, local time, microseconds and the sign of the offset."""
    def part(i: int) -> Column:
        return F.coalesce(F.nullif(a[i], F.lit("")), F.lit("00"))

    d = a[0]
    date = F.when(d.contains("W"), _week_day(F.replace(d, F.lit("-"), F.lit("")))) \
        .when(F.length(d) == 8, F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))).otherwise(d)
    off = F.when(a[5] == "", F.lit(UTC)).otherwise(F.rpad(F.substring(F.translate(a[5], "+-:.,", ""), 1, 12), 12, "0"))
    return F.struct(F.when((d != "") & ~d.startswith("0000"), date).alias("date"), off.alias("off"),
                    F.concat(F.lit("T"), part(1), F.lit(":"), part(2), F.lit(":"), part(3)).alias("time"),
                    F.rpad(F.substring(a[4], 1, 6), 6, "0").alias("frac"), a[5].startswith("-").alias("west"))


def _instant(x: Column) -> Column:
    """struct of ``_calendar`` -> struct(ts TIMESTAMP, NULL if invalid; the parts of its text)."""
    off, frac = x["off"], x["frac"]
    local = F.concat(x["date"], x["time"])
    is_utc = off.startswith("000000")  # whatever its fraction
    hour, minute, second, micro = (F.substring(off, i, n) for i, n in ((1, 2), (3, 2), (5, 2), (7, 6)))
    east = ((hour.cast("long") * 60 + minute.cast("long")) * 60 + second.cast("long")) * 1_000_000 + micro.cast("long")
    utc = F.concat(local, F.lit("."), frac, F.lit("+00:00")).try_cast("timestamp")
    ts = F.when(is_utc, utc).when((hour <= "23") & (minute <= "59") & (second <= "59"), F.timestamp_micros(
        F.unix_micros(utc) - F.when(x["west"], -east).otherwise(east)))
    off_txt = F.when(is_utc, F.lit("+00:00")).otherwise(F.concat(
        F.when(x["west"], F.lit("-")).otherwise(F.lit("+")), hour, F.lit(":"), minute,
        F.when(off.endswith("00000000"), F.lit("")).otherwise(F.concat(F.lit(":"), second)),
        F.when(off.endswith("000000"), F.lit("")).otherwise(F.concat(F.lit("."), micro))))
    return F.struct(ts.alias("ts"), local.alias("local"), frac.alias("frac"), off_txt.alias("off"))


def _format(x: Column) -> Column:
    """struct of ``_instant`` -> struct(ts TIMESTAMP, iso STRING) (both NULL if invalid)."""
    frac = F.when(x["frac"] != "000000", F.concat(F.lit("."), x["frac"])).otherwise(F.lit(""))
    return F.struct(x["ts"].alias("ts"), F.when(x["ts"].isNotNull(), F.concat(x["local"], frac, x["off"])).alias("iso"))


def parse_iso(raw: Column | str) -> Column:
    """struct(ts, iso) of an ISO-8601 text.

    One linear chain (strip -> 'Z' as '+00:00' -> one regexp_replace -> split),
    then the formatting in three lambdas, each binding what the next uses often: every step reads its input once, so
    predicate pushdown and projection collapsing cannot multiply the regex work.
    ('Z' can be replaced everywhere: a bare 10-character date holding a 'Z'
    is invalid either way.)
    """
    s1 = F.replace(strip_ws(as_col(raw).cast("string")), F.lit("Z"), F.lit("+00:00"))
    parts = F.split(F.regexp_replace(s1, ISO_ANY, CANONICAL), r"\|")
    return F.transform(F.transform(F.transform(F.array(parts), _calendar), _instant), _format)[0]


def parse_ts(raw: Column | str) -> Column:
    """Instant of an ISO-8601 text, NULL when it does not parse."""
    return parse_iso(raw)["ts"]


def iso_text(raw: Column | str) -> Column:
    """``isoformat()`` of the parsed value with its source offset, NULL when unparseable."""
    return parse_iso(raw)["iso"]


def with_iso_date(df: DataFrame, raw: Column | str, ts: str | None = "publication_date",
                  iso: str | None = None, tmp: str = "_dt") -> DataFrame:
    """Add the parsed instant (``ts``) and/or its ISO text (``iso``) of ``raw``."""
    df = df.withColumn(tmp, parse_iso(raw))
    if iso:
        df = df.withColumn(iso, F.col(tmp)["iso"])
    if ts:
        df = df.withColumn(ts, F.col(tmp)["ts"])
    return df.drop(tmp)


def utc_iso_text(ts: Column | str) -> Column:
    """``isoformat()`` of a UTC instant (session time zone must be UTC)."""
    t = as_col(ts)
    micros = F.unix_micros(t.cast("timestamp")) % 1000000
    return F.when(t.isNotNull(), F.concat(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit("")),
        F.lit("+00:00")))


def day_of(ts: Column | str) -> Column:
    """Calendar day in the session time zone (UTC)."""
    return F.to_date(as_col(ts))


# Sentinel used to sort missing dates last under a descending order.
SENTINEL_TS = "0001-01-01 00:00:00"


def sentinel_desc(ts: Column | str) -> Column:
    return F.coalesce(as_col(ts).cast("timestamp"), F.lit(SENTINEL_TS).cast("timestamp")).desc()

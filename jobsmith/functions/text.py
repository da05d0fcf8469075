"""String scalars as native Column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set: Unicode White_Space plus the four information
# separators U+001C..U+001F. ``(?U)`` makes Java's \s Unicode-aware.
WS_CLASS_JAVA = r"[\s\x1c-\x1f]"
WS_RUN_JAVA = r"(?U)" + WS_CLASS_JAVA + "+"
EDGE_WS_JAVA = r"(?U)^" + WS_CLASS_JAVA + "+|" + WS_CLASS_JAVA + "+$"
# The same class for RE2 (DuckDB), whose \s is ASCII only.
WS_CLASS_RE2 = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"

# A "word" character as in Python's Unicode \w: letters, numbers, underscore.
WORD_CHAR = r"[\p{L}\p{N}_]"
NON_WORD_CHAR = r"[^\p{L}\p{N}_]"
_REGEX_SPECIAL = set("\\.^$|?*+()[]{}")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_ws(c: Column | str) -> Column:
    """NULL/empty -> ''; collapse every whitespace run to one space; strip."""
    s = F.coalesce(as_col(c).cast("string"), F.lit(""))
    return F.trim(F.regexp_replace(s, WS_RUN_JAVA, " "))


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(as_col(c), EDGE_WS_JAVA, "")


def empty_to_null(c: Column | str) -> Column:
    """``value or None`` for strings."""
    return F.nullif(as_col(c), F.lit(""))


def lower_contains(c: Column | str, needle: str) -> Column:
    return F.lower(F.coalesce(as_col(c), F.lit(""))).contains(needle.lower())


def text_concat(title: Column | str, description: Column | str) -> Column:
    """Lower-cased ``title + '\\n' + description`` haystack used by the rules."""
    return F.lower(F.concat(F.coalesce(as_col(title), F.lit("")), F.lit("\n"),
                            F.coalesce(as_col(description), F.lit(""))))


def escape_regex(s: str) -> str:
    return "".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in s)


def _is_word_char(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def word_pattern(needles: list[str], dialect: str = "java") -> str:
    """Regex that is true when any needle occurs between ``\\b`` boundaries.

    ``\\b`` is resolved per needle: a needle that starts (ends) with a word
    character needs a non-word character or the text edge before (after) it; one
    that starts (ends) with a non-word character needs a word character there.
    Java gets look-arounds; RE2 (no look-around) consumes the neighbour, which
    is equivalent for a yes/no test.
    """
    alts = []
    for n in needles:
        body = escape_regex(n)
        first_w, last_w = _is_word_char(n[0]), _is_word_char(n[-1])
        if dialect == "java":
            pre = f"(?<!{WORD_CHAR})" if first_w else f"(?<={WORD_CHAR})"
            post = f"(?!{WORD_CHAR})" if last_w else f"(?={WORD_CHAR})"
        else:
            pre = f"(^|{NON_WORD_CHAR})" if first_w else WORD_CHAR
            post = f"($|{NON_WORD_CHAR})" if last_w else WORD_CHAR
        alts.append(pre + body + post)
    if dialect == "java":
        return "(?:" + "|".join(alts) + ")" if len(alts) > 1 else alts[0]
    return "|".join(f"({a})" for a in alts) if len(alts) > 1 else alts[0]


def contains_word(hay: Column, needles: list[str]) -> Column:
    """Whole-word test; a plain substring test runs first, so the regex only
    scans texts that contain one of the needles at all."""
    low = [n.lower() for n in needles]
    return F.when(contains_any(hay, low), hay.rlike(word_pattern(low))).otherwise(F.lit(False))


def contains_any(hay: Column, needles: list[str]) -> Column:
    cond = None
    for n in needles:
        c = hay.contains(n.lower())
        cond = c if cond is None else (cond | c)
    return cond if cond is not None else F.lit(False)


def cast_or_null(c: Column | str) -> Column:
    """``str(x or '') or None`` for a string column: '' -> NULL."""
    return F.nullif(as_col(c).cast("string"), F.lit(""))


def truthy_text(c: Column | str) -> Column:
    """Row-level truthiness of a CSV cell (NULL -> false).

    true/True/TRUE -> true, false/False/FALSE -> false, a number -> non-zero,
    any other non-empty text -> true.
    """
    v = F.trim(as_col(c))
    num = v.try_cast("double")
    return (F.when(v.isNull(), F.lit(False))
            .when(v.isin("true", "True", "TRUE"), F.lit(True))
            .when(v.isin("false", "False", "FALSE"), F.lit(False))
            .when(num.isNotNull(), num != 0)
            .otherwise(v != ""))

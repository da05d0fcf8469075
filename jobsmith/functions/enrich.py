"""Rule-based enrichment as Column expressions.

Keywords are whole-word matches on the lower-cased ``title\\ndescription``;
roles are ordered substring rules; seniority levels are ordered whole-word rules.

A keyword made only of word characters matches between ``\\b`` boundaries
exactly when it is one of the text's maximal word-character runs, so the text
is tokenised once (``split`` on non-word runs) and such keywords are found by
set intersection: one linear pass per row however large the dictionary. Only
keywords with inner non-word characters (``power bi``) fall back to a regex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsmith import rules as R
from jobsmith.functions.text import NON_WORD_CHAR, WORD_CHAR, _is_word_char, contains_any, contains_word, text_concat

TOKEN_SPLIT = NON_WORD_CHAR + "+"


def is_plain_word(s: str) -> bool:
    return bool(s) and all(_is_word_char(ch) for ch in s)


def tokens(hay: Column) -> Column:
    """Maximal word-character runs of ``hay`` (may contain '' at the edges)."""
    return F.split(hay, TOKEN_SPLIT)


def extract_keywords(hay: Column, toks: Column, keywords: list[str] | None = None) -> Column:
    """Sorted distinct keywords found as whole words in ``hay`` (never NULL)."""
    kws = sorted({k.lower() for k in (R.SKILL_KEYWORDS if keywords is None else keywords)})
    words = [k for k in kws if is_plain_word(k)]
    phrases = [k for k in kws if not is_plain_word(k)]
    parts = []
    if words:
        parts.append(F.array_intersect(toks, F.array(*[F.lit(w) for w in words])))
    if phrases:
        parts.append(F.array_compact(F.array(*[F.when(contains_word(hay, [k]), F.lit(k)) for k in phrases])))
    if not parts:
        return F.array().cast("array<string>")
    merged = parts[0] if len(parts) == 1 else F.array_distinct(F.concat(*parts))
    return F.sort_array(merged)


RUNS = f"{WORD_CHAR}+|{NON_WORD_CHAR}+"


def joined_runs(df: DataFrame, width: int) -> DataFrame:
    """Add ``wide``: for every place of ``runs`` the text of the ``width`` runs from there on, fewer at the end.

    Texts of twice the runs come from the whole array set against itself (a ``slice`` a place reads the array anew
    each time); every step is a column of its own, so the next reads it twice without computing it twice."""
    def put(shifted: Column) -> Column:
        return F.zip_with("wide", shifted, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))

    df, have = df.withColumn("wide", F.col("runs")), 1
    for bit in bin(width)[3:]:
        df, have = df.withColumn("wide", put(F.slice("wide", have + 1, F.size("wide")))), 2 * have
        if bit == "1":
            df, have = df.withColumn("wide", put(F.slice("runs", have + 1, F.size("runs")))), have + 1
    return df


def extract_keywords_table(docs: DataFrame, keywords: DataFrame, hay: Column, *, id_col: str = "doc_id",
                           keyword_col: str = "keyword", out: str = "skills_extracted") -> DataFrame:
    """(id, sorted distinct keywords found as whole words) for dictionaries too large to be literals of a plan.

    A text is cut into alternating runs of word and other characters. A keyword holds between ``\\b`` boundaries
    exactly where its own runs are consecutive runs of the text and a run of other characters that it begins or ends
    with does not touch the text's edge, so such edge runs are cut off. Places whose run begins some keyword (an
    equi-join to the first runs) offer the joined runs of each length that such a keyword has, and those are
    equi-joined to the keywords. Places alike up to the longest keyword's runs count once in a text; what is shuffled
    grows with the text times that length.

    Null and empty texts have none, null and empty keywords are left out, repeated ones count once; rows of
    one id are one document; a table without keywords gives empty lists."""
    k = keywords.select(F.lower(F.col(keyword_col)).alias("gram")).where("gram <> ''").distinct() \
        .withColumn("runs", F.regexp_extract_all("gram", F.lit(RUNS), 0)) \
        .select("gram", F.col("runs")[0].alias("first"), F.size("runs").alias("n"))
    lengths = sorted(r.n for r in k.select("n").distinct().collect())  # at most the longest keyword's runs
    ids = docs.select(F.col(id_col).alias("id"))
    if not lengths:
        return ids.distinct().select(F.col("id").alias(id_col), F.array().cast("array<string>").alias(out))
    runs = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(F.lower(hay), F.lit(RUNS), 0).alias("runs")) \
        .select("id", F.filter("runs", lambda r, i: (i > 0) & (i < F.size("runs") - 1) | r.rlike(f"^{WORD_CHAR}")).alias("runs"))
    # a place is its widest text: strings are told apart by hash, structs and arrays by comparing each with each
    places = joined_runs(runs, lengths[-1]).select("id", F.explode(F.array_distinct("wide")).alias("wide")) \
        .select("id", "wide", F.regexp_extract("wide", f"^(?:{RUNS})", 0).alias("first"))
    firsts = k.groupBy("first").agg(F.collect_set("n").alias("ns"))
    grams = places.join(firsts, "first").select("id", "ns", F.regexp_extract_all("wide", F.lit(RUNS), 0).alias("runs")) \
        .select("id", F.explode(F.transform("ns", lambda n: F.array_join(F.slice("runs", 1, n), ""))).alias("gram"))
    found = grams.join(k.select("gram"), "gram").select("id", "gram")
    return found.unionByName(ids.select("id", F.lit(None).cast("string").alias("gram"))) \
        .groupBy("id").agg(F.sort_array(F.collect_set("gram")).alias("found")) \
        .select(F.col("id").alias(id_col), F.col("found").alias(out))


def _word_hit(hay: Column, toks: Column, needles: list[str]) -> Column:
    words = [n.lower() for n in needles if is_plain_word(n)]
    phrases = [n.lower() for n in needles if not is_plain_word(n)]
    cond = None
    if words:
        cond = F.arrays_overlap(toks, F.array(*[F.lit(w) for w in words]))
    if phrases:
        c = contains_word(hay, phrases)
        cond = c if cond is None else (cond | c)
    return F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(False)


def classify_first_match(hay: Column, rules: list[tuple[str, list[str]]] | None = None,
                         default: str = R.ROLE_DEFAULT) -> Column:
    """First label whose needles occur as substrings."""
    chain = None
    for label, needles in (R.ROLE_RULES if rules is None else rules):
        cond = contains_any(hay, needles)
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def classify_word_match(hay: Column, toks: Column, rules: list[tuple[str, list[str]]] | None = None,
                        default: str = R.SENIORITY_DEFAULT) -> Column:
    """First label whose needles occur as whole words."""
    chain = None
    for label, needles in (R.SENIORITY_RULES if rules is None else rules):
        cond = _word_hit(hay, toks, needles)
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def with_enrichment(df: DataFrame, title: Column | str, description: Column | str, *, keywords=None,
                    role_rules=None, seniority_rules=None, outputs=("skills_extracted", "role_type",
                                                                    "seniority_level")) -> DataFrame:
    """Add skills_extracted, role_type and seniority_level.

    Staged: the haystack and its tokens are materialised once per row, then the
    three rule tables read them.
    """
    df = df.withColumn("_hay", text_concat(title, description))
    df = df.withColumn("_tok", tokens(F.col("_hay")))
    hay, toks = F.col("_hay"), F.col("_tok")
    cols = {
        "skills_extracted": extract_keywords(hay, toks, keywords),
        "role_type": classify_first_match(hay, role_rules),
        "seniority_level": classify_word_match(hay, toks, seniority_rules),
    }
    return df.withColumns({k: v for k, v in cols.items() if k in outputs}).drop("_hay", "_tok")

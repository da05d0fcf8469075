"""Merkle manifest, chat formatting and prefix trie against brute force: nulls, empty and long texts, ties, repeats,
clashing columns, empty tables."""

import hashlib
import random
import zlib

import duckdb
import pytest
import xxhash

from jobsmith.llm import chat_format, merkle_manifest, prefix_trie, queries
from jobsmith.llm.common import Stored

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def taken(df, cols):
    return in_order(tuple(r[c] for c in cols.split()) for r in df.collect())


# --- Merkle manifest

REPORT = "doc_id leaf subroot root proof_sha256 folded_root verified"
DOCS = "doc_id long, source string, lang string, n_chars long, text string, pos long, digest string, path string, g int"


def spell(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(level):
    """Root of the digests, and each one's siblings (left, right) from below."""
    paths, under = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        for i in range(len(level)):
            run, slot = level[i - i % 3:i - i % 3 + 3], i % 3
            for j in under[i]:
                paths[j].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        under = [sum(under[i:i + 3], []) for i in range(0, len(level), 3)]
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute_manifest(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted(((r[0] is not None, r[0] or 0, sha("".join(map(spell, r))), r) for r in rows if r[1] == s),
                     key=lambda x: x[:3]) for s in sources]
    trees = [tree([leaf for _, _, leaf, _ in g]) for g in groups]
    root, tops = tree([sub for sub, _ in trees]) if trees else ("", [])
    out = []
    for g, (sub, paths), top in zip(groups, trees, tops):
        for (_, _, leaf, r), path in zip(g, paths):
            text = r[4]
            if None not in (r[0], text) and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = sha("".join(map(spell, (*r[:4], text))))
            for a, b in path + top:
                now = sha(a + now + b)
            out.append((r[0], leaf, sub, root, sha("".join(a + b for a, b in path + top)), now, now == root))
    return in_order(out)


@pytest.mark.parametrize("n", [0, 1, 4, 2500])
def test_manifest_equals_brute_force(spark, n):
    rng = random.Random(n)
    names = [None, "", "é", "z", "b", *["hot"] * 9, *[f"s{i}" for i in range(n // 80)]]
    rows = [(rng.choice([i, i, i, None, 7]), rng.choice(names), rng.choice(["en", None, ""]), rng.choice([None, 5]),
             rng.choice([None, "", "a\nb", "x🙂\n" * 40_000 if i == 9 else "x\n"])) for i in range(n)]
    rows += rows[:2]
    got = merkle_manifest.tamper_report(spark.createDataFrame([(*r, 1, "d", "p", 2) for r in rows], DOCS))
    assert taken(got, REPORT) == brute_manifest(rows)


def test_manifest_deals_one_group_over_many_windows(spark):
    """One group of over 729 * 3 rows: several stages, places without a gap, every proof folds to the root."""
    rows = spark.range(2300).selectExpr("id AS doc_id", "'one' AS source", "CAST(id AS string) AS text")
    placed = merkle_manifest.positions(rows, "source", ["doc_id"])
    assert taken(placed, "doc_id pos n") == in_order((i, i, 2300) for i in range(2300))
    m = merkle_manifest.manifest(rows, merkle_manifest.leaf(rows.text), "source", "doc_id")
    folded = m.select(merkle_manifest.fold(m.leaf, "path").alias("f"), "root", "subroot")
    assert folded.distinct().count() == 1 and folded.where("f = root AND root = subroot").count() == 2300


# --- Chat formatting

BITS = [*chat_format.CONTROL, "<", "\\", "[", "s>", "/INST]", " ", "\n", "x", "é", "🙂", "<\\s>", "[\\\\INST]", "<|ro", "le|>"]
TURNS = "conv_id long, turn long, role string, text string, c string, part long, h long, place int"


def scraps(rng, most):
    return "".join(rng.choice(BITS) for _ in range(rng.randrange(most)))


def test_grammar_round_trip_on_control_strings():
    rng = random.Random(5)
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "", scraps(rng, 4), "tool"]), scraps(rng, 9))
                 for _ in range(rng.randrange(7))]
        text, spans = chat_format.write_turns(turns)
        assert [(r, t) for r, t, *_ in chat_format.parse(text)] == turns
        assert [chat_format.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
        t = scraps(rng, 12)
        assert chat_format.unescape(chat_format.escape(t)) == t


def test_grammar_leaves_clean_text_alone_and_refuses_others():
    assert chat_format.write_turns([("user", "a < b \\ c"), ("assistant", "")]) == ("[INST] a < b \\ c [/INST]  </s>", [(25, 25)])
    for bad in ("x", "[INST] a", "[INST] a</s>", "[INST] a <s> [/INST]", "<|role|>user<|text|>a<|end|>", " a </s> b"):
        with pytest.raises(chat_format.NotInGrammar):
            chat_format.parse(bad)


def text_hash(t):
    x = xxhash.xxh64_intdigest(t.encode(), 42)
    return x - (1 << 64) if x >> 63 else x


def ordered(rows, tie):
    convs = {}
    for c, k, role, text in rows:
        convs.setdefault(c, []).append((k is not None, k or 0, role or "", tie(role or "", text or ""), role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(x)] for c, x in convs.items()}


def turn_rows(n, seed=3):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(n // 4 + 1)]), rng.choice([i, i, i, None, 1]), rng.choice(["user", "assistant", "system", None, "tool"]),
             rng.choice([None, "", "hi", "ok", scraps(rng, 6), "long é" * 30_000 if i == 7 else "z"])) for i in range(n)]
    return rows + rows[:3]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_chat_digest_equals_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(chat_format, "PART_CHARS", 60)
    rows = turn_rows(n)
    parts = Stored(chat_format.format_chat(spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], TURNS)), "chat").df
    want = []
    for c, turns in ordered(rows, lambda r, t: text_hash(t)).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    assert taken(chat_format.digest(parts), "conv_id n_turns turns_sha256 loss_chars loss_sha256") == in_order(want)
    chars = {r["conv_id"]: r["formatted_chars"] for r in chat_format.digest(parts).collect()}
    whole = {}
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["text"]
    assert chars == {c: len(t) for c, t in whole.items()}
    back = {}
    for r in sorted(chat_format.read_chat(parts).collect(), key=lambda r: (r["part"], r["place"])):
        back.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert r["trained"] == (r["role"] == "assistant")
    assert back == ordered(rows, lambda r, t: text_hash(t))


# --- Prefix trie

NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"


def brute_trie(convs):
    members, kids = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for s in members:
        if s:
            kids.setdefault(s[:-1], []).append(s)

    def leaves(s):
        return sum(map(leaves, kids[s])) if s in kids else 1

    def saved(s):
        return (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0) + sum(map(saved, kids.get(s, [])))
    return in_order((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids.get(s, [])), leaves(s), saved(s),
                     sha(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(s)))))) for s, m in members.items())


@pytest.mark.parametrize("n", [0, 1, 60, 900])
def test_trie_equals_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    rows = turn_rows(n, seed=n)
    own = ordered([r for r in rows if r[0] is not None], lambda r, t: sha(f"{len(r.encode())}:{r}{t}"))
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    convs = {c: own.get(c - c % 5, [])[:h[c]] + turns[h[c]:] for c, turns in own.items()}
    df = spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], TURNS)
    assert taken(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(df))), NODE) == brute_trie(convs)


def test_trie_of_copies_and_of_turnless_conversations(spark):
    same = [(c, k, "user", f"t{k}") for c in range(40) for k in range(3)]
    convs = {c: [("user", f"t{k}") for k in range(3)] for c in range(40)}
    seq = prefix_trie.sequences(spark.createDataFrame(same, "conv_id long, turn long, role string, text string"))
    empty = seq.selectExpr("conv_id + 100 AS conv_id", "slice(turns, 1, 0) AS turns").where("conv_id < 105")
    got = prefix_trie.trie(seq.unionByName(empty))
    assert taken(got, NODE) == brute_trie(convs | {c: [] for c in range(100, 105)})


# --- the registered queries against their SQL

@pytest.mark.parametrize("name, cols", [("op11_merkle_manifest", REPORT), ("op13_prefix_trie", NODE),
                                        ("op12_chat_format", "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars")])
def test_query_equals_its_sql(spark, name, cols):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(f"SELECT {cols.replace(' ', ', ')} FROM ({queries.SQL[name]})").fetchall()
    assert taken(queries.QUERIES[name](spark, SF), cols) == in_order(want)

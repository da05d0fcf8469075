"""Operators on texts against brute force: nulls, empty texts, repeats, ties, clashing columns, empty tables."""

import collections
import os
import random
import re
import threading
import time
import zlib

import numpy as np
import psutil
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from jobsmith.llm import common, decontaminate, license_scan, lm_score, sentencepiece_lattice, simhash, token_binary
from jobsmith.session import scratch_path

SCHEMA = "doc_id long, text string, id long, t string, h long, fp long, lang string, source string, n_chars long"
TEXTS = [None, "", " \n\t", "One two three four five six.", "One two three four five six.", "ÉCOLE l'été — 你好 🙂 x² 3.14",
         "Licensed under CC BY-NC 4.0.\nAll rights reserved.", "general public license " * 40, "a b\x0bc", "It's don't 's"]


def docs(spark, texts=TEXTS, ids=None):
    """Rows with columns whose names the operators use themselves."""
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, "en", "s", 4) for i, t in zip(ids, texts)], SCHEMA)


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def by_id(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_words_of_bytes():
    rng = random.Random(1)
    alphabet = "aZ09é你🙂 .,\n\t`{\x7f\x80_@["
    for _ in range(300):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert [w.decode() for w in common.words(t)] == words(t)


def test_license_digest_equals_brute_force(spark):
    rows = license_scan.license_scan(docs(spark)).collect()
    assert len(rows) == len(TEXTS)
    for r, t in zip(sorted(rows, key=lambda r: r["doc_id"]), TEXTS):
        ws = words(t)
        places = [(i, label) for phrase, label in license_scan.BASE.items() for i in range(len(ws))
                  if ws[i:i + len(phrase.split())] == phrase.split()]
        firsts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(ws), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(firsts), max(firsts)) if firsts else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert license_scan.license_scan(docs(spark, [])).count() == 0


def test_license_rules_resolve_by_priority_and_containment():
    assert len(license_scan.rules()) > 300
    found = license_scan.detect(b" ".join(common.words("Licensed under the GNU General Public License, version 3")))
    assert {"gpl", "gpl-3"} <= {d.label for d in found}
    assert [d.label for d in license_scan.resolve(found)] == ["gpl-3"]
    make = lambda a, b, p: license_scan.Detection(a, b, f"{a}-{b}", p, 1.0, False)
    rng = random.Random(3)
    for _ in range(200):
        ds = [make(a := rng.randrange(12), a + rng.randrange(5), rng.randrange(3)) for _ in range(rng.randrange(9))]
        kept = []
        for d in sorted(ds, key=lambda d: (d.priority, d.first - d.last, d.first)):
            if not any(k.first <= d.first and d.last <= k.last for k in kept):
                kept.append(d)
        assert license_scan.resolve(ds) == sorted(kept, key=lambda d: (d.first, d.last))


def test_every_rule_match_holds_a_keyword():
    for text in ["spdx license identifier apache 2 0", "released under the mit license", "cc by sa 4 0 international",
                 "this program is free software you can redistribute it and or modify it", "creative commons zero"]:
        held = {k for k in {k for r in license_scan.rules() for k in r.keywords} if k in text}
        for r in license_scan.rules():
            assert not r.pattern.search(text.encode()) or not held.isdisjoint(r.keywords), (text, r.label)


def test_simple8b_round_trip():
    rng = np.random.default_rng(4)
    for _ in range(200):
        lists = [rng.integers(0, rng.choice([2, 9, 300, 70_000, 2**40]), rng.integers(0, 90), dtype=np.uint64)
                 for _ in range(rng.integers(1, 5))]
        if len(lists[0]) > 3:
            lists[0][2:4] = 2**63 + 5, 2**60   # escapes
        for ids, coded in zip(lists, token_binary.encode_many(lists)):
            assert (token_binary.decode(coded) == ids).all()
            offsets = token_binary.word_offsets(coded, 1)
            assert len(offsets) == len(coded) and (len(ids) == 0 or offsets[0] == 0)
            for stride in (1, 2, 5) if len(ids) else ():
                first = int(rng.integers(0, len(ids)))
                n = int(rng.integers(0, len(ids) - first + 1))
                part = token_binary.decode_span(coded, token_binary.word_offsets(coded, stride), first, n, stride)
                assert (part == ids[first:first + n]).all() and len(part) == n


def test_chosen_documents_are_read_from_the_offset_before_them(spark):
    path, files = public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "token-files")
    rng = random.Random(3)
    words = ["ore", "vent", "salt", "quay", "zzyx", "lamp,", "né."]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 40, 9000]))) for _ in range(60)]
    token_binary.write_tokens(docs(spark, texts, [*range(58), 5, None]), files, path, shards=2)
    whole = [tuple(r) for r in token_binary.read_tokens(spark, files).collect()]
    assert max(len(r[3]) for r in whole) > 4 * token_binary.STRIDE and len(whole) == 60
    chosen = spark.createDataFrame([(i,) for i in (5, 5, 0, 57, 33, 999, None)], "doc_id long")
    got = [tuple(r) for r in token_binary.read_chosen(spark, files, chosen).collect()]
    assert sorted(got) == sorted(r for r in whole if r[1] in (0, 5, 33, 57)) and len(got) == 5
    assert token_binary.read_chosen(spark, files, chosen.limit(0)).count() == 0


def test_token_digest_equals_library(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    ids = [7, 3, 11, 3, 9, 12, 20, 4, 5, 6]   # not ascending, one twice
    texts = TEXTS + ["<|endoftext|> a", "foo< ̸bar ΟΔΟΣ İstanbul ſ", "x" * 3000 + " ok"]
    ids += [30, 31, 32]
    got = {(r["doc_id"], r["ids_crc32"]): (r["start"], r["n_tokens"]) for r in
           token_binary.token_digest(docs(spark, texts, ids), path).collect()}
    start, n = 0, 0
    expect = collections.defaultdict(list)
    for i, t in zip(ids, texts):
        expect[i].append(np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))
    for i in sorted(expect):
        sizes = sorted(len(x) for x in expect[i])
        for x in expect[i]:
            assert got[i, zlib.crc32(x.tobytes())][1] == len(x)
            if len(expect[i]) == 1:
                assert got[i, zlib.crc32(x.tobytes())][0] == start
            n += 1
        start += sum(sizes)
    assert n == len(texts) == len(got)
    assert token_binary.token_digest(docs(spark, []), path).count() == 0


def test_token_encoder_equals_library_where_punctuation_meets_symbols_and_marks():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, ours = Tokenizer.from_file(path), token_binary.Encoder(path)
    texts = ["dogs', and", "the dogs'.", "20°: x", "“no”.", "e\u0301\u0323. İ. \u0958! ½, ²; x\u2003. 'S. O'R, ﬁ."]
    rng = random.Random(13)
    alphabet = "aZsé9.,!'\"“”°€½²İΣ你\u0958\u0301\u0338\u1161\u11a8ᄀ🙂\u200d\u00a0\u2003\u0085 \n-<"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 25))) for _ in range(20_000)]
    for t in texts:
        assert ours.text(t).tolist() == library.encode(t, add_special_tokens=False).ids, ascii(t)


def plain_simhash(text, k=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not ws:
        return 0
    k = min(k, len(ws))
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i:i + k]).encode(), 42) for i in range(len(ws) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_components_equal_brute_force(spark):
    rng = random.Random(5)
    base = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(400)]
    texts = list(TEXTS)
    for _ in range(120):   # a large group of near copies, beyond the size of a hot block
        t = list(base)
        t[rng.randrange(400)] = "other"
        texts.append(" ".join(t))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    fps = [plain_simhash(t) for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    assert got == {i: (f"{fps[i]:016x}", label[i]) for i in range(len(texts))}
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [2, 64])
def test_simhash_links_equal_all_pairs(spark, hot):
    rng = random.Random(6)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {(r["a"], r["b"]) for r in simhash.links(df, 2, hot_block=hot).collect()}
    assert got == {(a, b) for a in signed for b in signed if a > b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


def test_connected_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(i, i + 1) for i in range(200, 240)]
    edges += [(500, x) for x in range(501, 560)] + [(7, 7)]
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    assert {r["id"]: r["component"] for r in common.connected_components(df).collect()} == label
    assert common.connected_components(df.limit(0)).count() == 0


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return row[-1]
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(70))] for _ in "ab")
        assert decontaminate.edit_distance(a, b, 99) == plain(a, b)
        assert decontaminate.edit_distance(a, b, 3) == min(4, plain(a, b))


VOCABULARY = [f"w{i}" for i in range(400)]


def passages(rng, n, words_):
    return [[rng.choice(VOCABULARY) for _ in range(words_)] for _ in range(n)]


def test_leaks_are_found_and_exact(spark):
    rng = random.Random(9)
    items = passages(rng, 30, 20) + passages(rng, 30, 45)
    texts, planted = [None, "", "short text"], set()
    for i, item in enumerate(items):
        for edits in range(0, int(0.2 * len(item)) + 1):
            leak = list(item)
            for _ in range(edits):
                p = rng.randrange(len(leak))
                kind = rng.randrange(3)
                leak[p:p + 1] = [["new"], [], [leak[p], "ins"]][kind]
            pad = lambda: [rng.choice(VOCABULARY + ["zz"] * 200) for _ in range(60)]
            planted.add((len(texts), i, edits))
            texts.append(" ".join(pad() + leak + pad()).upper())
    clean = len(texts)
    texts += [" ".join(p) for p in passages(rng, 20, 200)]
    bench = spark.createDataFrame([(i, ", ".join(x)) for i, x in enumerate(items)] + [(900, None), (901, "too short")],
                                  "item_id long, text string")
    rows = decontaminate.leaks(docs(spark, texts), bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert all(d < clean for d, _ in got)
    assert {(d, i) for d, i, e in planted if e == 0} <= got          # exact passages always
    within = {(d, i) for d, i, _ in planted for ws in [words(texts[d])] for n in [len(items[i])] for most in [int(0.2 * n)]
              if any(decontaminate.edit_distance(items[i], ws[s:s + n], most) <= most for s in range(40, 80))}
    assert len(within) > 300 and len(within & got) >= 0.9 * len(within)
    for r in rows:
        window = words(texts[r["doc_id"]])[r["first_word"]:r["first_word"] + r["n_words"]]
        d = decontaminate.edit_distance(window, items[r["item_id"]], 99)
        assert d <= 0.2 * len(items[r["item_id"]]) and r["similarity"] == 1 - r["distance"] / r["n_words"]
    assert decontaminate.leaks(docs(spark, []), bench).count() == 0
    assert decontaminate.leaks(docs(spark, texts), bench.limit(0)).count() == 0


@pytest.mark.parametrize("n", [8, 15, 30, 45, 59, 64, 100, 101, 300, 1000])
def test_leaks_at_the_largest_distance_are_found(n):
    rng = random.Random(n)
    items, most, texts = passages(rng, 300 if n < 200 else 20, n), int(0.2 * n), []
    for item in items:
        while True:
            leak, pairs = list(item), rng.randrange(most // 2 + 1)
            for kind in rng.sample([0] * (most - 2 * pairs) + [1, 2] * pairs, most):
                p = rng.randrange(len(leak))
                leak[p:p + 1] = [["new"], [], [leak[p], "ins"]][kind]
            d = decontaminate.edit_distance(item, leak, n)
            if d == most or n > 100 and 0.9 * most < d <= most:  # many edits seldom leave exactly as large a distance
                break
        texts.append(" ".join(["zz"] * 40 + leak + ["yy"] * 40))
    index = decontaminate.Index([(i, " ".join(x)) for i, x in enumerate(items)], decontaminate.Lsh())
    found = index.search(texts)
    assert np.mean([i in {f[0] for f in x} for i, x in enumerate(found)]) >= 0.9


def test_short_and_long_items_equal_brute_force():
    rng = random.Random(4)
    items = [["solo"], ["w1", "w2"], *passages(rng, 6, 5), *passages(rng, 3, 7), *passages(rng, 2, 130), []]
    texts = [["x", "solo", "w1", "w2", "w1", "solo"], [], ["w2", "w1"]]
    for item in items[2:]:
        texts.append(["zz"] * 5 + item + ["yy"] * 3 + item[:-1] + ["qq"])
        texts.append(item)
        if len(item) > 100:  # ten words in front gone, ten put in behind; then a copy cut short, and one too far away
            texts.append(["zz"] * 3 + item[10:] + ["qq"] * 50 + item[:110] + ["qq"] * 50 + item[:60] + ["qq"] * 40)
    index = decontaminate.Index([(i, " ".join(x)) for i, x in enumerate(items)], decontaminate.Lsh())
    for text, got in zip(texts, index.search([" ".join(t) for t in texts])):
        for i, item in enumerate(items):
            n, most = len(item), int(0.2 * len(item)) if len(item) >= 8 else 0
            padded = ["-"] * most + text + ["-"] * most  # a window may reach over the text's ends
            near = [(decontaminate.edit_distance(item, padded[s:s + n], most), s) for s in range(len(padded) - n + 1)] if n else []
            near, taken = sorted(x for x in near if x[0] <= most), []
            for d, s in near:
                if all(abs(s - u) >= n for _, u in taken):
                    taken.append((d, s))
            assert sorted((max(0, s - most), d) for d, s in taken) == [(f, d) for j, f, _, d in got if j == i]
    assert decontaminate.Index([], decontaminate.Lsh()).search(["a", None, ""]) == [[], [], []]


def test_only_words_of_items_as_long_as_the_window_make_it_worth_a_walk(monkeypatch):
    rng = random.Random(21)
    short, long_ = [f"s{i}" for i in range(12)], [f"l{i}" for i in range(40)]
    index = decontaminate.Index([(0, " ".join(short)), (1, " ".join(long_))], decontaminate.Lsh())
    walked, calls, cgk = collections.Counter(), [], decontaminate.cgk

    def counted(ids, starts, n, *more):
        walked[n] += len(set(starts.tolist()))
        calls.append(n)
        return cgk(ids, starts, n, *more)
    monkeypatch.setattr(decontaminate, "cgk", counted)
    text = [rng.choice(long_) for _ in range(2000)] + short + ["zz"] * 50
    assert index.search([" ".join(text)]) == [[(0, 2000, 12, 0)]]
    assert walked[12] <= 5 and walked[40]  # before: each window of 12 words of the other item too
    assert len(calls) == 2  # few windows take all their walks at once


def test_lm_models_equal_brute_force(spark):
    rng = random.Random(10)
    draw = lambda ws: " ".join(rng.choice(ws) for _ in range(rng.randrange(1, 30)))
    target = [draw(["a", "b", "c", "rare%d" % i]) for i in range(30)]
    back = target + [draw(["b", "c", "d", "once%d" % i]) for i in range(50)] + [None, ""]
    models = lm_score.train(docs(spark, target), docs(spark, back), min_share=0.1)
    df = collections.Counter(w for t in back for w in set(words(t)))
    dt = collections.Counter(w for t in target for w in set(words(t)))
    vocabulary = {w for w in df if df[w] >= 0.1 * len(back) or dt[w] >= 3}
    assert {w.decode() for w in models.vocabulary} == vocabulary
    size = len(vocabulary) + 2
    # probabilities of either model sum to one after every history
    for c in range(2):
        assert abs(np.exp(models.single[c]).sum() - 1) < 1e-9
        for v in range(size):
            p = np.exp(models.back[c][v] + models.single[c])
            mine = models.keys // size == v
            p[models.keys[mine] % size] = np.exp(models.seen[c][mine])
            assert abs(p.sum() - 1) < 1e-9
    # one bigram by hand
    seqs = [[w if w in vocabulary else "<unk>" for w in words(t)] for t in target]
    after = sum(s[:-1].count("a") for s in seqs)
    n = sum(1 for s in seqs for x, y in zip(s, s[1:]) if (x, y) == ("a", "b"))
    a, b = models.vocabulary[b"a"], models.vocabulary[b"b"]
    at = np.searchsorted(models.keys, a * size + b)
    expect = lm_score.LAMBDA * n / after + np.exp(models.back[0][a] + models.single[0][b])
    assert models.keys[at] == a * size + b and abs(np.exp(models.seen[0][at]) - expect) < 1e-12
    rows = {r["doc_id"]: r for r in lm_score.cross_entropy_difference(
        docs(spark, [None, "", "a b a b a", "d d d once9 d"]), docs(spark, target), docs(spark, back), min_share=0.1).collect()}
    assert rows[0]["score"] == rows[1]["score"] == 0 and rows[0]["n_words"] == 0
    assert rows[2]["score"] > 0 > rows[3]["score"]
    empty = lm_score.cross_entropy_difference(docs(spark, ["a b", None]), docs(spark, []), docs(spark, [])).collect()
    assert [r["score"] for r in empty] == [0, 0]


@pytest.mark.parametrize("same", [True, False])
def test_lm_tables_equal_driver_model_with_the_same_cut_at_every_size(spark, same):
    rng = random.Random(14)
    draw = lambda ws, i: " ".join(rng.choice(ws + [f"pair{i // 2}", f"one{i}"]) for _ in range(rng.randrange(1, 20)))
    back = [draw(["a", "b", "c", "d"], i) for i in range(9000)] + [None, "", "seldom word"] + ["seldom word"]
    target, texts = back[:300], ["nowhere seldom word a", "pair3 pair3 one7 never never", None, ""]
    background = docs(spark, back)
    scored = background if same else docs(spark, texts)
    models = lm_score.train(docs(spark, target), background)
    assert b"seldom" in models.vocabulary    # two documents of 9,004
    got = by_id(lm_score.cross_entropy_difference(scored, docs(spark, target), background), "doc_id", "n_words",
                "target_loss", "background_loss")
    assert [r[0] for r in got] == list(range(len(back if same else texts)))
    for (_, n, t, b), text in zip(got, back if same else texts):
        m, mt, mb = models.losses(text)
        assert n == m and abs(t * max(n, 1) - mt) < 1e-6 and abs(b * max(n, 1) - mb) < 1e-6, text


def test_lm_tables_stay_below_the_texts(spark):
    """Before: a stored row of two hashes for every bigram of every document, many times the texts."""
    rng = random.Random(15)
    ws = [f"word{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(ws, k=150)) for _ in range(1500)]
    frame = docs(spark, texts)

    def stored():
        top = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names)
    before = stored()
    assert lm_score.cross_entropy_difference(frame, docs(spark, texts[:500]), frame).count() == 1500
    assert 0 < stored() - before < sum(map(len, texts))


@pytest.mark.parametrize("block_words", [40, 1 << 20])
def test_lm_target_named_by_ids_in_blocks_of_any_size(spark, block_words):
    rng = random.Random(16)
    draw = lambda i: " ".join(rng.choice(["a", "b", "c", f"pair{i // 2}", f"one{i}"]) for _ in range(rng.randrange(0, 12)))
    texts = [None, "", *map(draw, range(300)), "a b a b c", "a b a b c"]
    ids = [None, *range(len(texts) - 2), 7]   # a null id, and one that comes twice
    frame = docs(spark, texts, ids)
    chosen = spark.createDataFrame([(i,) for i in [None, 7, 7, *range(20, 90), 5000]], "doc_id long")
    models = lm_score.train(docs(spark, [t for i, t in zip(ids, texts) if i == 7 or i in range(20, 90)]), frame)
    got = lm_score.cross_entropy_difference(frame, chosen, frame, block_words=block_words)
    assert got.columns == ["doc_id", "n_words", "target_loss", "background_loss", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    expect = []
    for i, t in zip(ids, texts):
        n, mt, mb = models.losses(t)
        expect.append((i, n, round(mt / max(n, 1), 6) + 0.0, round(mb / max(n, 1), 6) + 0.0))
    rows = [(r[0], r[1], round(r[2], 6) + 0.0, round(r[3], 6) + 0.0) for r in got.collect()]
    assert sorted(rows, key=key) == sorted(expect, key=key)
    assert all(abs(r["background_loss"] - r["target_loss"] - r["score"]) < 1e-12 for r in got.collect())


def test_lm_packed_runs_come_back():
    rng = np.random.default_rng(17)
    for bits in (2, 3, 17, 40, 63, 64):
        x = np.unique(rng.integers(0, 1 << bits, 500, np.uint64, endpoint=False) if bits < 64 else
                      rng.integers(0, (1 << 64) - 1, 500, np.uint64, endpoint=True))
        assert (lm_score._unpack(lm_score._pack(x, True), True) == x).all() and (lm_score._unpack(lm_score._pack(x)) == x).all()
        mixed = lm_score._mix(x, bits)
        assert len(np.unique(mixed)) == len(x) and int(mixed.max()) < 1 << bits
        assert (lm_score._mix(mixed, bits, back=True) == x).all()
        cut = lm_score._slices(x, bits, 7)
        assert [i for _, a, b in cut for i in range(a, b)] == list(range(len(x)))
    for x in ([], [0], [0, 0, 0], [255, 256]):
        assert lm_score._unpack(lm_score._pack(np.array(x, np.int64))).tolist() == x


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The library's own unigram encoder over the same pieces and scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_units_join_to_the_text_and_cross_no_piece():
    rows = sentencepiece_lattice.pieces(PIECES)
    pattern = re.compile(sentencepiece_lattice.unit_pattern(rows))
    for t in ["Hello  world.\nFoo\t12 (é) 你好 x². ½a_b", " ", "\n\n a"]:
        assert "".join(sentencepiece_lattice.units(t, pattern)) == "▁" + t.replace(" ", "▁")
    for _, p, _ in rows:
        assert len(pattern.findall(p)) == 1, p


def test_runs_hold_the_units_and_known_runs_need_no_pattern(monkeypatch):
    rng = random.Random(22)
    pattern = sentencepiece_lattice.unit_pattern(sentencepiece_lattice.pieces(PIECES))
    texts = ["".join(rng.choice("ab é1²!\n\t \u2581 🙂") for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    for cut in (pattern, "▁*[^▁]+|▁+", "(?s).+"):
        of = re.compile(cut).findall
        for t in [*texts, None, "", " ", "  ", "a", " a", "a ", "a  b  ", "▁▁"]:
            assert [u for r in sentencepiece_lattice.runs(t, cut) for u in of("▁" + r)] == sentencepiece_lattice.units(t, re.compile(cut))
    units = sorted({u for t in texts for u in sentencepiece_lattice.units(t, re.compile(pattern))},
                   key=lambda u: np.uint64(xxhash.xxh64_intdigest(u.encode(), 42)).view(np.int64))
    hashes = np.array([xxhash.xxh64_intdigest(u.encode(), 42) for u in units], np.uint64).view(np.int64)
    held = sentencepiece_lattice.Held(hashes.tobytes(), np.full(len(units), 1, "<u4").tobytes(),
                                      np.arange(len(units), dtype="<u2").tobytes(), "<u2", pattern)
    place = {u: i for i, u in enumerate(units)}
    whole = [np.array([place[u] for u in sentencepiece_lattice.units(t, re.compile(pattern))], "<u2").tobytes() for t in texts]
    assert [held.encode(t) for t in texts] == whole
    monkeypatch.setattr(held, "learn", None)
    assert [held.encode(t) for t in texts] == whole and held.encode(None) == b""


def test_sentencepiece_equals_library_and_decodes(spark, unigram):
    rng = random.Random(11)
    syllables = "th er on an re he in ed tion ness ly é ou qu".split()
    plain = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 6))) for _ in range(200)]
    texts = TEXTS + [" ".join(plain[i:i + 10]) + ". 42%" for i in range(0, 200, 10)] + ["x" * 500, "🙂🙂 \x01 a"]
    df = docs(spark, texts)
    got = {r["doc_id"]: r["ids"] for r in sentencepiece_lattice.encode(df, PIECES).collect()}
    joined = {r["doc_id"]: r["ids"] for r in sentencepiece_lattice.encode(df, PIECES, send_units=0).collect()}
    assert got == joined and len(got) == len(texts)
    back = spark.createDataFrame(list(got.items()), "doc_id long, ids array<int>") \
        .select("doc_id", sentencepiece_lattice.decode("ids", PIECES).alias("text"))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}
    for i, t in enumerate(texts):
        if t and all(ord(c) < 0x250 and c not in "\n\t\x0b\x01²" for c in t) and "  " not in t and t[0] != " ":
            assert got[i] == unigram.encode(t), t
    assert sentencepiece_lattice.encode(docs(spark, []), PIECES).count() == 0


def test_viterbi_equals_all_segmentations(spark):
    """Best sum of scores over every way to cut a unit, by enumeration."""
    table = {p: s for _, p, s in sentencepiece_lattice.pieces(PIECES)}
    low = min(table.values()) - 10
    units = ["▁then", "▁onion", "▁ztth", "你好吗", "...", "▁🙂a", "▁▁▁"]

    def best(u):
        top = [0.0] + [None] * len(u)
        for e in range(1, len(u) + 1):
            top[e] = max(top[s] + table.get(u[s:e], low if e - s == 1 else float("-inf")) for s in range(e))
        return top[-1]
    df = spark.createDataFrame([(u,) for u in units], "unit string").select(F.xxhash64("unit").alias("h"), "unit")
    got = {r["unit"]: r["score"] for r in sentencepiece_lattice.encode_units(df, spark, PIECES).collect()}
    assert got == {u: best(u) for u in units}


def test_long_units_are_folded_like_short_ones(spark):
    rng = random.Random(12)
    letters = "etaoinshrdlucmfwyp" + "éüß你好🙂ж"
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (3, 40, 255, 256, 257, 700, 1500)]
    texts += ["a" * 1200, "the" * 500, "你" * 600, "!" * 900, "\U0001f642" * 300, "word " * 5, None, ""]
    df = docs(spark, texts)
    plain = {r["doc_id"]: r["ids"] for r in sentencepiece_lattice.encode(df, PIECES, long_chars=10_000).collect()}
    for most in (0, 200):
        got = {r["doc_id"]: r["ids"] for r in sentencepiece_lattice.encode(df, PIECES, long_chars=most).collect()}
        assert got == plain
    for r in sentencepiece_lattice.encode(df, PIECES, columns=("decoded_crc32",)).collect():
        assert r["decoded_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode())


def _worker_mb(run):
    """(result of ``run``, most MB that one Python worker had of its own meanwhile)."""
    most, over = [0.0], threading.Event()

    def watch():
        while not over.wait(0.05):
            for p in psutil.Process().children(recursive=True):
                try:
                    if "python" in p.name():
                        most[0] = max(most[0], p.memory_full_info().uss / 1e6)
                except psutil.Error:
                    pass
    thread = threading.Thread(target=watch)
    thread.start()
    try:
        return run(), most[0]
    finally:
        over.set()
        thread.join()


def test_a_task_holds_one_block_however_many_there_are(spark, monkeypatch):
    """One batch of 5,000 documents of some hundred blocks: its units of all blocks are not held at once."""
    rng = random.Random(14)
    some = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(5, 9))) for _ in range(40_000)]
    texts = [" ".join(rng.choices(some, k=300)) for _ in range(5000)]
    df = docs(spark, texts).coalesce(1)
    monkeypatch.setattr(sentencepiece_lattice, "BLOCK_CHARS", 1 << 16)
    got, mb = _worker_mb(lambda: sentencepiece_lattice.encode(df, PIECES, send_units=0, columns=("decoded_crc32",)).collect())
    assert sorted(tuple(r) for r in got) == [(i, zlib.crc32(t.encode())) for i, t in enumerate(texts)] and mb < 250


@pytest.mark.parametrize("catalog", [True, False])
def test_blocks_and_buckets_give_the_rows_of_the_sent_table(spark, monkeypatch, catalog):
    """Many blocks, many buckets; null and repeated ids, rows and texts, long units; with and without the right to make tables."""
    rng = random.Random(15)
    texts = TEXTS + [None, "", "x" * 700] + ["".join(rng.choices("etaoin  .é你\n42", k=rng.randrange(400))) for _ in range(120)]
    rows = [(rng.choice([None, i, 7]), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:30], "doc_id long, text string")
    for name, value in (("BLOCK_CHARS", 2000), ("BUCKET_UNITS", 100)):
        monkeypatch.setattr(sentencepiece_lattice, name, value, raising=False)
    if not catalog:
        def refused(*_, **__):
            raise AnalysisException("no right")
        monkeypatch.setattr(DataFrameWriter, "saveAsTable", refused)
    columns = ("ids", "n_tokens", "ids_crc32", "decoded_crc32")
    plain, joined = (sentencepiece_lattice.encode(df, PIECES, send_units=n, columns=columns) for n in (1000_000, 0))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["ids"])
    assert sorted(plain.collect(), key=key) == sorted(joined.collect(), key=key) and joined.count() == len(rows) + 30
    assert not spark.catalog.listTables()


def test_units_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(sentencepiece_lattice.xxhash, "xxh64_intdigest", lambda x, seed: len(x))
    texts = ["bb", "a", "ab", "c", ""]
    _, order = sentencepiece_lattice._by_hash(texts)
    assert [texts[i] for i in order] == ["", "a", "c", "ab", "bb"]
    packed = sentencepiece_lattice._pack_texts(pa.array(texts + ["你", "🙂"]))
    assert sentencepiece_lattice._unpack_texts(packed).to_pylist() == texts + ["你", "🙂"]
    assert not len(sentencepiece_lattice._unpack_texts(sentencepiece_lattice._pack_texts(pa.array([], pa.string()))))


def test_a_unit_of_200_000_letters_ends(spark):
    rng = random.Random(13)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(200_000))
    began = time.time()
    row = sentencepiece_lattice.digest(docs(spark, [text]), PIECES).first()
    assert row["decoded_crc32"] == zlib.crc32(text.encode()) and 20_000 < row["n_tokens"] < 200_000
    assert time.time() - began < 120

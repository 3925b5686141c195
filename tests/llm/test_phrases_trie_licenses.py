from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from acctscreen.llm import op11_collocations, op12_trie, op13_licenses
from acctscreen.llm.common import BATCH
from acctscreen.llm.queries import QUERIES
from tests.llm.conftest import EDGE, SF, collected

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- collocations --------------------------------------------------------------

def brute_collocations(rows, least, top, covered):
    """(lang, text) rows; every phrase of every piece is counted as it stands."""
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(_UPPER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


def _phrase_rows(seed: int, n: int = 300):
    r = random.Random(seed)
    words = ["a", "B", "b", "c c", "d", "é", "É", "x-y", "\x00", "de", "en"]
    ends = [" ", " ", " ", "\t ", ". ", "\n", ", ", ";"]
    rows = []
    for i in range(n):
        text = "".join(r.choice(words) + r.choice(ends) for _ in range(r.randrange(0, 12)))
        rows.append((i % 50, text, r.choice(["en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("budget", [1, 40, op11_collocations.BUDGET])
def test_collocations_equal_brute_force_at_any_budget(spark, budget):
    rows = _phrase_rows(1) + [(7, "hot hot hot hot hot hot", "en")] * 60
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = collected(op11_collocations.collocations(df, least=5, top=40, budget=budget))
    want = brute_collocations([(x[2], x[1]) for x in rows], 5, 40, 80)
    assert got == want and len({x[0] for x in got}) == 4


def test_collocation_ties_at_the_last_place_go_by_the_phrase(spark):
    texts = [f"{a}{b} {c}{d}" for a in "zyx" for b in "ab" for c in "pq" for d in "rs"]
    df = spark.createDataFrame([(i, t + ". " + t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    rows = [("en", t + ". " + t) for t in texts]
    assert collected(op11_collocations.collocations(df, least=2, top=3)) == brute_collocations(rows, 2, 3, 80)


def test_collocations_of_edge_rows(spark, edge, no_docs):
    got = collected(op11_collocations.collocations(edge, least=2, top=100))
    assert got == brute_collocations([(r[2], r[1]) for r in EDGE], 2, 100, 80)
    assert collected(op11_collocations.collocations(no_docs)) == []


def test_words_of_two_languages_stay_apart(spark):
    # The name of a language is a word like any other.
    df = spark.createDataFrame([(1, "es de es de es de", "en"), (2, "en de en de", "es")], "doc_id long, text string, lang string")
    assert collected(op11_collocations.collocations(df, least=2)) == brute_collocations([("en", "es de es de es de"), ("es", "en de en de")], 2, 2000, 80)


def test_group_plan_fills_groups_up_to_the_budget():
    sizes = np.array([3, 4, 0, 9, 25, 1, 10])
    first, parts, whole = op11_collocations.group_plan(sizes, 10)
    load = Counter()
    for k, n in enumerate(sizes.tolist()):
        assert parts[k] == max(-(-n // 10), 1)
        assert all(whole[first[k] + i] == (parts[k] == 1) for i in range(parts[k]))
        if parts[k] == 1:
            load[first[k]] += n
    assert max(load.values()) <= 10 and first.max() + parts[first.argmax()] == len(whole)


# -- conversation trie ---------------------------------------------------------

def brute_trie(rows, group=20, most=4):
    """(conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    seq = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    full = {}
    for c, s in seq.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(np.fmod(c, group))
        full[c] = tuple(seq.get(base, [])[:h] + s[h:])
    nodes = defaultdict(list)
    for c, s in sorted(full.items()):
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    words = {s: len(re.findall("[^\x20\x09-\x0d]+", s[-1][1])) if s else 0 for s in nodes}
    kids, leaves, saved = Counter(), Counter(), Counter()
    for s in nodes:
        if s:
            kids[s[:-1]] += 1
    for s, members in nodes.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(members) - 1) * words[s]
    out = []
    for s, members in nodes.items():
        ends = ",".join(str(c) for c in members if full[c] == s)
        out.append((members[0], len(s), nodes[s[:-1]][0] if s else None, len(members), kids[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


_TURNS = "conv_id long, turn long, role string, text string, m long, n long, depth string"


def _turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], _TURNS)


def _conversations(seed: int, n: int, texts: int = 3, longest: int = 7):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randrange(0, longest)):
            rows.append((c, t, r.choice(["user", "assistant"]) if t % 3 else "user", f"say {r.randrange(texts)} now" if t else "hello there"))
    return rows


@pytest.mark.parametrize("batch", ["1", "3", "1000"])
def test_trie_equals_brute_force_with_spines_of_any_shards(spark, batch):
    rows = _conversations(1, 150)
    old = spark.conf.get(BATCH)
    spark.conf.set(BATCH, batch)
    try:
        got = collected(op12_trie.prefix_trie(_turns(spark, rows)))
    finally:
        spark.conf.set(BATCH, old)
    assert got == brute_trie(rows)


def test_trie_of_long_conversations_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(op12_trie, "STRETCH", 4)
    long = [(40, t, "user", f"turn {t} of a long one") for t in range(60)]
    branch = [(41 + k, t, "user", f"turn {t} of a long one" if t < 10 * k else f"other {k}") for k in range(1, 5) for t in range(10 * k + 3)]
    copies = [(c, t, "user", f"same {t}") for c in range(100, 180) for t in range(5)]
    rows = long + branch + copies
    assert collected(op12_trie.prefix_trie(_turns(spark, rows), most=1)) == brute_trie(rows, most=1)
    assert collected(op12_trie.prefix_trie(_turns(spark, rows))) == brute_trie(rows)


def test_trie_of_edge_rows(spark):
    rows = [
        (1, None, "user", "first by its null turn"), (1, 0, None, None), (1, 0, None, None), (1, 0, "", ""), (1, 5, "user", " \n "),
        (None, 0, "user", "of no conversation"), (20, 0, "user", "a"), (20, 1, "user", "b"), (20, 2, "user", "c"), (23, 0, "user", "x"), (24, 9, "é", "ÀÉ ü"),
        (-3, 0, "user", "below zero"), (39, 1, "user", "w " * 30_000), (21, 3, "b", "tie"), (21, 3, "a", "tie"), (21, 3, "a", "a tie"),
    ]
    assert collected(op12_trie.prefix_trie(_turns(spark, rows))) == brute_trie(rows)
    # A conversation of fewer turns than it gives away, and none to begin with: it ends at the root.
    c = next(k for k in range(1, 200) if k % 20 and zlib.crc32(str(k).encode()) % 4 == 3)
    got = collected(op12_trie.prefix_trie(_turns(spark, [(c, 0, "user", "only")])))
    assert got == brute_trie([(c, 0, "user", "only")]) and len(got) == 1
    assert collected(op12_trie.prefix_trie(_turns(spark, []).filter("conv_id > 0"))) == []
    assert collected(op12_trie.prefix_trie(_turns(spark, [(None, 0, "user", "x")]))) == []


def test_trie_without_branches_is_one_run(spark):
    rows = [(c, t, "user", f"{t}") for c in (0, 20, 40) for t in range(4)]
    assert collected(op12_trie.prefix_trie(_turns(spark, rows))) == brute_trie(rows)


@pytest.mark.parametrize("seed", range(8))
def test_findclose_over_blocks(seed):
    r = random.Random(seed)
    bits, stack, close = [], [], {}
    while len(bits) < 30 * op12_trie.BLOCK or stack:
        deep = seed % 2 and len(bits) < 20 * op12_trie.BLOCK
        if len(bits) < 30 * op12_trie.BLOCK and (not stack or r.random() < (0.9 if deep else 0.5)):
            stack.append(len(bits))
            bits.append(True)
        else:
            close[stack.pop()] = len(bits)
            bits.append(False)
    p = np.array(sorted(close))
    assert op12_trie.Parentheses(np.array(bits)).findclose(p).tolist() == [close[x] for x in p.tolist()]


# -- license scan --------------------------------------------------------------

def brute_licenses(text):
    """Every window of every template, word by word."""
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(_UPPER))
    places, base, labels, score = [], set(), set(), 0.0
    for label, phrase in op13_licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    for label, template in op13_licenses.TEMPLATES:
        words = template.split()
        wanted, wide = set(words), -(-5 * len(words) // 4)
        best = max((len(wanted & set(w[i : i + wide])) for i in range(len(w))), default=0)
        if 100 * best >= 85 * len(wanted):
            labels.add(label)
            score = max(score, best / len(wanted))
    score = 1.0 if places else score
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score)


def _license_texts(seed: int, n: int):
    r = random.Random(seed)
    vocabulary = sorted({w for _, t in op13_licenses.TEMPLATES for w in t.split()}) + ["éa", "foo", "bar", "7"]
    out = []
    for _ in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randrange(0, 20))]
        for _ in range(r.randrange(0, 3)):
            t = r.choice(op13_licenses.TEMPLATES)[1].split()
            for _ in range(r.randrange(0, 4)):
                k = r.randrange(len(t))
                t[k : k + 1] = r.choice([[], [r.choice(vocabulary)], [t[k], r.choice(vocabulary)]])
            words += t + [r.choice(vocabulary) for _ in range(r.randrange(0, 5))]
        out.append(r.choice([" ", "\n", "-", ". "]).join(w.upper() if r.random() < 0.1 else w for w in words))
    return out


def test_licenses_equal_brute_force(spark):
    texts = _license_texts(1, 400) + ["CC-BY CC BY cc by", "All Rights Reserved. all rights reserved", "General Public License all rights", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in op13_licenses.license_digest(df).collect()}
    assert got == {k: brute_licenses(t) for k, t in enumerate(texts)}
    found = Counter(x[5] for x in got.values())
    assert sum(n for labels, n in found.items() if labels) > 200


def test_license_blocks_have_places_and_ends(spark):
    notice = "released under the MIT License"
    text = f"one two {notice}. three four {notice}, {notice}"
    row = op13_licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(b) for b in row["blocks"]] == [("mit", 2, 7, 1.0), ("mit", 9, 14, 1.0), ("mit", 14, 19, 1.0)]
    assert row["n_words"] == 19 and row["score"] == 1.0 and row["labels"] == "mit"
    assert row["n_base"] == 0 and row["first_word"] is None and row["base_labels"] == ""


def test_a_part_of_a_notice_is_not_enough(spark):
    texts = ["released under the license", "licensed under the version 2 0", "you may obtain a copy of the license", "the general license public"]
    got = op13_licenses.license_digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r["labels"] == "" and r["score"] == 0 for r in got)


def test_licenses_of_edge_rows(spark, edge, no_docs):
    got = collected(op13_licenses.license_digest(edge))
    assert got == sorted(((r[0], *brute_licenses(r[1])) for r in EDGE), key=repr)
    assert collected(op13_licenses.license_digest(no_docs)) == []


def test_one_notice_in_every_row_and_in_one_long_text(spark):
    line = "Licensed under the Apache License, Version 2.0.\n"
    texts = [line] * 2000 + [line * 5000]
    got = op13_licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["labels"] for r in got} == {"apache-2.0"} and sum(len(r["blocks"]) for r in got) >= 2001


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_conversation_trie", "op13_license_scan"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from acctscreen.llm.queries import ORACLE_SQL
    from tests.test_oracle import digest

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    df = QUERIES[name](spark, SF)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest([d[0] for d in res.description], res.fetchall())

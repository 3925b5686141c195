"""Scoring, toxicity, language identification."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctscreen.llm import op3_brown as brown
from acctscreen.llm import op4_toxicity as tox
from acctscreen.llm import op9_langid as lang
from tests.llm.conftest import EDGE, SF, prose

SMALL = {"words": 64, "endings": 16, "classes": 8, "rounds": 3, "head": 40}


def tokens(t):
    return [*(t or "").encode().lower().split(), b"\0end"]


def held(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == 0


def brute_base(rows, folds=10):
    c = Counter(w for i, t in rows if not held(i, folds) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        w = tokens(t)
        yield i, held(i, folds), len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)


def same_scores(got, want):
    order = lambda r: (repr(r[0]), r[2], r[5])
    for g, w in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-7)


FIELDS = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")


def test_scores_of_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    out = brown.score_texts(documents, **(SMALL | {"head": 500, "words": 300})).collect()
    same_scores([tuple(r[k] for k in FIELDS) for r in out], list(brute_base(rows)))
    test = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in test) > sum(r["base_score"] for r in test)
    for r in out:
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"]))


def test_scores_of_edge_rows(edge, no_docs):
    out = brown.score_texts(edge, **SMALL).collect()
    same_scores([tuple(r[k] for k in FIELDS) for r in out], list(brute_base([r[:2] for r in EDGE])))
    assert all(r["score"] < 0 for r in out)
    assert brown.score_texts(no_docs, **SMALL).count() == 0
    nothing = edge.filter("doc_id = 2 or doc_id is null").selectExpr("cast(null as long) doc_id", "text")
    assert {(r["train_tokens"], r["n_known"]) for r in brown.score_texts(nothing, **SMALL).collect()} == {(0, 0)}


def test_model_is_a_distribution(spark):
    """Over each class the words and one unknown word have probability 1, and so have the classes after a class."""
    from acctscreen.llm.common import Scratch

    texts = spark.createDataFrame([(prose(i, 50, 60),) for i in range(40)], "text string")
    model, counts = brown.fit(texts, Scratch(spark, "t"), **SMALL)
    assert np.allclose((10**model.transition).sum(1), 1)
    rows = counts.collect()
    mass = np.zeros(SMALL["classes"])
    for r in rows:
        k = 0 if r["h"] == 0 else model.class_of[int(model.units.of(np.array([r["h"]]), np.array([r["ending"]]))[0])]
        mass[k] += (r["n"] + brown.DELTA) / 10 ** model.emission[k]
    assert np.allclose(mass + brown.DELTA / 10**model.emission, 1)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(1)
    kind = np.arange(40) % 2
    n = np.where(kind[:, None] != kind[None, :], 20, 1) * rng.integers(1, 4, (40, 40))
    class_of = 1 + rng.integers(0, 2, 40)
    values = []
    for _ in range(4):
        after = np.stack([n[:, class_of == c].sum(1) for c in range(3)], 1).astype(float)
        before = np.stack([n[class_of == c].sum(0) for c in range(3)], 1).astype(float)
        g = np.zeros((3, 3))
        np.add.at(g, class_of, after)
        values.append(brown.likelihood(g))
        class_of = brown.exchange(after, before, class_of, 3)
    assert values[-1] > values[0]
    assert len({(k, c) for k, c in zip(kind[:-1], class_of[:-1], strict=True)}) == 2


def test_words_beyond_the_units_have_classes_by_their_neighbours(spark):
    """Words that share an ending but stand in unlike places are told apart, in the head and beyond."""
    from acctscreen.llm.common import SPACE, Scratch, hash_words

    r = random.Random(4)
    far = {k: [f"{k}{a}{b}zzz" for a in "abcdefgh" for b in "aeiou"] for k in "pq"}
    rows = []
    for i in range(400):
        before, k, after = ("the", "p", "of") if i % 2 else ("did", "q", "not")
        rows.append((" ".join(f"{before} {r.choice([r.choice(far[k]), k + 'main' + k])} {after}" for _ in range(12)),))
    texts = spark.createDataFrame(rows, "text string")
    for head in (6, 40):
        scratch = Scratch(spark, "t")
        first, counts = brown.fit(texts, scratch, words=6, endings=16, classes=24, rounds=0, head=head)  # each unit a class
        model, tail = brown.refine(texts, first, counts, scratch)
        looked = {x["h"]: x["c"] for x in tail.collect()}

        def class_of(word, model=model, looked=looked):
            h = hash_words([word], SPACE)[0].view(np.int64)
            _, _, ending, _ = next(brown.tokens(brown.pa.array([word]), model.units.endings))
            u = int(model.units.of(h, ending)[0])
            c = looked.get(int(h[0])) if u >= len(model.units.words) else None
            return int(model.class_of[u]) if c is None else c

        p, q = ({class_of(w) for w in far[k]} for k in "pq")
        assert p == {class_of("pmainp")} and q == {class_of("qmainq")} and p != q
        assert class_of("pabzzz") == class_of("unseenbzzz")  # still by the ending
        # Still a distribution: the words of a class and one unknown word.
        assert np.allclose((10**model.transition).sum(1), 1)
        mass = np.zeros(24)
        words = {w for t, in rows for w in t.split()}
        n = {x["h"]: x["n"] for x in counts.collect()}
        for w in words:
            mass[class_of(w)] += (n[int(hash_words([w], SPACE)[0].view(np.int64)[0])] + brown.DELTA) / 10 ** model.emission[class_of(w)]
        mass[0] += (len(rows) + brown.DELTA) / 10 ** model.emission[0]
        assert np.allclose(mass + brown.DELTA / 10**model.emission, 1)


def test_look_up_gives_the_scores_of_a_whole_head(spark):
    """A word's count and class are the same whether tasks have it or it is joined."""
    rows = [(i, prose(i % 7, 60, 90)) for i in range(120)] + [(None, None), (500, "never seen here never seen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = {"words": 20, "endings": 16, "classes": 8, "rounds": 2}
    got = [{(r["doc_id"]): r for r in brown.score_texts(docs, head=h, **sizes).collect()} for h in (20, 100_000)]
    for k in got[1]:
        for c in ("n_tokens", "n_known"):
            assert got[0][k][c] == got[1][k][c]
        for c in ("score", "base_score"):
            assert got[0][k][c] == pytest.approx(got[1][k][c], rel=1e-9)


# -- toxicity --------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2])
def test_automaton_equals_edit_distance(edits):
    rng = random.Random(edits)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(2, 6))) for _ in range(60)})
    trie = tox.Trie(terms)
    for word in ["".join(rng.choice("abc") for _ in range(rng.randint(0, 8))) for _ in range(150)]:
        want = {k: distance(word, t) for k, t in enumerate(terms) if distance(word, t) <= edits}
        assert tox.near_terms(word, trie, edits) == want
        begins = {k for k, t in enumerate(terms) if min(distance(word[:n], t) for n in range(len(word) + 1)) <= edits}
        assert set(tox.near_terms(word, trie, edits, prefix=True)) == begins


def test_terms_words_stems_and_context():
    lex = tox.Lexicon({"moron": 5.0}, {"grunz": 4.0}, {"moron": 3.0, "grunz": 2.0}, (-3.0, 2.0, 0.0, 0.0))
    assert lex.match("moron") == ("moron", 5.0, False) and lex.match("m0ron") == ("moron", 3.0, True)
    assert lex.match("grunzbold")[0] == "grunz" and lex.match("mormon")[0] == "moron" and lex.match("maroon")[0] == ""
    assert lex.match("moroons")[0] == "" and lex.match("")[0] == ""
    plain, quoted = "he is a moron here", 'he said the word "moron" here'
    assert tox.score_text("you moron", lex) > tox.score_text(plain, lex) > tox.score_text(quoted, lex) > tox.score_text("", lex)


def factors(text, hit):
    low = text.lower()
    c = tox.Contexts(low, list(tox._WORD.finditer(low)))
    return [c.factor(k) for k, w in enumerate(c.words) if w == hit]


def test_quotation_and_abuse_are_told_apart():
    quoted = [
        ('he said "what an idiot that man is"', "idiot"), ("the word idiot was written on the wall", "idiot"),
        ("she said that he is an idiot", "idiot"), ("'idiot' was the quote", "idiot"),
        ("“Idiot” he called", "idiot"), ("er sagte, dass der Mann ein Idiot sei", "idiot"), ("er schrieb: „so ein Idiot“", "idiot"),
        ("»Idiot«, sagte er", "idiot"), ("«quel idiot» dit-il", "idiot"), ("il dit souvent que cet idiot ment", "idiot"),
        ("dijo ayer que es un idiota", "idiota"), ("«idiota» escribió", "idiota"), ("la palabra idiota", "idiota"),
    ]
    for text, hit in quoted:
        assert factors(text, hit) == [tox.QUOTED], text
    abuse = [("you idiot", "idiot"), ("eres tú un idiota", "idiota"), ("du Idiot", "idiot"), ("vous idiot", "idiot")]
    for text, hit in abuse:
        assert factors(text, hit) == [tox.ADDRESSED], text
    plain = ["ton idiot", "it's an idiot and that's all", '"a" idiot "b"', "she said nothing. That idiot", 'the idiot "x', "An idiot. You went",
             'a "b\nc idiot d" e', '"' + "x " * 400 + 'idiot"', "l'idiot d'hier"]
    for text in plain:
        assert factors(text, "idiot") == [1.0], text
    assert factors('a plain "idiot" here, far from all that speaks', "idiot") == [tox.MARKED]
    assert factors('you are "an idiot" and "an idiot" he said, idiot', "idiot") == [tox.QUOTED, tox.QUOTED, 1.0]


def test_scores_equal_a_plain_recomputation():
    rng = random.Random(8)
    terms = ["blunder", "grimace", "wretched", "toad"]
    weights = dict(zip(terms, (3.0, 4.0, 2.5, 5.0), strict=True))
    lex = tox.Lexicon(weights, {}, {t: w / 2 for t, w in weights.items()}, (-3.0, 1.5, 0.25, 0.5))
    for n in [0, 1, 5, 40, 400]:
        words = [rng.choice([*terms, "bluner", "grimacee", "wetched", "toat", "quiet", "meadow", "river", "stone"]) for _ in range(n)]
        total, seen = 0.0, set()
        for w in words:
            found = [(weights[t], t) for t in terms if w == t] or [(weights[t] / 2, t) for t in terms if len(t) >= tox.FUZZY and distance(w, t) == 1]
            if found:
                total, seen = total + max(found)[0], seen | {max(found)[1]}
        odds = -3.0 + 1.5 * np.log1p(total) + 0.25 * np.log(0.005 + total / max(10, n)) + 0.5 * min(5, len(seen))
        assert abs(tox.score_text(" ".join(words), lex) - 1 / (1 + np.exp(-odds))) < 1e-12


def test_edits_at_the_head_of_a_stem():
    lex = tox.Lexicon({}, {"idiot": 4.0, "schurk": 4.0}, {"idiot": 2.0, "schurk": 2.0})
    for word in ("xdiot", "diot", "diots", "ixiotic", "iidiot", "xidiots", "idixt", "idiqotic", "idio"):
        assert lex.match(word) == ("idiot", 2.0, True), word
    assert lex.match("chxrken")[0] == "" and lex.match("hidiot")[0] == "idiot"
    # Every beginning one edit away, as the automaton says.
    rng = random.Random(5)
    stems = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(5, 7))) for _ in range(6)})
    lex = tox.Lexicon({}, dict.fromkeys(stems, 4.0), dict.fromkeys(stems, 2.0))
    for word in ["".join(rng.choice("abc") for _ in range(rng.randint(4, 9))) for _ in range(600)]:
        want = any(distance(word[:n], t) <= 1 for t in stems for n in range(len(word) + 1))
        assert bool(lex.match(word)[0]) == want, word


def test_a_word_under_a_stem_is_looked_for_misspelled():
    stats = {"idiot": (400, 50.0), "idi*": (410, 50.0), "idio*": (401, 50.0), "wicht": (300, 50.0)}
    kept = tox.choose_terms(stats)
    assert kept == ["idi*", "wicht"] and tox.words_under(stats, kept) == ["idiot"]
    lex = tox.Lexicon({"wicht": 4.0}, {"idi": 4.0}, {"wicht": 3.0}, under={"idiot": 2.0})
    assert lex.match("idiot") == ("idi", 4.0, False) and lex.match("wixht") == ("wicht", 3.0, True)
    for word in ("xdiot", "diot", "ixiot", "jidiot"):
        assert lex.match(word) == ("=idiot", 2.0, True), word
    assert tox.evidence("an idiot and a diot", lex)[2] == 1.0


def test_learns_and_holds_out(spark):
    docs, labels = [], []
    for i in range(600):
        text, bad = prose(i, 80), i % 6 == 0
        if bad:
            w = text.split()
            for k in range(0, 80, 16):
                w[k] = random.Random(i + k).choice(["blöder", "schurk" + w[1], "schurk" + w[2], "wicht"])
            text = " ".join(w)
        docs.append((i, text, i))
        labels.append((i, int(bad), 1))
    docs += [(None, "blöder wicht", 1), (1000, None, 1), (1001, "", 1), (1002, "blöder wicht schurkda " + prose(9, 20), 1), (1002, prose(5, 50), 1)]
    labels += [(None, 1, 0), (3, None, 0), (4, 7, 0), (5, 0, 0), (5, 0, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score long")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    out = tox.score_documents(d, lab).collect()
    assert len(out) == len(docs)
    truth = {i: i % 6 == 0 for i in range(600)}
    for r in out:
        assert r["held_out"] == held(r["doc_id"], 5) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    wrong = [r for r in out if r["doc_id"] in truth and r["predicted"] != truth[r["doc_id"]]]
    assert len(wrong) <= 3
    assert sorted(r["predicted"] for r in out if r["doc_id"] == 1002) == [0, 1]
    assert {r["predicted"] for r in out if r["doc_id"] in (1000, 1001)} == {0}
    assert {r["predicted"] for r in tox.score_documents(d, lab.limit(0)).collect()} == {0}
    assert tox.score_documents(d.limit(0), lab).count() == 0


# -- languages -------------------------------------------------------------------

def test_addresses_and_markup(spark):
    urls = ["https://blog.a.example.fr:80/x?y", "http://u@B.de/#z", "ftp://host", None, "", "no address", "http:///x"]
    host, domain, suffix = lang.address(F.col("u"))
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(host, domain, suffix).collect()
    assert [tuple(r) for r in rows] == [("blog.a.example.fr", "example.fr", "fr"), ("b.de", "b.de", "de"), ("host", "host", None), *[(None, None, None)] * 4]
    html = ["<html lang=en-GB><p>a</p>", '<HTML class="x" LANG="FR">', "<p lang=de>", None, "<html>"]
    df = spark.createDataFrame([(h,) for h in html], "h string")
    assert [r[0] for r in df.select(lang.markup_language(df["h"])).collect()] == ["en", "fr", None, None, None]
    assert "var" not in df.select(lang.markup_text(df["h"])).first()[0]


def records(spark, rows):
    return spark.createDataFrame(rows, "key long, text string, declared string, host string, domain string, suffix string, n long, p string")


def test_evidence_outweighs_a_short_text(spark):
    rng = random.Random(2)
    words = {"x": ["alpha", "gamma", "delta"], "y": ["zwurg", "krotz", "schnu"]}
    rows = []
    for i in range(400):
        k = "xy"[i % 2]
        rows.append((i, " ".join(rng.choice(words[k]) for _ in range(40)), k, f"h{i % 2}.{k}", f"d.{k}", k, 1, "p"))
    rows += [(1000, "a", None, "h0.x", "d.x", "x", 1, "p"), (1001, "a", None, "new.y", "d.y", "y", 1, "p"), (1002, None, "y", None, None, None, 1, "p"),
             (1003, None, None, None, None, None, None, None), (1004, "12 34 !!", None, "h0.x", None, None, 1, "p"), (1005, " ".join(["alpha"] * 9000), "y", None, None, None, 1, "p")]
    out = {r["key"]: r for r in lang.identify(records(spark, rows)).collect()}
    assert len(out) == len(rows)
    assert all(out[i]["language"] == "xy"[i % 2] and out[i]["kept"] for i in range(400))
    assert out[1000]["language"] == "x" and out[1001]["language"] == "y" and out[1002]["language"] == "y"
    assert not out[1003]["kept"] and not out[1004]["kept"] and out[1005]["language"] == "x"
    assert all(0 < r["probability"] <= 1 for r in out.values())
    assert lang.identify(records(spark, [])).count() == 0
    none = lang.identify(records(spark, [(1, "abc", None, None, None, None, None, None)])).collect()
    assert [(r["language"], r["kept"]) for r in none] == [(None, False)]


def test_fusion_equals_bayes_by_hand(spark):
    """The posterior from the stored parts: host prior, declared, suffix and tempered text."""
    rows = [(i, "abcab" if i % 2 else "xyzxy", "uv"[i % 2], "h" if i % 4 else "g", "d", "s", 1, "p") for i in range(16)]
    out = {r["key"]: r for r in lang.identify(records(spark, rows)).collect()}
    models = {}
    for k, text in (("u", "xyzxy"), ("v", "abcab")):
        models[k] = text
    n = {g: Counter("v" if i % 2 else "u" for i in range(16) if ("h" if i % 4 else "g") == g) for g in "gh"}
    whole = {k: (8 + 1.0 / 2) / 17 for k in "uv"}
    dom = {k: (8 + 25 * whole[k]) / 41 for k in "uv"}
    given = {(a, b): ((8 if a == b else 0) + 0.5) / (8 + 0.5 * 3) for a, b in itertools.product("uv", "uv")}
    for i in range(16):
        g, k = ("h" if i % 4 else "g"), "uv"[i % 2]
        other = "uv"[1 - i % 2]
        prior = {x: (n[g][x] + 10 * dom[x]) / (sum(n[g].values()) + 10) for x in "uv"}
        ratio = prior[other] * given[k, other] / (prior[k] * given[k, k])
        # The text only adds to the language it was learned from.
        assert out[i]["language"] == k and out[i]["probability"] >= 1 / (1 + ratio) - 1e-9


def test_copies_and_rare_languages_keep_their_models(spark):
    """Neither thousands of copies nor other languages' records push a language out of the sample."""
    rng = random.Random(3)
    words = {"x": ["alpha", "gamma", "delta"], "y": ["zwurg", "krotz", "schnu"], "z": ["oileain", "uisce", "bhfuil"]}
    text = lambda k: " ".join(rng.choice(words[k]) for _ in range(30))
    same = {k: text("x") for k in range(8)}
    rows = [same[i % 8] for i in range(4000)]
    told = [(t, "x") for t in rows] + [(text("x"), "x") for _ in range(1500)] + [(text("y"), "y") for _ in range(300)] + [(text("z"), "z") for _ in range(4)]
    every = records(spark, [(i, t, k, None, None, None, 1, "p") for i, (t, k) in enumerate(told)])
    out = lang.identify(every, fit_records=60).collect()
    assert {r["language"] for r in out if r["declared"] == "z"} == {"z"}
    assert all(r["kept"] and r["language"] == r["declared"] for r in out)
    from acctscreen.llm.common import Scratch

    scratch = Scratch(spark, "t")
    assert lang.fit_models(every, scratch, 60)[0] == ["x", "y", "z"]
    sample = Counter((r["declared"], r["text"]) for r in spark.read.parquet(f"{scratch.root}/sample").collect())
    assert set(sample.values()) == {1}
    assert Counter(k for k, _ in sample) == {"x": 50, "y": 50, "z": 4}
    assert lang.share([4, 300, 9000], 1000) == 696 and lang.share([5, 6], 1000) == 50 and lang.share([], 10) == 50


def test_corpus_and_filter(spark, documents, edge, no_docs):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = lang.identify_corpus(documents, pages).collect()
    assert sum(r["kind"] == "document" for r in out) == documents.count() and sum(r["kind"] == "page" for r in out) == pages.count()
    told = {r["doc_id"]: r["lang"] for r in documents.collect()}
    docs = [r for r in out if r["kind"] == "document"]
    assert sum(r["language"] == told[r["doc_id"]] for r in docs) >= 0.97 * len(docs)
    assert sum(r["kept"] for r in docs) >= 0.97 * len(docs)
    kept = lang.keep_identified(edge)
    assert kept.columns == edge.columns and kept.count() <= len(EDGE)
    assert {r["doc_id"] for r in kept.collect()} >= {1, 2}
    assert lang.keep_identified(no_docs).count() == 0


def test_rare_languages_keep_what_they_declare(spark):
    rows = [(1000 + i, prose(i, 60), "xx", None, None, None, None, None) for i in range(600)]
    rows += [(100, "щука жаба вълна ръка " * 20, "bg", None, None, None, None, None), (101, "щука жаба вълна ръка " * 20, None, None, None, None, None, None)]
    rows += [(200 + k, "ψάρι κύμα χέρι βουνό " * 20, "el", None, None, None, None, None) for k in range(5)]
    out = {r["key"]: r for r in lang.identify(records(spark, rows), most_models=1).collect()}
    assert [out[k]["kept"] for k in (1000, 100, 101, 200)] == [True, True, False, True]
    assert [out[k]["language"] for k in (1000, 100, 200)] == ["xx", "bg", "el"] and out[100]["probability"] == lang.ACCEPT
    few = lang.identify(records(spark, rows[600:602])).collect()  # no value is declared often enough for a model
    assert sorted((r["key"], r["language"], r["kept"]) for r in few) == [(100, "bg", True), (101, None, False)]


def test_hosts_of_registries_and_numbers(spark):
    urls = ["http://www.bbc.co.uk/x", "https://co.uk", "http://10.1.2.3/a", "http://[2001:db8::1]:80/", "http://a.b.example.com.", "http://x.gov.au:8080/?q=a.b", "http://host", "ftp://u@a.co.example/"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in df.select(*lang.address(F.col("u"))).collect()]
    assert got == [
        ("www.bbc.co.uk", "bbc.co.uk", "uk"), ("co.uk", "co.uk", "uk"), ("10.1.2.3", "10.1.2.3", None), ("[2001:db8::1]", "[2001:db8::1]", None),
        ("a.b.example.com", "example.com", "com"), ("x.gov.au", "x.gov.au", "au"), ("host", "host", None), ("a.co.example", "co.example", "example"),
    ]

"""Similarity join, decontamination, and the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from acctscreen.llm import op5_lshforest as forest
from acctscreen.llm import op8_decontaminate as clean
from acctscreen.llm import op9_langid as langid
from tests.llm.conftest import DOCS, EDGE, SF, prose


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=0.8):
    """Per row: (doc_id, class_id, set_id, n_links)."""
    sets = [shingle_set(t) for _, t in rows]
    label, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = lambda ids: min((x for x in ids if x is not None), default=None)
    by_class, by_set = defaultdict(list), defaultdict(list)
    for i, (d, _) in enumerate(rows):
        by_class[root(i)].append(d)
        by_set[sets[i] or i].append(d)
    return sorted(((d, least(by_class[root(i)]), least(by_set[sets[i] or i]), links[i]) for i, (d, _) in enumerate(rows)), key=repr)


def edited(text, n, seed):
    w, r = text.split(), random.Random(seed)
    for k in r.sample(range(len(w)), n):
        w[k] = f"neu{r.randint(0, 10**6)}"
    return " ".join(w)


def near_rows():
    rows, base = list(EDGE), prose(50, 200)
    rows += [(100 + i, edited(base, i % 5, i), "en", "a", 1, "x", 9, "k") for i in range(40)]
    rows += [(200 + i, prose(60, 100), "en", "a", 1, "x", 9, "k") for i in range(30)]
    rows += [(300 + i, prose(70, 30) + " " + prose(400 + i, 40), "en", "a", 1, "x", 9, "k") for i in range(30)]
    return rows


@pytest.mark.parametrize(("block", "block_shingles"), [(8, 1 << 20), (256, 900), (256, 1)])
def test_join_equals_brute_force(spark, monkeypatch, block, block_shingles):
    rows = near_rows()
    want = brute([r[:2] for r in rows])
    monkeypatch.setattr(forest, "BLOCK", block)
    monkeypatch.setattr(forest, "BLOCK_SHINGLES", block_shingles)
    got = forest.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_deduplication_keeps_one_of_each_group(spark, no_docs):
    rows = near_rows()
    df = spark.createDataFrame(rows, DOCS)
    kept = forest.deduplicate(df)
    assert kept.columns == df.columns
    got = Counter(r["doc_id"] for r in kept.collect())
    # All edits of one text are one group, as are all copies; a row that repeats is one.
    assert got[1] == 1 and got[2] == 0 and sum(got[100 + i] for i in range(40)) == 1 and sum(got[200 + i] for i in range(30)) == 1
    assert sum(got[300 + i] for i in range(30)) == 30 and got[7] == 2 and got[3] == got[4] == got[5] == 1 and got[None] == 2 and got[8] + got[9] == 1
    assert forest.near_duplicates(no_docs).count() == 0 and forest.deduplicate(no_docs).count() == 0


def test_depth_shortens_until_the_recall_at_the_threshold():
    depths = [forest.depth_for(s) for s in (0.99, 0.9, 0.85, 0.8)]
    assert depths == sorted(depths, reverse=True) and depths[0] == forest.DEPTH and depths[-1] == 5
    assert all(forest.found_by(d, s) >= forest.RECALL for d, s in zip(depths, (0.99, 0.9, 0.85, 0.8)))


def test_a_pair_at_the_threshold_among_many_near_equal_texts(spark):
    """Thousands of near-equal pairs do not make the prefixes too long for it."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    many = [rng.choice(words) for _ in range(120)]
    rows = [(k, " ".join([*many[:60], f"own{k}", *many[61:]])) for k in range(300)]
    # 36 shingles in all, 32 of them shared: 32 / 40 = 0.8 on the dot.
    for j in range(20):
        a = [f"p{j}x{k}" for k in range(40)]
        rows += [(1000 + 2 * j, " ".join(a)), (1001 + 2 * j, " ".join([*a[:36], *[f"q{j}x{k}" for k in range(4)]]))]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] == (0, 299) for k in range(300))
    for j in range(20):
        assert got[1000 + 2 * j] == got[1001 + 2 * j] == (1000 + 2 * j, 1)


def test_the_document_that_stays_does_not_depend_on_how_rows_are_dealt(spark):
    text = "one two three four five six seven"
    rows = [(5, text, "b"), (5, text, "a"), (5, text, "c"), (6, text, "a"), (7, "other words that stand quite alone here", "z")]
    kept = set()
    for order, parts in ((rows, 1), (rows[::-1], 3), (rows[2:] + rows[:2], 5)):
        out = forest.deduplicate(spark.createDataFrame(order, "doc_id long, text string, source string").repartition(parts))
        kept.add(tuple(sorted(map(tuple, out.collect()))))
    assert kept == {((5, text, "a"), (7, "other words that stand quite alone here", "z"))}


def test_hot_components_are_split(spark):
    from acctscreen.llm.common import Scratch
    from tests.test_skew import SKEW_CONF

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        both = spark.range(1, 9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("lo"), F.xxhash64("id").alias("hi"))
        both = Scratch(spark, "t").store(both, "both")
        least = both.groupBy(forest._by("lo")).agg(F.min("hi").alias("m")).select("_by.lo", "m")
        out = both.join(least, "lo")
        assert out.count() == 8999
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_overlaps_are_exact():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 5000, rng.integers(1, 3000)).astype(np.uint64)) for _ in range(25)]
    got = forest.overlaps(sets[:10], sets[10:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[10:]] for a in sets[:10]]


def test_components_of_chains(spark):
    from acctscreen.llm.common import Scratch

    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 100), (7, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, forest.components(df, Scratch(spark, "t"), "c").collect()))
    assert got == {i: i // 20 * 20 for i in range(60) if i % 20}


# -- decontamination -----------------------------------------------------------------

BENCH = "item_id long, text string, doc_id long"


def bench_rows():
    items = [(i, prose(900 + i, 30 + i, 3000).capitalize() + ". " + prose(950 + i, 8, 3000).capitalize() + ".", 1) for i in range(12)]
    return items + [(50, None, 1), (51, "", 1), (52, "!!!", 1), (0, items[0][1], 1)]


def leak_docs():
    items, r = bench_rows(), random.Random(3)
    docs, want = [], set()
    for i in range(12):
        w = items[i][1].replace(".", " ").split()
        verbatim = f"{prose(10 + i, 80, 3000)} {items[i][1]} {prose(30 + i, 700 if i == 3 else 60, 3000)}"
        said = [x for x in w if r.random() > 0.12]
        said.insert(len(said) // 2, "indeed")
        half = w[: len(w) // 3]
        docs += [(i, verbatim), (100 + i, f"{prose(60 + i, 40, 3000)} {' '.join(said).upper()} {prose(70 + i, 50, 3000)}"), (200 + i, f"{prose(80 + i, 60, 3000)} {' '.join(half)} {prose(90 + i, 60, 3000)}"), (300 + i, prose(500 + i, 200, 3000))]
        want |= {(i, i), (100 + i, i)}
    return [(d, t, "en", "a", 1, "x", 9, "k") for d, t in docs] + list(EDGE[2:]), want


def test_leaks_and_paraphrases_are_found(spark):
    rows, want = leak_docs()
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(bench_rows(), BENCH)
    got = clean.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["share"] >= clean.LCS for r in got)
    left = clean.decontaminate(docs, bench)
    assert left.columns == docs.columns
    held = {t for d, t, *_ in rows[: len(rows) - len(EDGE[2:])] if d in {d for d, _ in want}}
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(r[:2] for r in rows if r[1] not in held)


def test_decontamination_without_rows(spark, edge, no_docs):
    bench = spark.createDataFrame(bench_rows(), BENCH)
    assert clean.find_leaks(no_docs, bench).count() == 0 and clean.decontaminate(no_docs, bench).count() == 0
    assert clean.find_leaks(edge, bench.limit(0)).count() == 0 and clean.decontaminate(edge, bench.limit(0)).count() == len(EDGE)


def test_blocks_of_items_and_subsequences(spark):
    bench = spark.createDataFrame(bench_rows(), BENCH)
    blocks = list(clean.item_blocks(bench, 4))
    assert len(blocks) > 1 and sorted(i for b in blocks for i, _ in b) == list(range(12))

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old = row[:]
            for j, y in enumerate(b):
                row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
        return row[-1]

    r = np.random.default_rng(1)
    for _ in range(60):
        a, b = r.integers(0, 6, r.integers(1, 40)), r.integers(0, 6, r.integers(0, 60))
        assert clean.common_subsequence(a, b) == lcs(list(a), list(b))


def test_randomised_svd_finds_the_space(spark):
    """Against an exact SVD: the projection keeps as much of the matrix."""
    texts = [prose(700 + i % 6, 40, 80) for i in range(60)]
    items = clean._items([(i, t) for i, t in enumerate(texts)])
    vocabulary = clean.Vocabulary(np.unique(np.concatenate(items.words)))
    idf = np.ones(len(vocabulary.hashes))
    rows = []
    for w in items.words:
        for terms in clean._passages(w, vocabulary):
            t, x = clean._vector(terms, idf)
            v = np.zeros(len(idf))
            v[t] = x / np.linalg.norm(x)
            rows.append(v)
    a = np.array(rows)
    s = np.linalg.svd(a, compute_uv=False)
    space = clean.latent_space(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), vocabulary, idf, rank=8)
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-8)
    assert np.linalg.norm(a @ space) ** 2 >= 0.97 * (s[:8] ** 2).sum()


def fitted_docs():
    """Many more documents than a small sample holds, each with its own pair of
    frequent terms of the benchmark."""
    bench = [(k, prose(3000 + k, 50, 3000), 1) for k in range(30)]
    terms = sorted({w for _, t, _ in bench for w in t.split()})
    r = random.Random(4)
    docs = []
    for d in range(400):
        two = r.sample(terms, 2)
        docs.append((d, " ".join(two[i % 2] if i % 3 else prose(d * 40 + i, 1) for i in range(48))))
    return bench, docs + [(None, None), (3, ""), (4, "?!")]


def passage_rows(texts, vocabulary, idf):
    out = []
    for w in clean.hash_words([t or "" for t in texts], clean.PUNCTUATION, latin=True):
        for terms in clean._passages(w.view(np.int64), vocabulary):
            if len(terms):
                t, x = clean._vector(terms, idf)
                out.append(np.zeros(len(idf)))
                out[-1][t] = x / np.linalg.norm(x)
    return np.array(out)


def test_the_latent_space_is_fitted_to_every_document(spark, monkeypatch):
    """It keeps as much of all documents and the benchmark as an exact SVD of them."""
    seen = {}
    inner = clean.latent_space

    def kept(passages, vocabulary, idf, **options):
        seen.update(texts=Counter(r["text"] for r in passages.collect()), space=inner(passages, vocabulary, idf, **options), vocabulary=vocabulary, idf=idf)
        return seen["space"]

    monkeypatch.setattr(clean, "latent_space", kept)
    bench, docs = fitted_docs()
    clean.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, BENCH)).count()
    assert seen["texts"] == Counter([t for _, t in docs] + [t for _, t, _ in bench])
    space, a = seen["space"], passage_rows([t for _, t in docs], seen["vocabulary"], seen["idf"])
    own = passage_rows([t for _, t, _ in bench], seen["vocabulary"], seen["idf"])
    both = np.concatenate([a, own * math.sqrt(len(a) / len(own))])
    assert len(seen["idf"]) > clean.RANK
    best = (np.linalg.svd(both, compute_uv=False)[: clean.RANK] ** 2).sum()
    assert np.linalg.norm(both @ space) ** 2 >= 0.97 * best


@pytest.mark.parametrize("held, stored, dealt", [(1 << 24, 1 << 15, 1), (20_000, 3_000, 5)])
def test_products_of_terms_equal_those_of_all_passages(spark, monkeypatch, held, stored, dealt):
    """In any number of passes and tasks, and for weighted, empty and null rows."""
    monkeypatch.setattr(clean, "HELD", held)
    monkeypatch.setattr(clean, "STORED", stored)
    texts = [None, "", "zzzz", prose(1, 1, 300), prose(2, 16, 300), prose(3, 17, 300), prose(4, 32, 300), prose(5, 33, 300), prose(6, 700, 300), prose(6, 700, 300)]
    vocabulary = clean.Vocabulary(np.unique(np.concatenate(clean.hash_words([prose(k, 60, 300) for k in range(1, 7)], clean.PUNCTUATION, latin=True)).view(np.int64)))
    idf = np.random.default_rng(2).uniform(0.5, 5, len(vocabulary.hashes))
    a = np.concatenate([passage_rows([t], vocabulary, idf).reshape(-1, len(idf)) * math.sqrt(1 + i % 3) for i, t in enumerate(texts)])
    rows = spark.createDataFrame([(t, 1.0 + i % 3) for i, t in enumerate(texts)], "text string, weight double").repartition(dealt)
    start, got = clean._row_starts(len(idf)), np.zeros((len(idf),) * 2)
    for r in clean.term_products(rows, vocabulary, idf).collect():
        part = np.frombuffer(r["part"], np.int64)
        for k in range(r["first"], r["last"]):
            got[k, k:] += part[start[k] - start[r["first"]] : start[k + 1] - start[r["first"]]] / clean.UNIT
    assert np.allclose(got + got.T, a.T @ a, atol=1e-5)
    if dealt > 1:
        assert len(clean._row_ranges(start, held)) > 1


def test_a_text_that_keeps_enough_of_an_item_keeps_two_rare_words():
    for n in range(2, 200):
        kept = math.ceil(clean.LCS * n)
        assert clean.rarer(n) - (n - kept) >= min(2, kept) and clean.rarer(n) <= n


def every_window(items, texts):
    """(text, item) of all leaks: each item against every window of each text."""
    out = set()
    words = [w.view(np.int64) for w in clean.hash_words(texts, clean.PUNCTUATION, latin=True)]
    for d, h in enumerate(words):
        for k, w in enumerate(items.words):
            width = clean.PASSAGE + 2 * len(w)
            known = np.isin(h, w)
            if known.sum() < clean.LCS * len(w):
                continue
            for a in range(0, max(1, len(h) - width + len(w)), max(1, len(w) // 2)):
                if clean.is_leak(w, items.answer[k], h[a : a + width])[0]:
                    out.add((d, k))
                    break
    return out


@pytest.mark.parametrize("share", [1.0, 0.8, 0.6])
def test_recall_against_every_window(spark, share):
    """Items of 5 to 60 words, kept to a share and put into other text: of what
    a search over all windows finds, candidates must hold nine tenths."""
    r = random.Random(int(share * 10))
    bench = [(k, prose(2000 + k, 5 + k, 3000)) for k in range(56)]
    items = clean._items(bench)
    texts = []
    for _, t in bench:
        w = t.split()
        keep = sorted(r.sample(range(len(w)), math.ceil(share * len(w))))
        said = [w[i] for i in keep]
        for _ in range(len(w) - len(keep)):
            said.insert(r.randrange(len(said) + 1), r.choice(["also", "then", "some"]))
        texts.append(f"{prose(r.randrange(10**6), r.randrange(20, 60), 3000)} {' '.join(said)} {prose(r.randrange(10**6), 50, 3000)}")
    docs = spark.createDataFrame([(d, t) for d, t in enumerate(texts + [prose(5000 + i, 100, 3000) for i in range(40)])], "doc_id long, text string")
    want = every_window(items, texts)
    got = {(x["doc_id"], x["item_id"]) for x in clean.find_leaks(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    print(f"share {share}: {len(got & want)} of {len(want)}; short items {len([1 for d, k in want - got if k < 27])} missed")
    assert len(want) >= (40 if share > 0.6 else 20)
    assert len(got & want) >= 0.9 * len(want)


def test_passages_of_a_column_are_the_same_words():
    texts = ["Éa, b_c D9! e", "", None, "x" * 5]
    got = [[h[at[i] : at[i + 1]].tolist() for i in range(len(at) - 1)] for _, h, at in clean.word_hashes(pa.array(texts))]
    want = [w.view(np.int64).tolist() for w in clean.hash_words(["éa b_c d9 e", "", "", "xxxxx"], clean.PUNCTUATION, latin=True)]
    assert [x for part in got for x in part] == want


# -- pipeline --------------------------------------------------------------------------

def test_language_models_are_fitted_to_every_document(spark, monkeypatch):
    """To all texts, copies once, however many there are."""
    seen = []
    inner = langid.fit_models
    monkeypatch.setattr(langid, "fit_models", lambda *args, **options: seen.append(inner(*args, **options)) or seen[-1])
    words = prose(3, 9000, 3000).split()
    docs = [(f"{w} {words[k - 1]} {k}", "EN" if k % 9 else "de") for k, w in enumerate(words)]
    docs += docs[:500] + [("", "en"), (None, "de"), ("12 34", "fr"), ("12 34", "fr"), ("5", "fr"), (words[0], None), ("zzz", "xx")]
    rows = spark.createDataFrame([(k, t, x, "a", 1) for k, (t, x) in enumerate(docs)], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)["language"](spark, rows, "").count() <= len(docs)
    total = {k: np.zeros(langid.BUCKETS) for k in ("de", "en", "fr")}
    for t, x in {(t, x.lower()) for t, x in docs if t and x and x != "xx"}:
        code = np.concatenate([c for _, c, _ in langid.trigrams(pa.array([t]))])
        if len(code):
            total[x] += np.bincount(code, minlength=langid.BUCKETS) / np.sqrt(len(code))
    [(langs, models)] = seen
    assert langs == sorted(total)
    for k, x in enumerate(langs):
        assert models[k] == pytest.approx(np.log((total[x] + langid.SMOOTH) / (total[x] + langid.SMOOTH).sum()), abs=1e-9)


def test_decontamination_is_fitted_to_every_document(spark, monkeypatch, tmp_path):
    seen = []
    inner = clean.latent_space

    def kept(passages, *args, **options):
        seen.append(Counter(r["text"] for r in passages.collect()))
        return inner(passages, *args, **options)

    monkeypatch.setattr(clean, "latent_space", kept)
    bench, docs = fitted_docs()
    held = [(1000 + k, f"{prose(k, 20)} {t} {prose(40 + k, 20)}") for k, t, _ in bench[:5]]
    spark.createDataFrame(bench, BENCH).write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in docs + held], "doc_id long, text string, lang string, source string, n_chars long")
    left = dict(corpus_pipeline.STAGES)["decontamination"](spark, rows, str(tmp_path)).collect()
    assert seen == [Counter([t for _, t in docs + held] + [t for _, t, _ in bench])]
    assert sorted((r["doc_id"], r["text"]) for r in left if r["doc_id"] is not None) == sorted(x for x in docs if x[0] is not None)


def test_stages_and_run(spark, documents):
    """Each stage by brute force on its own input, at the smallest scale."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "decontamination", "mixing", "sharding"]
    docs, sizes = documents, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, SF).collect()
        sizes.append(len(out))
        if name == "sharding":
            assert Counter((r["doc_id"], r["text"], r["source"]) for r in out) == Counter((r["doc_id"], r["text"], r["source"]) for r in before)
            break
        assert out[0].__fields__ == documents.columns
        ids = Counter(r["doc_id"] for r in out)
        if name == "near_copies":
            want = brute([(r["doc_id"], r["text"]) for r in before])
            assert set(ids) == {c for _, c, _, _ in want}
        elif name == "decontamination":
            assert set(ids) <= {r["doc_id"] for r in before} and max(ids.values()) == 1
        elif name == "mixing":
            assert max(ids.values()) <= 2
        docs = spark.createDataFrame(out, documents.schema)
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_edge_rows(spark, edge, no_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    stage(spark, edge, SF).collect()
    assert stage(spark, no_docs, SF).count() == 0

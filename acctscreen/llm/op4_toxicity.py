"""Toxicity by a lexicon that tolerates misspellings.

The lexicon is learned from labelled documents: words, and stems that words
begin with, which are far more frequent in toxic documents than in others
and occur there in many contexts.  Terms form a trie.  Levenshtein automata
(bit-parallel, one state set for each number of edits) run along its branches
and accept a term one edit away, a stem also as the beginning of a word.
Each hit's weight depends on its context window: what stands between marks,
what someone is reported to have said and words that are only mentioned
count less, direct address more.  How much the weight of a document's hits,
their density and their variety say is a logistic regression on the same
documents.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctscreen.llm.common import Scratch, held_out, least_by_hash

FOLDS = 5
#: Labelled documents, the least by hash of id, that the lexicon is fitted to.
FIT_DOCS = 20_000
#: Features of toxic documents that are counted in the others, by frequency; terms of a lexicon.
FEATURES, TERMS = 50_000, 1_000
STEMS = (3, 4, 5, 6, 7, 8)
#: A term needs so many contexts, and to be so many times as frequent in toxic documents.
CONTEXTS, RATIO, MOST_WEIGHT = 8, 8.0, 6.0
#: Occurrences times the log of that: at least this much, and this share of the best term's.
LEAST_WORTH, WORTH_SHARE = 40.0, 0.02
#: A term of so many letters or more is looked for misspelled.
FUZZY = 5
WINDOW = 5
#: Factors of a hit that is reported or mentioned, between marks only, and in direct address.
QUOTED, MARKED, ADDRESSED = 0.4, 0.7, 1.25
#: Code points of a quotation; marks farther apart belong to different ones.
QUOTATION = 400
MEMO = 300_000

_WORD = re.compile(r"\w+")
#: Words of reported speech, of what follows them without marks, of mention and of direct address, fixed values.
REPORTS = frozenset("said says say called calls wrote writes quote quoted term word dijo dice llamó escribió palabra dit écrit appelé mot sagte sagt schrieb nannte wort".split())
THAT = frozenset("that que dass daß".split())
MENTIONS = frozenset("word term slur insult palabra término insulto mot terme insulte wort begriff schimpfwort".split())
ADDRESS = frozenset("you your youre yourself u tú tu usted vosotros vous toi du dich dir dein ihr euch sie".split())
#: Opening marks with what closes them; a straight one opens where no word ends.
_PAIRS = ('"', '"'), ("“", "”"), ("„", "“”"), ("«", "»"), ("»", "«"), ("‹", "›"), ("›", "‹"), ("‘", "’"), ("‚", "‘’"), ("'", "'")
_QUOTATION = re.compile("|".join(rf"(?<!\w){o}(?=\S)[^{c}\n]{{1,{QUOTATION}}}[{c}](?!\w)" for o, c in _PAIRS))
_STOP = re.compile(r"[.!?\n]")


class Trie:
    """Lexicon terms by their letters; ``ends[node]`` is a term's number or -1."""

    def __init__(self, terms: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        for k, term in enumerate(terms):
            node = 0
            for c in term:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(-1)
                node = self.next[node][c]
            self.ends[node] = k


def near_terms(word: str, trie: Trie, edits: int = 1, prefix: bool = False) -> dict[int, int]:
    """Terms within ``edits`` edits of ``word`` (with ``prefix``: of some
    beginning of it) and how many.  Bit i of state e says that i letters of
    the word are matched with e edits; a branch ends when no state is left."""
    at: dict[str, int] = {}
    for i, c in enumerate(word):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << (len(word) + 1)) - 1
    start = [1]
    for _ in range(edits):
        start.append((start[-1] | start[-1] << 1) & full)  # a letter of the word too many
    done, found, stack = 1 << len(word), {}, [(0, start)]
    while stack:
        node, states = stack.pop()
        if trie.ends[node] >= 0:
            for e, s in enumerate(states):
                if s & done or (prefix and s):
                    found[trie.ends[node]] = e
                    break
        for c, child in trie.next[node].items():
            m = at.get(c, 0)
            new = [(states[0] & m) << 1]
            for e in range(1, edits + 1):
                old = states[e - 1]
                new.append((((states[e] & m) << 1) | old | old << 1 | new[-1] << 1) & full)
            if any(new):
                stack.append((child, new))
    return found


@dataclass
class Lexicon:
    """Weights of words and stems as they are and (``near``) misspelled, the
    coefficients that turn a document's hits into log odds, and weights of
    whole words under a stem that count misspelled only; such a hit's term is
    the word after "="."""

    words: dict[str, float]
    stems: dict[str, float]
    near: dict[str, float] = field(default_factory=dict)
    odds: tuple[float, ...] = (-2.0, 0.0, 0.0, 0.0)
    under: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.near_words = [t for t in self.words if len(t) >= FUZZY and self.near.get(t, 0) > 0]
        self.under_words = [t for t in self.under if len(t) >= FUZZY and self.under[t] > 0]
        self.near_stems = [t for t in self.stems if len(t) >= FUZZY and self.near.get(t, 0) > 0]
        whole = self.near_words + self.under_words
        self.trie, self.stem_trie = Trie(whole), Trie(self.near_stems)
        self.named = [(self.near[t], t) for t in self.near_words] + [(self.under[t], "=" + t) for t in self.under_words]
        # An edit leaves the first two or the last two letters of a word as they are,
        self.heads = {t[:2] for t in whole}
        self.tails = {t[-2:] for t in whole}
        self.lengths = {len(t) + d for t in whole for d in (-1, 0, 1)}
        # and the first two of a stem or the three after them, one place off at most.
        self.stem_heads = {t[:2] for t in self.near_stems}
        self.cores = {t[2:5] for t in self.near_stems}
        self.stem_of = {"=" + t: t[:n] for t in self.under_words for n in reversed(STEMS) if t[:n] in self.stems}
        self.memo: dict[str, tuple[str, float, bool]] = {}

    def match(self, word: str) -> tuple[str, float, bool]:
        """The term that ``word`` stands for, its weight, and whether it is
        misspelled; ("", 0, False) if there is none."""
        hit = self.memo.get(word)
        if hit is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            hit = self.memo[word] = self._match(word)
        return hit

    def _match(self, word: str) -> tuple[str, float, bool]:
        if word in self.words:
            return word, self.words[word], False
        for n in STEMS:
            if word[:n] in self.stems and len(word) >= n:
                return word[:n], self.stems[word[:n]], False
        found: list[tuple[float, str]] = []
        if len(word) in self.lengths and (word[:2] in self.heads or word[-2:] in self.tails):
            found += [self.named[k] for k in near_terms(word, self.trie)]
        if len(word) >= FUZZY - 1 and (word[:2] in self.stem_heads or any(word[k : k + 3] in self.cores for k in (1, 2, 3))):
            found += [(self.near[t], t) for t in (self.near_stems[k] for k in near_terms(word, self.stem_trie, prefix=True))]
        weight, best = max(found, default=(0.0, ""))
        return best, weight, bool(best)


class Contexts:
    """Where the words of a text stand: its quotations and sentences."""

    def __init__(self, text: str, found: list[re.Match[str]]):
        self.words, self.starts = [m.group() for m in found], [m.start() for m in found]
        self.quotations = [m.span() for m in _QUOTATION.finditer(text)]
        self.opens = [a for a, _ in self.quotations]
        self.stops = [m.start() for m in _STOP.finditer(text)]

    def _first(self, at: int) -> int:
        """Number of words that begin before ``at``."""
        return bisect_left(self.starts, at)

    def factor(self, k: int) -> float:
        """Factor of a hit at the k-th word.

        Between marks: QUOTED if a word of reported speech stands in the window
        before or after the marks, else MARKED.  Without marks, in the hit's
        sentence: QUOTED after "said .. that" (a window's words may stand between
        them and the hit) or right after a word that announces a mention."""
        at, words = self.starts[k], self.words
        q = bisect_right(self.opens, at) - 1
        if q >= 0 and at < self.quotations[q][1]:
            a, b = (self._first(x) for x in self.quotations[q])
            outside = words[max(0, a - WINDOW) : a] + words[b : b + WINDOW]
            return QUOTED if any(w in REPORTS for w in outside) else MARKED
        s = bisect_left(self.stops, at)
        first = self._first(self.stops[s - 1]) if s else 0
        last = self._first(self.stops[s]) if s < len(self.stops) else len(words)
        before = words[max(first, k - 2 * WINDOW) : k]
        if before and before[-1] in MENTIONS:
            return QUOTED
        for j, w in enumerate(before):
            if w in REPORTS and any(x in THAT for x in before[j + 1 : j + 4]):
                return QUOTED
        around = words[max(first, k - WINDOW) : min(last, k + WINDOW + 1)]
        return ADDRESSED if any(w in ADDRESS for w in around) else 1.0


def evidence(text: str, lexicon: Lexicon) -> tuple[float, float, float]:
    """What the hits of a text say: the log of their weight, of their weight
    per word, and the number of their terms (5 at most)."""
    low = text.lower()
    words = _WORD.findall(low)
    hits = {w for w in set(words) if lexicon.match(w)[1]}
    total, terms = 0.0, set()
    if hits:
        contexts = Contexts(low, list(_WORD.finditer(low)))
        for k, w in enumerate(words):
            if w in hits:
                term, weight, _ = lexicon.match(w)
                total += weight * contexts.factor(k)
                terms.add(lexicon.stem_of.get(term, term))
    return math.log1p(total), math.log(0.005 + total / max(10, len(words))), float(min(5, len(terms)))


def score_text(text: str, lexicon: Lexicon) -> float:
    """Probability that ``text`` is toxic."""
    bias, *slopes = lexicon.odds
    odds = bias + sum(b * x for b, x in zip(slopes, evidence(text, lexicon), strict=True))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


# -- learning --------------------------------------------------------------------

def _features(word: str) -> list[str]:
    """The word, and its stems, marked with a star."""
    return [word, *[word[:n] + "*" for n in STEMS if len(word) >= n]]


def _toxic_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, context, number) of toxic documents; a context is the words
    on both sides.  The empty feature counts all words."""
    for batch in batches:
        n: Counter[tuple[str, str]] = Counter()
        for text in batch.column(0).to_pylist():
            words = _WORD.findall((text or "").lower())
            n["", ""] += len(words)
            for k, w in enumerate(words):
                around = f"{words[k - 1] if k else ''} {words[k + 1] if k + 1 < len(words) else ''}"
                n.update((f, around) for f in _features(w))
        rows = list(n)
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.string()), pa.array([n[x] for x in rows], pa.int64())], names=["feature", "around", "n"])


def _counted_in(known: frozenset[str]):
    """Occurrences of each known feature, and (as the empty one) of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = _WORD.findall((text or "").lower())
                n[""] += len(words)
                for w, k in Counter(words).items():
                    for f in _features(w):
                        if f in known:
                            n[f] += k
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["feature", "n"])

    return count


def _near_counter(lexicon: Lexicon):
    """Occurrences of each term misspelled, by label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w, k in Counter(_WORD.findall((text or "").lower())).items():
                    term, _, near = lexicon.match(w)
                    if near:
                        n[term, toxic] += k
        rows = list(n)
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.string()), pa.array([y for _, y in rows], pa.int32()), pa.array([n[x] for x in rows], pa.int64())], names=["term", "toxic", "n"])

    return count


def _evidence_of(lexicon: Lexicon):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([evidence(t or "", lexicon) for t in batch.column(0).to_pylist()], np.float64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(pa.array(rows[:, k]) for k in range(3)), batch.column(1).cast(pa.int32())], names=["a", "b", "c", "toxic"])

    return measure


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 60) -> np.ndarray:
    """Coefficients (bias first) of a logistic regression, by Newton's steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([1e-3, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return beta


def choose_terms(stats: dict[str, tuple[int, float]], most: int = TERMS) -> list[str]:
    """Of features (occurrences in toxic documents, how many times as frequent
    there) the ones that say most, none of which begins another; a word
    before a stem that stands for that word alone."""
    worth = {f: n * math.log(ratio) for f, (n, ratio) in stats.items()}
    least = max(LEAST_WORTH, WORTH_SHARE * max(worth.values(), default=0.0))
    by_worth = sorted((f for f in stats if worth[f] >= least), key=lambda f: (-worth[f], f.endswith("*"), -len(f), f))
    kept: list[str] = []
    begun, stems = set(), set()  # all beginnings of kept terms; kept stems
    for f in by_worth:
        plain = f.rstrip("*")
        if any(plain[:n] in stems for n in STEMS) or (f.endswith("*") and plain in begun):
            continue
        kept.append(f)
        begun.update(plain[:n] for n in range(1, len(plain) + 1))
        if f.endswith("*"):
            stems.add(plain)
        if len(kept) == most:
            break
    return kept


def words_under(stats: dict[str, tuple[int, float]], kept: list[str], most: int = TERMS) -> list[str]:
    """Words that say enough to be terms but begin with a kept stem.  A short
    stem is not looked for misspelled, and a longer one more loosely than the word."""
    stems = {f[:-1] for f in kept if f.endswith("*")}
    words = [f for f in choose_terms({f: x for f, x in stats.items() if not f.endswith("*")}, len(stats)) if len(f) >= FUZZY and any(f[:n] in stems for n in STEMS)]
    return words[:most]


def fit_lexicon(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fit_docs: int = FIT_DOCS, scratch: Scratch | None = None) -> Lexicon:
    """The lexicon of labelled documents whose fold is not held out.  The
    sample is of ``fit_docs`` ids at most; what comes to the driver are
    FEATURES features of that sample and three numbers for each document of it."""
    scratch = scratch or Scratch(docs.sparkSession, "toxic")
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", folds))
    chosen = usable.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = scratch.store(least_by_hash(chosen, ["_id"], fit_docs), "chosen")  # bounded by fit_docs
    sample = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(chosen), "_id")
    # Rows that repeat an id and a text are one example.
    sample = scratch.store(sample.dropDuplicates().repartition(24, "_id").select("text", "toxic"), "sample")

    rows = sample.filter("toxic = 1").select("text").mapInArrow(_toxic_features, "feature string, around string, n long")
    stats = rows.groupBy("feature").agg(F.sum("n").alias("n"), F.countDistinct("around").alias("contexts"))
    stats = stats.filter((F.col("contexts") >= CONTEXTS) | (F.col("feature") == "")).orderBy(F.desc("n"), "feature").limit(FEATURES)
    toxic = {r["feature"]: r["n"] for r in stats.collect()}
    clean = sample.filter("toxic = 0").select("text").mapInArrow(_counted_in(frozenset(toxic)), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    clean = {r["feature"]: r["n"] for r in clean.collect()}
    n_toxic, n_clean = toxic.pop("", 0), clean.get("", 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, {})

    # One occurrence in all, shared by the classes' sizes, is added: what was never seen speaks for neither.
    share = n_toxic / (n_toxic + n_clean)

    def ratio(n1: float, n0: float) -> float:
        return (n1 + share) / (n_toxic + share) / ((n0 + 1 - share) / (n_clean + 1 - share))

    rated = {f: (n, ratio(n, clean.get(f, 0))) for f, n in toxic.items()}
    kept = choose_terms({f: x for f, x in rated.items() if x[1] >= RATIO})
    weight = {f: min(MOST_WEIGHT, math.log(rated[f][1])) for f in kept}
    words = {f: w for f, w in weight.items() if not f.endswith("*")}
    stems = {f[:-1]: w for f, w in weight.items() if f.endswith("*")}
    # How misspelled terms fare in the sample; one that clean documents hold as often is dropped.
    under = words_under({f: x for f, x in rated.items() if x[1] >= RATIO}, kept)
    trial = Lexicon(words, stems, dict.fromkeys([*words, *stems], 1.0), under=dict.fromkeys(under, 2.0))
    near = {t: [0, 0] for t in [*words, *stems, *("=" + t for t in under)]}
    counted = sample.mapInArrow(_near_counter(trial), "term string, toxic int, n long").groupBy("term", "toxic").agg(F.sum("n").alias("n"))
    for r in counted.collect():
        near[r["term"]][r["toxic"]] = r["n"]
    near = {t: min(MOST_WEIGHT, math.log(ratio(n1, n0))) for t, (n0, n1) in near.items() if ratio(n1, n0) >= RATIO or n0 + n1 == 0}
    near = {t: w for t, w in near.items() if w > 0}
    under = {t: near.pop("=" + t) for t in under if "=" + t in near}
    lexicon = Lexicon(words, stems, near, under=under)
    data = sample.mapInArrow(_evidence_of(lexicon), "a double, b double, c double, toxic int").toPandas().to_numpy(np.float64)
    return Lexicon(words, stems, near, tuple(logistic(data[:, :3], data[:, 3])), under)


def _scorer(lexicon: Lexicon):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([score_text(t or "", lexicon) for t in batch.column(1).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return score


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text).

    Null and empty texts get the score of a text without hits; a null doc_id
    is held out; repeated rows are scored one by one.  Labels that are
    neither 0 nor 1 are left out, of several of one id the highest holds.
    Without toxic labels to learn from, nothing is predicted toxic."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lexicon = fit_lexicon(docs, labels.select("doc_id", "toxic"), folds, fit_docs)
    out = docs.mapInArrow(_scorer(lexicon), "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id", folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

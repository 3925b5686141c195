"""Secret scans, in Spark SQL functions only.

Three patterns give the base spans.  Beside them a window slides over each
candidate string (a long run of one character class); the Shannon entropy
of the window is kept up to date from incremental counts: the character
that enters and the one that leaves change two counts and two terms
``c * log2(c)`` of the sum.  Runs of windows whose entropy reaches the
class's threshold are further spans, unless an allow-list pattern fits the
candidate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base kinds, in the order of kinds.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"


@dataclass(frozen=True)
class CharClass:
    """Candidates are maximal runs of ``alphabet`` of ``window`` or more
    characters in which every pattern of ``needs`` occurs; windows of
    ``window`` characters with ``bits`` or more of entropy are secret."""

    kind: str
    alphabet: str
    letters: str
    window: int
    bits: float
    needs: tuple[str, ...]


#: Thresholds lie between the values that the entropy of a window can take.
CLASSES = (
    CharClass("entropy_hex", "[0-9A-Fa-f]", "0123456789ABCDEFabcdef", 16, 2.72, ("[0-9]", "[A-Fa-f]")),
    CharClass("entropy_base64", "[A-Za-z0-9+/_-]", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-", 20, 3.77, ("[0-9]", "[a-z]", "[A-Z]")),
)

#: Candidates that are no secrets: examples, placeholders, one character or one
#: alphabet repeated, identifiers in the form of a UUID, and paths, every part of
#: which is shorter than a window (a part as long as a window is looked at).
ALLOW = (
    r"EXAMPLE|[Ee]xample|PLACEHOLDER|[Pp]laceholder|CHANGEME|changeme",
    r"[Xx]{6}|0123456789|[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh]",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?!.*[A-Za-z0-9_-]{20})[A-Za-z0-9_-]*/[a-z/_-]*/[A-Za-z0-9/_-]*$",
)

SPAN = "array<struct<start:int,end:int,order:int,kind:string>>"


def _runs(text: Column, pattern: str) -> Column:
    """(start, end, text) of the leftmost non-overlapping matches, in code
    points.  The text between matches and the matches alternate, so their
    lengths give the places.  (Nothing that is computed from the whole text
    may stand inside a lambda: it would be computed once per element.)"""
    none = F.expr("cast(array() as array<struct<start:int,end:int,text:string>>)")
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["found"]), F.lit(0))
        run = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("text"))
        return F.struct(end.alias("at"), F.when(x["found"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(run))).alias("out"))

    walked = F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), walked).otherwise(none)


def _spans(runs: Column, order: int, kind: str) -> Column:
    return F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.lit(order).alias("order"), F.lit(kind).alias("kind")))


def entropy_spans(candidate: Column, c: CharClass) -> Column:
    """(start, end) in the candidate of the merged windows whose entropy is
    ``c.bits`` or more.  H = log2(w) - S / w with S the sum of n * log2(n)
    over the counts n in the window, so H >= bits where S <= limit."""
    w, limit = c.window, c.window * (math.log2(c.window) - c.bits)
    term = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(w + 1)])
    codes = F.transform(F.split(candidate, ""), lambda x: F.position(x, F.lit(c.letters)))
    counts = F.transform(F.sequence(F.lit(1), F.lit(len(c.letters))), lambda k: w - F.length(F.replace(F.substring(candidate, 1, w), F.substring(F.lit(c.letters), k, F.lit(1)), F.lit(""))))

    def hit(out: Column, at: Column, total: Column) -> Column:
        last = F.element_at(out, -1)
        new = F.array(F.struct(at.alias("start"), (at + w).alias("end")))
        joined = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), (at + w).alias("end"))))
        return F.when(total > limit, out).when(F.size(out) == 0, new).when(last["end"] >= at, joined).otherwise(F.concat(out, new))

    def slide(acc: Column, at: Column) -> Column:
        # The window moves to start at ``at``: codes[at - 1] leaves, codes[at + w - 1] enters.
        gone, come = F.get(acc["codes"], at - 1), F.get(acc["codes"], at + w - 1)
        n_out, n_in = F.get(acc["counts"], gone - 1), F.get(acc["counts"], come - 1)
        counts = F.transform(acc["counts"], lambda n, k: n + F.when(k + 1 == come, 1).when(k + 1 == gone, -1).otherwise(0))
        total = acc["total"] + F.get(term, n_in + 1) - F.get(term, n_in) + F.get(term, n_out - 1) - F.get(term, n_out)
        moved = F.struct(acc["codes"].alias("codes"), counts.alias("counts"), total.alias("total"), acc["out"].alias("out"))
        return F.when(gone == come, acc).otherwise(moved)

    def step(acc: Column, at: Column) -> Column:
        return F.struct(acc["codes"].alias("codes"), acc["counts"].alias("counts"), acc["total"].alias("total"), hit(acc["out"], at, acc["total"]).alias("out"))

    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    start = F.struct(codes.alias("codes"), counts.alias("counts"), F.lit(0.0).alias("total"), none.alias("out"))
    # One element for each window; the first only adds up the sum.
    places = F.sequence(F.lit(0), F.length(candidate) - w)

    def walk(acc: Column, at: Column) -> Column:
        summed = F.struct(acc["codes"].alias("codes"), acc["counts"].alias("counts"), F.aggregate(acc["counts"], F.lit(0.0), lambda a, n: a + F.get(term, n)).alias("total"), acc["out"].alias("out"))
        return F.when(at == 0, summed).otherwise(slide(acc, at))

    # Two functions a window: move (and sum up), then compare.
    return F.aggregate(places, start, lambda acc, at: _then(walk(acc, at), lambda x: step(x, at)), lambda acc: acc["out"])


def _then(value: Column, use) -> Column:
    """use(value) with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _suspicious(run: Column, c: CharClass, allow: tuple[str, ...]) -> Column:
    ok = F.lit(True)
    for need in c.needs:
        ok = ok & run.rlike(need)
    for pattern in allow:
        ok = ok & ~run.rlike(pattern)
    return ok


def _entropy_spans_of(text: Column, c: CharClass, order: int, allow: tuple[str, ...]) -> Column:
    runs = F.filter(_runs(text, f"{c.alphabet}{{{c.window},}}"), lambda r: _suspicious(r["text"], c, allow))

    def placed(r: Column) -> Column:
        span = lambda s: F.struct((r["start"] + s["start"]).alias("start"), (r["start"] + s["end"]).alias("end"), F.lit(order).alias("order"), F.lit(c.kind).alias("kind"))
        return F.transform(entropy_spans(r["text"], c), span)

    return F.flatten(F.transform(runs, placed))


def find_secrets(df: DataFrame, text: str = "text", classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``df`` with ``base_spans`` and ``entropy_spans``, arrays of
    (start, end, order, kind) in code points, end exclusive.

    A null or empty text has no spans.  Columns of ``df`` of those two names
    are replaced; all others stay as they are, repeated rows too."""
    t = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(_runs(t, ASSIGN), lambda r: F.length(F.regexp_extract(r["text"], ASSIGN, 2)) >= 12)
    access = F.filter(_runs(t, ACCESS), lambda r: r["end"] - r["start"] >= 18)
    hexes = _runs(t, HEX.replace("+", "{16,}"))  # a run of 16 or more is a match of [0-9a-f]+ that is kept
    base = F.concat(_spans(assign, 0, "assign"), _spans(access, 1, "access"), _spans(hexes, 2, "hex"))
    more = F.concat(*[_entropy_spans_of(t, c, 3 + k, allow) for k, c in enumerate(classes)])
    return df.withColumns({"base_spans": base.cast(SPAN), "entropy_spans": more.cast(SPAN)})


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def secret_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = find_secrets(docs.select("doc_id", "text")).select("doc_id", "base_spans", "entropy_spans")
    b = F.col("base_spans")
    return found.select(
        "doc_id",
        count(b, "assign").alias("n_assign"),
        count(b, "access").alias("n_access"),
        count(b, "hex").alias("n_hex"),
        F.sha2(joined(b), 256).alias("base_sha256"),
        joined(F.concat(b, "entropy_spans")).alias("spans"),
    )

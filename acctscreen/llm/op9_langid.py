"""Language identification by fusing evidence.

The likelihood of a record's text under byte-trigram models is combined, by
Bayes' rule, with what the record declares (markup language), with its
address suffix and with a prior of its host.  How far each declared value
and suffix can be trusted, and the host priors, are counted over all
records: the texts' own likelihoods say which language a record counts for.
Host priors are smoothed by the prior of their domain, that by the prior of
all records, so a host of a few records falls back on what stands above it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctscreen.llm.common import Scratch, chunks, fold_case, text_bytes

#: Hashed trigrams.
BUCKETS = 1 << 15
#: Texts that a declared language has in a sample (if one is asked for) in any case, if there are as many.
SHARE = 50
LEAST_RECORDS = 3  # of a declared language in the table, or it has no model
#: Languages that have a model, those with most records.  Records that declare
#: another one keep it where the models do not know their text.
MODELS = 64
SMOOTH = 0.5
#: Trigrams of running text depend on each other: of n, so many count.
EFFECTIVE, CEILING = 0.2, 200.0
#: Records that a host's or a domain's prior takes from the level above.
PRIOR_HOST, PRIOR_DOMAIN, PRIOR_ALL = 10.0, 25.0, 1.0
#: A record stays if its language has this probability, and if its text is not
#: farther (natural log per trigram) from what the models know than the first
#: number plus the second over the root of its trigrams: short texts vary more.
ACCEPT, STRANGE, STRANGE_SHORT = 0.5, 2.0, 12.0

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 256)]] = True


def trigrams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk of rows: first row, hashed byte trigrams, and their rows.
    Runs of letters in lower case count with a blank on either side; all else
    is a blank, and trigrams that are blank in the middle are left out."""
    data, offs = text_bytes(column)
    for a, b in chunks(offs):
        low = fold_case(data[offs[a] : offs[b]], latin=True)
        x = np.where(_LETTER[low], low, 0x20).astype(np.int64)
        row = np.repeat(np.arange(b - a), np.diff(offs[a : b + 1]))
        before, after = np.roll(x, 1), np.roll(x, -1)
        if len(x):
            start = np.append(True, row[1:] != row[:-1])
            before[start] = 0x20
            after[np.append(start[1:], True)] = 0x20
        code = ((before << 16 | x << 8 | after) * 0x9E3779B1 >> 9) & (BUCKETS - 1)
        keep = x != 0x20
        yield a, code[keep], row[keep]


def _trigram_counts(langs: list[str]):
    """Weights of each language's trigrams (declared, text): language's place, bucket, sum."""
    known = pa.array(langs, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(langs) * BUCKETS)
        for batch in batches:
            of = pc.index_in(batch.column(0), value_set=known).to_numpy()
            for a, code, row in trigrams(batch.column(1)):
                # A record counts as much as its number of letters' root, so a long one does not rule.
                np.add.at(total, of[a + row] * BUCKETS + code, 1 / np.sqrt(np.bincount(row)[row]))
        for k, counts in enumerate(total.reshape(-1, BUCKETS)):
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["lang", "bucket", "n"])

    return count


def share(sizes: list[int], most: int) -> int:
    """The largest number of texts for each language that sums to ``most`` or
    less, where one with fewer texts gives what it has; SHARE at least."""
    left, n = most, len(sizes)
    for k, size in enumerate(sorted(sizes)):
        if size * (n - k) > left:
            return max(SHARE, left // (n - k))
        left -= size
    return max(SHARE, *sizes, 0)


def _sampled(usable: DataFrame, fit_records: int, scratch: Scratch) -> DataFrame:
    """Each declared language's share of ``fit_records`` different texts: its least ones by hash."""
    usable = usable.withColumn("digest", F.xxhash64("text", "declared"))
    texts = scratch.store(usable.select("declared", "digest").distinct(), "texts")
    sizes = {r["declared"]: r["n"] for r in texts.groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = share(list(sizes.values()), fit_records)
    # Texts far beyond a language's share are left out by how many it has, so few more are ranked.
    near = 2 * most + 64
    bounds = [(x, int((near / n - 0.5) * 2**64) if n > 2 * near else 2**63 - 1) for x, n in sizes.items()]
    bounds = usable.sparkSession.createDataFrame(bounds, "declared string, bound long")
    first = texts.join(F.broadcast(bounds), "declared").filter(F.col("digest") <= F.col("bound"))
    rank = F.row_number().over(Window.partitionBy("declared").orderBy("digest"))
    chosen = scratch.store(first.withColumn("rank", rank).filter(F.col("rank") <= most).select("declared", "digest"), "chosen")
    sample = scratch.store(usable.join(F.broadcast(chosen), ["declared", "digest"]).dropDuplicates(["declared", "digest"]).select("declared", "text"), "sample")
    return sample.repartition(max(1, min(64, fit_records // 500)), F.xxhash64("text"))


def fit_models(records: DataFrame, scratch: Scratch, fit_records: int | None = None, models: int = MODELS) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities of trigrams by language, from all texts
    of the records that declare one (columns text, declared).  Copies count
    once, and a language needs LEAST_RECORDS records.  ``models`` languages at
    most, those with most records (ties by name), so what comes to the driver
    and what goes to the tasks are bounded however many values are declared.

    With ``fit_records`` the models are fitted to about so many texts only,
    of which each of these languages has its share."""
    usable = records.filter(F.col("declared").isNotNull() & (F.length("text") > 0)).select("declared", "text")
    sizes = usable.groupBy("declared").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_RECORDS)
    langs = sorted(r["declared"] for r in sizes.orderBy(F.desc("n"), "declared").limit(models).collect())
    total = np.zeros((len(langs), BUCKETS))
    if not langs:
        return langs, total
    usable = usable.filter(F.col("declared").isin(langs))
    texts = usable.distinct() if fit_records is None else _sampled(usable, fit_records, scratch)
    # A row for each language and bucket, whatever the number of tasks.
    sums = texts.mapInArrow(_trigram_counts(langs), "lang int, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    total[sums["lang"].to_numpy(np.int64), sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy()
    return langs, np.log((total + SMOOTH) / (total + SMOOTH).sum(1, keepdims=True))


def _likelihoods(models: np.ndarray, column: int):
    """Appends the number of trigrams and the mean log-likelihood by language."""
    table = np.ascontiguousarray(models.T.astype(np.float32))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            mean = np.zeros((batch.num_rows, table.shape[1]))
            for a, code, row in trigrams(batch.column(column)):
                if not len(code):
                    continue
                rows, first, size = np.unique(row, return_index=True, return_counts=True)
                n[a + rows] = size
                for k in range(table.shape[1]):
                    mean[a + rows, k] = np.add.reduceat(table[:, k][code], first, dtype=np.float64) / size
            lists = pa.ListArray.from_arrays(np.arange(0, mean.size + 1, max(1, mean.shape[1]), dtype=np.int32) if mean.shape[1] else np.zeros(batch.num_rows + 1, np.int32), pa.array(mean.ravel()))
            rest = [batch.column(k) for k in range(batch.num_columns) if k != column]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n), lists], names=[*(f"c{k}" for k in range(len(rest))), "n", "mean"])

    return score


#: Second labels under which a country's names are registered, fixed values.
REGISTRIES = ("ac", "co", "com", "edu", "gob", "gouv", "gov", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")


def address(url: Column) -> tuple[Column, Column, Column]:
    """Host, registered domain and suffix (last label) of an address.  The
    domain is the last two labels, or three where the second stands for a
    country's registry (``co.uk``); a numeric host is its own domain and has
    no suffix."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)", 1))
    host = F.regexp_replace(host, r"\.$", "")
    host = F.when(F.length(host) > 0, host)
    labels = F.split(host, r"\.", -1)
    named = (F.size(labels) > 1) & ~host.rlike(r"^\[|^[0-9.]+$")
    country = (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, F.size(labels) - 2).isin(*REGISTRIES)
    size = F.when(country & (F.size(labels) > 2), 3).otherwise(2)
    domain = F.when(named, F.array_join(F.slice(labels, -size, size), ".")).otherwise(host)
    return host, domain, F.when(named, F.element_at(labels, -1))


def markup_language(html: Column) -> Column:
    """The primary language subtag that the html element declares."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,8})", 1))
    return F.when(F.length(found) > 0, found)


def markup_text(html: Column) -> Column:
    """What is left of markup without scripts, styles, comments and tags."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def _smoothed(counts: DataFrame, by: str, above: DataFrame | None, on: str | None, strength: float, langs: list[str]) -> DataFrame:
    """Per value of ``by`` the array of (count + strength * prior above) / (all + strength)."""
    n = [F.sum(F.when(F.col("guess") == k, F.col("n")).otherwise(0)).alias(f"_{k}") for k in range(len(langs))]
    keys = [by] if on is None else [by, on]
    rows = counts.groupBy(*keys).agg(F.sum("n").alias("_all"), *n)
    prior = F.array(*[F.lit(1.0 / len(langs))] * len(langs)) if above is None else F.col("_above")
    if above is not None:
        rows = rows.join(above, on)
    return rows.select(by, F.array(*[(F.col(f"_{k}") + strength * F.get(prior, F.lit(k))) / (F.col("_all") + strength) for k in range(len(langs))]).alias("p"))


def identify(records: DataFrame, fit_records: int | None = None, most_models: int = MODELS) -> DataFrame:
    """``records`` (text, declared, host, domain, suffix and any others) with
    language, probability, n_trigrams and kept in place of the text.

    Missing evidence (null) counts for nothing.  A text without letters is
    judged by the rest, and kept only if some evidence is declared.  A record
    whose declared language has no model, as it is rare or beyond the
    ``most_models`` most frequent, keeps that language with the probability
    ACCEPT where the models do not know its text.  Values that appear in the
    records only are all that is learned from; without any declared language
    nothing is kept."""
    scratch = Scratch(records.sparkSession, "langid")
    told = ["declared", "host", "domain", "suffix"]
    added = ["language", "probability", "n_trigrams", "kept"]
    rest = [c for c in records.columns if c not in ("text", *told, *added)]
    # Columns that take no part travel as one, so their names clash with none made here.
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("row")
    records = records.select(row, *told, F.coalesce("text", F.lit("")).alias("text"))
    langs, models = fit_models(records, scratch, fit_records, most_models)
    shown = [*[F.col("row").getField(c).alias(c) for c in rest], *told]
    if not langs:
        told = F.col("declared").isNotNull()
        return records.select(*shown, F.col("declared").alias("language"), F.when(told, ACCEPT).otherwise(0.0).alias("probability"), F.lit(0).cast("long").alias("n_trigrams"), told.alias("kept"))
    names = ["row", *told]
    fields = [T.StructField(f"c{k}", records.schema[c].dataType) for k, c in enumerate(names)]
    fields += [T.StructField("n", T.LongType()), T.StructField("mean", T.ArrayType(T.DoubleType()))]
    scored = records.mapInArrow(_likelihoods(models, records.columns.index("text")), T.StructType(fields))
    scored = scored.withColumnsRenamed({f"c{k}": c for k, c in enumerate(names)})
    log = F.transform("mean", lambda m: m * F.least(F.col("n") * EFFECTIVE, F.lit(CEILING)))
    top = F.array_max("log")
    scored = scored.withColumn("log", log).withColumn("guess", F.when(F.col("n") > 0, F.array_position("log", top) - 1))
    scored = scratch.store(scored, "scored")

    # Counts by what is declared, by suffix and by host are small beside the records.
    sure = scored.filter("guess is not null")
    counts = scratch.store(sure.groupBy("declared", "suffix", "host", "domain", "guess").agg(F.count(F.lit(1)).alias("n")), "counts")
    every = counts.select(F.lit("all").alias("every"), "*")
    whole = _smoothed(every, "every", None, None, PRIOR_ALL, langs)
    by_domain = every.filter("domain is not null")
    domain = _smoothed(by_domain, "domain", whole.withColumnRenamed("p", "_above"), "every", PRIOR_DOMAIN, langs)
    by_host = counts.filter("host is not null")
    host = _smoothed(by_host, "host", domain.withColumnRenamed("p", "_above"), "domain", PRIOR_HOST, langs)
    overall = scratch.store(whole, "whole").first()
    overall = list(overall["p"]) if overall else [1.0 / len(langs)] * len(langs)

    def given_language(value: str) -> DataFrame:
        """log P(value | language), smoothed over the values and one unseen."""
        seen = counts.filter(F.col(value).isNotNull())
        n = [F.sum(F.when(F.col("guess") == k, F.col("n")).otherwise(0)).alias(f"_{k}") for k in range(len(langs))]
        rows = scratch.store(seen.groupBy(value).agg(*n), f"by-{value}")
        total = rows.agg(*[F.coalesce(F.sum(f"_{k}"), F.lit(0)).alias(f"t{k}") for k in range(len(langs))], F.count(F.lit(1)).alias("v")).first()
        logs = F.array(*[F.log((F.col(f"_{k}") + SMOOTH) / F.lit(float(total[f"t{k}"] + SMOOTH * (total["v"] + 1)))) for k in range(len(langs))])
        return scratch.store(rows.select(F.col(value).alias(f"_{value}"), logs.alias(f"log_{value}")), f"given-{value}")

    out = scored
    for value in ("declared", "suffix"):
        out = out.join(given_language(value), F.col(value) == F.col(f"_{value}"), "left").drop(f"_{value}")
    host = scratch.store(host.select(F.col("host").alias("_host"), F.transform("p", lambda p: F.log(p)).alias("log_host")), "hosts")
    out = out.join(host, F.col("host") == F.col("_host"), "left").drop("_host")
    prior = F.coalesce("log_host", F.array(*[F.log(F.lit(p)) for p in overall]))
    parts = ["log", "log_declared", "log_suffix"]
    terms = [functools.reduce(lambda a, b: a + b, [F.get(prior, F.lit(k)), *[F.coalesce(F.get(F.col(c), F.lit(k)), F.lit(0.0)) for c in parts]]) for k in range(len(langs))]
    out = out.withColumn("total", F.array(*terms))
    best = F.array_max("total")
    probability = 1 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("total")))
    names_of = F.array(*[F.lit(x) for x in langs])
    # What the models make of known text, the mean of the records' best means.
    usual = scored.filter("n > 0").agg(F.avg(F.array_max("mean"))).first()[0] or 0.0
    strange = (F.col("n") > 0) & (F.array_max("mean") < F.lit(usual - STRANGE) - STRANGE_SHORT / F.sqrt(F.greatest("n", F.lit(1))))
    evident = (F.col("n") > 0) | F.col("declared").isNotNull()
    known = evident & ~strange & (probability >= ACCEPT)
    alone = ~known & F.col("declared").isNotNull() & ~F.col("declared").isin(*langs)
    return out.select(
        *shown,
        F.when(alone, F.col("declared")).otherwise(F.get(names_of, (F.array_position("total", best) - 1).cast("int"))).alias("language"),
        F.when(alone, ACCEPT).otherwise(probability).alias("probability"),
        F.col("n").alias("n_trigrams"),
        (known | alone).alias("kept"),
    )


# -- documents and pages -----------------------------------------------------------

def document_records(docs: DataFrame) -> DataFrame:
    """Records of documents: lang is what they declare, source their host."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "text",
        F.lower(F.col("lang")).alias("declared"), F.concat(F.lit("source:"), F.col("source")).alias("host"), F.when(F.col("source").isNotNull(), "source:").alias("domain"), none.alias("suffix"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    host, domain, suffix = address(F.col("url"))
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), markup_text(html).alias("text"),
        markup_language(html).alias("declared"), host.alias("host"), domain.alias("domain"), suffix.alias("suffix"),
    )


def identify_corpus(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """kind, doc_id, page_id, language, probability, n_trigrams, kept of every document and page."""
    found = identify(document_records(docs).unionByName(page_records(pages)))
    return found.select("kind", "doc_id", "page_id", "language", "probability", "n_trigrams", "kept")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language is not identified.  All columns
    stay; rows that repeat an id are judged one by one, by their own text."""
    scratch = Scratch(docs.sparkSession, "keep")
    found = identify(document_records(docs).withColumn("digest", F.xxhash64(F.coalesce("text", F.lit("")), "declared", "host")))
    # What goes is a small part; rows alike in id, text, lang and source share a verdict.
    gone = scratch.store(found.filter(~F.col("kept")).select(F.xxhash64("doc_id", "digest").alias("_k")).distinct(), "gone")
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    inner = F.xxhash64(F.coalesce("row.text", F.lit("")), F.lower("row.lang"), F.concat(F.lit("source:"), "row.source"))
    rows = rows.withColumn("_k", F.xxhash64(F.col("row.doc_id").cast("long"), inner))
    return rows.join(gone, "_k", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in columns])

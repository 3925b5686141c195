"""License scan: an exact set-similarity join of text blocks and templates.

A template is a set of words.  A block is any stretch of a text that is a
quarter longer than the template at most, and it matches if it holds at least
17 of 20 of the template's words.  Words are ordered by how often the corpus
has them.  A block that matches must hold one of a template's few rarest
words (prefix filter) and as many template words as are needed (length
filter); the others are looked up from rare to frequent, until too few are
left to reach the threshold (positional filter).  No filter loses a block.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctscreen.llm.common import Scratch, chunks, fold_case, hash_spans, hash_words, text_bytes, word_bounds

#: Words are runs of digits, a-z (after lower-casing) and bytes beyond ASCII.
SEPARATORS = np.ones(256, bool)
SEPARATORS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 256)]] = False

# Phrases whose places are counted, by label.
PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}

# Wording of license notices, by label.  All but very short ones
# may miss some words or have others between.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("bsd", "released under the bsd license"),
    ("bsd", "licensed under the bsd license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("cc-by", "licensed under cc by"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    ("cc-by-nd", "licensed under cc by nd"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("reserved", "copyright c all rights reserved"),
)


def needed(n: int) -> int:
    """Words of a template of ``n`` different ones that a block must hold."""
    return (17 * n + 19) // 20


def width(words: int) -> int:
    """Longest block, in words, for a template of ``words`` words."""
    return (5 * words + 3) // 4


@dataclass(frozen=True)
class Terms:
    """Hashes of the templates' and phrases' words, in order of hash, and the
    words of each as places in it (a template's from rare to frequent)."""

    hashes: np.ndarray
    phrases: tuple[tuple[str, tuple[int, ...]], ...]
    templates: tuple[tuple[str, tuple[int, ...], int], ...]


def terms(phrases=PHRASES, templates=TEMPLATES, counts: dict[int, int] | None = None) -> Terms:
    texts = [*phrases.values(), *(t for _, t in templates)]
    hashed = hash_words(texts, SEPARATORS)
    if any(not len(h) for h in hashed):
        raise ValueError("a phrase or template without a word")
    hashes = np.unique(np.concatenate(hashed))
    n = {} if counts is None else counts
    rare = sorted(range(len(hashes)), key=lambda k: (n.get(k, 0), k))
    rank = {k: r for r, k in enumerate(rare)}
    at = [np.searchsorted(hashes, h).tolist() for h in hashed]
    return Terms(
        hashes,
        tuple((label, tuple(a)) for label, a in zip(phrases, at)),
        tuple((label, tuple(sorted(set(a), key=rank.get)), width(len(a))) for (label, _), a in zip(templates, at[len(phrases) :])),
    )


def _hits(column, known: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each chunk of rows: its first row, the places at which rows' words
    begin, and row, word (from 0 in the row) and term of every known word."""
    data, offs = text_bytes(column)
    for a, b in chunks(offs):
        low = fold_case(data[offs[a] : offs[b]])
        starts, ends, at = word_bounds(low, offs[a : b + 1] - offs[a], SEPARATORS)
        h = hash_spans(low, starts, ends)
        k = np.searchsorted(known, h)
        k[k == len(known)] = 0
        hit = np.flatnonzero(known[k] == h) if len(h) else np.zeros(0, np.int64)
        row = np.searchsorted(at, hit, "right") - 1
        yield a, at, row, hit - at[row], k[hit]


def _counter(known: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, _, _, term in _hits(batch.column(0), known):
                n += np.bincount(term, minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(known))), pa.array(n)], ["term", "n"])

    return count


def term_counts(docs: DataFrame, known: np.ndarray) -> dict[int, int]:
    """How often all texts hold each known word; one row for each of them."""
    rows = docs.select("text").mapInArrow(_counter(known), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {r["term"]: r["n"] for r in rows}


def _windows(at: np.ndarray, term: np.ndarray, wanted: tuple[int, ...], wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (of the last word wanted) and numbers of different wanted
    words of the blocks that match.  ``at`` are the places of known words, in
    order.  A block begins with a wanted word: no other holds more of them."""
    least = needed(len(wanted))
    none = np.zeros(0, np.int64)
    places = [at[term == u] for u in wanted]
    first = len(wanted) - least + 1
    if not any(len(p) for p in places[:first]) or sum(len(p) > 0 for p in places) < least:
        return none, none, none
    start = np.sort(np.concatenate(places))
    # Length filter: a block of fewer wanted words than are needed can't match.
    start = start[np.searchsorted(start, start + wide) - np.arange(len(start)) >= least]
    have, last = np.zeros(len(start), np.int64), start.copy()
    for k, p in enumerate(places):
        if not len(start):
            return none, none, none
        j = np.searchsorted(p, start)
        there = p[np.minimum(j, len(p) - 1)] if len(p) else np.zeros(len(start), np.int64)
        found = (j < len(p)) & (there < start + wide)
        have += found
        last = np.where(found, np.maximum(last, there), last)
        left = len(wanted) - k - 1
        # Prefix filter after the rarest words, positional filter at each one.
        keep = have + left >= least
        if k == first - 1:
            keep &= have > 0
        if not keep.all():
            start, have, last = start[keep], have[keep], last[keep]
    return start, last + 1, have


def _apart(start: np.ndarray, end: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of blocks that overlap the best one: most words wanted, then shortest, then first."""
    taken: list[int] = []  # starts of those chosen, in order
    chosen, ends = [], {}
    for k in np.lexsort((start, end - start, -have)).tolist():
        s, e = int(start[k]), int(end[k])
        i = bisect.bisect(taken, s)
        if (i and ends[taken[i - 1]] > s) or (i < len(taken) and taken[i] < e):
            continue
        taken.insert(i, s)
        ends[s] = e
        chosen.append(k)
    chosen.sort()
    return start[chosen], end[chosen], have[chosen]


def _finder(known: Terms):
    longest = max([w for _, _, w in known.templates], default=1) + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            n_words, n_base = np.zeros(size, np.int64), np.zeros(size, np.int64)
            first, last = [None] * size, [None] * size
            base: list[set] = [set() for _ in range(size)]
            blocks: list[list] = [[] for _ in range(size)]
            for a, starts, row, word, term in _hits(batch.column(1), known.hashes):
                n_words[a : a + len(starts) - 1] = np.diff(starts)
                # Rows lie so far apart that no block spans two.
                at = starts[row] + word + row * longest
                for label, phrase in known.phrases:
                    k = np.arange(max(len(at) - len(phrase) + 1, 0))
                    for j, u in enumerate(phrase):
                        k = k[(term[k + j] == u) & (at[k + j] == at[k] + j)]
                    np.add.at(n_base, a + row[k], 1)
                    for r, w in zip((a + row[k]).tolist(), word[k].tolist()):
                        base[r].add(label)
                        first[r] = w if first[r] is None else min(first[r], w)
                        last[r] = w if last[r] is None else max(last[r], w)
                for label, wanted, wide in known.templates:
                    s, e, n = _windows(at, term, wanted, wide)
                    if not len(s):
                        continue
                    s, e, n = _apart(s, e, n)
                    r = row[np.searchsorted(at, s)]
                    shift = starts[r] + r * longest
                    for doc, x, y, have in zip((a + r).tolist(), (s - shift).tolist(), (e - shift).tolist(), n.tolist()):
                        blocks[doc].append({"label": label, "start": x, "end": y, "containment": have / len(wanted)})
            for b in blocks:
                b.sort(key=lambda x: (x["start"], x["end"], x["label"], x["containment"]))
            score = [1.0 if x else max((y["containment"] for y in b), default=0.0) for x, b in zip(base, blocks)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()), pa.array(n_words), pa.array(n_base), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                    pa.array([",".join(sorted(x)) for x in base]),
                    pa.array([",".join(sorted(x | {y["label"] for y in b})) for x, b in zip(base, blocks)]),
                    pa.array(score, pa.float64()), pa.array(blocks, _BLOCKS),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"],
            )

    return find


_BLOCKS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))
_SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "blocks array<struct<label: string, start: long, end: long, containment: double>>"
)


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), equal rows too: its words,
    the places of ``phrases``, the labels found by either way, and ``blocks``
    (label, start and end in words, containment) that match ``templates``.

    ``score`` is 1 for a phrase, else the containment of the best block, 0
    without one.  A null or empty text has no words; a null doc_id stays null;
    other columns are not looked at; an empty table gives an empty one."""
    Scratch(docs.sparkSession, "licenses")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    plain = terms(phrases, templates)
    known = terms(phrases, templates, term_counts(rows, plain.hashes))
    return rows.mapInArrow(_finder(known), _SCANNED)


def license_digest(docs: DataFrame) -> DataFrame:
    """``scan`` without the blocks."""
    return scan(docs).drop("blocks")

"""License scan with a positional rare-token index (operator 10); DataFrame functions only.

Templates are short licence notices.  Document frequencies of their words are
counted over the whole corpus; each template is indexed under its
highest-IDF words with their positions.  A file's index words are looked up;
every hit proposes where the template would have to start, hits that agree on
that start are intersected, and a start is a match when its mandatory key
phrase stands in full and at least ``COVERAGE`` of the template's words stand
at their positions.  Places of the base phrases count and label by themselves.

Only the document frequencies of the template words (a number fixed by the
templates) reach the driver.

Defined results: a null or empty text has no words, no places, empty labels
and score 0; repeated rows are scanned alike; several matches give the sorted
distinct labels and the highest score; an empty table gives an empty table;
further columns are kept.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webstats.llm.common import whole_text

INDEX_WORDS = 4             # index words per template
COVERAGE = 0.6              # share of template words that have to stand at their places
SHIFT = 1 << 30

# fixed values: base phrases and their labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: label, notice, mandatory key phrase (a part of the notice); replace or extend as wanted
TEMPLATES = [
    ("mit", "released under the MIT License", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted"),
    ("apache", "licensed under the Apache License Version 2.0", "apache license"),
    ("gpl", "this work is licensed under the GNU General Public License version 3", "general public license"),
    ("lgpl", "under the terms of the GNU Lesser General Public License", "lesser general public license"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0", "cc by sa"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("mpl", "subject to the terms of the Mozilla Public License v 2.0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z folded."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def _template_words(notice: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", notice.translate(str.maketrans(UPPER, LOWER)))


def word_idf(df: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, float]:
    """Inverse document frequency, over all rows, of the words of a fixed vocabulary."""
    hits = df.select(F.array_intersect(words_of(whole_text(text)), F.array(*map(F.lit, vocabulary))).alias("w"))
    # the outer form: the plain one adds a filter on the array, pushed below, where it would tokenise again
    rows = hits.select(F.explode_outer(F.concat("w", F.array(F.lit("")))).alias("w")).groupBy("w").count().collect()
    found = {r["w"]: r["count"] for r in rows}
    n = found.get("", 0)
    return {w: math.log((n + 1) / (found.get(w, 0) + 1)) for w in vocabulary}


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _phrase_at(words: Column, phrase: list[str], at: Column) -> Column:
    """The words of ``phrase`` stand from position ``at`` (from 0) on."""
    out = F.lit(True)
    for j, w in enumerate(phrase):
        out = out & F.coalesce(F.get(words, at + j) == w, F.lit(False))
    return out


def scan_licenses(df: DataFrame, idf: dict[str, float], text: str = "text", templates=TEMPLATES, base=BASE,
                  index_words: int = INDEX_WORDS, coverage: float = COVERAGE) -> DataFrame:
    """``df`` with ``words``, ``places`` (start, label of base phrases) and ``matches`` (start, label, coverage)."""
    lists = [(label, _template_words(notice), _template_words(key)) for label, notice, key in templates]
    postings: dict[str, list[int]] = {}
    for t, (_, notice, _) in enumerate(lists):
        rare = sorted(set(notice), key=lambda w: (-idf.get(w, 0.0), w))[:index_words]
        for j, w in enumerate(notice):
            if w in rare:
                postings.setdefault(w, []).append((t + 1) * SHIFT * 2 - j)
    index = F.create_map(*[x for w, codes in postings.items() for x in (F.lit(w), F.array(*map(F.lit, codes)).cast("array<bigint>"))])
    keys = _strings(sorted(postings))
    words = F.col("words")
    out = df.withColumn("words", words_of(whole_text(text)))

    # base places
    phrases = [(p.split(" "), label) for p, label in base.items()]
    none = F.array().cast("array<struct<start:int,label:string>>")

    def base_at(i: Column) -> Column:
        label = F.lit(None).cast("string")
        for phrase, name in phrases:
            label = F.when(_phrase_at(words, phrase, i), F.lit(name)).otherwise(label)
        return F.struct(i.cast("int").alias("start"), label.alias("label"))

    lasts = _strings(sorted({p[-1] for p, _ in phrases}))
    every = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)))
    places = F.when(F.arrays_overlap(words, lasts),
                    F.filter(F.transform(every, base_at), lambda p: p["label"].isNotNull())).otherwise(none)
    out = out.withColumn("places", places)

    # proposed template starts: hit position minus template position, packed with the template's number
    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(keys, h["w"]))
    starts = F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(index, h["w"]), lambda c: c + h["i"])))
    nothing = F.array().cast("array<struct<start:int,label:string,coverage:double>>")

    def verify(c: Column) -> Column:
        t = F.floor((c + SHIFT) / F.lit(2 * SHIFT)).cast("long")
        at = (c - t * (2 * SHIFT)).cast("int")
        result = F.lit(None).cast("struct<start:int,label:string,coverage:double>")
        for n, (label, notice, key) in enumerate(lists):
            where = next(j for j in range(len(notice)) if notice[j:j + len(key)] == key)
            same = sum((F.coalesce(F.get(words, F.greatest(at + j, F.lit(0))) == w, F.lit(False)) & (at + j >= 0)).cast("int")
                       for j, w in enumerate(notice))
            share = same / F.lit(float(len(notice)))
            good = (t == n + 1) & (at + where >= 0) & _phrase_at(words, key, F.greatest(at + where, F.lit(0))) & (share >= coverage)
            result = F.when(good, F.struct(at.alias("start"), F.lit(label).alias("label"), share.alias("coverage"))).otherwise(result)
        return result

    proposed = F.array_distinct(starts)
    matches = F.when(F.arrays_overlap(words, keys),
                     F.filter(F.transform(proposed, verify), lambda m: m.isNotNull())).otherwise(nothing)
    return out.withColumn("matches", matches)


def license_vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, notice, _ in templates for w in _template_words(notice)})

"""Licence scan by a positional rare-token index, in DataFrame functions only.

Each template is the wording of a licence notice with key phrases that must be there. The index holds the
places of the words of all key phrases. Of a file, the licence words that it holds are ranked by inverse
document frequency over all documents. For every template whose key words it holds, the places of the rarest
of them are looked up; subtracting the place in the template gives where the template would start, and
where the looked-up words agree on a start, the key phrases are verified word by word. As all words of the key
phrases have to stand there, looking up more or other words of them would find the same: the frequencies
decide what a scan costs, never what it finds.

Besides, base phrases are found wherever their words stand consecutively. Words are runs of a-z,
0-9 and characters beyond ASCII, after A-Z became lower case. A null text has no words. Rows that repeat are
scanned each for itself, an empty table gives an empty result, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    label: str
    text: str
    key_phrases: Sequence[str]


BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Common wordings of licence notices.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("granted free of charge", "software and associated documentation")),
    Template("mit", "this project is released under the terms of the mit license", ("mit license",)),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("apache-2", "apache license version 2 0 january 2004 http www apache org licenses", ("apache license version 2", "january 2004")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license", ("gnu general public license", "version 3 of the license")),
    Template("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license", ("gnu general public license", "version 2 of the license")),
    Template("lgpl-3", "gnu lesser general public license as published by the free software foundation either version 3 of the license", ("gnu lesser general public license", "version 3")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "with or without modification")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc0", "licensed under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
)


def phrase_places(words: Sequence[str], phrase: Sequence[str]) -> list[int]:
    """Starts of the phrase in the words."""
    size = len(phrase)
    return [i for i in range(len(words) - size + 1) if list(words[i:i + size]) == list(phrase)]


def key_words(template: Template) -> list[tuple[int, str]]:
    """Places and words of the key phrases, each where it first stands in the template."""
    words = template.text.split()
    found = {}
    for phrase in template.key_phrases:
        start = phrase_places(words, phrase.split())[0]
        found |= {start + i: w for i, w in enumerate(phrase.split())}
    return sorted(found.items())


def vocabulary(templates: Sequence[Template]) -> list[str]:
    return sorted({w for t in templates for _, w in key_words(t)})


def _lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def document_frequencies(docs: DataFrame, words: Sequence[str]) -> dict[str, int]:
    """In how many rows of ``docs`` each of the given words stands; one number per given word."""
    known = F.array(*[F.lit(w) for w in words])
    found = docs.select(F.explode(F.array_intersect(F.split(_lower(F.col("text")), GAP + "+"), known)).alias("word"))
    counts = {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: counts.get(w, 0) for w in words}


def _pairs(pairs: Sequence[tuple[int, str]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("at"), F.lit(w).alias("word")) for i, w in pairs])


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, base: Mapping[str, str] = BASE_PHRASES,
         n_rare: int = 2) -> DataFrame:
    """One row per row of ``docs``.

    Returns ``doc_id``, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
    ``last_word`` (their smallest and largest start; null without any), ``base_labels``, ``labels``
    (distinct, sorted, comma-joined), ``score`` (1 with a base phrase, else the largest share of a
    verified template's words that stand in place, else 0) and ``matches`` (label, start word and
    share of each verified template). ``n_rare`` words of a template are looked up in a file at most.
    """
    words = vocabulary(templates)
    frequencies = document_frequencies(docs, words)
    ranked = sorted(words, key=lambda w: (frequencies[w], w))
    index: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        for at, word in key_words(template):
            index.setdefault(word, []).append((number, at))
    entry = "array<struct<template:int,at:int>>"
    postings = F.create_map(*[c for word, places in sorted(index.items()) for c in (F.lit(word), F.array(*[
        F.struct(F.lit(t).alias("template"), F.lit(i).alias("at")) for t, i in places]).cast(entry))])
    required = [sorted({w for _, w in key_words(t)}, key=ranked.index) for t in templates]
    needed = F.array(*[_pairs(key_words(t)) for t in templates])
    whole = F.array(*[_pairs(list(enumerate(t.text.split()))) for t in templates])
    names = F.array(*[F.lit(t.label) for t in templates])

    # Files without a base phrase and without the rarest key word of any template need no list of their words.
    phrase = "|".join([rf"{GAP}+".join(p.split()) for p in base] + sorted({r[0] for r in required}))
    likely = F.col("low").rlike(rf"(?:^|{GAP})(?:{phrase})(?:{GAP}|$)")
    named = docs.select("doc_id", _lower(F.col("text")).alias("low")).select(
        "doc_id", F.regexp_count("low", F.lit(WORD)).cast("bigint").alias("n_words"),
        F.when(likely, F.regexp_extract_all("low", F.lit(f"({WORD})"), 1))
        .otherwise(F.array().cast("array<string>")).alias("words"))

    def stands(phrase_words: Sequence[str], i: Column) -> Column:
        here = F.lit(True)
        for k, word in enumerate(phrase_words):
            here = here & F.coalesce(F.get("words", i + k) == word, F.lit(False))
        return here

    def phrase_starts(words: Sequence[str], label: str) -> Column:
        starts = F.filter(F.transform("words", lambda w, i: i), lambda i: stands(words, i))
        return F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.cast("bigint").alias("start")))

    places = F.concat(*[phrase_starts(p.split(), label) for p, label in base.items()])
    of_templates = F.array(*[
        F.struct(F.lit(t).alias("template"), F.array(*[F.lit(w) for w in r]).alias("words")) for t, r in enumerate(required)])
    # The file's licence words, of highest inverse document frequency first, and what is to be looked up for it.
    held = F.array_intersect(F.array(*[F.lit(w) for w in ranked]), "words")
    asked = F.transform(
        F.filter(of_templates, lambda t: F.size(F.array_except(t["words"], "held")) == 0),
        lambda t: F.struct(t["template"].alias("template"), F.slice(F.array_intersect("held", t["words"]), 1, n_rare).alias("rare")))
    sought = F.array_distinct(F.flatten("asked.rare"))
    seen = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
                    lambda x: F.array_contains("sought", x["word"]))

    def votes_of(t: Column) -> Column:
        return F.flatten(F.transform(F.filter("seen", lambda x: F.array_contains(t["rare"], x["word"])), lambda x: F.transform(
            F.filter(F.element_at(postings, x["word"]), lambda p: p["template"] == t["template"]),
            lambda p: F.struct(t["template"].alias("template"), (x["at"] - p["at"]).alias("start"), x["word"].alias("word"),
                               F.size(t["rare"]).alias("needed")))))

    # A template's start has one vote of each looked-up word at most.
    key = lambda k: F.struct(F.get("votes", k)["template"], F.get("votes", k)["start"])
    agreed = F.filter("votes", lambda v, k: (k + 1 >= v["needed"]) & (key(k) == key(k - v["needed"] + 1)))

    def in_place(pairs: Column, start: Column) -> Column:
        return F.filter(pairs, lambda p: F.coalesce(F.get("words", start + p["at"]) == p["word"], F.lit(False)))

    def verified(c: Column) -> Column:
        must = F.get(needed, c["template"])
        return F.size(in_place(must, c["start"])) == F.size(must)

    matches = F.transform(F.filter("agreed", verified), lambda c: F.struct(
        F.get(names, c["template"]).alias("label"), c["start"].cast("bigint").alias("start"),
        (F.size(in_place(F.get(whole, c["template"]), c["start"])) / F.size(F.get(whole, c["template"]))).alias("share")))
    found = (
        named.withColumn("places", places)
        .withColumn("held", held)
        .withColumn("asked", asked)
        .withColumn("sought", sought)
        .withColumn("seen", seen)
        .withColumn("votes", F.array_sort(F.array_distinct(F.flatten(F.transform("asked", votes_of)))))
        .withColumn("agreed", agreed)
        .withColumn("matches", matches)
    )
    joined = lambda *labels: F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*labels))))
    base_labels, more = F.col("places.label"), F.col("matches.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(base_labels, more).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.share"), F.lit(0.0))).alias("score"),
        "matches")

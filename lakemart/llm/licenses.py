"""License scans with a positional rare-token index (native).

Each licence template is indexed by its highest-IDF words: document
frequencies of all template words are counted over the whole corpus, and the
rarest few of each template become postings (word, template, position). A
text looks up the index words it contains; postings that agree on the
relative position (word position - template position) are intersected, and
an alignment with enough of the template's rare words must also have the
template's mandatory key phrase at its place. Base phrases are found wherever
their words stand consecutively.

Both passes are narrow: the only shuffled rows are counts of template words
(their number is bounded by the templates), and the index is a literal of at
most ``RARE`` postings a template. Alignments are found per row by sorting,
so a text full of licence words stays linear apart from that sort.

Defined cases: null and wordless texts have no words, no labels and score 0;
without documents all frequencies are 0 and ties go by the word; repeated
rows are scanned alike; other columns are carried.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, without

# Base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Licence notices as published, with the phrase that must be there.
TEMPLATES = (
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2 0"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2", "gnu general public license version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", "gnu general public license version 3"),
    ("lgpl", "under the terms of the GNU Lesser General Public License", "lesser general public license"),
    ("agpl", "under the terms of the GNU Affero General Public License", "affero general public license"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "all copyright and related or neighboring rights"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "released into the public domain"),
)
#: Postings of a template, and the least share of them that must align.
RARE = 4
SHARE = 0.75
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(s: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", s.lower())


def template_words(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, t, _ in templates for w in _words(t)})


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case; other letters may change their case
    but not become ASCII (the Kelvin sign would)."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))


def split_alnum(low: Column) -> Column:
    """Alphanumeric words of a lower-cased text."""
    def ends(s: Column) -> Column:
        first = (F.get(s, F.lit(0)) == "").cast("int")
        last = (F.get(s, F.size(s) - 1) == "").cast("int")
        return F.slice(s, first + 1, F.greatest(F.size(s) - first - last, F.lit(0)))
    return let(F.split(low, SEPARATOR), ends)


def document_frequencies(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> dict[str, int]:
    """Documents that contain each template word (a driver-side table of as
    many numbers as the templates have words)."""
    vocabulary = F.array(*[F.lit(w) for w in template_words(templates)])
    found = docs.select(F.explode(F.array_intersect(split_alnum(lowered(F.col(text))), vocabulary)).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: counts.get(w, 0) for w in template_words(templates)}


def build_index(frequencies: dict[str, int], templates=TEMPLATES, rare: int = RARE) -> list[tuple[str, int, int]]:
    """Postings (word, template, first position) of the rarest words."""
    out = []
    for t, (_, notice, _) in enumerate(templates):
        words = _words(notice)
        best = sorted(set(words), key=lambda w: (frequencies.get(w, 0), w))[:rare]
        out += [(w, t, words.index(w)) for w in best]
    return out


def _lits(values, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def _places(words: Column, phrase: str) -> Column:
    """Start positions of a phrase in a word array."""
    p = _words(phrase)
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - len(p), F.lit(0)))

    def here(i: Column) -> Column:
        same = F.get(words, i) == p[0]
        for k, w in enumerate(p[1:], 1):
            same = same & F.coalesce(F.get(words, i + k) == w, F.lit(False))
        return F.coalesce(same, F.lit(False))
    return F.filter(at, here)


def scan_licenses(docs: DataFrame, text: str = "text", templates=TEMPLATES, rare: int = RARE, share: float = SHARE) -> DataFrame:
    """``docs`` plus ``lic_`` columns: n_words, n_base, first_word,
    last_word, base_labels, labels (arrays) and score: the best share of a
    template's rare words in place (verified), 1 for a base phrase."""
    docs = without(docs, "lic_n_words", "lic_n_base", "lic_first_word", "lic_last_word", "lic_base_labels", "lic_labels", "lic_score")
    postings = build_index(document_frequencies(docs, text, templates), templates, rare)
    sizes = [sum(1 for p in postings if p[1] == t) for t in range(len(templates))]
    need = [max(1, -(-int(share * 100) * n // 100)) for n in sizes]
    keys = [_words(k) for _, _, k in templates]
    offsets = []
    for (_, notice, _), k in zip(templates, keys):
        w = _words(notice)
        offsets.append(next(i for i in range(len(w)) if w[i:i + len(k)] == k))
    index = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(t).alias("t"), F.lit(p).alias("p")) for w, t, p in postings])
    index_words = _lits(sorted({p[0] for p in postings}), "string")

    def aligned(words: Column, present: Column) -> Column:
        where = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains(present, x["w"]))
        votes = F.flatten(F.transform(where, lambda x: F.transform(
            F.filter(index, lambda p: p["w"] == x["w"]), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["p"]).alias("o")))))

        def runs(s: Column) -> Column:
            first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == 0) | (F.get(s, j) != F.get(s, j - 1)))
            return let(first, lambda f: F.transform(f, lambda j, q: F.struct(
                F.get(s, j)["t"].alias("t"), F.get(s, j)["o"].alias("o"), (F.coalesce(F.get(f, q + 1), F.size(s)) - j).alias("n"))))

        def verified(a: Column) -> Column:
            begin = a["o"] + F.get(_lits(offsets, "int"), a["t"])
            key = F.get(F.array(*[_lits(k, "string") for k in keys]), a["t"])
            there = F.when(begin >= 0, F.slice(words, F.greatest(begin, F.lit(0)) + 1, F.size(key)) == key).otherwise(F.lit(False))
            return (a["n"] >= F.get(_lits(need, "int"), a["t"])) & there
        good = let(F.sort_array(votes), lambda s: F.when(F.size(s) > 0, F.filter(runs(s), verified)))
        return F.transform(good, lambda a: F.struct(
            F.get(_lits([t[0] for t in templates], "string"), a["t"]).alias("label"),
            (a["n"] / F.get(_lits(sizes, "int"), a["t"])).alias("share")))

    base_re = "|".join(SEPARATOR.join(_words(p)) for p, _ in BASE)
    d = docs.select("*", lowered(F.col(text)).alias("__low"))
    low = F.col("__low")

    def found(w: Column) -> Column:
        places = [F.when(low.rlike(base_re), _places(w, p)).otherwise(F.array().cast("array<int>")) for p, _ in BASE]
        return F.struct(F.size(w).cast("long").alias("n"), F.array(*places).alias("p"),
                        let(F.array_intersect(w, index_words), lambda p: F.when(F.size(p) >= min(need), aligned(w, p))).alias("m"))
    # one expression: wherever the optimizer moves it, words are split once
    d = d.select(*docs.columns, let(split_alnum(low), found).alias("__f"))
    d = d.select(*docs.columns, F.col("__f.n").alias("lic_n_words"), F.col("__f.p").alias("__p"), F.col("__f.m").alias("__m"))
    every = F.flatten("__p")
    base = F.filter(F.array(*[F.when(F.size(F.get("__p", F.lit(i))) > 0, F.lit(label)) for i, (_, label) in enumerate(BASE)]), lambda x: x.isNotNull())
    matches = F.coalesce(F.col("__m"), F.array().cast("array<struct<label:string,share:double>>"))
    d = d.select(*docs.columns, "lic_n_words", F.size(every).cast("long").alias("lic_n_base"),
                 F.array_min(every).cast("long").alias("lic_first_word"), F.array_max(every).cast("long").alias("lic_last_word"),
                 F.sort_array(F.array_distinct(base)).alias("lic_base_labels"), matches.alias("__m"))
    labels = F.sort_array(F.array_distinct(F.concat("lic_base_labels", F.transform("__m", lambda m: m["label"]))))
    best = F.coalesce(F.array_max(F.transform("__m", lambda m: m["share"])), F.lit(0.0))
    return d.select(*docs.columns, "lic_n_words", "lic_n_base", "lic_first_word", "lic_last_word", "lic_base_labels", labels.alias("lic_labels"),
                    F.when(F.col("lic_n_base") > 0, F.lit(1.0)).otherwise(best).cast("double").alias("lic_score"))

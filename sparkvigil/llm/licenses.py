"""License scans by a positional index of rare words, in DataFrame functions only.

The templates below are indexed by word: every word posts the templates and places where it stands.
For every template of which the document holds all words of a key phrase, the ``TOP`` words that it
holds of the template and of each such phrase with the highest inverse document frequency (counted
over all documents) are looked up. A word at place p of the document that stands at place t
of a template votes for that template beginning at p - t; a template is a candidate where enough of
its looked-up words agree on one beginning, and it is reported where, besides, one of its mandatory
key phrases stands in the document word for word.

Base phrases are found at every place, whatever their words' frequency. All of it happens inside the
row, on the arrays of its words and their places: no row is ever shuffled or repeated.

Defined results: a null text is an empty one and has no words; overlapping places are all counted;
repeated rows give equal results; an empty table gives an empty result; ties of document frequency
go to the word that sorts first; columns of the input are kept, new ones are named by the caller.
"""

from __future__ import annotations

from math import log
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and labels that are always reported.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
GNU = "free software you can redistribute it and or modify it under the terms of the"
FOUNDATION = "as published by the free software foundation either version"
# The notices of common licences as they are usually quoted, one template each, and the
# phrases of which a document must hold one, where the template has it. Versions stand in the phrases.
NOTICES: list[tuple[str, str, tuple[str, ...]]] = [
    ("agpl-3.0", f"{GNU} gnu affero general public license {FOUNDATION} 3", (f"gnu affero general public license {FOUNDATION} 3",)),
    ("agpl-3.0", "under the gnu affero general public license version 3", ("gnu affero general public license version 3",)),
    ("agpl-3.0", "spdx license identifier agpl 3 0", ("spdx license identifier agpl 3 0",)),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in"
        " compliance with the license",
        ("apache license version 2 0",),
    ),
    ("apache-2.0", "www apache org licenses license 2 0", ("apache org licenses license 2 0",)),
    ("apache-2.0", "spdx license identifier apache 2 0", ("spdx license identifier apache 2 0",)),
    ("artistic-2.0", "under the terms of the artistic license 2 0", ("artistic license 2 0",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    ("bsd-2-clause", "spdx license identifier bsd 2 clause", ("spdx license identifier bsd 2 clause",)),
    (
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
        ("names of its contributors may be used to endorse or promote products derived from this software",),
    ),
    ("bsd-3-clause", "spdx license identifier bsd 3 clause", ("spdx license identifier bsd 3 clause",)),
    ("bsl-1.0", "boost software license version 1 0", ("boost software license version 1 0",)),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    (
        "cc-by-nc-4.0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial 4 0",),
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    (
        "cc-by-nc-nd-4.0",
        "licensed under a creative commons attribution noncommercial noderivatives 4 0 international license",
        ("creative commons attribution noncommercial noderivatives 4 0",),
    ),
    ("cc-by-nc-nd-4.0", "licensed under cc by nc nd 4 0", ("cc by nc nd 4 0",)),
    (
        "cc-by-nc-sa-4.0",
        "licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
        ("creative commons attribution noncommercial sharealike 4 0",),
    ),
    ("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0", ("cc by nc sa 4 0",)),
    (
        "cc-by-sa-3.0",
        "licensed under the creative commons attribution sharealike 3 0 unported license",
        ("creative commons attribution sharealike 3 0",),
    ),
    ("cc-by-sa-3.0", "licensed under cc by sa 3 0", ("cc by sa 3 0",)),
    (
        "cc-by-sa-4.0",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike 4 0",),
    ),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc0-1.0", "creative commons cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("cc0-1.0", "spdx license identifier cc0 1 0", ("spdx license identifier cc0 1 0",)),
    ("epl-2.0", "under the terms of the eclipse public license 2 0", ("eclipse public license 2 0",)),
    ("epl-2.0", "under the terms of the eclipse public license v 2 0", ("eclipse public license v 2 0",)),
    ("gpl-2.0", f"{GNU} gnu general public license {FOUNDATION} 2", (f"gnu general public license {FOUNDATION} 2",)),
    ("gpl-2.0", "under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-2.0", "spdx license identifier gpl 2 0", ("spdx license identifier gpl 2 0",)),
    ("gpl-3.0", f"{GNU} gnu general public license {FOUNDATION} 3", (f"gnu general public license {FOUNDATION} 3",)),
    (
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    ("gpl-3.0", "under the gnu general public license v3", ("gnu general public license v3",)),
    ("gpl-3.0", "spdx license identifier gpl 3 0", ("spdx license identifier gpl 3 0",)),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted provided that the above copyright notice and this permission notice appear",),
    ),
    ("isc", "spdx license identifier isc", ("spdx license identifier isc",)),
    (
        "lgpl-2.1",
        f"{GNU} gnu lesser general public license {FOUNDATION} 2 1",
        (f"gnu lesser general public license {FOUNDATION} 2 1",),
    ),
    ("lgpl-2.1", "under the gnu lesser general public license version 2 1", ("gnu lesser general public license version 2 1",)),
    ("lgpl-2.1", "spdx license identifier lgpl 2 1", ("spdx license identifier lgpl 2 1",)),
    (
        "lgpl-3.0",
        f"{GNU} gnu lesser general public license {FOUNDATION} 3",
        (f"gnu lesser general public license {FOUNDATION} 3",),
    ),
    ("lgpl-3.0", "under the gnu lesser general public license version 3", ("gnu lesser general public license version 3",)),
    ("lgpl-3.0", "spdx license identifier lgpl 3 0", ("spdx license identifier lgpl 3 0",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge to any person obtaining a copy of this software",),
    ),
    ("mit", "released under the mit license", ("under the mit license",)),
    ("mit", "under the terms of the mit license", ("terms of the mit license",)),
    ("mit", "spdx license identifier mit", ("spdx license identifier mit",)),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    ("mpl-2.0", "under the mozilla public license version 2 0", ("mozilla public license version 2 0",)),
    ("mpl-2.0", "spdx license identifier mpl 2 0", ("spdx license identifier mpl 2 0",)),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", ("sil open font license version 1 1",)),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish"
        " use compile sell or distribute this software",
        ("free and unencumbered software released into the public domain",),
    ),
    ("unlicense", "spdx license identifier unlicense", ("spdx license identifier unlicense",)),
    (
        "zlib",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to"
        " alter it and redistribute it freely",
        ("to use this software for any purpose including commercial applications and to alter it",),
    ),
    ("zlib", "spdx license identifier zlib", ("spdx license identifier zlib",)),
]
# Words that are looked up for each template and for each key phrase (none has more words), and votes
# that make a candidate.
TOP = 8
VOTES = 2

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def vocabulary() -> list[str]:
    """Every word of the templates and the base phrases."""
    texts = [text for _, text, _ in NOTICES]
    return sorted({word for text in [*texts, *BASE_PHRASES] for word in text.split()})


def rarest(phrase: str, weights: dict[str, float]) -> str:
    """The word of a phrase with the highest weight."""
    return max(sorted(phrase.split()), key=lambda w: weights[w])


def bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once for a row, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text in order; a null text has none."""

    def inner(parts: Column) -> Column:
        # Only the first and the last part can be empty.
        lead = (F.element_at(parts, 1) == "").cast("int")
        tail = ((F.element_at(parts, -1) == "") & (F.size(parts) > 1)).cast("int")
        return F.slice(parts, lead + 1, F.size(parts) - lead - tail)

    low = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return bind(F.split(low, SEPARATORS), inner)


def words_literal(words: list[str]) -> Column:
    return F.expr("array(" + ", ".join(f"'{w}'" for w in words) + ")")


def inverse_frequencies(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """ln((1 + documents) / (1 + documents with the word)) of every licence word.

    One row for each word of the fixed templates, and one for the number of documents.
    """
    held = F.array_intersect(words_of(F.col(text)), words_literal(vocabulary()))
    counts = docs.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counts.collect()}
    total = found.get("", 0)
    return {w: log((1 + total) / (1 + found.get(w, 0))) for w in vocabulary()}


def places(words: Column, wanted: Column) -> Column:
    """(word, place) of the words that are wanted, in order."""
    pairs = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("p")))
    return F.filter(pairs, lambda x: F.array_contains(wanted, x["w"]))


def stands_at(words: Column, phrase: str, begin: Column) -> Column:
    parts = phrase.split()
    return F.slice(words, begin + 1, len(parts)) == words_literal(parts)


def phrase_places(words: Column, phrase: str, anchor: str, anchors: Column) -> Column:
    """Begins of all places of ``phrase``, from the places of its word ``anchor``."""
    shift = phrase.split().index(anchor)
    begins = F.transform(F.filter(anchors, lambda x: x["w"] == anchor), lambda x: x["p"] - F.lit(shift))
    return F.filter(begins, lambda b: (b >= 0) & stands_at(words, phrase, F.greatest(b, F.lit(0))))


def postings() -> dict[str, list[tuple[int, int]]]:
    """Word -> (template number, place) wherever it stands."""
    out: dict[str, list[tuple[int, int]]] = {}
    for number, (_, text, _) in enumerate(NOTICES):
        for place, word in enumerate(text.split()):
            out.setdefault(word, []).append((number, place))
    return out


def posting_map(weights: dict[str, float]) -> str:
    """The postings as one SQL map, each with the weight of its word; words are letters and digits."""
    entries = []
    for word, at in postings().items():
        posts = ", ".join(
            f"named_struct('t', {t}, 'p', {p}, 'v', {weights[word]!r}D)" for t, p in at
        )
        entries.append(f"'{word}', array({posts})")
    return f"map({', '.join(entries)})"


def base_places(words: Column, at: Column, weights: dict[str, float]) -> Column:
    """(label, begin) of every place of every base phrase."""

    def labelled(phrase: str, label: str) -> Column:
        return F.transform(
            phrase_places(words, phrase, rarest(phrase, weights), at),
            lambda b: F.struct(F.lit(label).alias("label"), b.alias("begin")),
        )

    return F.concat(*[labelled(phrase, label) for phrase, label in BASE_PHRASES.items()])


def votes_of(at: Column, rare: Column, weights: dict[str, float]) -> Column:
    """(template, begin, weight) of every looked-up word and posting, sorted."""
    posted = F.expr(posting_map(weights))

    def cast_votes(x: Column) -> Column:
        return F.transform(
            posted[x["w"]],
            lambda q: F.struct(q["t"].alias("t"), (x["p"] - q["p"]).alias("begin"), q["v"].alias("v")),
        )

    looked_up = F.filter(at, lambda x: F.array_contains(rare, x["w"]))
    return F.array_sort(F.flatten(F.transform(looked_up, cast_votes)))


def candidates_of(votes: Column) -> Column:
    """(template, begin, weight) wherever a run of equal template and begin is long enough."""
    start = F.struct(
        F.lit(-1).alias("t"),
        F.lit(0).alias("begin"),
        F.lit(0).alias("n"),
        F.lit(0.0).alias("v"),
        F.expr("cast(array() as array<struct<t:int,begin:int,v:double>>)").alias("found"),
    )

    def count(run: Column, vote: Column) -> Column:
        same = (run["t"] == vote["t"]) & (run["begin"] == vote["begin"])
        n = F.when(same, run["n"] + 1).otherwise(F.lit(1))
        v = F.when(same, run["v"] + vote["v"]).otherwise(vote["v"])
        hit = F.array(F.struct(vote["t"].alias("t"), vote["begin"].alias("begin"), v.alias("v")))
        return F.struct(
            vote["t"].alias("t"),
            vote["begin"].alias("begin"),
            n.alias("n"),
            v.alias("v"),
            F.when(n >= VOTES, F.concat(run["found"], hit)).otherwise(run["found"]).alias("found"),
        )

    return F.aggregate(votes, start, count)["found"]


def notice_table(weights: dict[str, float]) -> Column:
    """The notices as one constant array: label, words by weight, and key phrases with their places."""

    def listed(words: list[str]) -> str:
        return "array(" + ", ".join(f"'{w}'" for w in words) + ")"

    def by_weight(text: str) -> list[str]:
        return sorted(set(text.split()), key=lambda w: (-weights[w], w))

    rows = []
    for label, text, phrases in NOTICES:
        keys = ", ".join(
            f"named_struct('words', {listed(p.split())}, 'rare', {listed(by_weight(p)[:TOP])}, 'shift', {text[: text.index(p)].count(' ')})"
            for p in phrases
        )
        rows.append(f"named_struct('label', '{label}', 'words', {listed(by_weight(text))}, 'phrases', array({keys}))")
    return F.expr(f"array({', '.join(rows)})")


def weight_map(weights: dict[str, float]) -> Column:
    return F.expr("map(" + ", ".join(f"'{w}', {v!r}D" for w, v in weights.items()) + ")")


def looked_up(notices: Column, held: Column) -> Column:
    """The words to look up: of every notice of which all words of a key phrase are there, the rarest ones."""
    nothing = F.expr("cast(array() as array<string>)")

    def of_notice(notice: Column) -> Column:
        stand = F.filter(notice["phrases"], lambda p: F.size(F.array_except(p["words"], held)) == 0)
        own = F.slice(F.array_intersect(notice["words"], held), 1, TOP)
        return F.when(F.size(stand) > 0, F.concat(F.flatten(F.transform(stand, lambda p: p["rare"])), own)).otherwise(nothing)

    return F.array_distinct(F.flatten(F.transform(notices, of_notice)))


def verified(words: Column, found: Column, notices: Column) -> Column:
    """The candidates where a key phrase stands as the template has it."""

    def holds(c: Column) -> Column:
        def stands(p: Column) -> Column:
            begin = c["begin"] + p["shift"]
            return (begin >= 0) & (F.slice(words, F.greatest(begin, F.lit(0)) + 1, F.size(p["words"])) == p["words"])

        return F.exists(F.element_at(notices, c["t"] + 1)["phrases"], stands)

    return F.filter(found, holds)


def finding(words: Column, base: Column, votes: Column, rare: Column, weights: dict[str, float]) -> Column:
    """Labels and score from the places and votes of one document."""
    notices, weight = notice_table(weights), weight_map(weights)

    def judged(c: Column) -> Column:
        notice = F.element_at(notices, c["t"] + 1)
        looked = F.filter(notice["words"], lambda w: F.array_contains(rare, w))
        most = F.aggregate(looked, F.lit(0.0), lambda total, w: total + weight[w])
        return F.struct(notice["label"].alias("label"), (c["v"] / F.greatest(most, F.lit(1e-9))).alias("v"))

    def result(sure: Column) -> Column:
        best = F.array_max(F.transform(sure, lambda c: c["v"]))
        return F.struct(
            F.size(words).cast("long").alias("words"),
            base.alias("base"),
            F.array_sort(F.array_distinct(F.transform(sure, lambda c: c["label"]))).alias("templates"),
            F.least(F.lit(1.0), F.coalesce(best, F.lit(0.0))).alias("score"),
        )

    return bind(F.transform(verified(words, candidates_of(votes), notices), judged), result)


def with_licenses(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct of its findings in the new column ``name``.

    words: their number; base: (label, begin) of all base places; templates: labels that were
    verified; score: the largest share of a template's looked-up weight that agreed on one of its
    verified candidates.
    """
    weights = inverse_frequencies(docs, text)
    base = words_literal(sorted({rarest(p, weights) for p in BASE_PHRASES}))
    needed = {rarest(p, weights) for p in [*BASE_PHRASES, *[p for _, _, phrases in NOTICES for p in phrases]]}
    anchors = words_literal(sorted(needed))
    licence_words = words_literal(sorted(postings()))

    def look_up(words: Column) -> Column:
        # Without the rarest word of any phrase nothing can be verified: the words are not walked through.
        held = F.array_intersect(licence_words, words)
        rare = bind(held, lambda h: looked_up(notice_table(weights), h))
        walked = bind(rare, lambda r: bind(F.array_union(r, base), lambda wanted: locate(words, r, wanted)))
        nothing = F.struct(
            F.size(words).cast("long").alias("words"),
            F.expr("cast(array() as array<struct<label:string,begin:int>>)").alias("base"),
            F.expr("cast(array() as array<string>)").alias("templates"),
            F.lit(0.0).alias("score"),
        )
        return F.when(F.arrays_overlap(words, anchors), walked).otherwise(nothing)

    def locate(words: Column, rare: Column, wanted: Column) -> Column:
        return bind(
            places(words, wanted),
            lambda at: bind(
                votes_of(at, rare, weights),
                lambda votes: finding(words, base_places(words, at, weights), votes, rare, weights),
            ),
        )

    return docs.withColumn(name, bind(words_of(F.col(text)), look_up))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id and findings of every document."""
    found = with_licenses(docs.select("doc_id", "text"), "found")
    return found.select("doc_id", "found.words", "found.base", "found.templates", "found.score")

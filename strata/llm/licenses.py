"""Licence scan over a positional rare-token index, in built-in expressions only.

Of each template the words with the highest inverse document frequency over all documents
form the index: word -> (template, position). A document looks up those of its words that
are indexed; each hit says where the template would have to begin. Beginnings that enough
rare words agree on are compared with the template, and the template's key phrase must
stand there word for word. Texts are read once and never shuffled: the words that templates
have are kept with their places in a checkpoint. What reaches the driver is one count for
each of these words.

The work grows with the length of a text: a beginning is compared with the words it can span.

Defined results: a null or empty text has no words, null positions, empty labels and score
0; repeated rows give repeated results; other columns are not looked at, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases that give a label wherever they stand.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of public licence notices, with the phrase that must be there.
TEMPLATES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "licensed under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("boost", "boost software license version 1 0", "boost software license"),
    ("cc0", "to the extent possible under law the author has dedicated all copyright to the public domain worldwide under cc0 1 0 universal", "cc0 1 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
]

# Template words too frequent to tell anything; positions still count them.
COMMON = frozenset("a all and any are as be for free in into is it may of or that the this to use with you".split())


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[tuple[int, str], ...]
    key: tuple[tuple[int, str], ...]


def _template(label: str, notice: str, phrase: str) -> Template:
    words, key = notice.split(), phrase.split()
    at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
    telling = tuple((i, w) for i, w in enumerate(words) if w not in COMMON)
    return Template(label, telling, tuple((i, w) for i, w in telling if at <= i < at + len(key)))


def _hits(words: Column, vocabulary: set[str]) -> Column:
    """(place, word) of those words that any template or phrase has."""

    def look(word: Column, place: Column) -> Column:
        small = F.lower(word)
        # lower() also turns a few letters beyond ASCII into ASCII ones, which shortens them
        same = F.octet_length(small) == F.octet_length(word)
        return F.when(small.isin(*sorted(vocabulary)) & same, F.struct(place.alias("p"), small.alias("w")))

    return F.filter(F.transform(words, look), lambda hit: hit.isNotNull())


def _frequencies(found: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each word that was hit."""
    own = F.array_distinct(F.transform("hits", lambda hit: hit["w"]))
    # The empty word stands for the document itself.
    counts = found.select(F.explode(F.concat(F.array(F.lit("")), own)).alias("w")).groupBy("w").count()
    number = {row["w"]: row["count"] for row in counts.collect()}
    return number.pop("", 0), number


def _texts(values) -> Column:
    return F.array(*[F.lit(value) for value in values])


def _placed(words) -> Column:
    return F.array(*[F.struct(F.lit(p).alias("p"), F.lit(w).alias("w")) for p, w in words])


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str, str]] | None = None,
    rare_words: int = 5,
    support: int = 3,
    least_cover: float = 0.6,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document.

    ``phrases`` (words -> label) count wherever they stand consecutively. A template (label,
    notice, key phrase) adds its label where ``support`` of its ``rare_words`` rarest words
    agree on one beginning, the key phrase stands at its place and at least ``least_cover``
    of the notice's telling words do too. score is the largest such cover, 1 for a phrase.
    """
    phrases = phrases or PHRASES
    known = [_template(*template) for template in (templates or TEMPLATES)]
    phrase_words = [tuple(phrase.split()) for phrase in phrases]
    vocabulary = {w for t in known for _, w in t.words} | {w for words in phrase_words for w in words}
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), F.lit(0))
    found = docs.select("doc_id", words.alias("words"))
    found = found.select("doc_id", F.size("words").cast("long").alias("n_words"), _hits(F.col("words"), vocabulary).alias("hits"))
    # The texts are read once; what is kept of them is the few words that templates have.
    found = cut_lineage(found)
    total, frequency = _frequencies(found)

    def rarity(word: str) -> float:
        return math.log((1 + total) / (1 + frequency.get(word, 0)))

    postings: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(known):
        rarest = sorted({w for _, w in template.words}, key=lambda w: (-rarity(w), w))[:rare_words]
        for place, word in template.words:
            if word in rarest:
                postings.setdefault(word, []).append((number, place))

    def phrase_at(hit: Column, index: Column) -> Column:
        label = F.lit(None).cast("string")
        for phrase, name in zip(phrase_words, phrases.values(), strict=True):
            here = hit["w"] == phrase[0]
            for k in range(1, len(phrase)):
                after = F.get(F.col("hits"), index + k)
                here = here & (after["w"] == phrase[k]) & (after["p"] == hit["p"] + k)
            label = F.when(here, F.lit(name)).otherwise(label)
        return F.when(label.isNotNull(), F.struct(hit["p"].alias("p"), label.alias("label")))

    index = F.create_map(
        *[
            part
            for word, places in sorted(postings.items())
            for part in (F.lit(word), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in places]))
        ]
    )
    numbered = F.transform("hits", lambda hit, i: F.struct(hit["p"].alias("p"), hit["w"].alias("w"), i.alias("i")))
    indexed = F.filter(numbered, lambda hit: hit["w"].isin(*sorted(postings)))

    def beginning(hit: Column, at: Column) -> Column:
        # Of the hits, as many at most lie between the beginning and this one as words do.
        first = F.greatest(hit["i"] - at["p"], F.lit(0)) + 1
        return F.struct(at["t"].alias("t"), (hit["p"] - at["p"]).alias("p"), first.alias("first"))

    begins = F.flatten(F.transform(indexed, lambda hit: F.transform(F.element_at(index, hit["w"]), lambda at: beginning(hit, at))))
    found = found.select(
        "doc_id",
        "n_words",
        "hits",
        F.filter(F.transform(F.col("hits"), phrase_at), lambda x: x.isNotNull()).alias("base"),
        F.sort_array(begins).alias("begins"),
    )
    def same(other: Column, begin: Column) -> Column:
        return (other["t"] == begin["t"]) & (other["p"] == begin["p"])

    def agreed_first(begin: Column, i: Column) -> Column:
        """The first of ``support`` equal beginnings."""
        before = F.get(F.col("begins"), i - 1)
        return same(F.get(F.col("begins"), i + (support - 1)), begin) & ~F.coalesce(same(before, begin), F.lit(False))

    agreed = F.filter(F.col("begins"), agreed_first)
    notices, keys = _sets(known)
    lengths = F.array(*[F.lit(t.words[-1][0] + 1) for t in known])

    def present(begin: Column, wanted: Column) -> Column:
        """Which words of a template stand at their places: looked for among the hits that its span can hold."""
        at, length = F.element_at(wanted, begin["t"] + 1), F.element_at(lengths, begin["t"] + 1)
        span = F.slice(F.col("hits"), begin["first"], length)
        return F.transform(at, lambda x: F.array_contains(span, F.struct((x["p"] + begin["p"]).alias("p"), x["w"].alias("w"))))

    def verified(begin: Column) -> Column:
        cover = F.aggregate(present(begin, notices), F.lit(0.0), lambda n, yes: n + F.when(yes, 1.0).otherwise(0.0))
        cover = cover / F.size(F.element_at(notices, begin["t"] + 1))
        whole = F.forall(present(begin, keys), lambda yes: yes)
        label = F.element_at(_texts([t.label for t in known]), begin["t"] + 1)
        return F.when(whole & (cover >= least_cover), F.struct(label.alias("label"), cover.alias("cover")))

    found = found.select(
        "doc_id",
        "n_words",
        "base",
        F.filter(F.transform(agreed, verified), lambda x: x.isNotNull()).alias("notices"),
    )
    base_labels = F.transform("base", lambda x: x["label"])
    all_labels = F.concat(base_labels, F.transform("notices", lambda x: x["label"]))
    cover = F.coalesce(F.array_max(F.transform("notices", lambda x: x["cover"])), F.lit(0.0))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["p"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["p"])).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(all_labels).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(cover).alias("score"),
    )


def _sets(known: list[Template]) -> tuple[Column, Column]:
    return F.array(*[_placed(t.words) for t in known]), F.array(*[_placed(t.key) for t in known])

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.llm.licenses import COMMON, PHRASES, TEMPLATES, scan_licenses


def by_hand(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)
    places = [
        (i, label)
        for i in range(len(words))
        for phrase, label in PHRASES.items()
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def base(rows):
    return [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


TEXTS = [
    "Released under the MIT License.",
    "gnu GENERAL\npublic--license, gnu general public license2",
    "cc by cc by! CC-BY-NC 4.0 cc  by",
    "mit licenseé King mit license mit.license",
    "Licensed under the Apache License, Version 2.0. apache apache license license",
    "mit general gnu public license",
    "",
    None,
]


def test_phrases_match_a_plain_search(make_docs):
    assert base(scan_licenses(make_docs(TEXTS)).collect()) == [by_hand(t) for t in TEXTS]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("gnu general public license apache cc by mit MIT x . - é 7".split()), max_size=12), min_size=1, max_size=20))
def test_phrases_in_random_texts(make_docs, lists):
    texts = [" ".join(words) for words in lists]
    assert base(scan_licenses(make_docs(texts)).collect()) == [by_hand(t) for t in texts]


def test_notices_need_their_key_phrase_at_its_place(make_docs):
    whole = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = [
        f"// {whole} (the Software)",
        whole.replace("free of charge", "for some money"),
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        " ".join(reversed(whole.split())),
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ]
    rows = {r["doc_id"]: r for r in scan_licenses(make_docs(texts)).collect()}
    assert [rows[i]["labels"] for i in range(6)] == ["mit", "", "cc-by,cc-by-nc", "cc-by", "", "gpl"]
    assert rows[0]["score"] > 0.9 and rows[1]["score"] == 0 and rows[0]["n_base"] == 0
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_odd_rows(odd_docs, no_docs):
    rows = scan_licenses(odd_docs).collect()
    assert len(rows) == 10 and {r["labels"] for r in rows} == {""}
    assert scan_licenses(no_docs).collect() == []


def test_plan_stays_native(make_docs, plan):
    shown = plan(scan_licenses(make_docs(TEXTS)))
    assert "Python" not in shown and "Arrow" not in shown


def test_unknown_template_phrase_fails(make_docs):
    with pytest.raises(StopIteration):
        scan_licenses(make_docs(TEXTS), templates=[("x", "some words here", "not there")])


def words_of(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def notices_by_hand(texts, rare_words=5, support=3, least_cover=0.6):
    """labels and score of every text, each template tried at every place."""
    templates = []
    for label, notice, phrase in TEMPLATES:
        words, key = notice.split(), phrase.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        telling = [(i, w) for i, w in enumerate(words) if w not in COMMON]
        templates.append((label, telling, [x for x in telling if at <= x[0] < at + len(key)]))
    vocabulary = {w for _, telling, _ in templates for _, w in telling} | {w for phrase in PHRASES for w in phrase.split()}
    frequency = Counter(w for text in texts for w in set(words_of(text)) & vocabulary)
    out = []
    for text in texts:
        words = words_of(text)
        *_, base_labels = by_hand(text)
        labels, score = set(base_labels.split(",")) - {""}, 1.0 if base_labels else 0.0
        for label, telling, key in templates:
            rarest = sorted({w for _, w in telling}, key=lambda w: (-math.log((1 + len(texts)) / (1 + frequency[w])), w))[:rare_words]
            for begin in range(-len(telling) * 4, len(words)):

                def there(wanted, begin=begin):
                    return [0 <= begin + i < len(words) and words[begin + i] == w for i, w in wanted]

                if sum(there([x for x in telling if x[1] in rarest])) < support or not all(there(key)):
                    continue
                cover = sum(there(telling)) / len(telling)
                if cover >= least_cover:
                    labels.add(label)
                    score = score if base_labels else max(score, cover)
        out.append((",".join(sorted(labels)), round(score, 9)))
    return out


def test_labels_and_scores_match_every_place(make_docs):
    chance = random.Random(1)
    texts = ["nothing here", "permission is granted"]
    for _, notice, _ in TEMPLATES:
        words = notice.split()
        texts += [notice, " ".join(words[2:] + words), "x " * 7 + " ".join(w if chance.random() < 0.85 else "odd" for w in words)]
        texts += [" ".join(chance.choice(words) for _ in range(60)), f"{notice} and {notice}"]
    docs = make_docs(texts).withColumn("hits", F.lit("clash")).withColumn("begins", F.lit(1)).withColumn("base", F.lit(2))
    rows = sorted(scan_licenses(docs).collect(), key=lambda r: r["doc_id"])
    assert [(r["labels"], round(r["score"], 9)) for r in rows] == notices_by_hand(texts)


def test_four_megabytes_of_notices(make_docs):
    whole = " ".join(notice for _, notice, _ in TEMPLATES) + "\n"
    took = []
    for size in (1 << 20, 4 << 20):
        docs = make_docs([whole * (size // len(whole))], 1)
        start = time.time()
        row = scan_licenses(docs).first()
        took.append(time.time() - start)
        assert row["score"] == 1.0 and row["n_base"] > 100
    assert took[1] < 60 and took[1] < 10 * max(took[0], 1)

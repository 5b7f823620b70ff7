import random

import numpy as np
import zlib
from pyspark.sql import functions as F

from strata.llm.langid import ByteNetwork, fit_language_model, held_out, keep_identified, predict_languages, windows

WORDS = {"en": "the of and to in that is was for on", "de": "der die und das nicht mit sich für über ist", "fr": "le la les des est une dans pour été où"}


def corpus(make_docs, n=240):
    chance = random.Random(0)
    rows = []
    for i in range(n):
        lang = chance.choice(list(WORDS))
        words = [chance.choice(WORDS[lang].split()) + chance.choice(["", "a", "en", "é"]) for _ in range(chance.randrange(20, 200))]
        rows.append((i, " ".join(words), lang, "a"))
    return make_docs(rows)


def test_held_out_documents_are_told_apart(make_docs):
    docs = corpus(make_docs)
    out = held_out(docs["doc_id"])
    model = fit_language_model(docs.where(~out), sample_docs=50, epochs=10)
    rows = predict_languages(docs.drop("lang", "source"), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 240
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_same_rows_give_the_same_model(make_docs):
    docs = corpus(make_docs, 60)
    one, two = (fit_language_model(d, sample_docs=10, epochs=2) for d in (docs, docs.repartition(5)))
    assert all((a == b).all() for a, b in zip(one.filters, two.filters, strict=True)) and (one.dense == two.dense).all()


def test_whole_text_is_read():
    data = np.frombuffer(b"ab" * 300 + b"z", np.uint8)
    kinds, of, size = windows(data, np.array([0, 600, 601, 601]), 256)
    assert kinds.shape == (4, 256) and of.tolist() == [0, 0, 0, 1] and size.tolist() == [256, 256, 88, 1]
    assert (kinds > 0).sum() == 601


def test_pooling_matches_a_plain_convolution():
    chance = np.random.default_rng(1)
    filters = tuple(chance.normal(size=(w, 64, 3)).astype(np.float32) for w in (2, 3, 4))
    for f in filters:
        f[:, 0, :] = 0
    network = ByteNetwork(("a",), filters, np.zeros((9, 1)), np.zeros(1), 20)
    kinds = chance.integers(0, 64, (5, 20)).astype(np.uint8)
    got, _, _ = network.pooled(kinds, network.tables())
    padded = np.concatenate([kinds, np.zeros((5, 4), np.uint8)], 1)
    wanted = [
        [max(0, max(sum(f[k, padded[i, p + k], c] for k in range(len(f))) for p in range(20))) for f in filters for c in range(3)]
        for i in range(5)
    ]
    assert np.allclose(got, wanted, atol=1e-4)


def test_odd_rows(odd_docs, no_docs):
    model = fit_language_model(odd_docs, sample_docs=5, epochs=1)
    rows = predict_languages(odd_docs, model).collect()
    assert len(rows) == 10
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if r["lang_pred"] == "und"} == {i: ("und", 0.0) for i in (1, 2, 3, 8)}
    assert fit_language_model(no_docs) is None
    assert {r["lang_pred"] for r in predict_languages(odd_docs, None).collect()} == {"und"}
    assert predict_languages(no_docs, model).collect() == []
    clash = odd_docs.withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1))
    kept = keep_identified(clash, model)
    assert kept.columns == clash.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 4, 5, 5, 6, 7]

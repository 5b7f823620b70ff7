import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from strata.llm.bpe import decode_ids, encode_texts, encoder, round_trips
from strata.llm.token_counts import AFTER, FLAGS, NONE, count_tokens, scan, token_counts

FILE = path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
ODD = st.text(alphabet=st.one_of(st.sampled_from("aeb'strevlmd 0127.!\n\t 　éß中́😀\x1c\x85"), st.characters(exclude_categories=["Cs"])), max_size=60)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(ODD, st.sampled_from(["", "<|endoftext|>", " <|endoftext|><|endoftext|>x", "<|endof"]), ODD)
def test_ids_counts_and_text_match_the_library(one, middle, other):
    text = one + middle + other
    ids = np.frombuffer(encoder(FILE).encode(text), "<u4")
    assert ids.tolist() == library(text)
    assert encoder(FILE).decode(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False) == text
    assert count_tokens(pa.array([text]), FILE).tolist() == [len(ids)]


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, " " * 5_000 + "x", "!" * 7_001, "aaab" * 3_000 + "'ll", "é" * 4_000])
def test_long_pieces(text):
    assert np.frombuffer(encoder(FILE).encode(text), "<u4").tolist() == library(text)
    assert count_tokens(pa.array([text]), FILE).tolist() == [len(library(text))]


def test_ids_that_are_no_text():
    ids = [94, 220, 162, 50256, 229]
    assert encoder(FILE).decode(np.array(ids)) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_scan_does_not_depend_on_the_chunks():
    kinds = np.random.default_rng(0).integers(0, 12, 5000).astype(np.uint8)
    state, flags = NONE, []
    for kind in kinds:
        flags.append(FLAGS[state, kind])
        state = AFTER[state, kind]
    for chunk in (1, 7, 512, 10_000):
        assert scan(kinds, chunk).tolist() == flags


def test_counts_of_many_texts_together():
    chance = random.Random(1)
    texts = ["".join(chance.choice("ab' sre1!\n<|é") for _ in range(chance.randrange(30))) for _ in range(3000)]
    assert count_tokens(pa.array(texts), FILE).tolist() == [len(library(t)) for t in texts]


def test_queries_on_odd_rows(odd_docs, no_docs):
    rows = {(r["doc_id"], r["text"]) for r in odd_docs.collect()}
    expected = {}
    for doc_id, text in rows:
        ids = library(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected[doc_id] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), len((text or "").encode()))
    found = round_trips(odd_docs, FILE).collect()
    assert len(found) == 10
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected[r["doc_id"]][:3] for r in found)
    counted = token_counts(odd_docs, FILE, batch_bytes=100).collect()
    assert len(counted) == 10
    assert all((r["n_bytes"], r["n_tokens"], r["over_limit"]) == (expected[r["doc_id"]][3], expected[r["doc_id"]][0], expected[r["doc_id"]][0] > 512) for r in counted)
    decoded = decode_ids(encode_texts(odd_docs, FILE), FILE).collect()
    assert {(r["doc_id"], r["text"]) for r in decoded} == {(i, t or "") for i, t in rows}
    assert round_trips(no_docs, FILE).collect() == token_counts(no_docs, FILE).collect() == []

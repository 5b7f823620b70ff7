"""Extra columns whose names are used inside the operators change nothing."""

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from strata.llm.bpe import round_trips
from strata.llm.licenses import scan_licenses
from strata.llm.lm import score_texts
from strata.llm.token_counts import token_counts
from strata.llm.token_store import stored_documents, write_tokens
from strata.session import working_folder

NAMES = ["ids", "n_tokens", "block", "bucket", "hashes", "part", "before", "codes", "score", "train", "words", "hits", "n", "start"]


def token_files(docs):
    target = working_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path("word_bpe_49k.json"), target)
    return stored_documents(docs.sparkSession, target)


@pytest.mark.parametrize(
    "operator",
    [
        lambda docs: round_trips(docs, path("byte_bpe_50k.json")),
        lambda docs: token_counts(docs, path("byte_bpe_50k.json")),
        token_files,
        scan_licenses,
        score_texts,
    ],
    ids=["bpe", "token_counts", "token_files", "licenses", "lm"],
)
def test_extra_columns(operator, odd_docs):
    wide = odd_docs
    for i, name in enumerate(NAMES):
        wide = wide.withColumn(name, F.lit(i) if i % 2 else F.lit("clash"))
    plain, clashing = operator(odd_docs), operator(wide)
    assert plain.columns == clashing.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, clashing.collect()))

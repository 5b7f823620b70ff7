import os
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from strata.llm.token_store import Codes, encode_words, open_block, pack_codes, read_tokens, stored_documents, tokens_at, write_tokens
from strata.session import working_folder

FILE = path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1).flatmap(lambda x: st.sampled_from([x, x % 256, x % 65536])), max_size=300), st.data())
def test_any_place_can_be_read(ids, data):
    codes = Codes(pack_codes(np.array(ids, np.uint32)))
    places = data.draw(st.lists(st.integers(0, len(ids) - 1), max_size=20)) if ids else []
    assert len(codes) == len(ids)
    assert codes.take(np.array(places, np.int64)).tolist() == [ids[p] for p in places]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.text(alphabet=st.one_of(st.sampled_from("aB'sTre!.,-_ 07\n éΣ́İ"), st.characters(exclude_categories=["Cs"])), max_size=30),
            st.sampled_from(["", "<|endoftext|>", "<|startoftext|>.", "<|endof"]),
        ).map("".join),
        max_size=5,
    )
)
def test_words_are_encoded_as_whole_texts(texts):
    ids, counts = encode_words(pa.array(texts, pa.string()), FILE)
    wanted = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]


def stored(spark, docs, **how):
    folder = working_folder(spark, "tokens")
    write_tokens(docs, FILE, folder, **how)
    return folder


def test_files_hold_all_documents_in_order(spark, make_docs):
    chance = random.Random(2)
    rows = [(i, " ".join(chance.choice(["one", "two,", "Three", "4", "fünf"]) for _ in range(chance.randrange(40))), "en", "a") for i in range(300)]
    folder = stored(spark, make_docs(rows, partitions=7), batch_bytes=500)
    every, found = [], {r["doc_id"]: r for r in stored_documents(spark, folder).collect()}
    for i, text, *_ in rows:
        ids = LIBRARY.encode(text, add_special_tokens=False).ids + [2]
        row = found[i]
        assert (row["start"], row["n_tokens"]) == (len(every), len(ids))
        assert row["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        every += ids
    wanted = sorted(chance.sample(range(len(every)), 50))
    got = {r["position"]: r["token_id"] for r in tokens_at(spark, folder, wanted).collect()}
    assert got == {p: every[p] for p in wanted}


def bytes_read(spark):
    return spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead")


def test_one_token_opens_one_file_and_reads_one_page_of_it(spark, make_docs):
    chance = random.Random(5)
    words = ["".join(chance.choice("abcdefghij") for _ in range(9)) for _ in range(400)]
    rows = [(i, " ".join(chance.choices(words, k=2000)), "en", "a") for i in range(120)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = stored(spark, make_docs(rows, partitions=4), batch_bytes=60_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    every = [i for _, text, *_ in rows for i in LIBRARY.encode(text, add_special_tokens=False).ids + [2]]
    blocks = f"{folder}/blocks"
    sizes = {name: os.path.getsize(f"{blocks}/{name}") for name in os.listdir(blocks) if name.endswith(".parquet")}
    place = len(every) // 3
    row = spark.read.parquet(f"{folder}/directory").where(f"start <= {place} and {place} < start + n_tokens").first()
    for name in sizes:  # any other file would now fail when it is opened
        if name != row["file"]:
            os.remove(f"{blocks}/.{name}.crc")
            with open(f"{blocks}/{name}", "wb") as file:
                file.write(b"no Parquet")
    chosen = tokens_at(spark, folder, [place, place])
    before = bytes_read(spark)
    assert [tuple(r) for r in chosen.collect()] == [(place, every[place])] * 2
    assert len(sizes) > 2 and bytes_read(spark) - before < sizes[row["file"]] / 2
    with pytest.raises(Exception, match="not a Parquet file"):
        tokens_at(spark, folder, [0, len(every) - 1]).collect()


def test_positions_that_do_not_exist(spark, odd_docs, no_docs):
    folder = stored(spark, odd_docs)
    assert tokens_at(spark, folder, []).collect() == []
    assert tokens_at(spark, folder, [-1, 1 << 40]).collect() == []
    assert tokens_at(spark, stored(spark, no_docs), [0]).collect() == []


def test_odd_rows(spark, odd_docs, no_docs):
    folder = stored(spark, odd_docs)
    rows = sorted(read_tokens(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(10)]
    assert all(bytes(r["ids"]) == struct.pack("<I", 2) for r in rows[1:4])
    assert stored_documents(spark, stored(spark, no_docs)).collect() == []


def test_a_file_is_not_written_over(spark, odd_docs):
    folder = stored(spark, odd_docs)
    with pytest.raises(Exception, match="exist"):
        write_tokens(odd_docs, FILE, folder)


def test_block_without_documents():
    ids, counts, codes = open_block(struct.pack("<I", 0) + pack_codes(np.zeros(0, np.uint32)))
    assert len(ids) == len(counts) == len(codes) == 0

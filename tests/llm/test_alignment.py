import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.alignment import align_corpus, aligned_groups, aligner, document_measures, pair_counts
from strata.session import working_folder

A_FILE, B_FILE = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_FILE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTERS = {chr(b): b for b in VISIBLE}
LETTERS |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in VISIBLE)}
ODD = st.text(alphabet=st.one_of(st.sampled_from("aeb'strevl md  0127.!\n\t 　éß中́😀\x1c\x85▁<>|"), st.characters(exclude_categories=["Cs"])), max_size=50)


def piece_bytes(piece):
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def by_hand(text):
    """(A ids, B ids, groups, links) of a text, token by token."""
    if not text:
        return [], [], [], []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    spelled_a = [bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a]
    spelled_b = [piece_bytes(B.id_to_piece(i)) for i in b]
    whole = (" " + text).encode()
    if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
        return [], [], [], []
    groups, links, i, j, at_a, at_b, mine, other = [], [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            at_a += len(spelled_a[i])
            mine.append(a[i])
            i += 1
        else:
            at_b += len(spelled_b[j])
            other.append(b[j])
            j += 1
        if at_a == at_b:
            groups.append((mine, other))
            links.append((mine[-1], other[-1]))
            mine, other = [], []
    return a, b, groups, links


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def measures(rows):
    found = [(i, by_hand(text)) for i, text in rows]
    counts = Counter(link for _, (*_, links) in found for link in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for i, (a, b, groups, links) in found:
        sha = hashlib.sha256(written(groups).encode()).hexdigest() if a else ""
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), sha))
    return sorted(out, key=str), counts, most


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def measured(spark, docs, **sizes):
    target = working_folder(spark, "alignment")
    align_corpus(docs, A_FILE, B_FILE, target, **sizes)
    rows = document_measures(docs, target).select(COLUMNS).collect()
    return sorted(map(tuple, rows), key=str), target


@settings(max_examples=300, deadline=None)
@given(ODD, st.sampled_from(["", "<|endoftext|>", " <s></s>", "\0 ", "  x"]), ODD)
def test_groups_match_both_libraries(one, middle, other):
    text = one + middle + other
    assert aligner(A_FILE, B_FILE).groups(text) == written(by_hand(text)[2])


@pytest.mark.parametrize("block", [50, 6 << 20])
def test_measures_match_brute_force(spark, make_docs, block):
    chance = random.Random(1)
    words = ["the", "cat's", "é", "Straße", "x1", "▁odd", "tion", "of,", "\n", "", "中文", "unbelievable", "1234"]
    texts = [" ".join(chance.choice(words) for _ in range(chance.randrange(1, 40))) for _ in range(80)]
    rows = list(enumerate(texts + texts[:10] * 5 + ["same old text"] * 300))
    docs = make_docs([(i, t, "en", "a") for i, t in rows], 5)
    got, target = measured(spark, docs, block_bytes=block)
    wanted, counts, most = measures(rows)
    assert got == wanted
    pairs = {(r["a_id"], r["b_id"]): (r["count"], r["best"]) for r in pair_counts(spark, target).collect()}
    assert pairs == {x: (n, n == most[x[1]]) for x, n in counts.items()}


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("mark", F.lit("clash")).withColumn("units", F.lit(1)).withColumn("copies", F.lit(0))
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert measured(spark, docs)[0] == measures(rows)[0]
    assert measured(spark, no_docs)[0] == []
    got = {r["doc_id"]: r["groups"] for r in aligned_groups(docs, A_FILE, B_FILE).collect()}
    assert got == {i: written(by_hand(text)[2]) for i, text in rows}


def test_long_texts(spark, make_docs):
    long = "a sentence that goes on, " * 12_000  # 300 KB, beyond the blocks below
    rows = [(1, long), (2, "x" * 30_000), (3, long + "!"), (4, long)]
    docs = make_docs([(i, t, "en", "a") for i, t in rows])
    assert measured(spark, docs, block_bytes=100_000)[0] == measures(rows)[0]

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.dedup import dart_signatures, drop_near_duplicates, link_group, near_duplicates
from strata.plans.sizing import Bound


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def by_hand(rows, least=0.8):
    sets = [shingle_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= least * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    classes = defaultdict(list)
    for x in range(len(rows)):
        classes[find(x)].append(rows[x][0])
    return {i: min(x for x in c if x is not None) for c in classes.values() for i in c if i is not None}


def edited(chance, words, times):
    words = list(words)
    for _ in range(times):
        words[chance.randrange(len(words))] = f"new{chance.randrange(10**6)}"
    return words


@pytest.fixture
def rows():
    chance = random.Random(3)
    texts = []
    for g in range(25):
        words = [f"t{g}x{chance.randrange(400)}" for _ in range(chance.randrange(30, 300))]
        texts.append(words)
        for _ in range(chance.randrange(8)):  # some copies of the first, some of the last one
            texts.append(edited(chance, chance.choice([words, texts[-1]]), chance.randrange(0, 1 + len(words) // 40)))
    texts += [["short"], ["SHORT"], ["other", "short"], []]
    chance.shuffle(texts)
    return [(i, " ".join(t), "en", "a") for i, t in enumerate(texts)]


@pytest.mark.parametrize("block", [2048, 3])
def test_classes_match_brute_force(make_docs, rows, block):
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(make_docs(rows), block=block).collect()}
    assert got == by_hand(rows)


def test_first_of_each_class_stays_with_all_columns(make_docs, rows):
    docs = make_docs(rows + rows[:20]).withColumn("node", F.lit("clash")).withColumn("mark", F.lit(0))
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # Without words, every row stays: also the repeated ones.
    empty = Counter(i for i, t, *_ in rows + rows[:20] if not t)
    wanted = Counter(set(by_hand(rows).values())) | empty
    assert Counter(r["doc_id"] for r in kept.collect()) == wanted


@pytest.mark.parametrize("edits", [1, 3])
def test_large_group_of_near_copies(make_docs, edits):
    chance = random.Random(4)
    words = [f"w{chance.randrange(10**6)}" for _ in range(200)]
    rows = [(i, " ".join(edited(chance, words, edits)), "en", "a") for i in range(400)]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(make_docs(rows), block=64).collect()}
    assert got == by_hand(rows)
    if edits == 1:
        assert set(got.values()) == {0}


def test_copies_linked_only_by_their_original(make_docs):
    chance = random.Random(5)
    words = [f"w{chance.randrange(10**6)}" for _ in range(400)]
    rows = [(i, " ".join(edited(chance, words, 8 if i else 0)), "en", "a") for i in range(40)]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(make_docs(rows), block=8).collect()}
    assert got == by_hand(rows)


def test_odd_rows(odd_docs, no_docs):
    got = sorted(((r["doc_id"] is not None, r["doc_id"], r["class_id"]) for r in near_duplicates(odd_docs).collect()))
    assert got == [(False, None, None)] + [(True, i, i) for i in (1, 2, 3, 4, 5, 5, 6, 7, 8)]
    assert sorted((r["doc_id"] or 0) for r in drop_near_duplicates(odd_docs).collect()) == list(range(9))
    assert near_duplicates(no_docs).collect() == drop_near_duplicates(no_docs).collect() == []


def test_signatures_estimate_weighted_similarity():
    chance = np.random.default_rng(6)
    elements = chance.integers(0, 1 << 62, 400).astype(np.uint64)
    one, two = chance.uniform(0.1, 3, 400), chance.uniform(0.1, 3, 400)
    two[:300] = one[:300]
    wanted = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    made = dart_signatures(np.tile(elements, 2), np.concatenate([one, two]), np.repeat([0, 1], 400), 2, 4096)
    assert abs((made[0] == made[1]).mean() - wanted) < 0.03


def test_signature_does_not_depend_on_the_batch():
    chance = np.random.default_rng(7)
    sets = [chance.integers(0, 1 << 62, n).astype(np.uint64) for n in (1, 3, 50, 5000)]
    of = np.repeat(np.arange(4), [len(s) for s in sets])
    together = dart_signatures(np.concatenate(sets), np.ones(len(of)), of, 4, 50)
    for i, s in enumerate(sets):
        assert (dart_signatures(s, np.ones(len(s)), np.zeros(len(s), int), 1, 50)[0] == together[i]).all()


def test_blocks_look_only_across():
    sets = [np.arange(10, dtype=np.uint64)] * 3
    signs = np.ones((3, 5), np.uint32)
    nodes = np.array([1, 2, 3])
    assert len(link_group(nodes, signs, sets, np.array([-1, -1, -1]), 0.8, 0.2)) == 2
    assert sorted(link_group(nodes, signs, sets, np.array([0, 0, 1]), 0.8, 0.2)) == [(3, 1), (3, 2)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 5), (400, 401), (401, 400)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    wanted = {i: 100 for i in range(101, 161)} | {i: 7 for i in range(200, 400)} | {401: 400}
    assert got == wanted
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("few", [None, Bound(0, 0)], ids=["broadcast", "shuffled"])
def test_components_of_any_graph(spark, few):
    chance = random.Random(11)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(230)]  # loops and repeated edges too
    edges += [(1000 + n, 5000 - n) for n in range(150)] + [(5000 - n, 1001 + n) for n in range(150)]  # a long path up and down
    edges += [(9000, n) for n in range(7000, 7400)] + [(8000, n) for n in range(8001, 8400)] + [(8000, 9000)]  # hubs above and below
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    wanted, seen = {}, set()
    for start in sorted(near):
        waiting = [start]
        while waiting:
            node = waiting.pop()
            if node in seen:
                continue
            seen.add(node)
            wanted[node] = start
            waiting += near[node]
    table = spark.createDataFrame(edges, "a long, b long")
    got = [(r["node"], r["root"]) for r in (components(table) if few is None else components(table, few)).collect()]
    assert sorted(got) == sorted((n, r) for n, r in wanted.items() if n != r)

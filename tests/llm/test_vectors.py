import numpy as np
import pytest

from strata.llm.ann import MultiIndex, nearest_neighbours
from strata.llm.topk import _groups, exact_top_k
from strata.llm.vectors import k_means


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, id int")


def rows_of(vectors, start=0):
    return [(start + i, [float(x) for x in v], "clash", i) for i, v in enumerate(vectors)]


def by_hand_products(rows, k, every, scale=1024):
    whole = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, *_ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for q, a in whole:
        if q % every == 0:
            scored = sorted((-sum(map(int.__mul__, a, b)), i) for i, b in whole if i != q)[:k]
            found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(found)


def test_top_k_matches_brute_force(spark):
    chance = np.random.default_rng(1)
    rows = rows_of(np.concatenate([chance.normal(size=(300, 8)), np.tile(chance.normal(size=8), (150, 1))]))
    got = exact_top_k(table(spark, rows), k=4, every=10, block_rows=40, pivot_count=7, group_queries=6)
    assert sorted(map(tuple, got.collect())) == by_hand_products(rows, 4, 10)


def test_top_k_leaves_out_cells_that_cannot_help(spark):
    chance = np.random.default_rng(2)
    centres = chance.normal(size=(5, 6)) * 50
    rows = rows_of(np.concatenate([c + chance.normal(size=(60, 6)) * 0.1 for c in centres]))
    got = exact_top_k(table(spark, rows), k=3, every=20, pivot_count=16)
    assert sorted(map(tuple, got.collect())) == by_hand_products(rows, 3, 20)


def test_top_k_with_large_numbers_is_exact(spark):
    rows = rows_of([[1e9, -3e8, 7.5], [2e9, 1.5, -1e7], [3.25, 4e8, 1e9], [-1e9, 1e3, 2.0]])
    got = exact_top_k(table(spark, rows), k=3, every=1, scale=1)
    assert sorted(map(tuple, got.collect())) == by_hand_products(rows, 3, 1, scale=1)


def test_top_k_odd_rows(spark):
    rows = [(0, [1.0, 0.0], "", 0), (0, [1.0, 0.0], "", 0), (1, None, "", 1), (2, [float("nan"), 1.0], "", 2),
            (3, [None, 1.0], "", 3), (None, [1.0, 1.0], "", 4), (4, [0.5, 0.5], "", 5), (4, [0.5, 0.5], "", 5), (5, [0.0, 0.0], "", 6)]
    got = sorted(map(tuple, exact_top_k(table(spark, rows), k=5, every=5).collect()))
    assert got == [(0, 1, 4, 524288), (0, 2, 4, 524288), (0, 3, 5, 0), (5, 1, 0, 0), (5, 2, 0, 0), (5, 3, 4, 0), (5, 4, 4, 0)]
    assert exact_top_k(table(spark, [])).collect() == []


def test_top_k_of_an_id_that_repeats(spark):
    chance = np.random.default_rng(8)
    rows = rows_of(chance.normal(size=(40, 4))) + [(0, [float(x) for x in v], "", 0) for v in [[5, 5, 5, 5]] * 12]
    got = exact_top_k(table(spark, rows), k=3, every=50, pivot_count=3)
    wanted = set()
    for v in {tuple(r[1]) for r in rows if r[0] == 0}:
        q = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
        scored = sorted((-sum(int(np.floor(1024 * float(np.float32(x)))) * y for x, y in zip(r[1], q, strict=True)), r[0]) for r in rows if r[0] != 0)
        wanted |= {(0, n + 1, i, -s) for n, (s, i) in enumerate(scored[:3])}
    assert set(map(tuple, got.collect())) == wanted


def test_groups_of_queries():
    assert _groups({0: 3, 1: 4, 2: 9, 3: 2, 4: 5}, 8) == ({0: 0, 1: 0, 2: 1, 3: 3, 4: 3}, {0: 1, 1: 1, 2: 2, 3: 1, 4: 1}, 4)
    assert _groups({}, 8) == ({}, {}, 0)


def by_hand_cosines(rows, k, every):
    whole = [(i, np.array(v)) for i, v, *_ in rows]
    found = {}
    for q, a in whole:
        if q % every == 0:
            scored = sorted((-(a * b).sum() / np.sqrt((a * a).sum()) / np.sqrt((b * b).sum()), i) for i, b in whole if i != q)
            found[q] = [-s for s, _ in scored[:k]]
    return found


def test_neighbours_of_a_full_walk_are_exact(spark):
    rows = rows_of(np.random.default_rng(3).normal(size=(400, 9)).astype(np.float32))
    got = nearest_neighbours(table(spark, rows), k=5, every=20, centres=8, share=1.0, block_rows=50, group_queries=7)
    wanted = by_hand_cosines(rows, 5, 20)
    for query, scores in wanted.items():
        mine = sorted((r for r in got.collect() if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["score"] for r in mine] == pytest.approx(scores, abs=1e-9)


def test_recall_of_a_partial_walk(spark):
    chance = np.random.default_rng(4)
    centres = chance.normal(size=(30, 32))
    rows = rows_of((centres[chance.integers(0, 30, 4000)] + 0.5 * chance.normal(size=(4000, 32))).astype(np.float32))
    got = nearest_neighbours(table(spark, rows), centres=16, share=0.3, least=100).collect()
    wanted = by_hand_cosines(rows, 5, 50)
    hits = sum(r["score"] >= wanted[r["query_id"]][-1] - 1e-9 for r in got)
    assert len(got) == 400 and hits / 400 >= 0.9


def test_ties_and_a_common_vector(spark):
    rows = rows_of([[1.0, 2.0, 3.0, 4.0]] * 300 + [[4.0, 3.0, 2.0, 1.0]])
    got = nearest_neighbours(table(spark, rows), k=5, every=100, block_rows=64, least=1).collect()
    for query in (0, 100, 200):
        mine = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == query]
        assert mine == [i for i in range(6) if i != query][:5]
    assert {r["rank"] for r in got if r["query_id"] == 300} == {1, 2, 3, 4, 5}


def test_neighbours_odd_rows(spark):
    rows = [(0, [1.0, 0.0], "", 0), (1, None, "", 1), (2, [0.0, 0.0], "", 2), (3, [float("inf"), 1.0], "", 3),
            (None, [1.0, 1.0], "", 4), (4, [3.0e38, 3.0e38], "", 5), (5, [], "", 6), (6, [1e-30], "", 7)]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in nearest_neighbours(table(spark, rows)).collect())
    assert got == [(0, 1, 6, 1.0), (0, 2, 4, round(0.5**0.5, 6))]
    assert nearest_neighbours(table(spark, [])).collect() == []


def test_walk_goes_by_summed_distance():
    chance = np.random.default_rng(5)
    index = MultiIndex(chance.normal(size=(6, 2)), chance.normal(size=(5, 2)), chance.integers(0, 4, (6, 5)))
    unit = chance.normal(size=4)
    apart = ((unit[:2] - index.first) ** 2).sum(1)[:, None] + ((unit[2:] - index.second) ** 2).sum(1)
    for wanted in (1, 7, 20, 10_000):
        reached, flags = 0, np.zeros((6, 5), bool)
        for cell in np.argsort(apart.ravel()):
            if reached >= wanted:
                break
            flags.ravel()[cell] = True
            reached += index.counts.ravel()[cell]
        assert (index.walk(unit, wanted) == flags).all()


def test_k_means_with_few_different_rows():
    assert len(k_means(np.ones((10, 3)), 4)) == 1

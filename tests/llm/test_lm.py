import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strata.llm.lm import Filter, LogCounts, Model, _answer, _cells, _from_cells, _planes, build_part, score_texts


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def learns(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


def by_hand(rows):
    """Scores of the same model from exact counts."""
    texts = [(i, tokens(t)) for i, t, *_ in rows]
    train = [t for i, t in texts if learns(i)]
    single = Counter(w for t in train for w in t)
    start = object()
    pairs = Counter(p for t in train for p in zip([start, *t], t, strict=False))
    total, kinds, alone = sum(single.values()), len(single), sum(c == 1 for c in single.values())
    new = (alone + 1) / (total + 2) if total else 1.0

    def seen(h):
        return len(train) if h is start else single[h]

    def middle(n):
        return 2 ** (n.bit_length() - 0.5)

    def left_out(group, weight):
        """Likelihood of the training bigrams after such histories, each left out of its own counts."""
        return sum(
            c * math.log((1 - weight) * min(1, (c - 1) / max(middle(seen(h)) - 1, 1)) + weight * (1 - new) * middle(single[w]) / total)
            for (h, w), c in pairs.items()
            if seen(h).bit_length() == group
        )

    weights = [0.01 * k for k in range(1, 100)]
    best = {g: max(weights, key=lambda x: left_out(g, x)) for g in {seen(h).bit_length() for h, _ in pairs}}
    found = []
    for _, t in texts:
        score = 0.0
        for h, w in zip([start, *t], t, strict=False):
            one = (1 - new) * single[w] / total if single[w] else new
            mix = best[seen(h).bit_length()] if seen(h) else 1.0
            score += math.log10((1 - mix) * (pairs[h, w] / seen(h) if seen(h) else 0) + mix * one)
        base = sum(math.log10((single[w] + 1) / (total + kinds + 1)) for w in t)
        found.append((len(t), sum(single[w] > 0 for w in t), total, base, score))
    return found


def compare(docs, rows, close, **how):
    got = sorted(map(tuple, score_texts(docs, **how).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    wanted = sorted(((i, not learns(i), *x) for (i, *_), x in zip(rows, by_hand(rows), strict=True)), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in wanted], rel=1e-9)
    for one, other in zip(got, wanted, strict=True):
        assert abs(one[6] - other[6]) <= close * one[2]  # so much for each token
    return got


@pytest.fixture
def rows():
    chance = np.random.default_rng(0)
    words = np.array(["The", "the", "of", "a", "x,", "é", "nix"] + [f"w{i}" for i in range(60)])
    rows = []
    for i in range(150):
        chosen = words[np.minimum(len(words) - 1, chance.geometric(0.1, chance.integers(0, 60)) - 1)]
        rows.append((i, " ".join(chosen) + (f" own{i}" if i % 4 == 0 else ""), "en", "a"))
    return rows


def test_scores_match_exact_counts(make_docs, rows):
    # fine levels and many bits: the filter then gives nearly exact counts
    got = compare(make_docs(rows), rows, 1e-3, growth=1.001, bits=40, probes=20)
    assert sum(r[6] for r in got if r[1]) > sum(r[5] for r in got if r[1])


def test_quantised_scores_stay_near(make_docs, rows):
    compare(make_docs(rows), rows, 0.05)


def test_blocks_and_a_filter_that_is_not_broadcast_change_nothing(make_docs, rows):
    one = sorted(map(tuple, score_texts(make_docs(rows)).collect()))
    many = sorted(map(tuple, score_texts(make_docs(rows, partitions=5), block_bytes=500, broadcast_bytes=0).collect()))
    assert [r[:5] for r in one] == [r[:5] for r in many]
    assert [r[6] for r in one] == pytest.approx([r[6] for r in many])


def test_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.collect()]
    compare(odd_docs, rows, 1e-3, growth=1.001)
    assert score_texts(no_docs).collect() == []


def test_without_training_texts(make_docs):
    rows = [(i, "some words", "en", "a") for i in range(60) if not learns(i)]
    got = score_texts(make_docs(rows)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got} == {(0, 0, 0.0, 0.0)}


def test_levels_are_never_too_low_and_rarely_too_high():
    chance = np.random.default_rng(1)
    keys, levels = chance.integers(0, 1 << 48, 20_000).astype(np.uint64), chance.geometric(0.6, 20_000)
    size, bits = build_part(keys, levels, 12, 6)
    held = Filter(np.array([0]), np.array([size]), bits)
    got = held.levels(keys, np.zeros(len(keys), int), 6)
    assert (got >= levels).all() and (got > levels).mean() < 0.01
    others = chance.integers(0, 1 << 48, 20_000).astype(np.uint64)
    assert (held.levels(others, np.zeros(len(others), int), 6) > 0).mean() < 0.01


def test_small_counts_are_exact():
    counts = LogCounts()
    few = np.arange(1, 4)
    assert counts.count(counts.level(few)).tolist() == few.tolist()
    large = np.array([10, 1000, 10**6, 10**12])
    assert np.abs(counts.count(counts.level(large)) / large - 1).max() < 0.3


@pytest.mark.parametrize("width", [2, 6, 8])
def test_cells_hold_the_planes_of_their_numbers(width):
    chance = np.random.default_rng(2)
    sizes = np.array([0, 3, 1, 0, 500, 7, 0])
    numbers = chance.integers(0, 1 << min(8 * width, 63), sizes.sum()).astype(np.uint64)
    cells = _cells(numbers, sizes, width)
    assert cells.to_pylist() == [_planes(x, width) for x in np.split(numbers, np.cumsum(sizes)[:-1])]
    for chunks in ([cells], [cells.slice(0, 2), cells.slice(2, 0), cells.slice(2)], []):
        back, n = _from_cells(pa.chunked_array(chunks, pa.binary()), width)
        assert back.tolist() == (numbers.tolist() if chunks else []) and n.tolist() == (sizes.tolist() if chunks else [])


def test_a_part_is_probed_once_however_many_blocks_ask(monkeypatch):
    chance = np.random.default_rng(3)
    keys, levels = np.unique(chance.integers(0, 1 << 48, 3_000).astype(np.uint64)), 1 + np.arange(3_000) % 5
    size, bits = build_part(keys, levels[: len(keys)], 12, 6)
    part = pa.table({"bucket": [0], "size": [size], "bits": pa.array([bits], pa.binary())})
    blocks = [np.sort(chance.choice(keys, 20, replace=False)) for _ in range(400)] + [np.zeros(0, np.uint64)]
    cells = _cells(np.concatenate(blocks), np.array([len(x) for x in blocks]), 6)
    asked = pa.table({"bucket": [0] * len(blocks), "block": range(len(blocks)), "keys": cells})
    held = Filter(np.array([0]), np.array([size]), bits)
    wanted = [_planes(held.levels(x, np.zeros(len(x), int), 6), 3) for x in blocks]
    probed, probe = [], Filter.levels
    monkeypatch.setattr(Filter, "levels", lambda self, keys, *how: probed.append(keys.tolist()) or probe(self, keys, *how))
    answer = _answer(Model(1, 1, 1, 1, 1, np.ones(64), 6, 1.3))
    got = answer(part, asked)
    assert got["levels"].to_pylist() == wanted and got["block"].to_pylist() == list(range(len(blocks)))
    assert len(probed) == 1 and len(probed[0]) == len(set(probed[0]))  # each key once, all at a time
    empty = answer(part.slice(0, 0), asked)
    assert set(b"".join(empty["levels"].to_pylist())) <= {0}
    assert answer(part, asked.slice(0, 0)).num_rows == 0

"""Language-model scoring with a log-frequency Bloom filter.

The counts of all training bigrams are quantised on a logarithmic scale and put into a Bloom
filter: an n-gram with level q goes in q times, with the numbers 1 to q. A reader probes for
1, 2, 3, ... until a probe fails, and so gets the level back; an n-gram is never too low, and
rarely too high. The filter is built in parts by the tasks that add up the counts, with
``bits`` for each insertion. Up to ``broadcast_bytes`` it is broadcast. A larger one stays
where it is: each block of texts sends its different bigrams to the parts they belong to, is
probed there, and gets the levels back. Both ways give the same levels, nothing is left out,
and what a task holds does not grow with the corpus.

How often each single token stands in the training texts is counted exactly, over all of
them. Texts are tokenised once, in blocks; a block holds each of its different tokens once
and exchanges them for their total counts, so what is shuffled are different tokens of blocks
rather than tokens, and no token is hot. Tokens are told apart by hashes of 64 bits.

The model: with N training tokens of which n1 are of a kind met once, a token never seen has
probability (n1 + 1) / (N + 2) and one seen c times the rest times c / N. A bigram's share of
its history is mixed with that. The weights, one for each power of two of the history's count,
are those with the best likelihood of the training bigrams when each is left out of its own
counts; for that, counts are taken by powers of two as well.

Defined results: a null text is empty and holds the end token alone; a null doc_id counts as
the empty text where the training texts are chosen; without training texts all scores are 0;
repeated rows are counted and scored as often as they stand; other columns are not looked at;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.memory import tidy
from strata.session import working_folder
from strata.sources.storage import Storage

_START, _END = np.uint64(0x5354415254), np.uint64(0x454E44)  # stand for the borders of a text
_STEP = np.uint64(0x9E3779B97F4A7C15)
_KEPT = np.uint64(16)  # low bits of an n-gram's hash that are not kept
_CLASSES = 64  # powers of two of a count
_LEVELS = 1 << 20  # more than there are for any growth


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each 64-bit hash; the buckets are ranges of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of numbers, all first bytes first: easy to compress."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(planes: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(planes) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return wide.view("<u8").ravel()


def _cells(numbers: np.ndarray, sizes: np.ndarray, width: int) -> pa.Array:
    """``_planes`` of neighbouring numbers, so many to a cell, without a step for each cell."""
    ends = np.cumsum(sizes)
    place = np.arange(len(numbers)) + np.repeat((width - 1) * (ends - sizes), sizes)
    step, planes = np.repeat(sizes, sizes), np.empty(width * len(numbers), np.uint8)
    raw = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)
    for k in range(width):
        planes[place] = raw[:, k]
        place += step
    borders = np.append(0, width * ends).astype("<i8")
    held = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(borders), pa.py_buffer(planes)])
    return held.cast(pa.binary())


def _from_cells(cells: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all cells one after the other, and how many each cell has."""
    numbers, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for chunk in cells.chunks:
        if len(chunk):
            chunk = chunk.cast(pa.large_binary())
            borders = np.frombuffer(chunk.buffers()[1], "<i8")[chunk.offset : chunk.offset + len(chunk) + 1]
            size = np.diff(borders) // width
            place = np.arange(size.sum()) + np.repeat(borders[:-1] - (np.cumsum(size) - size), size)
            step, wide = np.repeat(size, size), np.zeros((len(place), 8), np.uint8)
            planes = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)
            for k in range(width):
                wide[:, k] = planes[place]
                place += step
            numbers.append(wide.view("<u8").ravel())
            sizes.append(size)
    return np.concatenate(numbers), np.concatenate(sizes)


def _level_starts(growth: float) -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 50:
        starts.append(max(starts[-1] + 1, math.ceil(starts[-1] * growth)))
    return np.array(starts, np.int64)


class LogCounts:
    """Counts as levels; the first few levels are one count each."""

    def __init__(self, growth: float = 1.3):
        self._starts = _level_starts(growth)
        self._middle = np.append(0, (self._starts + np.append(self._starts[1:], self._starts[-1] + 1) - 1) / 2)

    def level(self, counts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self._starts, counts, side="right")

    def count(self, levels: np.ndarray) -> np.ndarray:
        return self._middle[levels]


def _first(keys: np.ndarray, number: int) -> np.ndarray:
    """The hash of the first probe for n-gram ``keys`` with ``number``; :func:`_stride` is from there to each next one."""
    return _mix(keys + np.uint64(number * int(_STEP) % (1 << 64)))


def _stride(first: np.ndarray) -> np.ndarray:
    return _mix(first) | np.uint64(1)


def _place(hashes: np.ndarray, size: np.ndarray | np.uint64) -> np.ndarray:
    """Bit of a probe in parts of ``size`` bits."""
    return ((hashes >> np.uint64(32)) * size >> np.uint64(32)).astype(np.int64)


def build_part(keys: np.ndarray, levels: np.ndarray, bits: int, probes: int) -> tuple[int, bytes]:
    """Number of bits and the bits of the part of the filter that holds these n-grams."""
    size = max(64, min(-(-int(levels.sum()) * bits // 64) * 64, (1 << 32) - 64))
    held, number = np.zeros(size, bool), 1
    while len(keys):
        at = _first(keys, number)
        stride = _stride(at)
        for _ in range(probes):
            held[_place(at, np.uint64(size))] = True
            at = at + stride
        number += 1
        more = levels >= number
        keys, levels = keys[more], levels[more]
    return size, np.packbits(held, bitorder="little").tobytes()


@dataclass(frozen=True)
class Filter:
    """Parts of the filter one after the other: where each begins (in bits), and how many bits it has."""

    begin: np.ndarray
    size: np.ndarray
    bits: bytes

    def levels(self, keys: np.ndarray, parts: np.ndarray, probes: int) -> np.ndarray:
        """Levels from repeated probes, for n-grams that belong to these parts."""
        held_bits = np.frombuffer(self.bits, np.uint8)
        found, active = np.zeros(len(keys), np.int64), np.arange(len(keys))
        begin, size = self.begin[parts], self.size[parts].astype(np.uint64)
        number = 1
        while len(active):
            held, at, stride = active, _first(keys[active], number), None
            for i in range(probes):
                # Most that are not there fall out at the first probes, so each probe looks at fewer.
                place = _place(at, size[held]) + begin[held]
                there = (held_bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                held, at = held[there], at[there]
                if not len(held):
                    break
                stride = stride[there] if i else _stride(at)
                at = at + stride
            found[held] += 1
            active, number = held, number + 1
        return found


def training(doc_id: Column, folds: int = 7, held_out: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds != held_out


def _tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all tokens, number of tokens of each text, and the hash of each code."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten()
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(texts)), sizes)
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    words, of = words.filter(pa.array(some)), of[some]
    counts = np.bincount(of, minlength=len(texts))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64) if len(words) else np.zeros(0, np.int64)
    names = np.array(coded.dictionary.to_pylist(), object)
    hashes = pd.util.hash_array(names, categorize=False) if len(names) else np.zeros(0, np.uint64)
    codes = np.insert(codes, np.cumsum(counts), len(names))
    hashes = np.append(hashes, _END)
    # Frequent tokens get small codes, which take less room.
    order = np.argsort(-np.bincount(codes, minlength=len(hashes)), kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return rank[codes], counts + 1, hashes[order]


_BLOCK = "block long, n_docs long, n_vocabulary long, n_train long, docs binary, known binary, train binary, sizes binary, codes binary, hashes binary"


def _blocks(docs: DataFrame, train: Column, block_bytes: int) -> DataFrame:
    """Tokenised blocks of documents, of about ``block_bytes`` of text each."""

    def pack(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            total, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
            while start < len(texts):
                before = total[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(total, before + block_bytes)))
                part = batch.slice(start, stop - start)
                codes, sizes, hashes = _tokenised(texts.slice(start, stop - start))
                ids, learn = part.column("doc_id"), part.column("train").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "block": block,
                            "n_docs": len(sizes),
                            "n_vocabulary": len(hashes),
                            "n_train": int(sizes[learn].sum()),
                            "docs": pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                            "known": ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                            "train": learn.astype(np.uint8).tobytes(),
                            "sizes": sizes.astype("<i8").tobytes(),
                            "codes": _planes(codes, 4),
                            "hashes": hashes.astype("<u8").tobytes(),
                        }
                    ],
                    schema=pa.schema(
                        [(c, pa.int64()) for c in ("block", "n_docs", "n_vocabulary", "n_train")]
                        + [(c, pa.binary()) for c in ("docs", "known", "train", "sizes", "codes", "hashes")]
                    ),
                )
                block, start = block + 1, stop

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], train.alias("train"))
    return chosen.mapInArrow(tidy(pack), _BLOCK)


def _rows(batch: pa.RecordBatch):
    """The rows of a batch; binary cells are not copied."""
    for i in range(batch.num_rows):
        cells = ((name, column[i]) for name, column in zip(batch.schema.names, batch.columns, strict=True))
        yield {name: x.as_buffer() if pa.types.is_binary(x.type) else x.as_py() for name, x in cells}


def _counts(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, sizes and training flags of a block read from the table."""
    return (
        _numbers(block["codes"], 4).astype(np.int64),
        np.frombuffer(block["sizes"], "<i8"),
        np.frombuffer(block["train"], np.uint8).astype(bool),
    )


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of the keys in their order, the buckets that have any, and how many each has."""
    order = np.argsort(keys, kind="stable")
    own = _bucket(keys[order], buckets)
    firsts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[: len(own)])
    return order, own[firsts], np.diff(np.append(firsts, len(own)))


def _sent(block: int | None, buckets: np.ndarray, **cells: pa.Array) -> pa.RecordBatch:
    """A row for each bucket, with the number of the block that sends it."""
    columns = {"bucket": pa.array(buckets, pa.int64())}
    if block is not None:
        columns["block"] = pa.array(np.full(len(buckets), block), pa.int64())
    return pa.RecordBatch.from_pydict(columns | cells)


def _send_tokens(buckets: int):
    """Each block's different tokens with their training counts, by bucket of their hash."""

    def send(batches):
        for batch in batches:
            for block in _rows(batch):
                codes, sizes, train = _counts(block)
                hashes = np.frombuffer(block["hashes"], "<u8")
                counts = np.bincount(codes[np.repeat(train, sizes)], minlength=len(hashes))
                order, found, n = _by_bucket(hashes, buckets)
                yield _sent(block["block"], found, hashes=_cells(hashes[order], n, 8), counts=_cells(counts[order], n, 4))

    return send


_TOTALS = "bucket long, block long, totals binary, tokens long, kinds long, alone long"


def _add_tokens(sent: pa.Table) -> pa.Table:
    """Total counts of a bucket's tokens, returned to each block in the order it sent them."""
    hashes, sizes = _from_cells(sent["hashes"], 8)
    counts, _ = _from_cells(sent["counts"], 4)
    _, which = np.unique(hashes, return_inverse=True)
    totals = np.bincount(which, weights=counts).astype(np.int64)  # exact below 2 ** 53
    first = np.arange(len(sizes)) == 0
    return pa.table(
        {
            "bucket": sent["bucket"],
            "block": sent["block"],
            "totals": _cells(totals[which], sizes, 6),
            "tokens": pa.array(np.where(first, totals.sum(), 0)),
            "kinds": pa.array(np.where(first, (totals > 0).sum(), 0)),
            "alone": pa.array(np.where(first, (totals == 1).sum(), 0)),
        }
    )


def _with_totals(blocks: pa.Table, totals: pa.Table) -> pa.Table:
    """A block together with the total count of each of its codes."""
    hashes = np.frombuffer(blocks["hashes"][0].as_py(), "<u8")
    counts = np.empty(len(hashes), np.int64)
    counts[np.argsort(hashes)], _ = _from_cells(totals.sort_by("bucket")["totals"], 6)
    return blocks.append_column("totals", pa.array([_planes(counts, 6)], pa.binary()))


def _pairs(codes: np.ndarray, sizes: np.ndarray, kinds: int) -> np.ndarray:
    """History and token of each position as one number; the history of a first token is ``kinds``."""
    before = np.concatenate([[kinds], codes[:-1]])
    starts = np.cumsum(sizes) - sizes
    before[starts] = kinds
    return before * (kinds + 1) + codes


def _keys(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    return _mix(_mix(history + _STEP) + token)


def _class(totals: np.ndarray) -> np.ndarray:
    """The power of two above each count; 0 for none."""
    return np.frexp(totals.astype(np.float64))[1]


@dataclass(frozen=True)
class _Bigrams:
    """The different bigrams of some texts of a block."""

    which: np.ndarray  # number of the bigram at each position
    counts: np.ndarray
    before: np.ndarray  # total count of the history; that of the start is the number of texts
    after: np.ndarray  # total count of the token
    keys: np.ndarray


def _bigrams(block: dict, texts: int, only_training: bool = False) -> _Bigrams:
    codes, sizes, train = _counts(block)
    if only_training:
        codes, sizes = codes[np.repeat(train, sizes)], sizes[train]
    hashes = np.append(np.frombuffer(block["hashes"], "<u8"), _START)
    totals = np.append(_numbers(block["totals"], 6).astype(np.int64), texts)
    kinds = len(hashes) - 1
    pairs, which, counts = np.unique(_pairs(codes, sizes, kinds), return_inverse=True, return_counts=True)
    history, token = np.divmod(pairs, kinds + 1)
    return _Bigrams(which, counts, totals[history], totals[token], _keys(hashes[history], hashes[token]))


def _send_bigrams(buckets: int, texts: int):
    """The different bigrams of each block's training texts, by bucket of their hash."""

    def send(batches):
        for batch in batches:
            for block in _rows(batch):
                found = _bigrams(block, texts, only_training=True)
                classes = (_class(found.before) * _CLASSES + _class(found.after)).astype(np.uint64)
                order, own, n = _by_bucket(found.keys, buckets)
                keys = _cells(found.keys[order] >> _KEPT, n, 6)
                yield _sent(None, own, keys=keys, counts=_cells(found.counts[order], n, 4), classes=_cells(classes[order], n, 2))

    return send


_PART = "bucket long, size long, bits binary, cells array<long>, kinds array<long>"


def _add_bigrams(bits: int, probes: int, growth: float):
    """One part of the filter, and how many bigrams there are by classes of history and token and by level."""

    def add(sent: pa.Table) -> pa.Table:
        keys, counts, classes = (_from_cells(sent[c], width)[0] for c, width in (("keys", 6), ("counts", 4), ("classes", 2)))
        counts, classes = counts.astype(np.int64), classes.astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        keys = keys[first]
        counts, classes = np.add.reduceat(counts[order], first), classes[order][first]
        levels = LogCounts(growth).level(counts)
        size, held = build_part(keys, levels, bits, probes)
        cells, kinds = np.unique(classes * _LEVELS + levels, return_counts=True)
        return pa.table(
            {
                "bucket": sent["bucket"].slice(0, 1),
                "size": pa.array([size], pa.int64()),
                "bits": pa.array([held], pa.binary()),
                "cells": pa.array([cells.tolist()], pa.list_(pa.int64())),
                "kinds": pa.array([kinds.tolist()], pa.list_(pa.int64())),
            }
        )

    return add


def _load(parts: DataFrame, buckets: int) -> Filter:
    """The whole filter, whose size has been checked."""
    table = parts.select("bucket", "size", "bits").toArrow()
    begin, size, bits, at, held = np.zeros(buckets, np.int64), np.full(buckets, 64, np.int64), [bytes(8)], 64, None
    # A bucket without n-grams reads the first bits, which are not set.
    for bucket, n, held in zip(table["bucket"].to_pylist(), table["size"].to_pylist(), table["bits"], strict=True):
        begin[bucket], size[bucket] = at, n
        bits.append(held.as_buffer())  # not copied
        at += 8 * bits[-1].size
    whole = b"".join(bits)
    del table, bits, held
    pa.default_memory_pool().release_unused()
    return Filter(begin, size, whole)


def fit_mix(cells: np.ndarray, kinds: np.ndarray, unigram, growth: float) -> np.ndarray:
    """For each class of histories, the weight of single tokens with the best left-out likelihood.

    ``cells`` are classes of history and token and levels of bigrams, as one number; ``kinds``
    is how many different bigrams each has.
    """
    classes, levels = np.divmod(cells, _LEVELS)
    before, after = np.divmod(classes, _CLASSES)
    count = LogCounts(growth).count(levels)
    middle = lambda c: np.exp2(c - 0.5)
    share = np.minimum(1, (count - 1) / np.maximum(middle(before) - 1, 1))
    single = unigram(middle(after))
    weights = np.linspace(0.01, 0.99, 99)
    mix = np.ones(_CLASSES)
    for c in np.unique(before):
        at = before == c
        chance = (1 - weights[:, None]) * share[at] + weights[:, None] * single[at]
        mix[c] = weights[np.argmax((kinds[at] * count[at] * np.log(chance)).sum(1))]
    return mix


@dataclass(frozen=True)
class Model:
    tokens: int  # N
    kinds: int  # V
    alone: int  # n1
    texts: int
    buckets: int
    mix: np.ndarray  # weight of single tokens for each class of histories
    probes: int
    growth: float

    def unigram(self, totals: np.ndarray) -> np.ndarray:
        new = (self.alone + 1) / (self.tokens + 2) if self.tokens else 1.0
        return np.where(totals > 0, (1 - new) * totals / max(self.tokens, 1), new)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _block_scores(model: Model, block: dict, levels_of) -> pa.RecordBatch:
    """Scores of the documents of a block; ``levels_of`` gives the levels of some bigrams."""
    codes, sizes, train = _counts(block)
    totals = _numbers(block["totals"], 6).astype(np.int64)
    found = _bigrams(block, model.texts)
    count = np.zeros(len(found.keys))
    some = _asked(found)
    count[some] = LogCounts(model.growth).count(levels_of(found.keys[some]))
    weight = np.where(found.before > 0, model.mix[_class(found.before)], 1.0)
    share = np.minimum(count / np.maximum(found.before, 1), 1)
    value = np.log10((1 - weight) * share + weight * model.unigram(found.after))
    base = np.log10((totals + 1) / (model.tokens + model.kinds + 1))
    starts = np.cumsum(sizes) - sizes
    known = np.frombuffer(block["known"], np.uint8) == 0
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.frombuffer(block["docs"], "<i8"), mask=known),
            pa.array(~train),
            pa.array(sizes),
            pa.array(np.add.reduceat((totals > 0).astype(np.int64)[codes], starts)),
            pa.array(np.add.reduceat(base[codes], starts)),
            pa.array(np.add.reduceat(value[found.which], starts)),
        ],
        [field.split()[0] for field in _SCORES.split(", ")],
    )


def _asked(found: _Bigrams) -> np.ndarray:
    """A bigram with a token that no training text has is unseen; the others are looked up."""
    return np.flatnonzero((found.before > 0) & (found.after > 0))


def _score_here(model: Model, broadcast):
    """Scores of blocks with the filter at hand."""

    def run(batches):
        held = broadcast.value
        for batch in batches:
            for block in _rows(batch):
                yield _block_scores(
                    model, block, lambda keys: held.levels(keys >> _KEPT, _bucket(keys, model.buckets), model.probes)
                )

    return run


def _send_questions(model: Model):
    """The bigrams that each block asks for, by bucket."""

    def send(batches):
        for batch in batches:
            for block in _rows(batch):
                found = _bigrams(block, model.texts)
                keys = found.keys[_asked(found)]
                order, own, n = _by_bucket(keys, model.buckets)
                yield _sent(block["block"], own, keys=_cells(keys[order] >> _KEPT, n, 6))

    return send


def _answer(model: Model):
    """Levels of the bigrams that blocks ask of one part of the filter; what several ask is probed once."""

    def answer(part: pa.Table, asked: pa.Table) -> pa.Table:
        keys, sizes = _from_cells(asked["keys"], 6)
        keys, which = np.unique(keys, return_inverse=True)
        found = np.zeros(len(keys), np.int64)
        if len(part):
            held = Filter(np.zeros(1, np.int64), part["size"].to_numpy(), part["bits"][0].as_buffer())
            found = held.levels(keys, np.zeros(len(keys), np.int64), model.probes)
        return pa.table({"bucket": asked["bucket"], "block": asked["block"], "levels": _cells(found[which], sizes, 3)})

    return answer


def _score_answered(model: Model):
    """Scores of one block with the levels that were sent back to it."""

    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        levels, _ = _from_cells(answers.sort_by("bucket")["levels"], 3)

        def levels_of(keys: np.ndarray) -> np.ndarray:
            back = np.zeros(len(keys), np.int64)
            back[np.argsort(keys, kind="stable")] = levels
            return back

        (block,) = _rows(blocks.combine_chunks().to_batches()[0])
        return pa.Table.from_batches([_block_scores(model, block, levels_of)])

    return score


def score_texts(
    docs: DataFrame,
    train: Column | None = None,
    bits: int = 12,
    probes: int = 6,
    growth: float = 1.3,
    block_bytes: int = 4 << 20,
    broadcast_bytes: int = 192 << 20,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``train`` says which documents to learn from. base_score is that of single tokens with one
    added to every count.
    """
    spark = docs.sparkSession
    folder = working_folder(spark, "lm")
    train = training(docs["doc_id"]) if train is None else train

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    packed = saved(_blocks(docs, train, block_bytes), "packed")
    entries, tokens = packed.agg(F.sum("n_vocabulary"), F.sum("n_train")).first()
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    if entries is None:
        return spark.createDataFrame([], _SCORES).withColumn("train_tokens", F.lit(0).cast("long")).select(*columns)
    buckets = max(16, -(-entries // 500_000))
    sent = packed.select("block", "codes", "sizes", "train", "hashes").mapInArrow(
        tidy(_send_tokens(buckets)), "bucket long, block long, hashes binary, counts binary"
    )
    totals = saved(sent.groupBy("bucket").applyInArrow(_add_tokens, _TOTALS), "totals")
    sums = totals.agg(F.sum("tokens"), F.sum("kinds"), F.sum("alone")).first()
    counted = saved(
        packed.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(_with_totals, f"{_BLOCK}, totals binary"),
        "counted",
    )
    storage = Storage(spark, folder)
    storage.remove("packed")
    storage.remove("totals")
    texts = docs.where(train).count()
    gram_buckets = max(16, -(-tokens // 1_000_000))
    grams = counted.select("codes", "sizes", "train", "hashes", "totals").mapInArrow(
        tidy(_send_bigrams(gram_buckets, texts)), "bucket long, keys binary, counts binary, classes binary"
    )
    parts = saved(grams.groupBy("bucket").applyInArrow(_add_bigrams(bits, probes, growth), _PART), "filter")
    cells = parts.select(F.explode(F.arrays_zip("cells", "kinds")).alias("x")).groupBy("x.cells").agg(F.sum("x.kinds"))
    cells = np.array([tuple(row) for row in cells.collect()], np.int64).reshape(-1, 2)  # classes and levels are few
    model = Model(*sums, texts, gram_buckets, np.ones(_CLASSES), probes, growth)
    model = replace(model, mix=fit_mix(cells[:, 0], cells[:, 1], model.unigram, growth))
    if (parts.agg(F.sum("size")).first()[0] or 0) <= 8 * broadcast_bytes:
        held = spark.sparkContext.broadcast(_load(parts, gram_buckets))
        scored = counted.mapInArrow(tidy(_score_here(model, held)), _SCORES)
    else:
        asked = counted.mapInArrow(tidy(_send_questions(model)), "bucket long, block long, keys binary")
        levels = (
            parts.groupBy("bucket")
            .cogroup(asked.groupBy("bucket"))
            .applyInArrow(_answer(model), "bucket long, block long, levels binary")
        )
        scored = counted.groupBy("block").cogroup(levels.groupBy("block")).applyInArrow(_score_answered(model), _SCORES)
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long")).select(*columns)

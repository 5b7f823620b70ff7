"""Language identification with a convolutional network over bytes.

A text is read whole, in windows of fixed length. Filters of several widths slide over the
bytes of a window (in 64 classes: letters without case, white space, digits, signs, bytes of
other scripts); the largest value of each filter goes to a softmax layer. A document gets the
mean of its windows' probabilities, weighted by their bytes. The network is trained in numpy.

What it learns from is a sample whose size is a parameter: about ``sample_docs`` documents
of each language, chosen by a hash of doc_id, with ``sample_windows`` windows from all over
each. Counts for the sample cover all rows; the prediction uses the text alone.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is
every text if no row has a language to learn from; of languages with equal scores the first
by code point is taken; repeated rows give repeated results; a
null doc_id counts as the empty text where the held-out rows are chosen; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.memory import tidy

UNKNOWN = "und"
_CLASSES = 64
_WIDTHS = (2, 3, 4)


def _byte_classes() -> np.ndarray:
    """0 fills up; 1 to 26 letters, 27 white space, 28 digits, 29 signs, then bytes beyond ASCII."""
    kinds = np.full(256, 29, np.uint8)
    for b in range(256):
        letter = chr(b).lower()
        if "a" <= letter <= "z" and b < 128:
            kinds[b] = ord(letter) - ord("a") + 1
        elif b < 128 and chr(b).isspace():
            kinds[b] = 27
        elif ord("0") <= b <= ord("9"):
            kinds[b] = 28
        elif 0x80 <= b < 0xC0:
            kinds[b] = 30 + b % 32  # folds the two cases of many letters
        elif b >= 0xC0:
            kinds[b] = 62 + b % 2
    return kinds


_KINDS = _byte_classes()


def windows(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all windows, the text each belongs to, and how many bytes of it each holds."""
    sizes = np.diff(offsets)
    number = -(-sizes // length)
    first = np.concatenate([[0], np.cumsum(number)])
    flat = np.zeros(first[-1] * length, np.uint8)
    shift = np.repeat(first[:-1] * length - (offsets[:-1] - offsets[0]), sizes)
    flat[np.arange(len(shift)) + shift] = _KINDS[data]
    of = np.repeat(np.arange(len(sizes)), number)
    place = np.arange(first[-1]) - first[of]
    return flat.reshape(-1, length), of, np.minimum(length, sizes[of] - place * length)


@dataclass(frozen=True)
class ByteNetwork:
    """Weights: per width and offset a row of filters for each class; then the softmax layer."""

    labels: tuple[str, ...]
    filters: tuple[np.ndarray, ...]  # (width, classes, filters) for each width
    dense: np.ndarray
    bias: np.ndarray
    length: int

    def tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per width the sums for two neighbouring bytes, and for the one or two bytes after them."""
        both = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(_CLASSES * _CLASSES, -1)
        made = []
        for weights in self.filters:
            rest = weights[2:]
            after = None if len(rest) == 0 else rest[0] if len(rest) == 1 else both(rest[0], rest[1])
            made.append((np.ascontiguousarray(both(weights[0], weights[1])), after))
        return made

    def pooled(self, kinds: np.ndarray, tables: list, places: bool = False):
        """Largest value of each filter in each window, at least 0, and where it is if asked for."""
        longest = max(_WIDTHS) - 1
        padded = np.zeros((len(kinds), kinds.shape[1] + longest + 1), np.int64)
        padded[:, : kinds.shape[1]] = kinds
        pairs = padded[:, :-1] * _CLASSES + padded[:, 1:]
        size, values, at = kinds.shape[1], [], []
        for width, (first, after) in zip(_WIDTHS, tables, strict=True):
            value = first.take(pairs[:, :size], axis=0)
            if width == 3:
                value += after.take(padded[:, 2 : size + 2], axis=0)
            elif width == 4:
                value += after.take(pairs[:, 2 : size + 2], axis=0)
            values.append(value.max(1))
            if places:
                at.append(value.argmax(1))
        return np.maximum(np.concatenate(values, 1), 0), at, padded

    def probabilities(self, kinds: np.ndarray, tables: list) -> np.ndarray:
        """Of each label for each window; a few windows at a time, so that the values stay in the cache."""
        found = np.empty((len(kinds), len(self.labels)))
        for start in range(0, len(kinds), 64):
            values, _, _ = self.pooled(kinds[start : start + 64], tables)
            found[start : start + 64] = _softmax(values @ self.dense + self.bias)
        return found


def _softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(1, keepdims=True))
    return grown / grown.sum(1, keepdims=True)


def train(
    kinds: np.ndarray, wanted: np.ndarray, labels: tuple[str, ...], filters: int = 16, epochs: int = 6, rate: float = 0.01, seed: int = 0
) -> ByteNetwork:
    """A network fitted to windows by Adam; gradients go to the places that the pooling chose."""
    chance = np.random.default_rng(seed)
    weights = [chance.normal(0, 0.1, (w, _CLASSES, filters)).astype(np.float32) for w in _WIDTHS]
    dense = chance.normal(0, 0.1, (filters * len(_WIDTHS), len(labels))).astype(np.float32)
    parameters = [*weights, dense, np.zeros(len(labels), np.float32)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in parameters]
    step = 0
    for _ in range(epochs):
        order = chance.permutation(len(kinds))
        for start in range(0, len(order), 64):
            rows = order[start : start + 64]
            for w in weights:
                w[:, 0, :] = 0  # what fills up a window tells nothing
            network = ByteNetwork(labels, tuple(weights), parameters[-2], parameters[-1], kinds.shape[1])
            values, at, padded = network.pooled(kinds[rows], network.tables(), places=True)
            error = _softmax(values @ parameters[-2] + parameters[-1])
            error[np.arange(len(rows)), wanted[rows]] -= 1
            error /= len(rows)
            back = (error @ parameters[-2].T) * (values > 0)
            gradients = [np.zeros_like(w) for w in weights]
            for i, width in enumerate(_WIDTHS):
                own = back[:, i * filters : (i + 1) * filters].astype(np.float32)
                column = np.broadcast_to(np.arange(filters), own.shape)
                for k in range(width):
                    seen = np.take_along_axis(padded, at[i] + k, axis=1)
                    np.add.at(gradients[i][k], (seen, column), own)
            gradients += [(values.T @ error).astype(np.float32), error.sum(0).astype(np.float32)]
            step += 1
            for p, g, (m, v) in zip(parameters, gradients, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    for w in weights:
        w[:, 0, :] = 0
    return ByteNetwork(labels, tuple(weights), parameters[-2], parameters[-1], kinds.shape[1])


def _id_text(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.crc32(_id_text(doc_id)) % folds == fold


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    whole = pa.concat_arrays([texts])
    offsets = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset : whole.offset + len(whole) + 1].astype(np.int64)
    return np.frombuffer(whole.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets


def fit_language_model(
    labelled: DataFrame, sample_docs: int = 400, sample_windows: int = 8, length: int = 256, **how
) -> ByteNetwork | None:
    """A network from rows (doc_id, text, lang); None if no row has a text and a language."""
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    counts = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    parts, most = F.lit(False), 1 << 30
    for lang, count in counts.items():
        limit = min(most, int(most * sample_docs / count))
        parts = parts | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(most)) < limit))

    def cut(batches):
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang")
            for i in range(len(texts)):
                data, offsets = _bytes_of(texts.slice(i, 1))
                kinds = windows(data, offsets, length)[0]
                if len(kinds) == 0:
                    continue
                spread = np.unique(np.linspace(0, len(kinds) - 1, min(sample_windows, len(kinds))).astype(int))
                pieces = [kinds[j].tobytes() for j in spread]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[i].as_py()] * len(pieces), pa.string()), pa.array(pieces, pa.binary())], ["lang", "window"]
                )

    sample = rows.where(parts).mapInArrow(tidy(cut), "lang string, window binary").toArrow()
    labels = tuple(sorted(counts))
    langs, pieces = sample["lang"].to_pylist(), sample["window"].to_pylist()
    order = sorted(range(len(pieces)), key=lambda i: (langs[i], pieces[i]))  # the same model on every run
    kinds = np.frombuffer(b"".join(pieces[i] for i in order), np.uint8).reshape(-1, length)
    wanted = np.array([labels.index(langs[i]) for i in order], np.int64)
    return train(kinds, wanted, labels, **how)


def _predicted(texts: pa.Array, model: ByteNetwork | None, tables: list) -> tuple[np.ndarray, np.ndarray]:
    """Number of the label (-1: none) and score of each text; null is no text."""
    texts = pc.fill_null(texts, "")
    lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
    label, score = np.full(len(texts), -1), np.zeros(len(texts))
    if model is None:
        return label, score
    total, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while start < len(texts):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + (2 << 20))))
        kinds, of, size = windows(*_bytes_of(texts.slice(start, stop - start)), model.length)
        each = model.probabilities(kinds, tables) * size[:, None]
        mean = np.zeros((stop - start, each.shape[1]))
        np.add.at(mean, of, each)
        mean /= np.maximum(np.bincount(of, weights=size, minlength=stop - start), 1)[:, None]
        label[start:stop], score[start:stop] = mean.argmax(1), mean.max(1)
        start = stop
    label[~lettered], score[~lettered] = -1, 0
    return label, np.clip(score, 0, 1)


def predict_languages(docs: DataFrame, model: ByteNetwork | None) -> DataFrame:
    """doc_id, lang_pred and score of each text."""

    def run(batches):
        tables = model.tables() if model else []
        names = np.array([*(model.labels if model else ()), UNKNOWN], object)  # -1 is the last one
        for batch in batches:
            label, score = _predicted(batch.column("text"), model, tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[label], pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(tidy(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: ByteNetwork | None, least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with ``least_score`` at least."""

    def run(batches):
        tables = model.tables() if model else []
        for batch in batches:
            label, score = _predicted(batch.column("text"), model, tables)
            yield batch.filter(pa.array((label >= 0) & (score >= least_score)))

    return docs.mapInArrow(tidy(run), docs.schema)

"""Token counts from compiled finite-state machines.

Two deterministic transducers count the tokens of a text without listing them.

The *scanner* cuts a text into pieces. It has thirteen states over twelve classes of
characters; each transition says how many pieces begin there. All texts of a batch are one
string that is cut into chunks of equal length. All chunks are read side by side, each from
every state at once, which gives each chunk a map from state to state. The maps are composed
by a parallel prefix scan, so that every chunk's true first state is known, and a second
reading from there gives the pieces.

The *counter* reads the bytes of a piece. Its transitions are annotated with the number of
tokens by which the encoding of the prefix grows (or shrinks). A state holds the beginnings
from which a token may still be under way, each with the token before it and the number of
tokens up to it; states and transitions are made when first met and then shared by all
pieces. A different piece is counted once for each batch.

Defined results: a null text has no bytes and no tokens; repeated rows give repeated
results; a special token's string inside a text counts as one token, as the tokenizers
library has it by default; other columns are not looked at, whatever their names; an empty
table gives an empty result. Texts can have any length.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.memory import tidy
from strata.llm.vocabulary import Vocabulary, load

# Classes of characters. Some small letters have their own, as they may follow an apostrophe.
LETTER, SHORT, R, V, E, L, NUMBER, QUOTE, OTHER, SPACE, WHITE, END = range(12)
# States of the scanner, named by what the open piece is.
NONE, WORD, DIGITS, SIGNS, LONE_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, DONE, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE = range(13)
_HERE, _BEFORE = 1, 2  # a piece begins at this character; at the one before


def _scanner() -> tuple[np.ndarray, np.ndarray]:
    """Next state and flags by (state, class)."""
    letters = (LETTER, SHORT, R, V, E, L)
    after, flags = np.zeros((13, 12), np.uint8), np.zeros((13, 12), np.uint8)
    waiting = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: L}
    for state in range(13):
        for kind in range(12):
            word, white = kind in letters, kind in (SPACE, WHITE)
            flag = 0
            if kind == END:
                to, flag = NONE, _BEFORE if state in waiting else 0
            elif waiting.get(state) == kind:
                to = DONE  # 're, 've, 'll
            elif state in waiting and word:
                to, flag = WORD, _BEFORE
            elif state == LONE_QUOTE and kind == SHORT:
                to = DONE  # 's, 't, 'm, 'd
            elif state == LONE_QUOTE and kind in (R, V, L):
                to = {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind]
            elif white and state in (ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE):
                to = MORE_SPACE if kind == SPACE else MORE_WHITE
            else:
                if white:
                    to = ONE_SPACE if kind == SPACE else ONE_WHITE
                else:
                    to = WORD if word else DIGITS if kind == NUMBER else SIGNS
                joins = to == state or state == LONE_QUOTE and to == SIGNS or state in (ONE_SPACE, MORE_SPACE) and not white
                if kind == QUOTE and not joins:
                    to = LONE_QUOTE
                flag = 0 if joins else _HERE
                # A run of white space gives its last character to what follows, or leaves it alone.
                if state in waiting or state in (MORE_SPACE, MORE_WHITE):
                    flag |= _BEFORE
            after[state, kind], flags[state, kind] = to, flag
    return after, flags


AFTER, FLAGS = _scanner()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point, by the same Unicode properties as the pattern of the vocabulary."""
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        every = "".join(map(chr, (c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) != "Cs")))
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    for letters, kind in (("stmd", SHORT), ("r", R), ("v", V), ("e", E), ("l", L), ("'", QUOTE), (" ", SPACE)):
        kinds[[ord(c) for c in letters]] = kind
    return kinds


def _code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Code points of the characters of UTF-8 ``data`` that begin at ``lead``."""
    first = data[lead].astype(np.uint32)
    points = first.copy()
    for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        high = {2: 0xE0, 3: 0xF0, 4: 0x100}[size]
        chosen = np.flatnonzero((first >= low) & (first < high))
        value = first[chosen] & mask
        for k in range(1, size):
            value = value << 6 | (data[lead[chosen] + k] & 0x3F)
        points[chosen] = value
    return points


def scan(kinds: np.ndarray, chunk: int = 512) -> np.ndarray:
    """Flags of each character of a string of classes, from chunk maps composed by a prefix scan."""
    lanes = -(-len(kinds) // chunk)
    padded = np.full(lanes * chunk, END, np.uint8)
    padded[: len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(lanes, chunk).T)
    width = AFTER.shape[1]
    table, flags = AFTER.ravel(), FLAGS.ravel()
    maps = np.repeat(np.arange(AFTER.shape[0], dtype=np.uint8)[:, None], lanes, axis=1)
    for column in columns:
        maps = table.take(maps * np.uint8(width) + column)
    step = 1
    while step < lanes:  # after each round, a map spans twice as many chunks
        maps[:, step:] = np.take_along_axis(maps[:, step:], maps[:, :-step].copy(), axis=0)
        step *= 2
    state = np.concatenate([[NONE], maps[NONE, :-1]]).astype(np.uint8)
    found = np.empty_like(columns)
    for i, column in enumerate(columns):
        at = state * np.uint8(width) + column
        flags.take(at, out=found[i])
        state = table.take(at)
    return found.T.ravel()[: len(kinds)]


class Counter:
    """The transducer that counts the tokens of a piece; states are numbers, made when first met."""

    _MOST = 500_000  # transitions kept; more are made again

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary = vocabulary
        self._begun = {token[:i] for token in vocabulary.ids for i in range(len(token) + 1)}
        self._clear()

    def _clear(self) -> None:
        # A state: for each beginning, the bytes since, the token before it, its count less the present one.
        self._states = [((b"", -1, 0),)]
        self._numbers = {self._states[0]: 0}
        self._moves: dict[int, tuple[int, int]] = {}

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        vocabulary, letter = self._vocabulary, bytes([byte])
        grown = [(begun + letter, before, count) for begun, before, count in self._states[state]]
        last, change = -1, 0
        for text, before, count in grown:
            token = vocabulary.ids.get(text)
            if token is not None and vocabulary.whole(token) and (before < 0 or vocabulary.beside(before, token)):
                last, change = token, count + 1
                break
        open_ = [(text, before, count - change) for text, before, count in grown if text in self._begun]
        key = (*open_, (b"", last, 0))
        number = self._numbers.setdefault(key, len(self._states))
        if number == len(self._states):
            self._states.append(key)
        self._moves[state << 8 | byte] = number, change
        return number, change

    def count(self, piece: bytes) -> int:
        if len(self._moves) > self._MOST:
            self._clear()
        moves, state, total = self._moves, 0, 0
        for byte in piece:
            move = moves.get(state << 8 | byte) or self._move(state, byte)
            state = move[0]
            total += move[1]
        return total


@lru_cache(maxsize=4)
def _counter(path: str) -> Counter:
    return Counter(load(path))


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pieces of the texts, and how many each text has. The texts may not be null."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    kinds = _classes()[_code_points(data, lead)]
    # An end after each text: character i of text t moves by t places.
    ends = np.searchsorted(lead, offsets[1:])
    kinds = np.insert(kinds, ends, END)
    flags = scan(kinds)
    begins = (flags & _HERE).astype(bool)
    begins[:-1] |= (flags[1:] & _BEFORE).astype(bool)
    begins = np.delete(begins, ends + np.arange(len(ends)))
    starts = lead[begins]
    borders = np.append(starts, len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return pieces, np.diff(np.searchsorted(starts, offsets))


def count_tokens(texts: pa.Array, path: str) -> np.ndarray:
    """Number of tokens of each text of a string array without nulls."""
    vocabulary, counter = load(path), _counter(path)
    total = np.zeros(len(texts), np.int64)
    of = np.arange(len(texts))
    for special in vocabulary.special:
        held = pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        if held.any():
            parts = pc.split_pattern(texts, special)
            lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
            np.add.at(total, of, lengths - 1)
            of, texts = np.repeat(of, lengths), parts.flatten()
    pieces, sizes = _pieces(texts)
    coded = pieces.dictionary_encode()
    counts = np.fromiter(map(counter.count, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    each = counts[coded.indices.to_numpy()] if len(pieces) else np.zeros(0, np.int64)
    sums = np.concatenate([[0], np.cumsum(each)])
    border = np.concatenate([[0], np.cumsum(sizes)])
    np.add.at(total, of, sums[border[1:]] - sums[border[:-1]])
    return total


def token_counts(docs: DataFrame, path: str, limit: int = 512, batch_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether n_tokens is above ``limit``, of each text."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), pc.fill_null(batch.column("text"), "")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            total, start = np.cumsum(sizes), 0
            while start < len(texts):
                before = total[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(total, before + batch_bytes)))
                part = pa.concat_arrays([texts.slice(start, stop - start)])  # offsets from the part's own beginning
                counts = count_tokens(part, path)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), pa.array(sizes[start:stop]), pa.array(counts), pa.array(counts > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )
                start = stop

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return chosen.mapInArrow(tidy(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

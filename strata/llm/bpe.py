"""BPE encoding and decoding with one table entry per prefix.

For a piece of text the automaton gives all vocabulary tokens that end at each position.
Exactly one of them ends the encoding of the prefix up to there: the one that may stand
beside the last token of the prefix it begins after. That last token is stored for each
prefix; the ids are read off from the end by following the tokens' lengths back. The work
grows with the length of the piece, however long it is.

Defined results: a null text is encoded as the empty text; repeated rows give repeated
results; a special token's string inside a text is that token, as the tokenizers library
has it by default; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.memory import tidy
from strata.llm.vocabulary import PIECES, Vocabulary, load

_LONG_PIECE = 64


class _Pieces(dict):
    """Ids of a piece as bytes of unsigned 32-bit numbers, found when first asked for.

    When it is full, what it holds is put aside, and pieces that are asked for again come back.
    """

    def __init__(self, encoder: Encoder, most: int):
        super().__init__()
        self._encoder, self._most = encoder, most
        self._aside: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        value = self._aside.get(piece)
        if value is None:
            ids = self._encoder.encode_piece(piece.encode("utf-8"))
            value = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= _LONG_PIECE:
            if len(self) >= self._most:
                self._aside = dict(self)
                self.clear()
            self[piece] = value
        return value


class _Suffixes:
    """The automaton of the vocabulary's tokens; its states are made when first met.

    A state is the longest end of what was read with which some token begins. So every token
    that ends here is an end of the state, and ``tokens`` has them, the longest first.
    """

    _MOST = 400_000  # transitions; more are made again

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary = vocabulary
        self._begun = {token[:i] for token in vocabulary.ids for i in range(len(token) + 1)}
        self.moves: dict[int, int] = {}
        self.tokens: list[tuple[int, ...]] = [()]
        self._texts, self._numbers = [b""], {b"": 0}

    def move(self, state: int, byte: int) -> int:
        text = self._texts[state] + bytes([byte])
        while text not in self._begun:
            text = text[1:]
        number = self._numbers.setdefault(text, len(self._texts))
        if number == len(self._texts):
            ids, whole = self._vocabulary.ids, self._vocabulary.whole
            ends = (ids.get(text[i:]) for i in range(len(text)))
            self._texts.append(text)
            self.tokens.append(tuple(token for token in ends if token is not None and whole(token)))
        if len(self.moves) >= self._MOST:
            self.moves.clear()
        self.moves[state << 8 | byte] = number
        return number


class Encoder:
    def __init__(self, vocabulary: Vocabulary, remembered: int = 80_000):
        self._vocabulary = vocabulary
        self._suffixes = _Suffixes(vocabulary)
        self._size = [len(token) for token in vocabulary.tokens]
        self._find = regex.compile(PIECES).findall
        self._special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self._pieces = _Pieces(self, remembered)

    def encode_piece(self, piece: bytes) -> list[int]:
        suffixes, sizes, vocabulary = self._suffixes, self._size, self._vocabulary
        moves, tokens, known = suffixes.moves.get, suffixes.tokens, vocabulary.known_beside.get
        state, last = 0, [0]  # the last token of each prefix; the empty one has none
        for end, byte in enumerate(piece, 1):
            after = moves(state << 8 | byte)
            state = suffixes.move(state, byte) if after is None else after
            for token in tokens[state]:
                start = end - sizes[token]
                if start:
                    fits = known(last[start] << 32 | token)
                    if fits is None:
                        fits = vocabulary.beside(last[start], token)
                    if not fits:
                        continue
                last.append(token)
                break
            else:
                raise ValueError(f"no token of the vocabulary ends with byte {byte}")
        ids, end = [], len(piece)
        while end:
            ids.append(last[end])
            end -= sizes[last[end]]
        ids.reverse()
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if self._special is None or not self._special.search(text):
            return b"".join(map(self._pieces.__getitem__, self._find(text)))
        special = self._vocabulary.special
        parts = self._special.split(text)
        return b"".join(
            struct.pack("<I", special[part]) if part in special else b"".join(map(self._pieces.__getitem__, self._find(part)))
            for part in parts
        )

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; bytes that are no text become U+FFFD."""
        return b"".join(map(self._vocabulary.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str, remembered: int = 80_000) -> Encoder:
    """The encoder of a worker. Twice ``remembered`` pieces are kept; more are found again."""
    return Encoder(load(path), remembered)


def _small(batches, rows: int = 256):
    """Few rows at a time, so that what is made of them takes little room."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _texts(column: pa.Array):
    for text in column:
        yield text.as_py() or ""


def encode_texts(docs: DataFrame, path: str, remembered: int = 30_000) -> DataFrame:
    """doc_id with the ``ids`` of each text."""

    def run(batches):
        tool = encoder(path, remembered)
        for batch in _small(batches):
            found = [tool.encode(text) for text in _texts(batch.column("text"))]
            ends = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in found])]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
            column = pa.ListArray.from_arrays(pa.array(ends), ids)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], ["doc_id", "ids"])

    return _narrow(docs).mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id with the ``text`` of each row of ids; null ids are an empty text."""

    def run(batches):
        tool = encoder(path)
        for batch in _small(batches):
            texts = [tool.decode(np.array(ids or [], np.uint32)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    chosen = encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), encoded["ids"].alias("ids"))
    return chosen.mapInArrow(tidy(run), "doc_id long, text string")


def round_trips(docs: DataFrame, path: str, remembered: int = 250_000) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text, encoded and decoded again."""

    def run(batches):
        tool = encoder(path, remembered)
        for batch in _small(batches):
            counts, codes, texts = [], [], []
            for text in _texts(batch.column("text")):
                ids = tool.encode(text)
                counts.append(len(ids) // 4)
                codes.append(hashlib.sha256(ids).hexdigest())
                texts.append(hashlib.sha256(tool.decode(np.frombuffer(ids, "<u4")).encode("utf-8")).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(codes, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _narrow(docs).mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))

"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits. The first level holds the lowest chunk of every id;
a bitmap says which ids go on, and the next level holds one chunk for each of those. A rank
directory counts the set bits before each word of a bitmap, so the place of an id's next
chunk is known at once, and any token is read without decoding what stands around it.

Documents are put in order of doc_id by a range shuffle (rows that share a doc_id by their
text) and written as blocks of bounded size, a row of a Parquet file for each. A block stands
in a page of its own, uncompressed, so that a reader gets at it by the file's index of pages.
A block knows how many tokens its file part has before it. A directory, written once after
the blocks, holds for each block its file, its number there and the tokens before it in all
files, in that order: a single token costs a look there and one page of one file. Spark
commits the files, so a task that runs again leaves nothing twice.

Defined results: a null text holds the end id alone; a null doc_id comes first and stays
null; repeated rows are stored as often as they stand; other columns are not stored; an empty table gives files without
blocks, which read as an empty result.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.memory import tidy
from strata.plans.sizing import sized_for

_HEAD = "part int, number int, before long, n_tokens long"
_DIRECTORY = "start long, n_tokens long, part int, number int, file string"
_ONE_PAGE_A_ROW = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.page.row.count.limit": "1"}

_REMEMBERED = 800_000  # words; more are encoded again
_LONG_WORD = 64
_PLAIN = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # no apostrophe: it may begin a piece with the letters after it


def pack_codes(ids: np.ndarray) -> bytes:
    """Ids as levels of byte chunks with continuation bitmaps and rank directories."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest > 0xFF
        bits = np.zeros(-(-len(rest) // 64) * 8, np.uint8)
        packed = np.packbits(more, bitorder="little")
        bits[: len(packed)] = packed
        words = bits.view(np.uint64)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.uint32)
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8).tobytes(), words.tobytes(), before.tobytes()))
        rest = rest[more] >> np.uint32(8)
    parts = [struct.pack("<I", len(levels))]
    for length, chunks, words, before in levels:
        parts += [struct.pack("<Q", length), words, before, chunks]
    return b"".join(parts)


class Codes:
    """Packed ids; ``take`` reads those at any places."""

    def __init__(self, packed: bytes):
        (count,) = struct.unpack_from("<I", packed)
        self._levels, at = [], 4
        for _ in range(count):
            (length,) = struct.unpack_from("<Q", packed, at)
            words = -(-length // 64)
            at += 8
            bits = np.frombuffer(packed, np.dtype("<u8"), words, at)
            before = np.frombuffer(packed, np.dtype("<u4"), words, at + 8 * words)
            at += 12 * words
            self._levels.append((np.frombuffer(packed, np.uint8, length, at), bits, before))
            at += length
        self.end = at

    def __len__(self) -> int:
        return len(self._levels[0][0]) if self._levels else 0

    def take(self, places: np.ndarray) -> np.ndarray:
        ids = np.zeros(len(places), np.uint32)
        which, at = np.arange(len(places)), places.astype(np.int64)
        for level, (chunks, bits, before) in enumerate(self._levels):
            ids[which] |= chunks[at].astype(np.uint32) << np.uint32(8 * level)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            more = (word >> bit & np.uint64(1)).astype(bool)
            if not more.any():
                break
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            at = (before[at >> 6].astype(np.int64) + below)[more]
            which = which[more]
        return ids


class _Words:
    """Encodes different words many at a time, with a special token between them as the border.

    What is known is kept as one array of words, and their ids one after the other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        self._tool = Tokenizer.from_file(path)
        special = {x.content: i for i, x in self._tool.get_added_tokens_decoder().items() if x.special}
        self._border = min(special.items(), default=None)
        self.special = tuple(special)
        with open(path, encoding="utf-8") as file:
            suffix = json.load(file)["model"].get("end_of_word_suffix")
        vocabulary = self._tool.get_vocab()
        self._ends_word = np.zeros(1 + max(vocabulary.values()), bool)
        self._ends_word[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self._words = pa.array([], pa.string())
        self._ids, self._ends = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where in it those of each of the different ``words`` begin and end."""
        if len(self._words) > _REMEMBERED:
            self._forget()
        place = pc.fill_null(pc.index_in(words, value_set=self._words), -1).to_numpy(zero_copy_only=False).copy()
        # Words of letters alone come first, as they are encoded in another way.
        new = np.flatnonzero(place < 0)
        letters = pc.match_substring_regex(words, "^[a-z]+$").to_numpy(zero_copy_only=False)[new]
        new = np.concatenate([new[letters], new[~letters]])
        if len(new):
            place[new] = len(self._words) + np.arange(len(new))
            missing = words.take(pa.array(new))
            ids, sizes = self._encode(missing.to_pylist(), int(letters.sum()))
            before = len(self._ids)
            self._words = pa.concat_arrays([self._words, missing])
            self._ids = np.concatenate([self._ids, ids])
            self._ends = np.concatenate([self._ends, before + np.cumsum(sizes)])
        begins = np.concatenate([[0], self._ends])
        return self._ids, begins[place], begins[place + 1]

    def _one(self, text: str) -> np.ndarray:
        return np.array(self._tool.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode(self, words: list[str], letters: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has.

        The first ``letters`` words are of letters alone. Such a word ends with the first token
        that has the mark for it, so white space is border enough.
        """
        found = []
        for start in range(0, letters, 64):
            part = words[start : min(start + 64, letters)]
            ids = self._one(" ".join(part))
            ends = np.flatnonzero(self._ends_word[ids]) + 1
            same = len(ends) == len(part) and ends[-1] == len(ids)
            found += np.split(ids, ends[:-1]) if same else [self._one(word) for word in part]
        for start in range(letters, len(words), 512):
            part = words[start : start + 512]
            if self._border is None or any(x in word for word in part for x in self.special):
                found += [self._one(word) for word in part]
                continue
            text, number = self._border
            ids = self._one(text.join(part))
            borders = np.flatnonzero(ids == number)
            found += np.split(np.delete(ids, borders), borders - np.arange(len(borders)))
        return np.concatenate(found), np.array([len(ids) for ids in found])


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> _Words:
    return _Words(path)


def _cut_marks(words: pa.Array, special: tuple[str, ...]) -> tuple[pa.Array, np.ndarray]:
    """Words without the marks that follow their last letter or digit of ASCII, and these marks; whose they are.

    Such marks are a piece of their own for the tokenizer, whatever stands before them.
    """
    words = pa.concat_arrays([words])
    borders = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    body = borders[:-1] + pc.binary_length(pc.ascii_rtrim(words, characters=_MARKS)).to_numpy(zero_copy_only=False)
    cut = (body > borders[:-1]) & _PLAIN[data[np.maximum(body - 1, 0)]]
    for text in special:
        cut &= ~pc.match_substring(words, text).to_numpy(zero_copy_only=False)
    pairs = np.stack([np.where(cut, body, borders[1:]), borders[1:]], 1).ravel()
    some = np.diff(np.concatenate([borders[:1], pairs])) > 0
    pieces = pa.Array.from_buffers(
        pa.string(), int(some.sum()), [None, pa.py_buffer(np.concatenate([borders[:1], pairs[some]])), words.buffers()[2]]
    )
    return pieces, np.repeat(np.arange(len(words)), 2)[some]


def encode_words(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts and how many each text has.

    For vocabularies that drop white space and case: each different word is encoded once.
    The texts may not be null.
    """
    tool = _tokenizer(path)
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    if not pc.any(pc.not_equal(words, "")).as_py():
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    held = tuple(x for x in tool.special if pc.any(pc.match_substring(texts, x)).as_py())
    pieces, whose = _cut_marks(words, held)
    coded = pieces.dictionary_encode()
    # The vocabulary has no case; beyond ASCII that is left to the tokenizer.
    different = coded.dictionary
    special = pc.match_substring(different, held[0]) if held else pa.array(np.zeros(len(different), bool))
    for x in held[1:]:
        special = pc.or_(special, pc.match_substring(different, x))
    plain = pc.and_(pc.string_is_ascii(different), pc.invert(special))
    folded = pc.if_else(plain, pc.ascii_lower(different), different).dictionary_encode()
    ids, begins, ends = tool.ids_of(folded.dictionary)
    codes = folded.indices.to_numpy()[coded.indices.to_numpy()]
    sizes = (ends - begins)[codes]
    stops = np.cumsum(sizes)
    places = np.arange(stops[-1]) + np.repeat(begins[codes] - (stops - sizes), sizes)
    return ids[places], np.bincount(of[whose], weights=sizes, minlength=len(texts)).astype(np.int64)


def _with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id))


def _block(doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> bytes:
    known = np.frombuffer(pc.is_valid(doc_ids).cast(pa.uint8()).to_numpy(zero_copy_only=False).tobytes(), np.uint8)
    numbers = pc.fill_null(doc_ids, 0).to_numpy(zero_copy_only=False).astype("<i8")
    return b"".join([struct.pack("<I", len(counts)), numbers.tobytes(), counts.astype("<i8").tobytes(), known.tobytes(), pack_codes(ids)])


def open_block(packed: bytes) -> tuple[pa.Array, np.ndarray, Codes]:
    """doc_id and number of tokens of the documents of a block, and its codes."""
    (docs,) = struct.unpack_from("<I", packed)
    numbers, counts = (np.frombuffer(packed, "<i8", docs, 4 + 8 * docs * k) for k in (0, 1))
    known = np.frombuffer(packed, np.uint8, docs, 4 + 16 * docs)
    return pa.array(numbers, mask=known == 0), counts, Codes(packed[4 + 17 * docs :])


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 2, batch_bytes: int = 6 << 20) -> None:
    """Write the ids of all texts, each followed by ``end_id``, in order of doc_id.

    A block holds whole documents of about ``batch_bytes`` of text.
    """

    def run(batches):
        part, number, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), pc.fill_null(batch.column("text"), "")
            total, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
            while start < len(texts):
                done = total[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(total, done + batch_bytes)))
                ids, counts = encode_words(texts.slice(start, stop - start), path)
                ids, counts = _with_ends(ids, counts, end_id), counts + 1
                packed = _block(doc_ids.slice(start, stop - start), counts, ids)
                yield pa.RecordBatch.from_pylist(
                    [{"part": part, "number": number, "before": before, "n_tokens": len(ids), "block": packed}],
                    schema=pa.schema([("part", pa.int32()), ("number", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("block", pa.binary())]),
                )
                number, before, start = number + 1, before + len(ids), stop

    # The hash keeps many rows of one doc_id from meeting in one task.
    keys = (F.col("doc_id"), F.xxhash64("text"), F.col("text"))
    with sized_for(docs):
        ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).repartitionByRange(*keys[:2])
        blocks = ordered.sortWithinPartitions(*keys).mapInArrow(tidy(run), f"{_HEAD}, block binary")
        blocks.write.options(**_ONE_PAGE_A_ROW).mode("errorifexists").parquet(f"{folder}/blocks")
    _write_directory(docs.sparkSession, folder)


def _write_directory(spark: SparkSession, folder: str) -> None:
    """Where each block stands, in order of the tokens; no block is read for it."""
    heads = spark.read.schema(_HEAD).parquet(f"{folder}/blocks").select("*", F.col("_metadata.file_name").alias("file"))
    parts = heads.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row for each part, that is for each task of the job that wrote the blocks.
    offsets = parts.select("part", F.coalesce(earlier, F.lit(0)).alias("offset"))
    placed = heads.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("before"))
    columns = ("start", "n_tokens", "part", "number", "file")
    placed.select(*columns).sort("start").write.mode("errorifexists").parquet(f"{folder}/directory")


def _directory(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_DIRECTORY).parquet(f"{folder}/directory")


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    """All blocks with ``start``, the number of tokens before them in all files."""
    blocks = spark.read.schema("part int, before long, block binary").parquet(f"{folder}/blocks")
    # A part's first block has nothing before it there: one row for each part.
    offsets = _directory(spark, folder).where("number = 0").select("part", F.col("start").alias("offset"))
    return blocks.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("before"))


def _documents(batches):
    """Of each block: doc_id, start and number of tokens of its documents, and their ids as bytes."""
    for batch in batches:
        for start, block in zip(batch.column("start"), batch.column("block"), strict=True):
            doc_ids, counts, codes = open_block(block.as_buffer())
            data = memoryview(codes.take(np.arange(len(codes))).astype("<u4").tobytes())
            ends = np.cumsum(counts)
            ids = [data[4 * int(a) : 4 * int(b)] for a, b in zip(ends - counts, ends, strict=True)]
            yield doc_ids, pa.array(start.as_py() + ends - counts), pa.array(counts), ids


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ``ids`` (little-endian unsigned 32-bit numbers) of every document."""

    def run(batches):
        for *columns, ids in _documents(batches):
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return _blocks(spark, folder).select("start", "block").mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(spark: SparkSession, folder: str, positions: list[int]) -> DataFrame:
    """position and token_id for some positions in the order of all files.

    The directory tells which blocks hold them; only these blocks' files are opened, and only
    their pages read. A position beyond the last token has no row; one asked twice has two.
    What reaches the driver is one row for each such block, so no more than ``positions``.
    """
    result = "position long, token_id long"

    def run(batches):
        for batch in batches:
            for begin, block, places in zip(*(batch.column(c) for c in ("start", "block", "wanted")), strict=True):
                wanted = places.as_py()
                ids = open_block(block.as_buffer())[2].take(np.array(wanted) - begin.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(ids.astype(np.int64))], ["position", "token_id"])

    if not positions:
        return spark.createDataFrame([], result)
    end = F.col("start") + F.col("n_tokens")
    inside = F.filter(F.array(*[F.lit(int(p)).cast("long") for p in positions]), lambda p: (p >= F.col("start")) & (p < end))
    near = _directory(spark, folder).where((F.col("start") <= max(positions)) & (end > min(positions)))
    found = near.select("part", "number", "start", "file", inside.alias("wanted")).where(F.size("wanted") > 0).collect()
    if not found:
        return spark.createDataFrame([], result)
    files = sorted({f"{folder}/blocks/{row['file']}" for row in found})
    wanted = spark.createDataFrame(
        [(row["part"], row["number"], row["start"], row["wanted"]) for row in found],
        "part int, number int, start long, wanted array<long>",
    )
    blocks = spark.read.schema("part int, number int, block binary").parquet(*files)
    chosen = blocks.where(F.col("number").isin(sorted({row["number"] for row in found})))
    return chosen.join(F.broadcast(wanted), ["part", "number"]).select("start", "block", "wanted").mapInArrow(tidy(run), result)


def stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the stored ids of every document."""

    def run(batches):
        for doc_ids, starts, counts, ids in _documents(batches):
            sums = pa.array([zlib.crc32(x) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([doc_ids, starts, counts, sums], ["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = _blocks(spark, folder).select("start", "block")
    return blocks.mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")

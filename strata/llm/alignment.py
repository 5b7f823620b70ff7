"""Alignment of two tokenizers over a corpus, with each different text tokenised once.

A text gets tokens from a byte-level vocabulary (A) and from a vocabulary of pieces (B). Where
a token of A and one of B end at the same byte they are linked, and these ends cut both into
groups. How often a pair of ids is linked in the whole corpus weighs the links of each text.

1. Rows are shuffled by their full text, so each different text is there once, with the number
   of its copies (:func:`align_corpus`).
2. A task goes through its texts block by block. A text falls apart at single spaces between
   visible characters: no token of either vocabulary reaches over such a place, so units between
   them are tokenised and aligned on their own, each different one of a block once. A block
   keeps the units of its texts as numbers, the id pairs its units link, and how often, copies
   included; it is written to the shared folder.
3. Pair counts are summed over blocks (:func:`pair_counts`), and every block gets back the sums
   of the pairs it has, never the whole table (:func:`text_measures`).
4. Measures of texts are joined to documents by a SHA-256 of the text; a text with very many
   copies is spread over salts (:func:`document_measures`).

Defined results: null and empty texts, and texts whose tokens do not spell a space and the text
in either vocabulary, have no tokens and take no part in the counts; strings of special tokens
are plain text; repeated rows are copies, and each gets the text's measures; a null doc_id is
kept; ties for a B id's most frequent pair are all its best; an empty table gives an empty
result. Other columns are not looked at, whatever their names. A text longer than a block is a
block of its own, and one without spaces is one unit.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.memory import tidy
from strata.plans.skew import lookup_join
from strata.session import cut_lineage

_MARK = "▁"  # what vocabularies of pieces write for a space
#: A space with a visible character on either side.
_BETWEEN = re.compile(rf" (?<=[^\s{_MARK}] )(?=[^\s{_MARK}])")
_BLOCK_BYTES = 4 << 20
_REMEMBERED = 40_000
_TOGETHER = 4_096  # units that are tokenised at once
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_letters() -> dict[str, int]:
    """Byte-level files write a byte as the letter of its number if it is visible, else as one from 256 on."""
    visible = {chr(b): b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 0xA0}
    rest = [b for b in range(256) if b not in visible.values()]
    return visible | {chr(256 + place): b for place, b in enumerate(rest)}


class _Tokens:
    """The byte strings of a vocabulary's ids."""

    def __init__(self, texts: list[bytes]):
        self.bytes = texts
        self.sizes = np.array([len(x) for x in texts], np.int64)
        names = [str(i) for i in range(len(texts))]
        self.named = {after: np.array([x + after for x in names], object) for after in ",|;"}


class Aligner:
    """Tokenises and aligns units of texts with two vocabularies."""

    def __init__(self, byte_file: str, piece_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self._a = Tokenizer.from_file(byte_file)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        letters = _byte_letters()
        with open(byte_file, encoding="utf-8") as file:
            special = {x["id"] for x in json.load(file)["added_tokens"]}
        table = [b""] * self._a.get_vocab_size()
        for text, number in self._a.get_vocab().items():
            table[number] = text.encode() if number in special else bytes(letters[c] for c in text)
        self.a = _Tokens(table)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b = _Tokens([self._piece_bytes(p) for p in pieces])
        # Units are only independent if no piece goes on after a space.
        self.cuts = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self._known: dict[str, tuple] = {}

    @staticmethod
    def _piece_bytes(piece: str) -> bytes:
        byte = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(_MARK, " ").encode()

    def units(self, text: str) -> list[str]:
        """Parts of a text that are tokenised alike on their own; a space is left out before each."""
        return _BETWEEN.split(text) if self.cuts else [text]

    def _spelled(self, unit: str, a: list[int], b: list[int]) -> bool:
        whole = (" " + unit).encode()
        return b"".join(self.a.bytes[i] for i in a) == whole == b"".join(self.b.bytes[i] for i in b)

    def align(self, units: list[str]) -> list[tuple]:
        """For each unit n_a, n_b, n_links, the text of its groups, and its linked pairs as bytes; None if not spelled."""
        known = self._known
        missing = [u for u in units if u not in known]
        fresh: dict[str, tuple | None] = {}
        for start in range(0, len(missing), _TOGETHER):
            some = missing[start : start + _TOGETHER]
            fresh.update(zip(some, self._align(some), strict=True))
        found = [fresh[u] if u in fresh else known[u] for u in units]
        if len(known) > _REMEMBERED:
            known.clear()
        known.update((u, x) for u, x in fresh.items() if len(u) <= 24)
        return found

    def _align(self, units: list[str]) -> list[tuple | None]:
        a = [x.ids for x in self._a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        b = self._b.encode(units, num_threads=1)
        whole = b"".join((" " + u).encode() for u in units)
        names_a, names_b = self.a.bytes, self.b.bytes
        if b"".join(names_a[i] for x in a for i in x) != whole or b"".join(names_b[i] for x in b for i in x) != whole:
            good = [self._spelled(u, x, y) for u, x, y in zip(units, a, b, strict=True)]
            kept = [i for i, x in enumerate(good) if x]
            made = iter(self._groups([a[i] for i in kept], [b[i] for i in kept]))
            return [next(made) if x else None for x in good]
        return self._groups(a, b)

    def _groups(self, a: list[list[int]], b: list[list[int]]) -> list[tuple]:
        """Units that both vocabularies spell, aligned all together: their bytes stand one after the other."""
        if not a:
            return []
        count_a, count_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.a.sizes[flat_a]), np.cumsum(self.b.sizes[flat_b])
        met = np.searchsorted(ends_b, ends_a)
        linked = ends_b[np.minimum(met, len(ends_b) - 1)] == ends_a
        at_a = np.flatnonzero(linked)
        at_b = met[linked]
        pairs = (flat_a[at_a] << 32 | flat_b[at_b]).tobytes()
        # Names of ids with what follows them, in the order A's of a group, then B's.
        last_a, last_b = np.zeros(len(flat_a), bool), np.zeros(len(flat_b), bool)
        last_a[at_a], last_b[at_b] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.concatenate([[0], at_b + 1])[group_a]
        upto_a = (at_a + 1)[group_b]
        names = np.empty(len(flat_a) + len(flat_b), object)
        a_named, b_named = self.a.named, self.b.named
        names[np.arange(len(flat_a)) + before_b] = np.where(last_a, a_named["|"][flat_a], a_named[","][flat_a])
        names[np.arange(len(flat_b)) + upto_a] = np.where(last_b, b_named[";"][flat_b], b_named[","][flat_b])
        names = names.tolist()
        unit_ends = np.cumsum(count_a)
        links = np.diff(np.searchsorted(at_a, np.concatenate([[0], unit_ends])))
        out, start, first = [], 0, 0
        for n_a, n_b, n_links in zip(count_a.tolist(), count_b.tolist(), links.tolist(), strict=True):
            stop = start + n_a + n_b
            out.append((n_a, n_b, n_links, "".join(names[start:stop]), pairs[8 * first : 8 * (first + n_links)]))
            start, first = stop, first + n_links
        return out

    def groups(self, text: str | None) -> str:
        """The groups of a text as ids, ``a,a|b;a|b,b``; empty if it has no tokens."""
        found = self.align(self.units(text)) if text else [None]
        return "" if any(x is None for x in found) else "".join(x[3] for x in found)[:-1]


@lru_cache(maxsize=2)
def aligner(byte_file: str, piece_file: str) -> Aligner:
    """The aligner of two files, read once by a worker."""
    return Aligner(byte_file, piece_file)


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, bytes of the same weight together, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(packed[8:], 4 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


_TEXT = "mark binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, units long"
_BLOCK = (
    f"block long, texts array<struct<{_TEXT.replace(' ', ':').replace(',:', ',')}>>, "
    "pairs array<struct<pair:long,n:long>>, unit_links binary, links binary, codes binary"
)


class _Numbers(dict):
    """Units numbered as they are first met."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


def _block(number: int, texts: list[tuple[bytes, str, int]], work: Aligner) -> dict:
    """What is kept of a block of (mark, text, copies)."""
    codes_of = _Numbers()
    coded = [np.array([codes_of[u] for u in work.units(text)], np.int32) for _, text, _ in texts]
    found = work.align(list(codes_of))
    spelled = np.array([x is not None for x in found])
    sizes = np.array([x[:3] if x else (0, 0, 0) for x in found], np.int64).reshape(-1, 3)
    rows, kept, times = [], [], np.zeros(len(found), np.int64)
    for (mark, _, copies), codes in zip(texts, coded, strict=True):
        if spelled[codes].all():
            n_a, n_b, n_links = sizes[codes].sum(0).tolist()
            text = "".join([found[c][3] for c in codes.tolist()])[:-1]
            np.add.at(times, codes, copies)
            kept.append(codes)
            rows.append((mark, n_a, n_b, n_links, n_links, hashlib.sha256(text.encode()).hexdigest(), len(codes)))
        else:
            rows.append((mark, 0, 0, 0, 0, "", 0))
    pairs = np.frombuffer(b"".join([x[4] for x in found if x]), np.int64)
    of = np.repeat(np.arange(len(found)), sizes[:, 2])
    different, links = np.unique(pairs, return_inverse=True)
    counts = np.zeros(len(different), np.int64)
    np.add.at(counts, links, times[of])
    names = [x.split(" ")[0] for x in _TEXT.split(", ")]
    return {
        "block": number,
        "texts": [dict(zip(names, row, strict=True)) for row in rows],
        "pairs": (different, counts),
        "unit_links": _pack(sizes[:, 2]),
        "links": _pack(links),
        "codes": _pack(np.concatenate([np.zeros(0, np.int64), *kept])),
    }


def _as_batch(row: dict) -> pa.RecordBatch:
    pairs, counts = row["pairs"]
    listed = pa.ListArray.from_arrays(
        pa.array([0, len(pairs)], pa.int32()),
        pa.StructArray.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"]),
    )
    kind = pa.struct([(x.split(" ")[0], {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[x.split(" ")[1]]) for x in _TEXT.split(", ")])
    return pa.RecordBatch.from_arrays(
        [pa.array([row["block"]], pa.int64()), pa.array([row["texts"]], pa.list_(kind)), listed]
        + [pa.array([row[c]], pa.binary()) for c in ("unit_links", "links", "codes")],
        ["block", "texts", "pairs", "unit_links", "links", "codes"],
    )


def _mark(text) -> F.Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def align_corpus(docs: DataFrame, byte_file: str, piece_file: str, target: str, block_bytes: int = _BLOCK_BYTES) -> None:
    """Aligns each different text of ``docs`` once and writes the blocks to the folder ``target``."""
    texts = docs.select(docs["text"]).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.select(_mark(F.col("text")).alias("mark"), "text", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(byte_file, piece_file)
        number = TaskContext.get().partitionId() << 32
        waiting, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                waiting.append((batch.column("mark")[i].as_py(), text, batch.column("copies")[i].as_py()))
                size += len(text)
                if size >= block_bytes:
                    yield _as_batch(_block(number, waiting, work))
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield _as_batch(_block(number, waiting, work))

    texts.mapInArrow(tidy(run), _BLOCK).write.parquet(target)


def _blocks(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(target)


def pair_counts(spark: SparkSession, target: str) -> DataFrame:
    """a_id, b_id, count (links in the corpus, copies included) and best (no A id is linked with b_id more often)."""
    linked = _blocks(spark, target).select(F.inline("pairs"))
    totals = linked.groupBy("pair").agg(F.sum("n").alias("count"))
    totals = totals.select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id"), "count")
    totals = cut_lineage(totals)
    # At most as many rows as the vocabulary has ids.
    most = totals.groupBy("b_id").agg(F.max("count").alias("most"))
    joined = totals.join(F.broadcast(most.withColumnRenamed("b_id", "of")), F.col("b_id") == F.col("of"))
    return joined.select("a_id", "b_id", "count", (F.col("count") == F.col("most")).alias("best"))


def text_measures(spark: SparkSession, target: str) -> DataFrame:
    """The measures of each different text, by its SHA-256 (``mark``)."""
    blocks = _blocks(spark, target)
    counted = pair_counts(spark, target).select(F.shiftleft("a_id", 32).bitwiseOR(F.col("b_id")).alias("of"), "count", "best")
    wanted = blocks.select("block", F.posexplode("pairs").alias("at", "linked")).select("block", "at", F.col("linked.pair").alias("pair"))
    sums = wanted.join(counted, wanted["pair"] == counted["of"]).groupBy("block")
    # As many entries as the block itself has pairs.
    sums = sums.agg(F.collect_list(F.struct("at", "count", "best")).alias("sums"))
    given = blocks.drop("pairs").join(sums.withColumnRenamed("block", "for"), F.col("block") == F.col("for"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts = batch.column("texts")[i].values
                linked = batch.column("sums")[i].values
                n = 0 if linked is None else len(linked)
                count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
                if n:
                    at = linked.field("at").to_numpy()
                    count[at] = linked.field("count").to_numpy()
                    best[at] = linked.field("best").to_numpy(zero_copy_only=False)
                of_unit, links, codes = (_unpack(batch.column(c)[i].as_py()).astype(np.int64) for c in ("unit_links", "links", "codes"))
                # Running sums over links, over units, and over the units of texts.
                ends = np.cumsum(of_unit)
                units = texts.field("units").to_numpy()
                stops = np.cumsum(units)
                measures = []
                for values in (best, count):
                    along = np.concatenate([[0], np.cumsum(values[links])])
                    unit = along[ends] - along[ends - of_unit]
                    along = np.concatenate([[0], np.cumsum(unit[codes])])
                    measures.append(pa.array(along[stops] - along[stops - units]))
                names = ["mark", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
                yield pa.RecordBatch.from_arrays([texts.field(c) for c in names] + measures, [*names, "n_best", "count_sum"])

    schema = "mark binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    given = given.select("texts", "unit_links", "links", "codes", "sums")
    return given.mapInArrow(tidy(run), schema)


def document_measures(docs: DataFrame, target: str) -> DataFrame:
    """The measures of each document of ``docs``, which were aligned to ``target``."""
    marked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.when(docs["text"] != "", _mark(docs["text"])).alias("mark"))
    measures = cut_lineage(text_measures(docs.sparkSession, target))
    joined = lookup_join(cut_lineage(marked), measures, {"mark": "mark"})
    zeros = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return joined.select("doc_id", *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def aligned_groups(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """doc_id and the groups of each document's text as ids (``a,a|b;a|b,b``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(byte_file, piece_file)
        for batch in batches:
            made = [work.groups(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], ["doc_id", "groups"])

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return chosen.mapInArrow(tidy(run), "doc_id long, groups string")

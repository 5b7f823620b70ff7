"""Near-duplicate documents with DartMinHash.

A document is the set of its shingles of five words. Every shingle throws darts: a Poisson
process of hashed ranks over the region [0, weight) x [0, rank bound), here with weight 1 for
each different shingle. A dart falls on one of ``coordinates`` places; the earliest dart of
each place is the signature, so that two documents agree on a place with the probability of
their weighted Jaccard similarity. The rank bound follows from the total weight: a document
throws about as many darts as it needs, however long it is.

1. Rows with the same words are one node.
2. Signatures are cut into bands. Nodes that agree on a band are linked to the smallest of
   them, and the components of these links are the groups in which links can be.
3. Within a group the similarity of shingle sets is computed exactly for all pairs that the
   signatures don't rule out and that aren't connected yet, most similar first. A large group
   is cut into blocks, and every pair of blocks is looked at by a task of its own: no link is
   lost, and no task holds more than two blocks.
4. The components of the verified links are the classes.

Defined results: words are cut at white space and compared without the case of A to Z; a
text of fewer than five words is one shingle; documents without words (null, empty) are in
no group, and each stays; a class is named by its smallest doc_id, null last; repeated rows
are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.memory import tidy
from strata.plans.sizing import within
from strata.session import cut_lineage, working_folder

_HAS_WORD = r"[^\x20\x09-\x0D]"
_BLOCK_WORDS = 2_000_000
_GOLDEN = 0x9E3779B97F4A7C15
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(number: int) -> np.uint64:
    return np.uint64(number * _GOLDEN % (1 << 64))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, and how many words each has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten()
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    coded = words.filter(pa.array(some)).dictionary_encode()
    names = np.array(coded.dictionary.to_pylist(), object)
    hashes = _mix(pd.util.hash_array(names, categorize=False)) if len(names) else np.zeros(0, np.uint64)
    return hashes[coded.indices.to_numpy()] if len(names) else hashes, np.bincount(of[some], minlength=len(texts))


def shingles(words: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``width`` words, and the text it is from; a shorter text is one run."""
    ends = np.cumsum(counts)
    starts = ends - counts
    place = np.arange(len(words)) - np.repeat(starts, counts)
    left = np.repeat(counts, counts) - place  # words from here to the end of the text
    total = np.zeros(len(words), np.uint64)
    for k in range(width):
        shifted = np.zeros(len(words), np.uint64)
        shifted[: len(words) - k] = words[k:]
        total += np.where(left > k, _mix(shifted + _salt(k + 1)), np.uint64(0))
    chosen = (left >= width) | (place == 0)
    return _mix(total[chosen]), np.repeat(np.arange(len(counts)), counts)[chosen]


def dart_signatures(
    elements: np.ndarray, weights: np.ndarray, of: np.ndarray, sets: int, coordinates: int
) -> np.ndarray:
    """The earliest dart on each coordinate, for ``sets`` weighted sets, as 32 bits of its hash.

    Element i of set ``of[i]`` has weight ``weights[i]``. An element that stands twice in a set
    with the same weight counts once. Sets without elements get zeros.
    """
    earliest = np.full((sets, coordinates), _NEVER)
    total = np.bincount(of, weights=weights, minlength=sets)
    todo = np.flatnonzero(total > 0)
    darts = coordinates * math.log(max(2, coordinates)) + 2 * coordinates
    # Unit layers of the weights: darts of a layer are the same whatever the weight.
    layers = np.ceil(weights).astype(np.int64)
    element = np.repeat(np.arange(len(elements)), layers)
    layer = np.arange(len(element)) - np.repeat(np.cumsum(layers) - layers, layers)
    cells = _mix(elements[element] + layer.astype(np.uint64) * np.uint64(_GOLDEN)) if layers.max(initial=1) > 1 else _mix(elements)
    while len(todo):
        bound = np.zeros(sets)
        bound[todo] = darts / total[todo]
        active = np.flatnonzero(bound[of[element]] > 0)
        rank, number = np.zeros(len(active)), 0
        while len(active):
            number += 1
            thrown = _mix(cells[active] + _salt(number))
            # The gap to the next dart of a cell is exponential.
            rank = rank - np.log(((thrown >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            inside = rank < bound[of[element[active]]]
            active, rank, thrown = active[inside], rank[inside], thrown[inside]
            where = _mix(thrown + _salt(7))
            height = layer[active] + ((where >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32
            hit = height < weights[element[active]]
            at = ((where & np.uint64(0xFFFFFFFF)) * np.uint64(coordinates) >> np.uint64(32)).astype(np.int64)
            # Positive floats have the order of their bits.
            value = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | _mix(thrown) >> np.uint64(32)
            np.minimum.at(earliest.ravel(), (of[element[active]] * coordinates + at)[hit], value[hit])
        todo = todo[(earliest[todo] == _NEVER).any(1)]
        darts *= 2  # a few sets left a coordinate without a dart
    earliest[total <= 0] = 0
    return (earliest & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each band of ``rows`` coordinates."""
    bands = signatures.shape[1] // rows
    keys = np.zeros((len(signatures), bands), np.uint64)
    for k in range(rows):
        keys = _mix(keys + signatures[:, k : bands * rows : rows].astype(np.uint64) + np.uint64(1))
    return _mix(keys + np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(_GOLDEN))


def _pieces(texts: pa.Array, most: int = 512 << 10):
    """Neighbouring texts of about ``most`` bytes together."""
    total, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + most)))
        yield start, stop
        start = stop


def _worded(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text) of the documents that have words; mark is a hash of the text."""
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("mark"), docs["text"])
    return chosen.where(F.col("text").rlike(_HAS_WORD))


def signed(docs: DataFrame, coordinates: int, width: int) -> DataFrame:
    """doc_id, mark, node (a hash of the words in their order), words and signature of each document with words."""

    def sign(batches):
        for batch in batches:
            for start, stop in _pieces(batch.column("text")):
                part = batch.slice(start, stop - start)
                words, counts = word_hashes(part.column("text"))
                place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
                ordered = _mix(words + place.astype(np.uint64) * np.uint64(_GOLDEN))
                node = _mix(np.add.reduceat(ordered, np.cumsum(counts) - counts) + counts.astype(np.uint64))
                found, of = shingles(words, counts, width)
                made = dart_signatures(found, np.ones(len(found)), of, len(counts), coordinates)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("mark"),
                        pa.array(node.view(np.int64)),
                        pa.array(counts.astype(np.int64)),
                        pa.array([row.tobytes() for row in made], pa.binary()),
                    ],
                    ["doc_id", "mark", "node", "words", "signature"],
                )

    return _worded(docs).mapInArrow(tidy(sign), "doc_id long, mark long, node long, words long, signature binary")


def _band_links(nodes: DataFrame, coordinates: int, rows: int) -> DataFrame:
    """Each node with the smallest node of every band that others share with it."""

    def cut(batches):
        for batch in batches:
            rows_ = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, coordinates)
            keys = band_keys(rows_, rows).view(np.int64)
            node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], ["band", "node"])

    bands = nodes.select("node", "signature").mapInArrow(tidy(cut), "band long, node long")
    first = bands.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    shared = first.where("hub < last").select(F.col("band").alias("shared"), "hub")
    linked = bands.join(shared, bands["band"] == shared["shared"]).where("node <> hub")
    return linked.select(F.col("node").alias("a"), F.col("hub").alias("b"))


def _similar(one: np.ndarray, other: np.ndarray, least: float) -> bool:
    """Do two sorted sets have at least this Jaccard similarity?"""
    small, large = sorted((len(one), len(other)))
    if small < least * large:
        return False
    both = np.concatenate([one, other])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common >= least * (small + large - common)


def link_group(
    nodes: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray], side: np.ndarray, least: float, margin: float
) -> list[tuple[int, int]]:
    """Links of similar nodes that span the components of all of them.

    ``side`` is -1 for a group that is whole, else the block of each node: then only pairs of
    different blocks are looked at. A pair is compared unless its signatures agree on less than
    ``least - margin`` of their coordinates, or the pair is connected already.
    """
    n, size = len(nodes), signatures.shape[1]
    label, links = np.arange(n), []
    agree = np.zeros((n, n), np.uint16)
    for i in range(n - 1):
        agree[i, i + 1 :] = (signatures[i] == signatures[i + 1 :]).sum(1)
        if side[i] >= 0:
            agree[i, i + 1 :][side[i + 1 :] == side[i]] = 0
    floor = least - margin
    steps = [1.01, *(x for x in (0.95, 0.9, least, (least + floor) / 2) if x > floor), floor]
    for high, low in zip(steps, steps[1:], strict=False):
        for i in range(n - 1):
            row = agree[i, i + 1 :]
            for j in np.flatnonzero((row >= low * size) & (row < high * size)) + i + 1:
                if label[i] != label[j] and _similar(sets[i], sets[j], least):
                    label[label == label[j]] = label[i]
                    links.append((int(nodes[j]), int(nodes[i])))
    return links


def _verified(
    docs: DataFrame, nodes: DataFrame, groups: DataFrame, width: int, coordinates: int, least: float, margin: float, block: int
) -> DataFrame:
    """Links (a, b) between nodes of the same group whose shingle sets are similar enough."""
    # A block holds so many nodes, and so many words of them, at most about.
    counted = groups.join(nodes.select("node", "words"), "node").groupBy("root")
    most = F.greatest(F.count(F.lit(1)) / block, F.sum("words") / _BLOCK_WORDS)
    sizes = counted.agg(F.ceil(most).cast("int").alias("blocks"))
    wanted = groups.join(sizes, "root").join(nodes, "node").select(
        "node", "root", "blocks", "signature", F.col("at.doc_id").alias("at_doc"), F.col("at.mark").alias("at_mark")
    )
    wanted = cut_lineage(wanted)
    if within(wanted):
        wanted = F.broadcast(wanted)
    texts = _worded(docs)
    same = texts["doc_id"].eqNullSafe(wanted["at_doc"]) & (texts["mark"] == wanted["at_mark"])
    texts = texts.join(wanted, same).select("node", "root", "blocks", "signature", "text")

    def cut(batches):
        for batch in batches:
            for start, stop in _pieces(batch.column("text")):
                part = batch.slice(start, stop - start)
                found, of = shingles(*word_hashes(part.column("text")), width)
                borders = np.searchsorted(of, np.arange(stop - start + 1))
                sets = [np.unique(found[a:b]).tobytes() for a, b in zip(borders, borders[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("node", "root", "blocks", "signature")] + [pa.array(sets, pa.binary())],
                    ["node", "root", "blocks", "signature", "shingles"],
                )

    cut_up = texts.mapInArrow(tidy(cut), "node long, root long, blocks int, signature binary, shingles binary")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    sent = cut_up.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select(
        "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "signature", "shingles"
    )
    key = ["root", "i", "j"]

    def link(rows: list[dict]) -> list[tuple[int, int]]:
        rows = list({row["node"]: row for row in rows}.values())  # repeated rows of the table
        if len(rows) < 2:
            return []
        across = rows[0]["i"] != rows[0]["j"]
        return link_group(
            np.array([row["node"] for row in rows]),
            np.frombuffer(b"".join(row["signature"] for row in rows), np.uint32).reshape(-1, coordinates),
            [np.frombuffer(row["shingles"], np.uint64) for row in rows],
            np.array([row["own"] if across else -1 for row in rows]),
            least,
            margin,
        )

    def run(batches):
        group, rows = None, []
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                at = (row["root"], row["i"], row["j"])
                if at != group:
                    found += link(rows)
                    group, rows = at, []
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])
        found = link(rows)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    ordered = sent.repartition(*key).sortWithinPartitions(*key, "node")
    return ordered.mapInArrow(tidy(run), "a long, b long")


def _classes(
    docs: DataFrame, least: float, width: int, coordinates: int, band_rows: int, margin: float, block: int
) -> tuple[DataFrame, DataFrame]:
    """All documents with words (doc_id, mark, node), and the class of each node with its first document."""
    spark = docs.sparkSession
    folder = working_folder(spark, "dedup")

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    rows = saved(signed(docs, coordinates, width), "rows")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    nodes = saved(rows.groupBy("node").agg(F.min(at).alias("at"), F.first("words").alias("words"), F.first("signature").alias("signature")), "nodes")
    groups = components(_band_links(nodes, coordinates, band_rows))
    # A root stands for itself in its group.
    groups = cut_lineage(groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct()))
    links = _verified(docs, nodes, groups, width, coordinates, least, margin, block)
    roots = components(links)
    classed = nodes.select("node", "at").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = classed.groupBy("root").agg(F.min("at").alias("first"))
    return rows.select("doc_id", "mark", "node"), classed.select("node", "root").join(first, "root")


def near_duplicates(
    docs: DataFrame,
    least: float = 0.8,
    width: int = 5,
    coordinates: int = 125,
    band_rows: int = 5,
    margin: float = 0.18,
    block: int = 2_048,
) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of the documents linked with it, one row per document.

    Documents are linked if their sets of shingles of ``width`` words have Jaccard similarity
    ``least`` or more. A pair at 0.8 agrees on one of 25 bands of five with probability
    0.99995, and lies within ``margin`` (five standard errors) of its estimate.
    """
    rows, classes = _classes(docs, least, width, coordinates, band_rows, margin, block)
    found = rows.join(classes, "node").select("doc_id", F.col("first.doc_id").alias("class_id"))
    alone = docs.where(~F.coalesce(docs["text"].rlike(_HAS_WORD), F.lit(False)))
    alone = alone.select(alone["doc_id"].cast("long").alias("doc_id"))
    return found.unionByName(alone.select("doc_id", F.col("doc_id").alias("class_id")))


def drop_near_duplicates(
    docs: DataFrame,
    least: float = 0.8,
    width: int = 5,
    coordinates: int = 125,
    band_rows: int = 5,
    margin: float = 0.18,
    block: int = 2_048,
) -> DataFrame:
    """The first row of each class, with all columns; documents without words stay."""
    rows, classes = _classes(docs, least, width, coordinates, band_rows, margin, block)
    kept = cut_lineage(classes.select("root", "first.doc_id", "first.mark").distinct().select("doc_id", "mark"))
    known = rows.join(kept, rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["mark"] == kept["mark"]))
    repeated = known.count() > kept.count()
    if within(kept):
        kept = F.broadcast(kept)
    has_word = F.coalesce(docs["text"].rlike(_HAS_WORD), F.lit(False))
    mark = F.xxhash64(docs["text"])
    columns = [docs[f"`{name.replace('`', '``')}`"] for name in docs.columns]
    packed = docs.where(has_word).select(docs["doc_id"].cast("long").alias("at"), mark.alias("of"), F.struct(*columns).alias("row"))
    chosen = packed.join(kept, packed["at"].eqNullSafe(kept["doc_id"]) & (packed["of"] == kept["mark"]), "left_semi")
    if repeated:  # rows that repeat a doc_id with its text: the first by the other columns
        order = Window.partitionBy("at", "of").orderBy(F.to_json("row"))
        chosen = chosen.withColumn("turn", F.row_number().over(order)).where("turn = 1")
    return chosen.select("row.*").unionByName(docs.where(~has_word))

"""Repair of conversations: the cheapest edits that make roles alternate.

A repaired conversation is empty, or a system turn that may be missing and then pairs of user
and assistant. Its rows are the layers of a lattice whose nodes are the four states of that
pattern (start, after system, after user, after assistant); keeping, changing the role,
deleting and inserting are its arcs, with whole numbers as costs. A row that is blank or a
duplicate has to go, and a truncated one costs extra if it stays.

Shortest paths come from the auction algorithm (:class:`Lattice`). Every node has a price. From
an origin a path is extended by the arc with the least cost plus price while the price of its
end equals that sum; else the price rises to the sum and the path is contracted by a node. When
the path meets the end, prices of its nodes are distances to the end, and an arc is tight if its
cost is the difference of its prices. Layers are taken in blocks from the end, whose prices are
settled before, so that the work grows with the rows. The edits are traced along tight arcs, the
letter that is first in ASCII first; what a tight arc leads to is settled before it is taken.

Rows are sorted over all tasks by conversation and turn, so a task holds whole conversations,
but for those at its borders and those longer than a segment. These are cut into segments: each
gives the least cost from any state to any other, their sums from the end give each segment the
prices of its end, and each segment traces its part from all four states, of which the one that
the part before leads to is taken. No task holds a long conversation, but for its audit, which
is one cell of the result, and its text runs through a hash piece by piece.

Defined results: a null role or text is one space. Rows of the same turn stand in the order of
role, of the first 64 letters of the text, and of a hash; equal rows are adjacent, the first one
may stay and the others are duplicates. A role is known by its first letter (s, u, a); any other
role, also the empty one, cannot be kept. An empty table gives an empty result; other columns
are not looked at. Texts can have any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.memory import tidy
from strata.plans.skew import lookup_join
from strata.session import working_folder

START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # the state after the one of user and assistant that fits
_KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_INITIALS = {"s": 0, "u": 1, "a": 2}
_LEGAL = {"su", "ua", "au"}
DELETE, CHANGE, INSERT, TRUNCATED = 4, 3, 3, 3
#: What is still to be inserted in each state after the last row.
AT_END = (0, 2 * INSERT, INSERT, 0)
_GONE = 8  # code of rows that have to go; others: initial (3: none), and 4 more if truncated
_BLOCK = 16
_SEGMENT_LETTERS = 4 << 20
_NO_WAY = 1 << 60


def _arcs(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, layers forward, state) from a state before a row, in the order of letters."""
    initial, extra = code % 4, TRUNCATED if code >= 4 else 0
    arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, _NEXT[state])]
    if code == _GONE:
        return arcs
    if (state, initial) in _KEPT:
        arcs.append(("K", extra, 1, _KEPT[state, initial]))
    return [*arcs, ("R", CHANGE + extra, 1, _NEXT[state])]


_ARCS = [[_arcs(code, state) for state in range(4)] for code in range(_GONE + 1)]


class Lattice:
    """The layers of a run of rows: a code for each, and how often it stands there (only rows that go repeat)."""

    def __init__(self, codes: Sequence[int], times: Sequence[int], end: Sequence[int] = AT_END):
        self._codes, self._times, self._n = codes, times, len(codes)
        self.prices = [0] * (4 * self._n) + list(end)
        self._settled = bytearray(4 * self._n) + b"\1\1\1\1"
        for stop in range(self._n, 0, -_BLOCK):
            start = max(0, stop - _BLOCK)
            # No way from the block's layers is cheaper than the cheapest end.
            self.prices[4 * start : 4 * stop] = [min(self.prices[4 * stop : 4 * stop + 4])] * (4 * (stop - start))
            for state in range(4):
                self.settle(4 * start + state)

    def arcs(self, node: int) -> Iterator[tuple[str, int, int]]:
        """(letter, cost, node) of the arcs that leave ``node``."""
        at, state = divmod(node, 4)
        code, times = self._codes[at], self._times[at]
        for letter, cost, forward, to in _ARCS[code][state]:
            yield letter, cost * times if code == _GONE and forward else cost, 4 * (at + forward) + to

    def settle(self, origin: int) -> None:
        """Raise prices by auction until that of ``origin`` is its distance to the end."""
        prices, settled, path = self.prices, self._settled, [origin]
        while not settled[path[-1]]:
            node, least, to = path[-1], _NO_WAY, -1
            for _, cost, other in self.arcs(node):
                if cost + prices[other] < least:
                    least, to = cost + prices[other], other
            if prices[node] < least:
                prices[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        for node in path:
            settled[node] = 1

    def trace(self, state: int) -> tuple[str, int]:
        """The cheapest edits from ``state`` before the first row, least in ASCII, and the state they end in."""
        node, letters = state, []
        while node < 4 * self._n:
            for letter, cost, other in self.arcs(node):
                if cost + self.prices[other] == self.prices[node]:
                    self.settle(other)
                    if cost + self.prices[other] == self.prices[node]:
                        break
            at = node // 4
            letters.append(letter * self._times[at] if other // 4 > at else letter)
            node = other
        return "".join(letters), node % 4


def crossing_costs(codes: Sequence[int], times: Sequence[int]) -> list[list[int]]:
    """The least cost from each state before the rows to each state after them."""
    total = DELETE * sum(times)
    to_user = Lattice(codes, times, (INSERT, INSERT, 0, INSERT)).prices[:4]
    to_assistant = Lattice(codes, times, (2 * INSERT, 2 * INSERT, INSERT, 0)).prices[:4]
    # Only deletions lead to the start, and one kept row of a system after the start.
    system = total - DELETE if 0 in codes else total - DELETE + TRUNCATED if 4 in codes else _NO_WAY
    return [
        [total if state == START else _NO_WAY, total if state == SYSTEM else system if state == START else _NO_WAY, to_user[state], to_assistant[state]]
        for state in range(4)
    ]


@dataclass
class Segment:
    """Neighbouring rows of a conversation, as layers and with what is needed to write them again."""

    codes: list[int] = field(default_factory=list)
    times: list[int] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    first: str | None = None
    last: str | None = None
    illegal: int = 0
    letters: int = 0

    def add(self, role: str, text: str, fault: str, copies: int) -> None:
        """A row that stands ``copies`` times; ``fault`` is that of its first one."""
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.illegal += copies - 1  # a role next to itself
        self.last = initial
        if fault in ("", "truncated"):
            self._layer(_INITIALS.get(initial, 3) + (4 if fault else 0), 1, role, text)
            copies -= 1
        if copies:
            self._layer(_GONE, copies, "", "")

    def _layer(self, code: int, times: int, role: str, text: str) -> None:
        self.codes.append(code)
        self.times.append(times)
        self.roles.append(role)
        self.texts.append(text)
        self.letters += len(text)


def apply_edits(edits: str, state: int, codes: Sequence[int], times: Sequence[int], roles: Sequence[str], texts: Sequence[str]) -> list[tuple[str, str]]:
    """(role, text) of the rows that ``edits`` leave, from the state before them."""
    out, at, place = [], 0, 0
    while place < len(edits):
        letter = edits[place]
        if letter == "I":
            state = _NEXT[state]
            out.append((_NAMES[state], ""))
        elif letter == "K":
            state = _KEPT[state, codes[at] % 4]
            out.append((roles[at], texts[at]))
        elif letter == "R":
            state = _NEXT[state]
            out.append((_NAMES[state], texts[at]))
        if letter != "I":
            place += times[at] - 1  # a layer's deletions stand together
            at += 1
        place += 1
    return out


def _lines(rows: list[tuple[str, str]]) -> str | None:
    return "\n".join(f"{role}:{text}" for role, text in rows) if rows else None


_SAID = ["conv_id", "turn", "role", "text"]
_VISIBLE = r"[^\x20\x09-\x0D]"
_ENDS_WELL = r"[.!?][\x20\x09-\x0D]*\z"


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (how often the row stands there) after planted damage.

    By crc32 of ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row, 1 empties its
    text, 2 removes ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    chosen = conversations.select(*[conversations[name].alias(name) for name in _SAID])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    chosen = chosen.withColumn("way", F.crc32(name.cast("binary")) % 20).where("way <> 0")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return chosen.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("way") == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.when(F.col("way") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def with_faults(rows: DataFrame, folder: str) -> DataFrame:
    """Equal rows made one, with ``fault`` ('', blank, duplicate, truncated) of the first of its copies."""
    spark = rows.sparkSession
    said = F.unhex(F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256))
    whole = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "copies")
    whole = whole.groupBy(*_SAID).agg(F.sum("copies").alias("copies")).withColumn("said", said)
    whole.write.parquet(f"{folder}/rows")
    whole = spark.read.schema(whole.schema).parquet(f"{folder}/rows")
    visible = F.col("text").rlike(_VISIBLE)
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = whole.where(visible).groupBy("said").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("n"))
    again.where("n > 1").select("said", "first").write.parquet(f"{folder}/again")
    again = spark.read.parquet(f"{folder}/again").withColumnRenamed("said", "of")
    joined = lookup_join(whole, again, {"said": "of"})
    fault = (
        F.when(~visible, "blank")
        .when(F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn")), "duplicate")
        .when(~F.col("text").rlike(_ENDS_WELL), "truncated")
        .otherwise("")
    )
    return joined.select(*_SAID, "copies", "said", fault.alias("fault"))


def _counts(rows: DataFrame) -> DataFrame:
    """gaps and faults of each conversation, added up for each turn first."""
    fault, copies = F.col("fault"), F.col("copies")
    # The other copies of a row without a fault, or of a truncated one, are duplicates.
    own = {
        "blank": F.sum(F.when(fault == "blank", copies).otherwise(0)),
        "duplicate": F.sum(F.when(fault == "duplicate", copies).when(fault == "blank", 0).otherwise(copies - 1)),
        "truncated": F.sum(F.when(fault == "truncated", 1).otherwise(0)),
    }
    turns = rows.groupBy("conv_id", "turn").agg(*[value.alias(name) for name, value in own.items()])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    return turns.groupBy("conv_id").agg(gaps.cast("long").alias("gaps"), *[F.sum(name).cast("long").alias(name) for name in own])


_PIECE = (
    "conv_id {0}, part long, open boolean, codes binary, times array<long>, roles array<string>, texts array<string>, "
    "costs array<long>, first string, last string, illegal long, cost long, audit string, repaired string, sha string"
)


def _pieces(rows: DataFrame, keep_texts: bool, most: int) -> DataFrame:
    """Whole conversations with their repair, and the segments of those that may go on elsewhere (``open``).

    A segment has ``most`` layers, or letters beyond a bound.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.substring("text", 1, 64), F.asc("said")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        names, schema = [x.split(" ")[0] for x in _PIECE.split(", ")], None
        nothing = dict.fromkeys(names)

        def segment(conv, piece: Segment, is_open: bool) -> dict:
            nonlocal part
            part += 1
            row = nothing | {"conv_id": conv, "part": part, "open": is_open, "illegal": piece.illegal, "first": piece.first, "last": piece.last}
            if is_open:
                costs = [x for line in crossing_costs(piece.codes, piece.times) for x in line]
                return row | {"codes": bytes(piece.codes), "times": piece.times, "roles": piece.roles, "texts": piece.texts, "costs": costs}
            lattice = Lattice(piece.codes, piece.times)
            edits, state = lattice.trace(START)
            edits += "I" * (AT_END[state] // INSERT)
            text = _lines(apply_edits(edits, START, piece.codes, piece.times, piece.roles, piece.texts))
            sha = hashlib.sha256((text or "").encode()).hexdigest()
            return row | {"cost": lattice.prices[START], "audit": edits, "sha": sha, "repaired": text if keep_texts else None}

        def batch_of(found: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(found, schema)

        conv, piece, at_border, began, found, size = None, None, True, False, [], 0
        for batch in batches:
            if schema is None:
                types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
                types |= {"array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
                schema = pa.schema([(n, types.get(x.split(" ")[1])) for n, x in zip(names[1:], _PIECE.split(", ")[1:], strict=True)])
                schema = schema.insert(0, pa.field("conv_id", batch.schema.field("conv_id").type))
            for conv_id, role, text, fault, copies in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "fault", "copies")], strict=True):
                if piece is None or conv_id != conv:
                    if piece is not None:
                        found.append(segment(conv, piece, at_border))
                        size += piece.letters
                        at_border = False
                    conv, piece = conv_id, Segment()
                elif len(piece.codes) >= most or piece.letters >= _SEGMENT_LETTERS:
                    found.append(segment(conv, piece, True))
                    size += piece.letters
                    piece, at_border = Segment(), True
                piece.add(role, text, fault, copies)
                if size > _SEGMENT_LETTERS or len(found) > 2_000:
                    yield batch_of(found)
                    found, size = [], 0
        if piece is not None:
            found.append(segment(conv, piece, True))
        if found:
            yield batch_of(found)

    return ordered.select("conv_id", "role", "text", "fault", "copies").mapInArrow(tidy(run), _PIECE.format(kind))


def _end_prices(group: list[dict]) -> list[dict]:
    """The prices after each of a conversation's segments, and its cost."""
    prices, out = list(AT_END), []
    for row in reversed(group):
        out.append({"part": row["part"], "prices": prices, "cost": 0})
        costs = row["costs"]
        prices = [min(costs[4 * state + to] + prices[to] for to in range(4)) for state in range(4)]
    for row in out:
        row["cost"] = prices[START]
    return out


def _entries(group: list[dict]) -> list[dict]:
    """The state before each of a conversation's segments, and how many rows are inserted after it."""
    state, out = START, []
    for row in group:
        out.append({"part": row["part"], "state": state, "more": 0})
        state = row["after"][state]
    out[-1]["more"] = AT_END[state] // INSERT
    return out


def _by_conversation(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` of the rows of each conversation, in the order of their parts; few small rows for each."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: row["part"])
        kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
        fields = [x.split(" ") for x in schema.split(", ")]
        return pa.Table.from_pylist(function(rows), pa.schema([(name, kinds[kind]) for name, kind in fields]))

    return df.groupBy("conv_id").applyInArrow(run, schema)


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int64()), ("edits", pa.list_(pa.string())), ("after", pa.list_(pa.int64()))])
    for batch in batches:
        for row in batch.to_pylist():
            lattice = Lattice(row["codes"], row["times"], row["prices"])
            edits, after = zip(*[lattice.trace(state) for state in range(4)], strict=True)
            yield pa.RecordBatch.from_pylist([{"part": row["part"], "edits": list(edits), "after": list(after)}], schema)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [
            _lines(apply_edits(row["edits"], row["state"], row["codes"], row["times"], row["roles"], row["texts"]))
            for row in batch.select(["edits", "state", "codes", "times", "roles", "texts"]).to_pylist()
        ]
        kept = ["conv_id", "part", "first", "last", "illegal", "cost", "edits"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(made, pa.string())], [*kept, "repaired"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from their pieces, which come in order."""
    kind, now, found = None, None, []

    def end() -> None:
        now["audit"], now["sha"] = "".join(now["audit"]), now["sha"].hexdigest()
        found.append({name: now[name] for name in ("conv_id", "illegal", "cost", "audit", "sha")})

    for batch in batches:
        kind = kind or batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now["conv_id"]:
                if now:
                    end()
                now = {"conv_id": row["conv_id"], "cost": row["cost"], "illegal": 0, "audit": [], "sha": hashlib.sha256(), "last": None, "lines": False}
            now["illegal"] += row["illegal"] + (now["last"] is not None and now["last"] + row["first"] not in _LEGAL)
            now["last"] = row["last"]
            now["audit"].append(row["edits"])
            if row["repaired"] is not None:
                now["sha"].update((("\n" if now["lines"] else "") + row["repaired"]).encode())
                now["lines"] = True
    if now:
        end()
    if found:
        fields = [("conv_id", kind), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string())]
        yield pa.RecordBatch.from_pylist(found, pa.schema(fields))


@dataclass(frozen=True)
class Repair:
    """``report``: a row for each conversation with rows. ``texts``: conv_id, part, repaired (its lines), if asked for."""

    report: DataFrame
    texts: DataFrame | None


def repair_conversations(rows: DataFrame, keep_texts: bool = False, segment_rows: int = 16_384) -> Repair:
    """Repairs the conversations of ``rows`` (conv_id, turn, role, text, copies).

    The report has gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.
    """
    spark, folder = rows.sparkSession, working_folder(rows.sparkSession, "conversations")
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = with_faults(rows, folder)
    _pieces(found, keep_texts, segment_rows).write.parquet(f"{folder}/pieces")
    pieces = spark.read.schema(_PIECE.format(kind)).parquet(f"{folder}/pieces")
    whole = pieces.where("not open").select("conv_id", "illegal", "cost", "audit", "sha")
    cut = pieces.where("open")
    prices = _by_conversation(cut.select("conv_id", "part", "costs"), _end_prices, "part long, prices array<long>, cost long")
    prices.write.parquet(f"{folder}/prices")
    prices = spark.read.parquet(f"{folder}/prices")
    traced = cut.select("part", "codes", "times").join(prices.select("part", "prices"), "part").select("part", "codes", "times", "prices")
    traced.mapInArrow(tidy(_traced), "part long, edits array<string>, after array<long>").write.parquet(f"{folder}/traced")
    traced = spark.read.parquet(f"{folder}/traced")
    entries = _by_conversation(cut.select("conv_id", "part").join(traced.select("part", "after"), "part"), _entries, "part long, state long, more long")
    chosen = F.concat(F.element_at("edits", F.col("state").cast("int") + 1), F.expr("repeat('I', cast(more as int))"))
    entries = entries.join(traced.select("part", "edits"), "part").select("part", "state", chosen.alias("edits"))
    entered = cut.drop("cost").join(prices.select("part", "cost"), "part").join(entries, "part")
    entered = entered.select("conv_id", "part", "first", "last", "illegal", "cost", "edits", "state", "codes", "times", "roles", "texts")
    schema = f"conv_id {kind}, part long, first string, last string, illegal long, cost long, edits string, repaired string"
    entered.mapInArrow(tidy(_applied), schema).write.parquet(f"{folder}/applied")
    applied = spark.read.parquet(f"{folder}/applied")
    joined = applied.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    joined = joined.mapInArrow(tidy(_joined), f"conv_id {kind}, illegal long, cost long, audit string, sha string")
    edits = whole.unionByName(joined).withColumnRenamed("conv_id", "of").withColumnRenamed("sha", "repaired_sha256")
    counts = _counts(found)
    report = counts.join(edits, counts["conv_id"].eqNullSafe(edits["of"])).drop("of")
    texts = None
    if keep_texts:
        texts = pieces.where("not open").select("conv_id", "part", "repaired").unionByName(applied.select("conv_id", "part", "repaired"))
    return Repair(report, texts)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Every conv_id with the report of its rows after damage; zeros and an empty audit if none are left."""
    ids = conversations.select(conversations["conv_id"]).distinct()
    report = repair_conversations(damage(conversations)).report.withColumnRenamed("conv_id", "of")
    joined = ids.join(report, ids["conv_id"].eqNullSafe(report["of"]), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def filled(name: str, value: object, kind: str) -> Column:
        return F.coalesce(F.col(name), F.lit(value)).cast(kind).alias(name)

    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", *[filled(n, 0, "long") for n in numbers], filled("audit", "", "string"), filled("repaired_sha256", empty, "string")
    )

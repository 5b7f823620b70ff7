import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from strata import (
    affected_partitions,
    earliest_affected,
    load_period,
    pit_partition,
    pit_snapshots,
    publish_snapshot,
    read_snapshot,
    retain_last,
    roll_forward,
    roll_snapshots,
    snapshot_at,
    working_folder,
)
from strata.functions.dates import (
    next_period,
    period_of,
    periods_between,
    previous_period,
    start_after,
    start_of,
    starts_between,
)
from strata.operators.temporal import roll_forward_parts
from strata.plans.sizing import Bound

CHANGE = "id int, at date, value string, gone boolean"
HOW = {"keys": ["id"], "order": ["at"], "deleted": "gone"}


def day(text):
    return dt.date.fromisoformat(text)


def changes(spark, *rows):
    return spark.createDataFrame([(i, day(d) if d else None, v, g) for i, d, v, g in rows], CHANGE)


HISTORY = [
    (1, "2024-01-10", "a", False),
    (1, "2024-01-20", "b", False),
    (1, "2024-03-05", "c", False),
    (2, "2024-02-01", "x", False),
    (2, "2024-03-31", "x", True),
    (2, "2024-05-02", "y", False),
]
MONTHS = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01", "2024-05-01"]
EXPECTED = {
    "2024-01-01": {1: "b"},
    "2024-02-01": {1: "b", 2: "x"},
    "2024-03-01": {1: "c"},
    "2024-04-01": {1: "c"},
    "2024-05-01": {1: "c", 2: "y"},
}


def by_period(df, deleted=None):
    found = {}
    live = df if deleted is None else df.filter(~F.col(deleted))
    for row in live.collect():
        period = found.setdefault(row["period"].isoformat(), {})
        assert row["id"] not in period
        period[row["id"]] = row["value"]
    return found


def brute_force(history, months):
    """Month by month, newest first, the way a single partition is built."""
    out = {}
    for month in months:
        start = day(month)
        end = dt.date(start.year + start.month // 12, start.month % 12 + 1, 1)
        newest = {}
        for key, at, value, gone in sorted((h for h in history if h[1]), key=lambda h: h[1]):
            if day(at) < end:
                newest[key] = (value, gone)
        live = {key: value for key, (value, gone) in newest.items() if not gone}
        if live:
            out[month] = live
    return out


@pytest.mark.parametrize(
    "unit, start, before, after",
    [
        ("day", "2024-05-17", "2024-05-16", "2024-05-18"),
        ("week", "2024-05-13", "2024-05-06", "2024-05-20"),
        ("month", "2024-05-01", "2024-04-01", "2024-06-01"),
        ("quarter", "2024-04-01", "2024-01-01", "2024-07-01"),
        ("year", "2024-01-01", "2023-01-01", "2025-01-01"),
    ],
)
def test_periods(spark, unit, start, before, after):
    moment = F.lit("2024-05-17 13:00:00").cast("timestamp_ntz")
    here = period_of(moment, unit)
    span = periods_between(previous_period(here, unit), next_period(here, unit), unit)
    empty = periods_between(next_period(here, unit), here, unit)
    row = spark.range(1).select(here, span, empty).first()
    assert row[0] == day(start)
    assert row[1] == [day(before), day(start), day(after)]
    assert row[2] == []


@pytest.mark.parametrize("unit", ["day", "week", "month", "quarter", "year"])
def test_periods_on_the_driver_are_the_same(spark, unit):
    days = [day("1999-12-31") + dt.timedelta(days=17 * n) for n in range(120)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    here = period_of(F.col("d"), unit)
    for row in df.select("d", here.alias("here"), next_period(here, unit).alias("after")).collect():
        assert (start_of(row["d"], unit), start_after(row["here"], unit)) == (row["here"], row["after"])
    first, last = start_of(days[0], unit), start_of(days[9], unit)
    span = spark.range(1).select(periods_between(F.lit(first), F.lit(last), unit)).first()[0]
    assert starts_between(first, last, unit) == span and starts_between(last + dt.timedelta(days=999), last, unit) == []


def test_unknown_period():
    with pytest.raises(ValueError):
        period_of(F.lit(None), "fortnight")


def test_all_snapshots(spark):
    got = by_period(pit_snapshots(changes(spark, *HISTORY), upto=day("2024-05-01"), **HOW))
    assert got == EXPECTED == brute_force(HISTORY, MONTHS)


@pytest.mark.parametrize("lost", [(3, None, "undated", False), (3, "2024-06-01", "after the last period", False)])
def test_rows_in_no_period_fail_the_job(spark, lost):
    stored = store(spark, HISTORY, "2024-05-01")
    with pytest.raises(Exception, match="null or after 2024-05-01"):
        pit_snapshots(changes(spark, *HISTORY, lost), upto=day("2024-05-01"), **HOW).collect()
    with pytest.raises(Exception, match="null or after 2024-05-01"):
        roll_forward(stored, changes(spark, *LATE, lost), stored_upto=day("2024-05-01"), **HOW).collect()
    with pytest.raises(ValueError):
        roll_snapshots(changes(spark, *HISTORY, lost), working_folder(spark, "t"), upto=day("2024-05-01"), **HOW)


def test_hot_key_is_cut_before_both_shuffles(spark, plan):
    text = plan(pit_snapshots(changes(spark, *HISTORY), upto=day("2024-05-01"), **HOW))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange hashpartitioning") == 2


def test_affected(spark, rows):
    late = changes(spark, *HISTORY[2:], (3, None, "undated", False))
    got = rows(affected_partitions(late, "at"))
    assert got == [(day("2024-02-01"),), (day("2024-03-01"),), (day("2024-05-01"),)]
    assert earliest_affected(late, "at") == day("2024-02-01")
    assert earliest_affected(late.limit(0), "at") is None


def test_one_partition_from_three_sources(spark, rows):
    previous = changes(spark, (1, "2024-01-01", "old", False), (2, "2024-01-01", "kept", False))
    current = changes(spark, (1, "2024-02-01", "now", False), (3, "2024-02-01", "gone soon", False))
    incoming = changes(spark, (3, "2024-02-02", "gone soon", True), (4, "2024-02-03", "new", False))
    got = pit_partition(incoming, previous.drop("gone"), current.drop("gone"), **HOW)
    assert rows(got, "id", "value") == [(1, "now"), (2, "kept"), (4, "new")]


def test_three_sources_equal_dates(spark, rows):
    same = "2024-01-01"
    sides = [changes(spark, (1, same, name, False)) for name in ("incoming", "zz previous", "current")]
    assert rows(pit_partition(*sides, **HOW), "value") == [("incoming",)]
    assert rows(pit_partition(sides[0].limit(0), *sides[1:], **HOW), "value") == [("current",)]


def store(spark, history, upto):
    path = working_folder(spark, "pit")
    snapshots = pit_snapshots(changes(spark, *history), upto=day(upto), keep_tombstones=True, **HOW)
    publish_snapshot(snapshots, path, partition_by=["period"])
    return read_snapshot(spark, path)


LATE = [
    (1, "2024-02-15", "late b", False),
    (2, "2024-02-20", "late x", False),
    (4, "2024-03-15", "late new", False),
    (4, "2024-04-15", "late new", True),
]


@pytest.mark.parametrize("rows_bound", [0, 1000])
def test_late_rows_roll_forward(spark, rows_bound):
    stored = store(spark, HISTORY, "2024-05-01")
    rolled = roll_forward(
        stored, changes(spark, *LATE), stored_upto=day("2024-05-01"), bound=Bound(rows=rows_bound), **HOW
    )
    assert set(rolled.columns) == set(stored.columns)
    wanted = brute_force(HISTORY + LATE, MONTHS[1:])
    assert by_period(rolled, "gone") == wanted
    # Key 2 was deleted in March; the late February row must not revive it.
    assert 2 not in wanted["2024-03-01"]


def test_roll_forward_into_new_periods(spark):
    old = [row for row in HISTORY if row[1] < "2024-03"]
    new = [row for row in HISTORY if row[1] and row[1] >= "2024-03"] + LATE[2:]
    stored = store(spark, old, "2024-02-01")
    rolled = roll_forward(
        stored, changes(spark, *new), stored_upto=day("2024-02-01"), upto=day("2024-05-01"), **HOW
    )
    assert by_period(rolled, "gone") == brute_force(old + new, MONTHS[2:])


VERSIONS = hs.lists(
    hs.tuples(hs.integers(1, 3), hs.integers(0, 120), hs.booleans(), hs.booleans()),
    min_size=1, max_size=12, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(versions=VERSIONS)
def test_any_late_rows(spark, versions):
    start = day("2024-01-05")
    rows = [
        (key, (start + dt.timedelta(days=after)).isoformat(), f"v{after}", gone, late)
        for key, after, gone, late in versions
    ]
    early = [row[:4] for row in rows if not row[4]]
    late = [row[:4] for row in rows if row[4]]
    stored = store(spark, early, "2024-05-01")
    rolled = roll_forward(stored, changes(spark, *late), stored_upto=day("2024-05-01"), **HOW)
    first = min((row[1][:7] for row in late), default="9999")
    touched = [month for month in MONTHS if month[:7] >= first]
    assert by_period(rolled, "gone") == brute_force(early + late, touched)


def test_roll_forward_of_nothing(spark):
    stored = store(spark, HISTORY, "2024-05-01")
    assert roll_forward(stored, changes(spark), stored_upto=day("2024-05-01"), **HOW).isEmpty()


def test_snapshot_at_reads_one_partition(spark, rows, plan):
    stored = store(spark, HISTORY, "2024-05-01")
    march = snapshot_at(stored, day("2024-03-17"), deleted="gone")
    assert rows(march, "id", "value") == [(1, "c")]
    assert "PartitionFilters: [isnotnull(period" in plan(march)
    assert set(march.columns) == {"id", "at", "value"}


def test_snapshot_table_takes_late_rows(spark):
    path = working_folder(spark, "table")
    settings = {**HOW, "upto": day("2024-05-01")}
    assert len(roll_snapshots(changes(spark, *HISTORY), path, **settings)) == 5
    january = set(os.listdir(f"{path.removeprefix('file:')}/period=2024-01-01"))
    for _ in range(2):
        written = roll_snapshots(changes(spark, *LATE), path, **settings)
        assert written == [day(month) for month in MONTHS[1:]]
        table = spark.read.schema(CHANGE + ", period date").parquet(path)
        assert by_period(table, "gone") == brute_force(HISTORY + LATE, MONTHS)
    assert set(os.listdir(f"{path.removeprefix('file:')}/period=2024-01-01")) == january
    assert roll_snapshots(changes(spark), path, **settings) == []
    assert roll_snapshots(changes(spark), working_folder(spark, "t"), **settings) == []
    with pytest.raises(ValueError, match="2024-06-01"):
        roll_snapshots(changes(spark, (1, "2024-06-09", "too late", False)), path, **settings)


def test_periods_loaded_one_by_one(spark):
    path = working_folder(spark, "table")
    for month in MONTHS:
        arrived = [row for row in HISTORY if row[1] and row[1][:7] == month[:7]]
        for _ in range(2):
            load_period(changes(spark, *arrived), path, day(month) + dt.timedelta(days=9), **HOW)
    table = spark.read.schema(CHANGE + ", period date").parquet(path)
    assert by_period(table, "gone") == EXPECTED


def test_partition_rebuild_equals_history(spark):
    """Ingest-time rebuild, month after month, gives the one-pass snapshots."""
    history = [row for row in HISTORY if row[1]]
    previous = changes(spark)
    for month in MONTHS:
        start = day(month)
        arrived = [row for row in history if row[1][:7] == month[:7]]
        previous = pit_partition(
            changes(spark, *arrived), previous, changes(spark), keep_tombstones=True, **HOW
        )
        live = {row["id"]: row["value"] for row in previous.filter("not gone").collect()}
        assert live == EXPECTED[start.isoformat()]
    assert retain_last(previous, keep_tombstones=True, **HOW).count() == 2


LONG = [*MONTHS, "2024-06-01", "2024-07-01", "2024-08-01"]


def test_quiet_periods_get_their_snapshot(spark):
    """Stored up to March; late rows begin in June; the last month has none at all."""
    path = working_folder(spark, "table")
    early = [row for row in HISTORY if row[1] < "2024-04"]
    late = [(1, "2024-06-15", "june", False), (5, "2024-07-01", "july", False)]
    settings = {**HOW}
    roll_snapshots(changes(spark, *early), path, upto=day("2024-03-01"), **settings)
    written = roll_snapshots(changes(spark, *late), path, upto=day("2024-08-20"), **settings)
    assert written == [day(month) for month in LONG[3:]]
    table = spark.read.schema(CHANGE + ", period date").parquet(path)
    assert by_period(table, "gone") == brute_force(early + late, LONG)
    stored = store(spark, early, "2024-03-01")
    for bound in (Bound(), Bound(rows=0)):
        rolled = roll_forward(stored, changes(spark, *late), stored_upto=day("2024-03-01"), upto=day("2024-08-01"), bound=bound, **HOW)
        assert by_period(rolled, "gone") == brute_force(early + late, LONG[3:])


def test_roll_forward_without_late_rows(spark):
    path = working_folder(spark, "table")
    roll_snapshots(changes(spark, *HISTORY), path, upto=day("2024-05-01"), **HOW)
    assert roll_snapshots(changes(spark), path, upto=day("2024-07-01"), **HOW) == [day(m) for m in LONG[5:7]]
    table = spark.read.schema(CHANGE + ", period date").parquet(path)
    assert by_period(table, "gone") == brute_force(HISTORY, LONG[:7])


def test_period_after_a_gap_starts_from_the_newest_before(spark):
    path = working_folder(spark, "table")
    load_period(changes(spark, (1, "2024-01-10", "a", False), (2, "2024-01-11", "b", False)), path, day("2024-01-31"), **HOW)
    load_period(changes(spark, (1, "2024-03-10", "c", False)), path, day("2024-03-31"), **HOW)
    table = spark.read.schema(CHANGE + ", period date").parquet(path)
    assert by_period(table, "gone") == {"2024-01-01": {1: "a", 2: "b"}, "2024-03-01": {1: "c", 2: "b"}}


def test_columns_of_stored_snapshots_are_kept(spark):
    path = working_folder(spark, "table")
    full = changes(spark, (1, "2024-01-10", "a", False)).withColumn("extra", F.lit("kept"))
    load_period(full, path, day("2024-01-31"), **HOW)
    less = changes(spark, (2, "2024-02-10", "b", False))
    with pytest.raises(ValueError, match="extra"):
        load_period(less, path, day("2024-02-28"), **HOW)
    with pytest.raises(ValueError, match="extra"):
        roll_snapshots(less, path, upto=day("2024-02-01"), **HOW)
    with pytest.raises(ValueError, match="value"):
        load_period(full.withColumn("value", F.lit(1)), path, day("2024-02-28"), **HOW)
    load_period(less, path, day("2024-02-28"), evolve=True, **HOW)
    roll_snapshots(less.withColumn("more", F.lit(1)), path, upto=day("2024-03-01"), evolve=True, **HOW)
    table = spark.read.option("mergeSchema", "true").parquet(path).filter("period >= '2024-02-01'")
    got = {(r["period"].month, r["id"], r["extra"], r["more"]) for r in table.collect()}
    assert got == {(2, 1, "kept", None), (2, 2, None, 1), (3, 1, "kept", None), (3, 2, None, 1)}


def test_stored_rows_are_scanned_once_and_not_shuffled(spark, plan):
    stored = store(spark, HISTORY, "2024-05-01")
    text = plan(roll_forward(stored, changes(spark, *LATE), stored_upto=day("2024-05-01"), **HOW))
    assert "hashpartitioning" not in text.split("Union")[1].split("BroadcastExchange")[0]
    assert text.count("FileScan parquet") == 2  # all columns once, the keys once


def test_a_task_fills_one_new_period(spark):
    """However many periods are filled from the last stored one, no task holds its rows more than once."""
    early = [row for row in HISTORY if row[1] < "2024-04"]
    stored = store(spark, early, "2024-03-01")
    late = changes(spark, (1, "2024-06-15", "june", False), (5, "2024-07-01", "july", False))
    placed, others = roll_forward_parts(stored, late, stored_upto=day("2024-03-01"), upto=day("2024-08-01"), **HOW)
    tasks = placed.select(F.spark_partition_id().alias("task"), "period").distinct().groupBy("task").count()
    assert tasks.count() >= 5 and tasks.agg(F.max("count")).first()[0] == 1
    assert placed.count() == 5 * stored.where("period = date'2024-03-01'").count()
    assert {row["id"] for row in others.collect()} == {5}

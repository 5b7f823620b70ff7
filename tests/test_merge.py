import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from strata import current_state, flatten_changes, retain_last, same_rows
from strata.plans.sizing import Bound

RECORD = "id int, value string, _as_of timestamp, _deleted boolean"
MERGE = {"keys": ["id"], "order": ["_as_of"], "deleted": "_deleted"}


def at(text):
    return dt.datetime.fromisoformat(f"2020-01-01T{text}")


def merge(spark, rows, new, old, **more):
    result = retain_last(
        spark.createDataFrame(new, RECORD), spark.createDataFrame(old, RECORD), **{**MERGE, **more}
    )
    return rows(result)


def test_two_empty_sides(spark, rows):
    assert merge(spark, rows, [], []) == []


@pytest.mark.parametrize("side", ["incoming", "existing", "both"])
def test_one_record_wherever_it_is(spark, rows, side):
    record = [(1, "a", at("10:00:00"), None)]
    new = record if side != "existing" else []
    old = record if side != "incoming" else []
    assert merge(spark, rows, new, old) == [(1, "a", at("10:00:00"))]


def test_newer_incoming_replaces(spark, rows):
    new, old = [(1, "new", at("10:00:01"), None)], [(1, "old", at("10:00:00"), None)]
    assert merge(spark, rows, new, old) == [(1, "new", at("10:00:01"))]


def test_older_incoming_is_ignored(spark, rows):
    new, old = [(1, "stale", at("09:40:00"), None)], [(1, "kept", at("10:00:00"), None)]
    assert merge(spark, rows, new, old) == [(1, "kept", at("10:00:00"))]


def test_newest_delete_removes(spark, rows):
    new, old = [(1, "x", at("10:00:01"), True)], [(1, "x", at("10:00:00"), None)]
    assert merge(spark, rows, new, old) == []


def test_older_delete_does_not_remove(spark, rows):
    new, old = [(1, "x", at("09:00:00"), True)], [(1, "x", at("10:00:00"), None)]
    assert merge(spark, rows, new, old) == [(1, "x", at("10:00:00"))]


def test_only_the_right_key_changes(spark, rows):
    old = [(1, "a", at("10:00:01"), None), (2, "a", at("10:00:01"), None)]
    got = merge(spark, rows, [(1, "b", at("10:01:00"), None)], old)
    assert got == [(1, "b", at("10:01:00")), (2, "a", at("10:00:01"))]


def test_null_sort_value_loses_but_survives_alone(spark, rows):
    new = [(1, "dated", at("10:00:00"), None), (2, "alone", None, None)]
    got = merge(spark, rows, new, [(1, "undated", None, None)])
    assert got == [(1, "dated", at("10:00:00")), (2, "alone", None)]


def test_null_keys_form_one_entity(spark, rows):
    new, old = [(None, "b", at("10:00:01"), None)], [(None, "a", at("10:00:00"), None)]
    for unique in (False, True):
        assert merge(spark, rows, new, old, existing_unique=unique) == [(None, "b", at("10:00:01"))]


def test_ties_incoming_then_delete_then_content(spark, rows):
    same = at("10:00:00")
    assert merge(spark, rows, [(1, "a", same, None)], [(1, "z", same, None)]) == [(1, "a", same)]
    assert merge(spark, rows, [(1, "z", same, None), (1, "a", same, True)], []) == []
    for order in ([0, 1], [1, 0]):
        pair = [(1, "a", same, None), (1, "z", same, None)]
        assert merge(spark, rows, [pair[i] for i in order], []) == [(1, "z", same)]


def test_flag_missing_on_either_side_means_live(spark, rows):
    new = spark.createDataFrame([(1, "n", at("10:00:00"), True)], RECORD)
    old = spark.createDataFrame([(2, "o", at("10:00:00"))], "id int, value string, _as_of timestamp")
    assert rows(retain_last(new, old, **MERGE)) == [(2, "o", at("10:00:00"))]
    assert rows(retain_last(old, new, **MERGE)) == [(2, "o", at("10:00:00"))]


def test_column_order_may_differ_but_not_the_set(spark, rows):
    new = spark.createDataFrame([(1, "n", at("10:00:00"))], "id int, value string, _as_of timestamp")
    old = spark.createDataFrame([(at("09:00:00"), "o", 2)], "_as_of timestamp, value string, id int")
    got = retain_last(new, old, keys=["id"], order=["_as_of"])
    assert got.columns == ["id", "value", "_as_of"]
    assert rows(got) == [(1, "n", at("10:00:00")), (2, "o", at("09:00:00"))]
    with pytest.raises(Exception, match="value|column"):
        retain_last(new, old.drop("value"), keys=["id"], order=["_as_of"]).collect()


def test_keys_and_order_are_mandatory(spark):
    frame = spark.createDataFrame([], RECORD)
    with pytest.raises(ValueError):
        retain_last(frame, keys=[], order=["_as_of"])
    with pytest.raises(ValueError):
        retain_last(frame, keys=["id"], order=[])


def test_kept_tombstones_stop_a_late_older_event(spark, rows):
    first = spark.createDataFrame([(1, "x", at("10:00:00"), True)], RECORD)
    late = spark.createDataFrame([(1, "old", at("09:00:00"), False)], RECORD)
    state = retain_last(first, keep_tombstones=True, **MERGE)
    assert rows(retain_last(late, state, **MERGE)) == []
    # Without them the key comes back, as in a target that stores live rows only.
    forgotten = retain_last(first, **MERGE)
    assert rows(retain_last(late, forgotten, **MERGE)) == [(1, "old", at("09:00:00"))]


def test_order_that_needs_a_map_column_beside_it(spark):
    frame = spark.sql("select 1 as id, timestamp'2020-01-01' as t, map('a', 1) as m")
    assert retain_last(frame, frame, keys=["id"], order=["t"]).count() == 1


def test_small_changes_are_put_into_a_large_state(spark, rows, plan):
    old = spark.range(1000).select(F.col("id").cast("int"), F.lit("o").alias("value"), F.lit(1).alias("v"))
    new = spark.createDataFrame([(5, "n", 2), (2000, "n", 1), (7, "n", 0)], "id int, value string, v int")
    common = {"keys": ["id"], "order": ["v"], "existing_unique": True}
    fast = retain_last(new, old, **common)
    slow = retain_last(new, old, bound=Bound(rows=2), **common)
    assert "LeftOuter, BuildRight" in plan(fast) and "FullOuter" in plan(slow)
    assert rows(fast) == rows(slow) and fast.count() == 1001


def test_any_column_name(spark, rows):
    names = ["the key", "a.b", "tick`s", "gone?"]
    new = spark.createDataFrame([(1, 2, "n", False), (2, 2, "n", True)], names)
    old = spark.createDataFrame([(1, 1, "o", False), (2, 1, "o", False), (3, 1, "o", False)], names)
    got = retain_last(
        new, old, keys=["the key"], order=["a.b"], deleted="gone?", existing_unique=True
    )
    assert got.columns == names[:3]
    assert rows(got) == [(1, 2, "n"), (3, 1, "o")]


def test_plan_cuts_rows_before_the_shuffle(spark, plan):
    frame = spark.createDataFrame([], RECORD)
    text = plan(retain_last(frame.repartition(2), frame.repartition(2), **MERGE))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "Python" not in text


VERSIONS = hs.lists(
    hs.tuples(hs.integers(1, 3), hs.integers(0, 50), hs.booleans()),
    min_size=1, max_size=14, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(versions=VERSIONS, seed=hs.randoms())
def test_properties(spark, rows, versions, seed):
    schema, how = "id int, v int, gone boolean", {"keys": ["id"], "order": ["v"], "deleted": "gone"}
    whole = spark.createDataFrame(versions, schema)
    state = retain_last(whole, keep_tombstones=True, **how)
    expected = {}
    for key, v, gone in sorted(versions, key=lambda r: r[1]):
        expected[key] = (key, v, gone)
    assert rows(state) == sorted(expected.values())
    assert rows(retain_last(state, keep_tombstones=True, **how)) == rows(state)
    shuffled = list(versions)
    seed.shuffle(shuffled)
    cut = len(shuffled) // 2
    step = retain_last(spark.createDataFrame(shuffled[:cut], schema), keep_tombstones=True, **how)
    rest = spark.createDataFrame(shuffled[cut:], schema)
    both = retain_last(rest, step, keep_tombstones=True, existing_unique=True, **how)
    assert rows(both) == rows(state)


SMALL = hs.one_of(hs.none(), hs.integers(0, 2))
ROWS = hs.lists(
    hs.tuples(hs.one_of(hs.none(), hs.integers(1, 4)), SMALL, SMALL, hs.sampled_from([None, True, False])),
    max_size=10,
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(new=ROWS, old=ROWS)
def test_broadcast_and_shuffle_agree(spark, rows, new, old):
    """With nulls and ties in keys, order and flags, whichever way the merge takes."""
    schema = "id int, a int, b int, gone boolean, side string"
    how = {"keys": ["id"], "order": ["a", "b"], "deleted": "gone"}
    unique = list({row[0]: row for row in old}.values())
    incoming = spark.createDataFrame([(*row, "new") for row in new], schema)
    existing = spark.createDataFrame([(*row, "old") for row in unique], schema)
    for keep in (True, False):
        shuffled = retain_last(incoming, existing, keep_tombstones=keep, **how)
        put_in = retain_last(incoming, existing, keep_tombstones=keep, existing_unique=True, **how)
        assert put_in.columns == shuffled.columns
        assert same_rows(put_in, shuffled)


# -- change events ---------------------------------------------------------------------

PERSON = "id int, first_name string, last_name string, email string"
EVENT = f"before struct<{PERSON}>, after struct<{PERSON}>, ts_ms bigint not null"
STATE = f"{PERSON}, _as_of timestamp"
IDA = (31, "Ida", "Berg", "ida@example.org")
MOVED = (31, "Ida", "Berg", "berg@example.com")
NOTHING = (None, None, None, None)
T1, T2 = 1635920120000, 1635920224250
WHEN1 = dt.datetime.fromisoformat("2021-11-03T06:15:20")
WHEN2 = dt.datetime.fromisoformat("2021-11-03T06:17:04.250")


def run(spark, rows, events, existing, **more):
    state = current_state(
        spark.createDataFrame(events, EVENT), spark.createDataFrame(existing, STATE), keys=["id"], **more
    )
    return rows(state)


@pytest.mark.parametrize("image", ["row", "field"])
def test_change_scenarios(spark, rows, image):
    stored = [(*IDA, WHEN1)]
    assert run(spark, rows, [(None, IDA, T1)], [], image=image) == [(*IDA, WHEN1)]
    assert run(spark, rows, [(NOTHING, MOVED, T2)], stored, image=image) == [(*MOVED, WHEN2)]
    assert run(spark, rows, [(NOTHING, MOVED, T2)] * 2, [], image=image) == [(*MOVED, WHEN2)]
    assert run(spark, rows, [(MOVED, None, T2)], stored, image=image) == []
    assert run(spark, rows, [], stored, image=image) == stored


def test_field_set_to_null(spark, rows):
    erased = (31, "Ida", "Berg", None)
    events = spark.createDataFrame([(IDA, erased, T2)], EVENT)
    assert rows(flatten_changes(events), "email") == [(None,)]
    assert rows(flatten_changes(events, image="field"), "email") == [(IDA[3],)]


def test_sequence_orders_one_millisecond(spark, rows):
    events = spark.createDataFrame([(None, MOVED, T1, 2), (None, IDA, T1, 1)], EVENT + ", seq int")
    got = current_state(events, keys=["id"], sequence=["seq"])
    assert rows(got, "email") == [(MOVED[3],)]


def test_unknown_image(spark):
    with pytest.raises(ValueError):
        flatten_changes(spark.createDataFrame([], EVENT), image="cell")

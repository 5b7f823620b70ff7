import pytest

from strata import dataset_diff, multiset_diff, same_rows

SCHEMA = "k int, v string"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_added_removed_changed(spark):
    before = frame(spark, (1, "same"), (2, "old"), (3, "gone"), (4, None), (5, None))
    after = frame(spark, (1, "same"), (2, "new"), (4, None), (5, "set"), (6, None)).select("v", "k")
    got = {
        row["k"]: (row["change"], row["before"] and row["before"]["v"], row["after"] and row["after"]["v"])
        for row in dataset_diff(before, after, ["k"]).collect()
    }
    assert got == {
        2: ("changed", "old", "new"),
        3: ("removed", "gone", None),
        5: ("changed", None, "set"),
        6: ("added", None, None),
    }


def test_null_key(spark):
    diff = dataset_diff(frame(spark, (None, "a")), frame(spark, (None, "b")), ["k"])
    assert [row["change"] for row in diff.collect()] == ["changed"]


def test_repeated_key_fails(spark):
    with pytest.raises(Exception, match="more than once"):
        dataset_diff(frame(spark, (1, "a"), (1, "b")), frame(spark), ["k"]).collect()
    with pytest.raises(Exception, match="more than once"):
        dataset_diff(frame(spark, (1, "a"), (1, "a")), frame(spark), ["k"]).collect()


def test_all_columns_are_keys(spark, rows):
    diff = dataset_diff(frame(spark, (1, "a")), frame(spark, (2, "b")), ["k", "v"])
    assert rows(diff, "k", "change") == [(1, "removed"), (2, "added")]


def test_copies_count(spark, rows):
    before = frame(spark, (1, "a"), (1, "a"), (2, None))
    after = frame(spark, (1, "a"), (2, None), (2, None), (3, "c"))
    assert rows(multiset_diff(before, after)) == [(1, "a", -1), (2, None, 1), (3, "c", 1)]
    assert not same_rows(before, after)
    assert same_rows(before, before.select("v", "k").orderBy("k"))


def test_columns_must_agree(spark):
    with pytest.raises(ValueError, match="x"):
        multiset_diff(frame(spark), spark.createDataFrame([], "k int, x string"))


def test_no_join(spark, plan):
    assert "Join" not in plan(dataset_diff(frame(spark, (1, "a")), frame(spark, (2, "b")), ["k"]))

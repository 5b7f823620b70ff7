import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

import strata as st
from strata.sources import commits


@pytest.fixture
def path(spark):
    return st.working_folder(spark, "shared")


def frame(spark, rows):
    return spark.createDataFrame(rows, "day string, n long")


def put(spark, path, rows, days=None, **options):
    days = {day for day, _ in rows} if days is None else days
    return st.commit_partitions(spark, path, "day", days, lambda version: frame(spark, rows), **options)


def held(spark, path, version=None, **options):
    return sorted(tuple(row) for row in st.read_version(spark, path, version, **options).collect())


def test_versions_partitions_and_emptied_ones(spark, path):
    with pytest.raises(FileNotFoundError):
        st.read_version(spark, path)
    assert put(spark, path, [("a", 1), ("b", 2), (None, 3)]) == 1
    assert put(spark, path, [("a", 10)], ["a", "b"]) == 2
    assert sorted(tuple(r) for r in st.read_version(spark, path, 2).collect() if r["day"]) == [("a", 10)]
    assert st.read_version(spark, path, 1).count() == 3
    assert held(spark, path, partitions=["a", "x"]) == [("a", 10)]
    assert held(spark, path, partitions=[None]) == [(None, 3)]
    assert held(spark, path, partitions=[]) == []
    assert put(spark, path, [], ["a", None]) == 3
    assert held(spark, path) == []
    with pytest.raises(KeyError):
        st.read_version(spark, path, 9)


def test_jobs_on_other_partitions_keep_their_rows(spark, path):
    put(spark, path, [("a", 1), ("b", 2)])
    built = []

    def build(version):
        built.append(version.number)
        if len(built) == 1:
            put(spark, path, [("b", 20)])  # by another job, meanwhile
        return frame(spark, [("a", 10)])

    assert st.commit_partitions(spark, path, "day", ["a"], build) == 3
    assert built == [1]
    assert held(spark, path) == [("a", 10), ("b", 20)]
    assert held(spark, path, 2) == [("a", 1), ("b", 20)]


@pytest.mark.parametrize("options", [{}, {"reads": ["b"]}, {"reads": "all"}], ids=["same", "read", "all"])
def test_jobs_that_depend_on_each_other_take_turns(spark, path, options):
    put(spark, path, [("a", 1), ("b", 2), ("c", 3)])
    mine, theirs = ("a", "a") if not options else ("a", "b")
    built = []

    def build(version):
        built.append(version.number)
        seen = st.read_version(spark, path, version).where(F.col("day").isin("a", "b")).agg(F.sum("n")).first()[0]
        if len(built) == 1:
            put(spark, path, [(theirs, 100)])
        return frame(spark, [(mine, seen)])

    assert st.commit_partitions(spark, path, "day", [mine], build, **options) == 3
    assert built == [1, 2]
    wanted = [("a", 102), ("b", 2)] if not options else [("a", 101), ("b", 100)]
    assert held(spark, path) == [*wanted, ("c", 3)]


def test_nothing_is_lost_between_threads(spark, path):
    put(spark, path, [("a", 0), ("b", 0)])
    failures = []

    def add(day):
        def build(version):
            return st.read_version(spark, path, version, partitions=[day]).withColumn("n", F.col("n") + 1)

        try:
            for _ in range(3):
                st.commit_partitions(spark, path, "day", [day], build)
        except Exception as error:
            failures.append(error)

    threads = [threading.Thread(target=add, args=(day,)) for day in "aab"]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failures
    assert held(spark, path) == [("a", 6), ("b", 3)]
    assert st.table_version(spark, path).number == 10


def test_one_of_several_creates_a_number(spark, path):
    put(spark, path, [("a", 1)])
    built = []

    def build(version):
        built.append(version.number)
        put(spark, path, [("a", len(built))])
        return frame(spark, [("a", -1)])

    with pytest.raises(st.CommitConflict):
        st.commit_partitions(spark, path, "day", ["a"], build, attempts=2)
    assert built == [1, 2]
    assert held(spark, path) == [("a", 2)]


def test_full_commits_hold_all_partitions(spark, path, monkeypatch):
    monkeypatch.setattr(commits, "_FULL", 2)
    for n in range(1, 6):
        put(spark, path, [(f"d{n % 3}", n)])
    assert held(spark, path) == [("d0", 3), ("d1", 4), ("d2", 5)]
    assert [held(spark, path, n) for n in (1, 2)] == [[("d1", 1)], [("d1", 1), ("d2", 2)]]


def test_rows_and_columns_that_do_not_belong(spark, path):
    put(spark, path, [("a", 1)])
    with pytest.raises(ValueError, match="not replaced"):
        put(spark, path, [("a", 1), ("b", 2)], ["a"])
    wider = frame(spark, [("b", 2)]).withColumn("more", F.lit("x"))
    with pytest.raises(ValueError, match="differ"):
        st.commit_partitions(spark, path, "day", ["b"], lambda version: wider)
    with pytest.raises(ValueError, match="stored as"):
        st.commit_partitions(spark, path, "day", ["b"], lambda version: wider.select("day", F.lit("2").alias("n")))
    with pytest.raises(ValueError, match="partitioned by"):
        st.commit_partitions(spark, path, "n", [2], lambda version: frame(spark, [("b", 2)]))
    st.commit_partitions(spark, path, "day", ["b"], lambda version: wider, evolve=True)
    assert sorted(map(tuple, st.read_version(spark, path).collect()), key=str) == [("a", 1, None), ("b", 2, "x")]


def test_purge_removes_what_no_kept_version_reads(spark, path):
    put(spark, path, [("a", 1), ("b", 2)])
    put(spark, path, [("a", 10)])
    put(spark, path, [("a", 100)])
    frame(spark, [("a", 5)]).write.partitionBy("day").parquet(f"{path}/data/__write=wdead")  # of a job that died
    assert len(st.purge_commits(spark, path, keep=1)) == 2  # version 1's a, and version 2's
    assert held(spark, path) == [("a", 100), ("b", 2)]
    assert st.purge_commits(spark, path, keep=1, idle=dt.timedelta(seconds=-1)) == ["__write=wdead"]
    assert held(spark, path) == [("a", 100), ("b", 2)]


def test_merges_of_the_same_key_in_any_order(spark, path):
    schema = "id long, day string, at int, gone boolean"
    how = {"keys": ["id"], "order": ["at"], "deleted": "gone"}
    one = spark.createDataFrame([(1, "a", 1, False), (2, "b", 1, False), (3, "a", 5, True)], schema)
    two = spark.createDataFrame([(1, "a", 2, False), (3, "a", 4, False)], schema)
    assert st.merge_committed(one, path, "day", **how) == 1
    assert st.merge_committed(two, path, "day", **how) == 2
    wanted = [(1, "a", 2, False), (2, "b", 1, False), (3, "a", 5, True)]
    assert sorted(map(tuple, st.read_version(spark, path).select("id", "day", "at", "gone").collect())) == wanted
    assert st.merge_committed(two.limit(0), path, "day", **how) is None
    st.merge_committed(one, path, "day", **how)  # again
    assert sorted(map(tuple, st.read_version(spark, path).select("id", "day", "at", "gone").collect())) == wanted
    with pytest.raises(ValueError, match="another partition"):
        st.merge_committed(spark.createDataFrame([(2, "a", 9, False)], schema), path, "day", **how)

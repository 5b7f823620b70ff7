import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from strata import (
    RunLedger,
    apply_changes,
    current_state_incremental,
    current_state_partitioned,
    flatten_changes,
    labelled_version,
    latest_version,
    merge_partitions,
    merge_table_partitions,
    process_new_files,
    publish_snapshot,
    purge_swapped,
    purge_versions,
    read_raw,
    read_snapshot,
    read_state,
    read_unprocessed,
    rebuild_partitions,
    rebuild_table_partitions,
    replay_files,
    replay_range,
    swap_table_partitions,
    unprocessed,
    working_folder,
)
from strata.session import shared_folder
from strata.sources.snapshots import version_path, versions


def local(path):
    return path.removeprefix("file:")


def test_publish_reads_its_own_target(spark, rows):
    path = working_folder(spark, "snap")
    assert latest_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    assert read_snapshot(spark, path, schema="id bigint").isEmpty()
    assert publish_snapshot(spark.range(3), path) == 0
    assert publish_snapshot(read_snapshot(spark, path).selectExpr("id + 1 as id"), path) == 1
    assert rows(read_snapshot(spark, path)) == [(1,), (2,), (3,)]
    assert rows(read_snapshot(spark, path, version=0)) == [(0,), (1,), (2,)]


def test_schema_is_published_too(spark, rows):
    path = working_folder(spark, "snap")
    df = spark.createDataFrame([(1, "007")], "id int, code string")
    publish_snapshot(df, path, partition_by=["code"])
    assert rows(read_snapshot(spark, path), "code") == [("007",)]
    publish_snapshot(df.limit(0), path, partition_by=["code"])
    empty = read_snapshot(spark, path)
    assert empty.isEmpty() and empty.dtypes == df.dtypes


def test_unfinished_version_is_invisible_and_replaced(spark, rows):
    path = working_folder(spark, "snap")
    publish_snapshot(spark.range(1), path)
    spark.range(9).write.parquet(version_path(path, 1))  # a job that died before the mark
    assert latest_version(spark, path) == 0
    assert publish_snapshot(spark.range(2), path) == 1
    assert rows(read_snapshot(spark, path)) == [(0,), (1,)]


def test_numbered_publish_happens_once(spark):
    path = working_folder(spark, "snap")
    publish_snapshot(spark.range(2), path, version=7)
    publish_snapshot(spark.range(5), path, version=7)
    assert read_snapshot(spark, path).count() == 2
    assert latest_version(spark, path, before=7) is None


def test_purge(spark):
    path = working_folder(spark, "snap")
    for _ in range(3):
        publish_snapshot(spark.range(1), path)
    spark.range(9).write.parquet(version_path(path, 3))
    assert purge_versions(spark, path, keep=2) == [0]
    assert versions(spark, path) == [1, 2]
    assert os.path.exists(local(version_path(path, 3)))  # it may still be in the making
    with pytest.raises(ValueError):
        purge_versions(spark, path, keep=0)


def years(spark):
    return spark.createDataFrame([(1, 1997), (2, 1997), (3, 1998), (4, 1999)], "id int, y int")


def rebuilt(df):
    return df.filter("y = 1997").withColumn("id", F.col("id") * 10)


def test_rebuild_is_idempotent_and_drops_emptied(spark, rows):
    path = working_folder(spark, "parts")
    years(spark).write.partitionBy("y").parquet(path)
    kept = sorted(os.listdir(f"{local(path)}/y=1999"))
    result = rebuilt(years(spark))
    assert rebuild_partitions(result, path, "y", [1997, 1998]) == [1998]
    for _ in range(2):
        assert rows(spark.read.parquet(path)) == [(4, 1999), (10, 1997), (20, 1997)]
        assert rebuild_partitions(result, path, "y", [1997, 1998]) == []
    assert sorted(os.listdir(f"{local(path)}/y=1999")) == kept


def test_rebuild_reads_its_own_table(spark, rows):
    path = working_folder(spark, "parts")
    years(spark).write.partitionBy("y").parquet(path)
    rebuild_partitions(rebuilt(spark.read.parquet(path)), path, "y", [1997])
    assert rows(spark.read.parquet(path)) == [(3, 1998), (4, 1999), (10, 1997), (20, 1997)]


def test_rebuild_ignores_rows_of_other_partitions(spark, rows):
    path = working_folder(spark, "parts")
    years(spark).write.partitionBy("y").parquet(path)
    rebuild_partitions(years(spark).withColumn("id", F.lit(0)), path, "y", [1998])
    assert rows(spark.read.parquet(path)) == [(0, 1998), (1, 1997), (2, 1997), (4, 1999)]
    assert rebuild_partitions(years(spark), path, "y", []) == []


@pytest.mark.parametrize(
    "kind, kept, gone",
    [
        ("string", "a/b c=d%", "x:y"),
        ("string", "kept", None),
        ("timestamp_ntz", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 2, 3, 4, 500)),
        ("boolean", True, False),
    ],
)
def test_rebuild_odd_partition_values(spark, rows, kind, kept, gone):
    path = working_folder(spark, "parts")
    df = spark.createDataFrame([(1, kept), (2, gone)], f"id int, p {kind}")
    df.write.partitionBy("p").parquet(path)
    rest = df.filter("id = 1").withColumn("id", F.lit(5))
    assert rebuild_partitions(rest, path, "p", [kept, gone]) == [gone]
    assert rows(spark.read.parquet(path), "id") == [(5,)]


def test_merge_touches_few_partitions(spark, rows):
    path = working_folder(spark, "parts")
    stored = "id int, v int, gone boolean, p string"
    spark.createDataFrame([(1, 1, False, "a"), (2, 1, False, "b"), (3, 1, False, None)], stored).write.partitionBy(
        "p"
    ).parquet(path)
    before = sorted(os.listdir(f"{local(path)}/p=b"))

    def merge(*new):
        return merge_partitions(
            spark.createDataFrame(new, stored), path, "p", keys=["id"], order=["v"], deleted="gone"
        )

    assert set(merge((1, 2, True, "a"), (4, 1, False, "c"), (3, 2, False, None))) == {"a", "c", None}
    assert merge((1, 1, False, "a")) == ["a"]  # older than the delete
    assert merge() == []
    assert rows(spark.read.parquet(path).filter("not gone"), "id", "v") == [(2, 1), (3, 2), (4, 1)]
    assert sorted(os.listdir(f"{local(path)}/p=b")) == before


def test_rebuild_date_partitions(spark, rows):
    path = working_folder(spark, "parts")
    days = spark.sql("select * from values (1, date'2024-01-01'), (2, date'2024-02-01') as t(id, d)")
    days.write.partitionBy("d").parquet(path)
    gone = rebuild_partitions(days.filter("id = 9"), path, "d", [dt.date(2024, 2, 1)])
    assert gone == [dt.date(2024, 2, 1)]
    assert rows(spark.read.parquet(path), "id") == [(1,)]


def test_rebuild_catalog_table(spark, rows):
    path = working_folder(spark, "parts")
    name = "years_" + path[-12:]
    spark.sql(f"create table {name} (id int, y int) using parquet partitioned by (y) location '{path}'")
    years(spark).write.insertInto(name)
    assert rebuild_table_partitions(rebuilt(spark.table(name)), name, "y", [1997, 1998]) == [1998]
    assert rows(spark.table(name)) == [(4, 1999), (10, 1997), (20, 1997)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_swap_partitions_in_the_catalog(spark, rows):
    path = working_folder(spark, "parts")
    name = "years_" + path[-12:]
    spark.sql(f"create table {name} (id int, y int) using parquet partitioned by (y) location '{path}/t'")
    years(spark).write.insertInto(name)
    old = sorted(os.listdir(f"{local(path)}/t/y=1997"))
    new = rebuilt(spark.table(name)).unionByName(spark.createDataFrame([(9, 2001)], "id int, y int"))
    assert swap_table_partitions(new, name, "y", [1997, 1998, 2001], f"{path}/run1") == [1998]
    expected = [(4, 1999), (9, 2001), (10, 1997), (20, 1997)]
    assert rows(spark.table(name)) == expected
    assert sorted(os.listdir(f"{local(path)}/t/y=1997")) == old
    with pytest.raises(FileExistsError):
        swap_table_partitions(new, name, "y", [1997], f"{path}/run1")
    swap_table_partitions(spark.table(name), name, "y", [1997, 2001], f"{path}/run2")
    assert rows(spark.table(name)) == expected
    assert rows(spark.table(name).filter("y = 2001")) == [(9, 2001)]


def test_merge_into_catalog_partitions(spark, rows):
    path = working_folder(spark, "parts")
    name = "state_" + path[-12:]
    columns = "id int, v int, gone boolean, p string"
    spark.sql(f"create table {name} ({columns}) using parquet partitioned by (p) location '{path}/t'")

    def merge(run, *new):
        return merge_table_partitions(
            spark.createDataFrame(new, columns), name, "p", f"{path}/{run}",
            keys=["id"], order=["v"], deleted="gone",
        )

    merge("r1", (1, 1, False, "a"), (2, 1, False, "it's"), (3, 1, False, None))
    assert set(merge("r2", (1, 2, True, "a"), (3, 2, False, None))) == {"a", None}
    merge("r3", (1, 1, False, "a"))
    assert rows(spark.table(name).filter("not gone"), "id", "v", "p") == [(2, 1, "it's"), (3, 2, None)]


# -- run records -----------------------------------------------------------------------


def test_ledger_remembers_only_success(spark, rows):
    path = working_folder(spark, "ledger")
    ledger = RunLedger(spark, f"{path}/runs")
    files = f"{path}/files"
    seen = []

    def ingest(fail=False, paused=False):
        time.sleep(0.02)
        with ledger.run("job", paused=paused) as run:
            df = read_unprocessed(run, spark, files, "id bigint")
            seen.append(sorted(row["id"] for row in df.collect()))
            if fail:
                raise InterruptedError

    spark.range(2).write.mode("append").json(files)
    with pytest.raises(InterruptedError):
        ingest(fail=True)
    ingest(paused=True)
    ingest()
    spark.range(5, 6).write.mode("append").json(files)
    ingest()
    ingest()
    assert seen == [[0, 1], [0, 1], [0, 1], [5], []]
    assert ledger.runs().count() == 3
    with pytest.raises(ValueError), ledger.run(""):
        pass


def test_jobs_do_not_share_records(spark):
    ledger = RunLedger(spark, working_folder(spark, "ledger"))
    ledger.record("one", dt.datetime(2024, 1, 1, tzinfo=dt.UTC))
    assert ledger.read_until("two") is None
    assert ledger.read_until("one") == dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def test_lag_leaves_young_files(spark):
    path = working_folder(spark, "ledger")
    ledger = RunLedger(spark, f"{path}/runs")
    spark.range(2).write.json(f"{path}/files")
    with ledger.run("job", lag=dt.timedelta(hours=1)) as run:
        assert read_unprocessed(run, spark, f"{path}/files", "id bigint").isEmpty()
    with ledger.run("job") as run:
        assert read_unprocessed(run, spark, f"{path}/files", "id bigint").count() == 2


def test_files_chosen_by_time(spark, rows):
    path = working_folder(spark, "raw")
    for n, stamp in ((1, 1_700_000_000), (2, 1_700_000_100), (3, 1_700_000_200)):
        spark.range(n, n + 1).coalesce(1).write.mode("append").json(f"{path}/{n}")
        for name in os.listdir(local(f"{path}/{n}")):
            os.utime(f"{local(path)}/{n}/{name}", (stamp, stamp))

    def moment(seconds):
        return dt.datetime.fromtimestamp(seconds, dt.UTC)

    folders = [f"{path}/{n}" for n in (1, 2, 3)]
    got = read_raw(spark, folders, "id bigint", since=moment(1_700_000_100), until=moment(1_700_000_200))
    assert rows(got) == [(2,)]


def test_files_outside_the_range_are_not_opened(spark, rows):
    path = working_folder(spark, "raw")
    spark.range(1).coalesce(1).write.parquet(path)
    broken = f"{local(path)}/part-broken.parquet"
    with open(broken, "wb") as file:
        file.write(b"this is no such file")
    os.utime(broken, (1_700_000_000, 1_700_000_000))
    since = dt.datetime.fromtimestamp(1_700_000_001, dt.UTC)
    assert rows(read_raw(spark, path, "id bigint", "parquet", since=since)) == [(0,)]
    with pytest.raises(Exception):
        read_raw(spark, path, "id bigint", "parquet").collect()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_replay_first_in_end_out(spark, rows, plan, kind):
    ledger = RunLedger(spark, working_folder(spark, "ledger"))
    for day in (1, 2, 3):
        ledger.record("job", dt.datetime(2024, 1, day, tzinfo=dt.UTC), run_id=f"r{day}")
    times = ["2023-12-31 23:59:59.999999", "2024-01-01 00:00:00", "2024-01-02 23:59:59.999999", "2024-01-03 00:00:00"]
    path = working_folder(spark, "rows")
    spark.createDataFrame([(t,) for t in times], "t string").selectExpr(
        "t", f"cast(t as {kind}) as at"
    ).write.parquet(path)
    got = replay_range(spark.read.parquet(path), ledger, "job", "r1", "r3", "at")
    assert rows(got, "t") == [(times[1],), (times[2],)]
    assert "GreaterThanOrEqual(at" in plan(got)
    with pytest.raises(KeyError):
        replay_range(spark.read.parquet(path), ledger, "job", "r1", "r9", "at")


def test_unprocessed_rows(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    done = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert rows(unprocessed(df, done, ["id"])) == [(None,), (2,), (2,)]


# -- streaming -------------------------------------------------------------------------

PERSON = "id int, email string"
EVENT = f"before struct<{PERSON}>, after struct<{PERSON}>, ts_ms bigint"


def test_state_from_a_growing_folder(spark, rows):
    path = working_folder(spark, "stream")

    def arrive(*events):
        if events:
            frame = spark.createDataFrame(events, EVENT)
            frame.coalesce(1).write.mode("append").parquet(f"{path}/in")
        return current_state_incremental(
            spark, f"{path}/in", EVENT, f"{path}/state", f"{path}/checkpoint",
            keys=["id"], order=["_as_of"], deleted="_deleted", transform=flatten_changes,
        )

    assert arrive((None, (1, "a"), 10), (None, (2, "b"), 10)) == 0
    assert arrive(((1, "a"), None, 30), ((2, "b"), (2, "c"), 20)) == 1
    assert arrive(((1, "a"), (1, "late"), 20)) == 2  # older than the delete
    assert arrive() == 2
    assert rows(read_state(spark, f"{path}/state", "_deleted"), "id", "email") == [(2, "c")]


def test_state_in_buckets(spark, rows):
    path = working_folder(spark, "stream")

    def arrive(*events):
        spark.createDataFrame(events, EVENT).coalesce(1).write.mode("append").parquet(f"{path}/in")
        current_state_partitioned(
            spark, f"{path}/in", EVENT, f"{path}/state", f"{path}/checkpoint",
            keys=["id"], order=["_as_of"], deleted="_deleted", transform=flatten_changes, buckets=3,
        )

    arrive(*[(None, (n, "first"), 10) for n in range(9)])
    folders = {name: set(os.listdir(f"{local(path)}/state/{name}")) for name in os.listdir(f"{local(path)}/state") if "=" in name}
    arrive(((1, "first"), None, 30))
    after = {name: set(os.listdir(f"{local(path)}/state/{name}")) for name in folders}
    assert sum(folders[name] != after[name] for name in folders) == 1
    arrive((None, (1, "late"), 20))
    state = spark.read.parquet(f"{path}/state").filter("not _deleted")
    assert rows(state, "id") == [(n,) for n in range(9) if n != 1]


def test_failed_batch_comes_again_under_its_number(spark):
    path = working_folder(spark, "stream")
    spark.range(3).write.parquet(f"{path}/in")
    calls = []

    def handle(batch, number):
        calls.append((number, batch.count()))
        if len(calls) == 1:
            raise InterruptedError("fails once")

    def go():
        process_new_files(spark, f"{path}/in", "id bigint", f"{path}/checkpoint", handle)

    with pytest.raises(Exception, match="fails once"):
        go()
    go()
    go()
    assert calls == [(0, 3), (0, 3)]


def test_apply_changes_job(spark, rows):
    path = working_folder(spark, "state")
    born = spark.createDataFrame([(None, (1, "a"), 10), (None, (2, "b"), 10)], EVENT)
    died = spark.createDataFrame([((1, "a"), None, 20)], EVENT)
    assert apply_changes(born, path, keys=["id"]).count() == 2
    for _ in range(2):
        assert rows(apply_changes(died, path, keys=["id"]), "id") == [(2,)]
    assert rows(apply_changes(born, path, keys=["id"]), "id") == [(2,)]


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured or spark.sparkContext.getCheckpointDir())


def test_empty_mark_is_no_version(spark, rows):
    path = working_folder(spark, "snap")
    publish_snapshot(spark.range(1), path)
    spark.range(9).write.parquet(version_path(path, 1))
    open(f"{local(version_path(path, 1))}/_PUBLISHED", "w").close()  # the driver died between
    assert latest_version(spark, path) == 0
    assert publish_snapshot(spark.range(2), path, version=1, label="again") == 1
    assert rows(read_snapshot(spark, path)) == [(0,), (1,)]
    assert labelled_version(spark, path, "again") == 1 and labelled_version(spark, path, "other") is None
    assert not [n for n in os.listdir(local(version_path(path, 1))) if n.startswith("._PUB") and not n.endswith(".crc")]


def test_new_checkpoint_over_an_older_state(spark, rows):
    """A state begun by a job, then a stream, then a stream with a new checkpoint: no batch is dropped."""
    path = working_folder(spark, "stream")
    apply_changes(spark.createDataFrame([(None, (1, "a"), 10)], EVENT), f"{path}/state", keys=["id"])

    def arrive(number, *events):
        spark.createDataFrame(events, EVENT).coalesce(1).write.mode("append").parquet(f"{path}/in{number}")
        return current_state_incremental(
            spark, f"{path}/in{number}", EVENT, f"{path}/state", f"{path}/checkpoint{number}",
            keys=["id"], order=["_as_of"], deleted="_deleted", transform=flatten_changes,
        )

    assert arrive(1, (None, (2, "b"), 20)) == 1
    assert arrive(1, (None, (3, "c"), 20)) == 2
    assert arrive(2, (None, (4, "d"), 20)) == 3
    assert rows(read_state(spark, f"{path}/state", "_deleted"), "id") == [(1,), (2,), (3,), (4,)]


def test_another_number_of_buckets_is_refused(spark):
    path = working_folder(spark, "stream")

    def arrive(buckets, key):
        spark.createDataFrame([(None, (key, "x"), 10)], EVENT).coalesce(1).write.mode("append").parquet(f"{path}/in")
        current_state_partitioned(
            spark, f"{path}/in", EVENT, f"{path}/state", f"{path}/checkpoint",
            keys=["id"], order=["_as_of"], deleted="_deleted", transform=flatten_changes, buckets=buckets,
        )

    arrive(3, 1)
    with pytest.raises(ValueError, match="3 buckets"):
        arrive(4, 2)
    arrive(3, 3)
    assert spark.read.parquet(f"{path}/state").count() == 3


def state_table(spark, path, *stored):
    columns = "id int, v int, extra string, gone boolean, p string"
    spark.createDataFrame(stored, columns).write.partitionBy("p").parquet(path)
    return columns


def test_merge_keeps_the_columns_of_the_table(spark, rows):
    path = working_folder(spark, "parts")
    columns = state_table(spark, path, (1, 1, "kept", False, "a"), (2, 1, "kept", False, "b"))
    how = {"keys": ["id"], "order": ["v"], "deleted": "gone"}
    less = spark.createDataFrame([(1, 2, False, "a"), (3, 1, False, "a")], "id int, v int, gone boolean, p string")
    with pytest.raises(ValueError, match="extra"):
        merge_partitions(less, path, "p", **how)
    with pytest.raises(ValueError, match="'v'"):
        merge_partitions(spark.createDataFrame([(1, "2", "x", False, "a")], columns.replace("v int", "v string")), path, "p", **how)
    merge_partitions(less, path, "p", evolve=True, **how)
    merge_partitions(less.withColumns({"v": F.lit(9), "more": F.lit(1), "extra": F.lit("e")}), path, "p", evolve=True, **how)
    table = spark.read.option("mergeSchema", "true").parquet(path)
    assert rows(table, "id", "v", "extra", "more") == [(1, 9, "e", 1), (2, 1, "kept", None), (3, 9, "e", 1)]


def test_moved_key_is_refused(spark):
    path = working_folder(spark, "parts")
    columns = state_table(spark, path, (1, 1, "x", False, "a"), (2, 1, "x", False, "b"))
    how = {"keys": ["id"], "order": ["v"], "deleted": "gone"}
    with pytest.raises(ValueError, match="another partition"):
        merge_partitions(spark.createDataFrame([(1, 2, "x", False, "b")], columns), path, "p", **how)
    with pytest.raises(ValueError, match="several partitions"):
        merge_partitions(spark.createDataFrame([(7, 2, "x", False, "b"), (7, 3, "x", False, "c")], columns), path, "p", **how)
    assert spark.read.parquet(path).count() == 2


def test_patched_rows_are_not_shuffled(spark, monkeypatch, plan):
    path = working_folder(spark, "parts")
    columns = state_table(spark, path, *[(i, 1, "x", False, "ab"[i % 2]) for i in range(50)])
    plans = []
    from strata.plans import jobs

    def seen(df, *args, in_place=None, **how):
        plans.append((plan(df), plan(in_place)))
        return rebuild_partitions(df, *args, in_place=in_place, **how)

    monkeypatch.setattr(jobs, "rebuild_partitions", seen)
    merge_partitions(spark.createDataFrame([(2, 2, "y", False, "a"), (90, 1, "y", False, "a")], columns), path, "p", keys=["id"], order=["v"], deleted="gone")
    (_, placed), = plans
    assert "Exchange hashpartitioning" not in placed and "REBALANCE" not in placed
    table = spark.read.parquet(path)
    assert table.count() == 51 and table.filter("extra = 'y'").count() == 2


def test_partitions_of_several_columns(spark, rows):
    path = working_folder(spark, "parts")
    df = spark.createDataFrame([(1, 1997, "a"), (2, 1997, None), (3, 1998, "a"), (4, 1998, "b/c")], "id int, y int, p string")
    df.write.partitionBy("y", "p").parquet(path)
    new = df.filter("id in (2, 4)").withColumn("id", F.col("id") * 10)
    assert rebuild_partitions(new, path, ["y", "p"], [(1997, None), (1998, "a"), (1998, "b/c")]) == [(1998, "a")]
    assert rows(spark.read.parquet(path), "id") == [(1,), (20,), (40,)]
    touched = merge_partitions(
        spark.createDataFrame([(1, 1997, "a", 5), (9, 1999, "z", 1)], "id int, y int, p string, v int").withColumn("gone", F.lit(False)),
        working_folder(spark, "other"), ["y", "p"], keys=["id"], order=["v"], deleted="gone",
    )
    assert sorted(touched) == [(1997, "a"), (1999, "z")]
    name = "two_" + path[-12:]
    spark.sql(f"create table {name} (id int, y int, p string) using parquet partitioned by (y, p) location '{path}/t'")
    df.write.insertInto(name)
    assert swap_table_partitions(new, name, ["y", "p"], [(1997, None), (1998, "a")], f"{path}/r1") == [(1998, "a")]
    assert rows(spark.table(name), "id") == [(1,), (4,), (20,)]
    assert rebuild_table_partitions(df.filter("id = 0"), name, ["y", "p"], [(1997, None)]) == [(1997, None)]
    assert rows(spark.table(name), "id") == [(1,), (4,)]


def test_rebuild_empties_a_partition_that_was_switched(spark, rows):
    path = working_folder(spark, "parts")
    name = "years_" + path[-12:]
    spark.sql(f"create table {name} (id int, y int) using parquet partitioned by (y) location '{path}/t'")
    years(spark).write.insertInto(name)
    swap_table_partitions(spark.table(name), name, "y", [1997, 1998], f"{path}/r/1")
    assert rebuild_table_partitions(rebuilt(spark.table(name)), name, "y", [1997, 1998]) == [1998]
    assert rows(spark.table(name)) == [(4, 1999), (10, 1997), (20, 1997)]


def test_swapped_folders_are_purged(spark, rows):
    path = working_folder(spark, "parts")
    name = "years_" + path[-12:]
    spark.sql(f"create table {name} (id int, y int) using parquet partitioned by (y) location '{path}/t'")
    years(spark).write.insertInto(name)
    swap_table_partitions(spark.table(name), name, "y", [1997, 1998], f"{path}/r/1")
    swap_table_partitions(spark.table(name), name, "y", [1998], f"{path}/r/2")
    before = rows(spark.table(name))
    assert [f.rsplit("/", 2)[1:] for f in purge_swapped(spark, name, f"{path}/r")] == [["1", "y=1998"]]
    swap_table_partitions(spark.table(name), name, "y", [1997], f"{path}/r/3")
    assert len(purge_swapped(spark, name, f"{path}/r")) == 1
    assert sorted(os.listdir(f"{local(path)}/r")) == ["2", "3"]
    assert purge_swapped(spark, name, f"{path}/r") == [] and rows(spark.table(name)) == before


def test_replay_goes_by_what_runs_have_read(spark):
    path = working_folder(spark, "replay")
    ledger = RunLedger(spark, f"{path}/runs")
    start = 1_700_000_000
    for n, hours in enumerate((0, 2, 4)):
        spark.range(n, n + 1).coalesce(1).write.mode("append").json(f"{path}/files/{n}")
        for name in os.listdir(f"{local(path)}/files/{n}"):
            os.utime(f"{local(path)}/files/{n}/{name}", (start + 3600 * hours,) * 2)
    hour = lambda n: dt.datetime.fromtimestamp(start + 3600 * n, dt.UTC)
    # Runs at one, three and five hours read with a lag of one hour and a half.
    for n in (1, 3, 5):
        ledger.record("job", hour(n), hour(n - 1.5), run_id=f"r{n}")
    folders = [f"{path}/files/{n}" for n in range(3)]
    got = lambda a, b: sorted(r[0] for r in replay_files(ledger, "job", a, b, folders, "id bigint").collect())
    assert got("r1", "r3") == [0] and got("r3", "r5") == [1]


def test_no_time_limit_by_default(spark):
    import inspect

    for function in (process_new_files, current_state_incremental, current_state_partitioned):
        assert inspect.signature(function).parameters["timeout"].default is None

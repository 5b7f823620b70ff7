import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import (
    Enrichment,
    GrainError,
    array_filter,
    assert_grain,
    attach_nested,
    bronze_to_silver,
    build_product,
    grain_check,
    grain_coverage,
    load_typed_table,
    lookup_join,
    nest_attribute,
    parse_date,
    product_rollup,
    read_snapshot,
    route,
    standardize,
    wide_product,
    working_folder,
)
from strata.plans.sizing import (
    Bound,
    planned_bytes,
    scanned_bytes,
    sized_for,
    task_sizes,
    within,
)
from strata.plans.skew import hot_keys

BOOK = "title string, publish_date string, author string"
AUTHOR = "name string, id bigint, birth_date string"
MOMO = ("Momo", "1973-01-01", "Michael Ende")
EMIL = ("Emil und die Detektive", "1929-10-15", "Erich Kästner")


def books(spark, *rows):
    return spark.createDataFrame(rows, BOOK)


def authors(spark, *rows):
    return spark.createDataFrame(rows, AUTHOR)


def test_standardize(spark, rows):
    out = standardize(
        books(spark, MOMO, ("Untitled", "soon", None)),
        {"title": "title", "publish_date": "publish_date", "author_name": "author"},
        {"publish_date": "yyyy-MM-dd"},
    )
    assert out.dtypes == [("title", "string"), ("publish_date", "date"), ("author_name", "string")]
    assert rows(out) == [
        ("Momo", dt.date(1973, 1, 1), "Michael Ende"),
        ("Untitled", None, None),
    ]


def test_strict_dates_raise(spark):
    with pytest.raises(Exception, match="(?i)date|pars"):
        books(spark, ("x", "soon", None)).select(parse_date(F.col("publish_date"), strict=True)).collect()


def product(spark, known, **more):
    raw = wide_product(
        books(spark, MOMO, EMIL),
        [
            Enrichment(
                known, {"author": "name"}, {"author_birth_date": parse_date(F.col("birth_date")), "author_id": "id"},
                **more,
            )
        ],
    )
    return raw.select("title", "author", "author_birth_date", "author_id")


@pytest.mark.parametrize("split_hot", [False, True])
def test_matched_and_unmatched(spark, rows, split_hot):
    got = rows(product(spark, authors(spark, ("Michael Ende", 7, "1929-11-12")), split_hot=split_hot))
    assert got == [
        ("Emil und die Detektive", "Erich Kästner", None, None),
        ("Momo", "Michael Ende", dt.date(1929, 11, 12), 7),
    ]


def test_repeated_lookup_key(spark):
    twice = authors(spark, ("Erich Kästner", 1, None), ("Erich Kästner", 2, None))
    with pytest.raises(GrainError, match="Erich Kästner"):
        product(spark, twice)
    assert product(spark, twice, unique=False).count() == 3


def test_chain_on_added_columns(spark, rows):
    base = spark.range(4).selectExpr("id", "if(id = 3, null, id % 2) as a")
    first = spark.createDataFrame([(0, 10), (1, 11)], "a bigint, b bigint")
    second = spark.createDataFrame([(11, "eleven")], "b bigint, c string")
    for split in (None, True):
        out = wide_product(
            base,
            [
                Enrichment(first, {"a": "a"}, {"b": "b"}, split_hot=split),
                Enrichment(second, {"b": "b"}, {"c": "c"}, split_hot=split),
            ],
        )
        assert rows(out, "id", "b", "c") == [
            (0, 10, None), (1, 11, "eleven"), (2, 10, None), (3, None, None),
        ]


# -- skew ------------------------------------------------------------------------------


def skewed(spark, n=9000):
    """A third of the rows under key 1, a third under null, the rest spread out."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1).cast("long")).when(F.col("id") % 3 == 2, F.col("id"))
    return spark.range(n).select("id", key.alias("k"))


def test_hot_keys_are_found(spark):
    df = skewed(spark)
    hashes = {r[0]: r[1] for r in spark.sql("select 1 as k, xxhash64(1L) union all select null, xxhash64(null)").collect()}
    both = df.withColumn("d", F.col("k").cast("double"))
    found, as_double = hot_keys(both, [["k"], ["d"]])
    assert set(found) == set(hashes.values()) and len(as_double) == 2
    assert all(300 <= salts <= 400 for salts in found.values())  # a third of 1024 shares
    assert hot_keys(spark.range(5000), [["id"]]) == [{}]
    assert hot_keys(spark.range(0), [["id"]]) == [{}]


def test_key_with_one_row_in_three_hundred_is_found(spark):
    df = spark.range(90_000).select(F.when(F.col("id") % 300 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert len(hot_keys(df, [["k"]])[0]) == 1


@pytest.mark.parametrize("how", ["left_outer", "left_semi", "left_anti"])
def test_split_equals_plain_join(spark, rows, plan, how):
    left = skewed(spark)
    right = spark.range(0, 9000, 2).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("v"))
    right = right.unionByName(spark.createDataFrame([(1, 5)], "rk bigint, v bigint"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = lookup_join(left, right, {"k": "rk"}, how)
        text = plan(split)
        # One join over one scan of either side; only the list of hot keys is broadcast.
        assert text.count("SortMergeJoin") == 1 and "__salt" in text
        assert text.count("Range (0, 9000, step=1") == 1
        assert rows(split) == rows(lookup_join(left, right, {"k": "rk"}, how, split_hot=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_split_across_integer_types(spark, plan):
    left = skewed(spark).select("id", F.col("k").cast("int").alias("k"))
    right = spark.range(3000).select(F.col("id").alias("rk"), F.lit("v").alias("v"))
    out = lookup_join(left, right, {"k": "rk"}, split_hot=True)
    assert "__salt" in plan(out)
    plain = lookup_join(left, right, {"k": "rk"}, split_hot=False)
    assert out.filter("v is null").count() == plain.filter("v is null").count()


@pytest.mark.parametrize("kind", ["double", "float", "int"])
def test_split_of_numbers_of_unlike_types(spark, rows, kind):
    left = spark.sql("select * from values (0.0D, 1), (-0.0D, 2), (0.0D, 3), (2.0D, 4), (double('nan'), 5) as t(k, i)")
    right = spark.sql(f"select cast(0 as {kind}) as k, 'zero' as v union all select cast(2 as {kind}), 'two'")
    assert rows(lookup_join(left, right, {"k": "k"}, split_hot=True), "i", "v") == [
        (1, "zero"), (2, "zero"), (3, "zero"), (4, "two"), (5, None),
    ]


def test_no_split_where_text_collates(spark):
    left = spark.sql("select collate('A', 'UTF8_LCASE') as k from range(10)")
    right = spark.sql("select collate('a', 'UTF8_LCASE') as k, 1 as v")
    assert lookup_join(left, right, {"k": "k"}).filter("v = 1").count() == 10
    with pytest.raises(ValueError, match="may differ"):
        lookup_join(left, right, {"k": "k"}, split_hot=True)


def test_null_lookup_keys_do_not_prevent_the_split(spark, plan):
    left = skewed(spark)
    right = spark.range(500).selectExpr("if(id < 400, null, id) as rk", "id as v")
    out = lookup_join(left, right, {"k": "rk"}, split_hot=True)
    assert "__salt" in plan(out)
    assert out.count() == left.count()


def test_lookup_must_not_repeat_a_column(spark):
    left = spark.range(1).selectExpr("id", "1 as v")
    with pytest.raises(ValueError, match="v"):
        lookup_join(left, spark.range(1).selectExpr("id as k", "2 as V"), {"id": "k"})
    assert lookup_join(left, left, {"id": "id"}, "left_semi").columns == ["id", "v"]


def test_wide_lookup_rows_of_hot_keys_are_repeated_not_broadcast(spark, plan):
    left = spark.range(100).selectExpr("1L as k", "'the same row' as t")
    right = spark.createDataFrame([(1, ["x" * 100] * 50)], "rk bigint, v array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(left, right, {"k": "rk"})
        assert "SortMergeJoin" in plan(out) and out.columns == ["k", "t", "v"]
        assert out.filter("v is not null").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_scan_of_the_base_and_no_checkpoint(spark, plan):
    path = working_folder(spark, "base")
    skewed(spark).withColumn("j", F.col("id") % 2).write.parquet(path)
    one = spark.range(500).selectExpr("id as a", "id as x")
    two = spark.range(500).selectExpr("id as b", "id as y")
    out = wide_product(
        spark.read.parquet(path),
        [Enrichment(one, {"k": "a"}, {"x": "x"}, split_hot=True), Enrichment(two, {"j": "b"}, {"y": "y"}, split_hot=True)],
    )
    text = plan(out)
    assert text.count("FileScan parquet") == 1 and "ExistingRDD[id" not in text and "Union" not in text
    assert out.count() == 9000 and out.filter("y is null").count() == 0


def test_measured_bound(spark):
    df = spark.range(10).selectExpr("repeat('x', 100) as s", "array(id) as a")
    assert within(df, Bound(rows=10, bytes=10_000))
    assert not within(df, Bound(rows=9, bytes=10_000))
    assert not within(df, Bound(rows=10, bytes=500))
    assert within(df.limit(0), Bound(rows=0, bytes=0))


def test_task_sizes(spark):
    mb, tb = 2**20, 2**40
    given = (200, 128 * mb, 64 * mb)
    assert task_sizes(10 * mb, *given) == given
    assert task_sizes(tb, *given) == (4096, 128 * mb, 64 * mb)
    assert task_sizes(1000 * tb, *given) == (50_000, 1024 * mb, 512 * mb)
    names = (
        "spark.sql.shuffle.partitions",
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    before = [spark.conf.get(name) for name in names]
    with sized_for(spark.range(2**38)):
        assert int(spark.conf.get(names[0])) == 8192
    assert [spark.conf.get(name) for name in names] == before


def test_scanned_bytes_of_a_join(spark):
    path = working_folder(spark, "sizes")
    spark.range(10_000).write.parquet(path)
    one = spark.read.parquet(path)
    joined = one.join(one.withColumnRenamed("id", "other"), F.col("id") == F.col("other"))
    single = scanned_bytes(one)
    assert 0 < scanned_bytes(joined) <= 2 * single
    assert planned_bytes(joined) > 100 * single
    assert scanned_bytes(one.filter("id > 3").checkpoint()) <= single


# -- grain, arrays, rollups ------------------------------------------------------------


def test_grain(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(grain_check(df, ["a", "b"])) == [(None, 1, 2), (1, 1, 2)]
    assert_grain(df.filter("b = 2"), ["a"])
    with pytest.raises(GrainError):
        assert_grain(df, ["a"])


def test_coverage(spark, rows):
    required = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    present = spark.createDataFrame([(1,), (1,)], "pk int")
    assert rows(grain_coverage(required, present, {"k": "pk"})) == [(2,), (3,)]


def test_nested_arrays(spark, rows):
    children = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, label string")
    assert rows(nest_attribute(children, ["k"], "label")) == [(1, ["a", "b"]), (2, [])]
    assert nest_attribute(children, ["k"], "label", max_values=2).count() == 2
    with pytest.raises(ValueError, match="more than 1 values"):
        nest_attribute(children, ["k"], "label", max_values=1)
    base = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    whole = attach_nested(base, children, {"id": "k"}, "label", "labels")
    assert rows(whole) == [(1, ["a", "b"]), (2, []), (3, [])]
    assert rows(array_filter(whole, "labels", "a"), "id") == [(1,)]


def test_rollup(spark, rows):
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "g string, v int")
    out = product_rollup(df, {"group": "g"}, {"n": F.count("*"), "total": F.sum("v")})
    assert rows(out) == [(None, 1, 3), ("x", 2, 3)]


# -- layers and jobs -------------------------------------------------------------------


def test_silver(spark, rows, plan):
    raw = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, "b", 7)], "id int, kind string, v int")
    assert rows(bronze_to_silver(raw, ["v"], "a", "kind")) == [(1, "a", 5)]
    with pytest.raises(ValueError):
        bronze_to_silver(raw, ["v"], "a")
    path = working_folder(spark, "silver")
    assert route(bronze_to_silver(raw, ["v"]), "kind", path) == 0
    assert route(read_snapshot(spark, path).filter("id < 9"), "kind", path) == 1
    only_b = read_snapshot(spark, path).filter("kind = 'b'")
    assert rows(only_b, "id", "v") == [(3, 7)]
    assert "PartitionFilters: [isnotnull(kind" in plan(only_b)


def test_raw_files_to_typed_table(spark, rows):
    path = working_folder(spark, "job")
    name = "books_" + path[-12:]
    books(spark, MOMO, EMIL).write.json(f"{path}/landing")
    spark.sql(
        f"create table {name} (title string, publish_date date, author_name string)"
        f" using parquet location '{path}/table/v=0'"
    )
    for _ in range(2):
        load_typed_table(
            spark, f"{path}/landing", BOOK,
            {"title": "title", "publish_date": "publish_date", "author_name": "author"},
            {"publish_date": "yyyy-MM-dd"}, name, f"{path}/table",
        )
    assert rows(spark.table(name)) == [
        ("Emil und die Detektive", dt.date(1929, 10, 15), "Erich Kästner"),
        ("Momo", dt.date(1973, 1, 1), "Michael Ende"),
    ]


def test_product_job(spark):
    path = working_folder(spark, "job")
    for _ in range(4):
        build_product(
            books(spark, MOMO), [Enrichment(authors(spark), {"author": "name"}, {"author_id": "id"})], path
        )
    assert read_snapshot(spark, path).count() == 1


def test_hot_keys_of_added_columns_are_split_by_default(spark, rows, plan, monkeypatch):
    from strata.operators import product as module

    base = spark.range(20_000, numPartitions=4).selectExpr("id", "id % 5000 as shop", "id % 7 as other")
    shops = spark.range(4_000).selectExpr("id as s", "if(id % 3 = 0, 1, id + 10) as city", "id % 2 as kind")
    cities = spark.range(6_000).selectExpr("cast(id as int) as c", "id % 900 as land")
    lands = spark.range(900).selectExpr("id as l", "concat('land ', id) as name")
    lookups = [
        Enrichment(shops, {"shop": "s"}, {"city": "city", "kind": "kind"}),
        Enrichment(cities, {"city": "c"}, {"land": "land"}),
        Enrichment(lands, {"land": "l"}, {"land_name": "name"}),
    ]
    seen = []
    found = module.hot_keys_counted
    monkeypatch.setattr(module, "hot_keys_counted", lambda *args: seen.append(found(*args)) or seen[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = wide_product(base, lookups)
        plain = wide_product(base, [Enrichment(i.frame, i.on, i.columns, split_hot=False) for i in lookups])
        text = plan(out)
        assert rows(out) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Shops 0, 3, 6, ... have city 1 (a quarter of all rows), shops from 4,000 on are unknown: no city, no land.
    city, land = seen
    of = lambda kind, x: spark.sql(f"select xxhash64(cast({x} as {kind}))").first()[0]
    exact = base.join(shops, base["shop"] == shops["s"], "left").groupBy("city").count().where("count * 1024 > 20000")
    expected = {of("bigint", "null" if r["city"] is None else r["city"]): -(-r["count"] * 1024 // 20_000) for r in exact.collect()}
    assert city == expected and {of("bigint", 1), of("bigint", "null")} == set(city)
    assert of("bigint", 1) in land and of("bigint", "null") in land
    assert text.count("__salt") > 4 and "NestedLoop" not in text
    nothing = wide_product(base.limit(0), [Enrichment(i.frame, i.on, i.columns, split_hot=True) for i in lookups])
    assert nothing.count() == 0

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import (
    conform,
    conform_losses,
    read_conformed,
    reads_table,
    replace_table,
    resolve_schema,
    schema_from_columns,
    table_schema,
    with_schema,
    working_folder,
    write_conformed,
    writes_table,
)

DECLARED = [
    ("title", "string", T.StringType()),
    ("level", "tinyint", T.ByteType()),
    ("rooms", "smallint", T.ShortType()),
    ("visits", "int", T.IntegerType()),
    ("steps", "bigint", T.LongType()),
    ("opened", "date", T.DateType()),
    ("seen_at", "timestamp", T.TimestampType()),
    ("fees", "decimal(38,2)", T.DecimalType(38, 2)),
    ("owner", "struct<name:string,age:int>", T.StructType().add("name", "string").add("age", "integer")),
    ("scores", "array<int>", T.ArrayType(T.IntegerType())),
    (
        "labels",
        "array<struct<key:string,value:string>>",
        T.ArrayType(T.StructType().add("key", "string").add("value", "string")),
    ),
    # Types that a split on commas and colons cannot read.
    ("price", "struct<amount:decimal(10, 2),in:struct<unit:string>>",
     T.StructType().add("amount", "decimal(10,2)").add("in", T.StructType().add("unit", "string"))),
    ("tags", "map<string,double>", T.MapType(T.StringType(), T.DoubleType())),
    ("flag", "boolean", T.BooleanType()),
]


@pytest.mark.parametrize("name, text, kind", DECLARED)
def test_declared_types(spark, name, text, kind):
    assert schema_from_columns([(name, text)])[name].dataType == kind
    assert schema_from_columns([{"Name": name, "Type": text}]).fieldNames() == [name]
    assert resolve_schema(f"{name} {text}")[name].dataType == kind


def test_bad_type(spark):
    with pytest.raises(Exception, match="(?i)type|parse"):
        schema_from_columns([("x", "no_such_type")])


def test_schema_given_late(spark):
    assert resolve_schema(lambda: "x int") == resolve_schema("x int")
    with pytest.raises(TypeError):
        resolve_schema(17)


def test_widen_prune_reorder(spark, rows):
    df = spark.createDataFrame([(1, "a", 2)], "x int, extra string, y int")
    out = conform(df, "y string, x bigint")
    assert out.dtypes == [("y", "string"), ("x", "bigint")]
    assert rows(out) == [("2", 1)]


def test_only_declared_columns_are_read(spark, plan):
    path = working_folder(spark, "test")
    spark.range(5).selectExpr("id as a", "id as b", "id as c").write.parquet(path)
    text = plan(conform(spark.read.parquet(path), "c int"))
    assert "ReadSchema: struct<c:bigint>" in text


def test_missing_column_fails(spark):
    with pytest.raises(Exception, match="nope"):
        conform(spark.range(1), "nope int").collect()


def test_declared_case_wins(spark):
    assert conform(spark.range(1), "ID int").columns == ["ID"]


def test_nested_leaf(spark, rows):
    df = spark.createDataFrame([(((42,),),)], "s struct<n: struct<v: int>>")
    out = conform(df, "s struct<n: struct<v: bigint>>")
    assert out.dtypes == [("s", "struct<n:struct<v:bigint>>")]
    assert out.first()["s"]["n"]["v"] == 42


def test_arrays_and_maps(spark):
    df = spark.sql("select array(1, 2) as a, map(1, named_struct('p', 1, 'q', 2)) as m")
    out = conform(df, "a array<bigint>, m map<string, struct<q: string, p: int>>")
    assert out.first()["a"] == [1, 2]
    assert out.first()["m"]["1"].asDict() == {"q": "2", "p": 1}


def test_structs_match_by_name(spark):
    df = spark.createDataFrame([((7, "Rex"),)], "pet struct<age: string, name: string>")
    pet = conform(df, "pet struct<name: string, age: int>").first()["pet"]
    assert (pet["name"], pet["age"]) == ("Rex", 7)
    with pytest.raises(ValueError, match="colour"):
        conform(df, "pet struct<colour: string>")


def test_null_struct_stays_null(spark):
    df = spark.createDataFrame([(None,), ((1, None),)], "s struct<a: int, b: int>")
    got = [row["s"] for row in conform(df, "s struct<b: string, a: bigint>").collect()]
    assert got[0] is None
    assert got[1].asDict() == {"b": None, "a": 1}


def test_strict_raises_lenient_counts(spark, rows):
    df = spark.createDataFrame(
        [("1", 1, ["1", "x"]), ("a1", 300, ["y"]), (None, None, None), ("zz", -128, [None])],
        "n string, b int, l array<string>",
    )
    declared = "n int, b tinyint, l array<int>"
    with pytest.raises(Exception, match="does not fit"):
        conform(df, declared).collect()
    got = {tuple(map(str, row)) for row in conform(df, declared, mode="lenient").collect()}
    assert got == {
        ("1", "1", "[1, None]"), ("None", "None", "[None]"), ("None", "None", "None"), ("None", "-128", "[None]"),
    }
    assert rows(conform_losses(df, declared)) == [("b", 1), ("l", 2), ("n", 2)]
    with pytest.raises(ValueError):
        conform(df, declared, mode="loose")


def test_with_schema_reaches_every_frame(spark):
    @with_schema("x string")
    def seen(one, number, *, other):
        return one.dtypes, number, other.dtypes

    frame = spark.sql("select 1 as x, 2 as y")
    assert seen(frame, 3, other=frame) == ([("x", "string")], 3, [("x", "string")])


def _table(spark, schema, **more):
    path = working_folder(spark, "table")
    name = "t_" + path[-12:]
    spark.sql(f"create table {name} ({schema}) using parquet {more.get('by', '')} location '{path}/v=0'")
    return name, path


def test_table_schema_keeps_partition_columns(spark):
    name, _ = _table(spark, "a int, p string", by="partitioned by (p)")
    assert table_schema(spark, name).fieldNames() == ["a", "p"]


def test_write_and_read_conformed(spark, rows):
    name, _ = _table(spark, "title string, publish_date date, price decimal(10,2)")
    raw = spark.createDataFrame([(1, 1.5, "2020-02-03", "t")], "extra int, price double, publish_date string, title string")
    written = write_conformed(raw, name)
    assert written.columns == ["title", "publish_date", "price"]
    assert rows(spark.table(name)) == [("t", dt.date(2020, 2, 3), Decimal("1.50"))]
    assert read_conformed(spark, name, "price string").first()[0] == "1.50"
    write_conformed(raw, name)
    assert spark.table(name).count() == 2
    write_conformed(raw, name, overwrite=True)
    assert spark.table(name).count() == 1


def test_partitioned_table_gets_few_files(spark, rows):
    name, path = _table(spark, "a bigint, p int", by="partitioned by (p)")
    many = spark.range(0, 100, 1, 10).selectExpr("id as a", "id % 2 as p")
    write_conformed(many, name)
    assert spark.table(name).count() == 100
    assert len(spark.table(name).inputFiles()) == 2
    with pytest.raises(ValueError, match="partitioned"):
        replace_table(many, name, path)


def test_replace_table_that_is_read(spark, rows):
    name, path = _table(spark, "x bigint")
    replace_table(spark.range(3).toDF("x"), name, path)
    for _ in range(3):
        replace_table(spark.table(name).selectExpr("x + 1 as x"), name, path)
    assert rows(spark.table(name)) == [(3,), (4,), (5,)]


def test_source_and_sink_decorators(spark, rows):
    source, _ = _table(spark, "x int, y int")
    target, _ = _table(spark, "x bigint")
    spark.sql(f"insert into {source} values (1, 2), (3, 4)")

    @writes_table(target)
    @reads_table(source, "x string")
    def job(frame, suffix):
        assert frame.dtypes == [("x", "string")]
        return frame.selectExpr(f"concat(x, '{suffix}') as x")

    assert rows(job("0")) == [(10,), (30,)]
    assert rows(spark.table(target)) == [(10,), (30,)]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    "given, kind, declared",
    [
        ("300", "int", "tinyint"),
        ("'abc'", "string", "int"),
        ("'2024-13-01'", "string", "date"),
        ("1e30", "double", "bigint"),
        ("123456.7", "double", "decimal(5,2)"),
        ("'abcdef'", "string", "varchar(3)"),
        ("array(1, 300)", "array<int>", "array<tinyint>"),
        ("map('a', 'x')", "map<string,string>", "map<string,int>"),
        ("named_struct('f', 'x')", "struct<f:string>", "struct<f:int>"),
    ],
)
def test_strict_does_not_depend_on_ansi(spark, ansi, given, kind, declared):
    df = spark.sql(f"select cast({given} as {kind}) as x union all select null")
    with pytest.raises(Exception, match="does not fit"):
        conform(df, f"x {declared}").collect()
    assert conform_losses(df, f"x {declared}").first()["lost"] == 1
    assert conform(df.filter("x is null"), f"x {declared}").first()["x"] is None


def test_same_values_with_and_without_ansi(spark, ansi):
    df = spark.sql("select ' 7 ' as a, 3.0d as b, 100 as c, 'abc' as d, timestamp_ntz'2024-01-02 03:04:05' as e")
    row = conform(df, "a int, b int, c tinyint, d varchar(3), e date").first()
    assert tuple(row) == (7, 3, 100, "abc", dt.date(2024, 1, 2))


def test_losses_count_fractions(spark, rows):
    df = spark.sql("select * from values (1.9d, 1.25, 'abcd'), (2.0d, 1.20, 'abc'), (null, null, null) as t(f, m, s)")
    assert rows(conform(df.select("f"), "f int")) == [(None,), (1,), (2,)]
    assert rows(conform_losses(df, "f int, m decimal(9,1), s varchar(3)")) == [("f", 1), ("m", 1), ("s", 1)]


def test_columns_go_to_their_names(spark, rows):
    name, path = _table(spark, "first string, second string")
    df = spark.createDataFrame([("F", "S")], "first string, second string")
    written = write_conformed(df, name, "second string, first string")
    assert written.columns == ["second", "first"]
    assert rows(spark.table(name), "first", "second") == [("F", "S")]

    @writes_table(name, "second string, first string")
    def job():
        return df

    job()
    replace_table(spark.table(name).limit(1), name, path, "second string, first string")
    assert rows(spark.table(name), "first", "second") == [("F", "S")]
    for schema in ("first string", "first string, second string, third string"):
        with pytest.raises(ValueError, match="second|third"):
            write_conformed(df.withColumn("third", F.lit("x")), name, schema)


def test_returned_frame_is_a_read_of_the_table(spark, plan):
    name, _ = _table(spark, "x bigint")
    written = write_conformed(spark.range(3).toDF("x"), name)
    assert "FileScan" in plan(written) and "Range" not in plan(written)

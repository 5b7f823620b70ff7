"""One query per operator, over whole tables.

Dates and decimals leave as text, so that the comparison with SQL results does not
depend on how a client library represents them. Each ``(spark, folder)`` function
returns a frame; those that show a sink write to a fresh working folder and return
what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata as st
from strata.operators.merge import is_live
from strata.plans.sizing import Bound

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT = dt.datetime(2024, 1, 16)
HMAC_KEY = b"a key for tests only"
MASTER_KEYS = {"2023": b"0123456789abcdef" * 2, "2024": b"fedcba9876543210" * 2}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Declared, so that no file is opened to infer a schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "benchmark": "item_id bigint, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _text(*names: str) -> dict:
    return {name: F.col(name).cast("string") for name in names}


# -- merging ---------------------------------------------------------------------------

EVENT_COLUMNS = ["user_id", "ts", "event_id", "event_type", "value"]
EVENT_ORDER = {"keys": ["user_id"], "order": ["ts", "event_id"], "order_is_total": True}


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(*EVENT_COLUMNS)
    return events.withColumn("deleted", F.col("event_type") == "error")


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows from before the split, and from then on."""
    late = F.col("ts") >= F.lit(str(SPLIT)).cast("timestamp_ntz")
    return rows.filter(~late), rows.filter(late)


@query
def merge_latest(spark: SparkSession, folder: str) -> DataFrame:
    existing, incoming = _halves(_versions(spark, folder))
    return st.retain_last(incoming, existing, deleted="deleted", **EVENT_ORDER)


@query
def merge_both_ways(spark: SparkSession, folder: str) -> DataFrame:
    """Changes put into a stored state by a broadcast, and by a join as if they were too many for that."""
    existing, incoming = _halves(_versions(spark, folder))
    settings = {"deleted": "deleted", **EVENT_ORDER}
    state = st.retain_last(existing, keep_tombstones=True, **settings)
    ways = [
        st.retain_last(incoming, state, existing_unique=True, bound=bound, **settings).withColumn("way", F.lit(way))
        for way, bound in (("broadcast", Bound()), ("joined", Bound(rows=0)))
    ]
    return ways[0].unionByName(ways[1])


@query
def merge_missing_flag(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rows know no delete flag, so all of them are live."""
    existing, incoming = _halves(_versions(spark, folder))
    stored = existing.filter(is_live("deleted")).drop("deleted")
    return st.retain_last(incoming, stored, deleted="deleted", **EVENT_ORDER)


@query
def merge_tiebreak(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("gone", F.col("o_orderstatus") == "F")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return st.retain_last(
        orders.filter(urgent),
        orders.filter(~urgent),
        keys=["o_custkey"],
        order=["o_orderdate"],
        deleted="gone",
    )


@query
def merge_null_sort(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    known = orders.withColumn("o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return st.retain_last(known, keys=["o_custkey"], order=["o_orderdate", "o_orderkey"])


@query
def merge_null_flag(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    flag = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    return st.retain_last(
        orders.withColumn("gone", flag),
        keys=["o_custkey"],
        order=["o_orderdate", "o_orderkey"],
        deleted="gone",
    )


@query
def merge_tombstones(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs that get interleaved events; kept tombstones make them equal one run."""
    rows = _versions(spark, folder)
    first = F.col("event_type").isin("error", "purchase", "signup")
    settings = {"deleted": "deleted", "keep_tombstones": True, **EVENT_ORDER}
    state = st.retain_last(rows.filter(first), **settings)
    return st.retain_last(rows.filter(~first), state, **settings)


def _envelopes(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    before = F.struct("user_id", F.concat(F.lit("old "), kind).alias("event_type"), (-F.col("value")).alias("value"))
    after = F.struct("user_id", F.nullif(kind, F.lit("view")).alias("event_type"), "value")
    return events.select(
        F.when(kind != "signup", before).alias("before"),
        F.when(kind != "error", after).alias("after"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        "event_id",
        "ts",
    )


def _as_of_ntz(df: DataFrame) -> DataFrame:
    return df.withColumn("_as_of", F.col("_as_of").cast("timestamp_ntz"))


@query
def flatten_changes_row(spark: SparkSession, folder: str) -> DataFrame:
    return _as_of_ntz(st.flatten_changes(_envelopes(spark, folder), carry=["event_id"]))


@query
def flatten_changes_field(spark: SparkSession, folder: str) -> DataFrame:
    events = _envelopes(spark, folder)
    return _as_of_ntz(st.flatten_changes(events, image="field", carry=["event_id"]))


def _state_run(spark: SparkSession, folder: str, image: str) -> DataFrame:
    early, late = _halves(_envelopes(spark, folder))
    settings = {"keys": ["user_id"], "sequence": ["event_id"], "image": image}
    stored = st.current_state(early, keep_tombstones=True, **settings)
    return _as_of_ntz(st.current_state(late, stored, **settings))


@query
def current_state(spark: SparkSession, folder: str) -> DataFrame:
    return _state_run(spark, folder, "row")


@query
def current_state_field(spark: SparkSession, folder: str) -> DataFrame:
    return _state_run(spark, folder, "field")


@query
def apply_changes(spark: SparkSession, folder: str) -> DataFrame:
    early, late = _halves(_envelopes(spark, folder))
    path = st.working_folder(spark, "state")
    settings = {"keys": ["user_id"], "sequence": ["event_id"]}
    # The younger events come first, so the second run gets only older ones.
    st.apply_changes(late, path, **settings)
    return _as_of_ntz(st.apply_changes(early, path, **settings))


@query
def current_state_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A state begun by a job, continued by a stream, and by another one with a new checkpoint."""
    early, late = _halves(_versions(spark, folder))
    work = st.working_folder(spark, "stream")
    odd = F.col("event_id") % 2 == 1
    first = st.retain_last(late.filter(odd), deleted="deleted", keep_tombstones=True, **EVENT_ORDER)
    st.publish_snapshot(first, f"{work}/state")

    def arrive(part: DataFrame, stream: str) -> int | None:
        part.write.mode("append").parquet(f"{work}/{stream}")
        return st.current_state_incremental(
            spark, f"{work}/{stream}", early.schema, f"{work}/state", f"{work}/checkpoint-{stream}",
            deleted="deleted", **EVENT_ORDER,
        )

    arrive(late.filter(~odd), "one")
    arrive(early.filter(odd), "one")
    arrive(early.filter(~odd), "two")
    return st.read_state(spark, f"{work}/state", "deleted")


def _priced_again(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders by year; and the urgent ones of the last years, with new prices or cancelled."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
        F.lit(1).alias("version"),
        F.lit(False).alias("gone"),
        F.year("o_orderdate").alias("o_year"),
    )
    again = orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_year") >= 1999))
    changes = again.withColumns(
        {
            "o_totalprice": F.col("o_totalprice") * 2,
            "version": F.lit(2),
            "gone": F.col("o_orderstatus") == "F",
        }
    )
    return orders, changes


VERSIONED = {"keys": ["o_orderkey"], "order": ["version"], "deleted": "gone"}


@query
def merge_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Changed orders merged into the years they touch."""
    path = st.working_folder(spark, "merged")
    orders, changes = _priced_again(spark, folder)
    orders.hint("rebalance", "o_year").write.partitionBy("o_year").parquet(path)
    st.merge_partitions(changes, path, "o_year", **VERSIONED)
    merged = spark.read.schema(orders.schema).parquet(path).filter(is_live("gone"))
    return merged.select("o_orderkey", "o_totalprice", "version", "o_year")


@query
def merge_committed(spark: SparkSession, folder: str) -> DataFrame:
    """The same by four jobs at once, each with a part of the changed orders of all touched years."""
    path = st.working_folder(spark, "committed")
    orders, changes = _priced_again(spark, folder)
    st.merge_committed(orders, path, "o_year", **VERSIONED)

    def job(part: int) -> int | None:
        mine = changes.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(4)) == part)
        return st.merge_committed(mine, path, "o_year", follows_key=True, **VERSIONED)

    with ThreadPoolExecutor(4) as jobs:
        list(jobs.map(job, range(4)))
    merged = st.read_version(spark, path).filter(is_live("gone"))
    return merged.select("o_orderkey", "o_totalprice", "version", "o_year")


@query
def merge_table_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The same in a catalog table, whose partitions are switched to new folders."""
    path = st.working_folder(spark, "switched")
    name = "orders_" + path[-12:]
    orders, changes = _priced_again(spark, folder)
    columns = ", ".join(f"{column} {kind}" for column, kind in orders.dtypes)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (o_year) LOCATION '{path}/first'"
    )
    orders.hint("rebalance", "o_year").write.insertInto(name)
    st.merge_table_partitions(changes, name, "o_year", f"{path}/second", **VERSIONED)
    merged = spark.table(name).filter(is_live("gone"))
    return merged.select("o_orderkey", "o_totalprice", "version", "o_year")


@query
def current_state_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    early, late = _halves(_versions(spark, folder))
    work = st.working_folder(spark, "buckets")
    for part in (late, early):
        part.write.mode("append").parquet(f"{work}/landing")
        st.current_state_partitioned(
            spark,
            f"{work}/landing",
            early.schema,
            f"{work}/state",
            f"{work}/checkpoint",
            keys=["user_id"],
            order=["ts", "event_id"],
            deleted="deleted",
            buckets=4,
        )
    state = spark.read.parquet(f"{work}/state")
    return state.filter(is_live("deleted")).select(*EVENT_COLUMNS)


# -- schemas ---------------------------------------------------------------------------

LINE_SCHEMA = (
    "l_orderkey int, l_linenumber bigint, l_quantity int, l_extendedprice decimal(12,2), l_shipdate date"
)


@query
def conform_flat(spark: SparkSession, folder: str) -> DataFrame:
    fitted = st.conform(table(spark, folder, "lineitem"), LINE_SCHEMA)
    return fitted.withColumns(_text("l_extendedprice", "l_shipdate"))


LENIENT_SCHEMA = "o_orderkey tinyint, o_custkey smallint, o_orderstatus int, o_orderdate timestamp_ntz"


@query
def conform_lenient(spark: SparkSession, folder: str) -> DataFrame:
    return st.conform(table(spark, folder, "orders"), LENIENT_SCHEMA, mode="lenient")


@query
def conform_losses(spark: SparkSession, folder: str) -> DataFrame:
    return st.conform_losses(table(spark, folder, "orders"), LENIENT_SCHEMA)


@query
def conform_nested(spark: SparkSession, folder: str) -> DataFrame:
    account = F.struct(
        F.struct("c_custkey", "c_nationkey").alias("ids"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_name").alias("name"),
    )
    customer = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, account).alias("account"),
        F.array(
            F.struct(F.lit("segment").alias("key"), F.col("c_mktsegment").alias("value")),
            F.struct(F.lit("nation").alias("key"), F.col("c_nationkey").cast("string").alias("value")),
        ).alias("tags"),
        F.array("c_nationkey").alias("nations"),
    )
    declared = """
        account struct<name: string, balance: decimal(12,2), ids: struct<c_nationkey: bigint, c_custkey: string>>,
        tags array<struct<value: string, key: string>>, nations array<string>, c_custkey bigint
    """
    fitted = st.conform(customer, declared)
    return fitted.select(
        "c_custkey",
        F.col("account").isNull().alias("no_account"),
        F.col("account.name").alias("name"),
        F.col("account.balance").cast("string").alias("balance"),
        F.col("account.ids.c_nationkey").alias("nation_key"),
        F.col("account.ids.c_custkey").alias("cust_text"),
        F.col("tags")[0]["value"].alias("segment"),
        F.col("tags")[1]["key"].alias("second_key"),
        F.col("nations")[0].alias("nation_text"),
    )


@query
def with_schema(spark: SparkSession, folder: str) -> DataFrame:
    @st.with_schema("o_custkey int, o_totalprice decimal(14,2)")
    def spend(orders: DataFrame) -> DataFrame:
        return orders.groupBy("o_custkey").agg(F.sum("o_totalprice").cast("string").alias("spend"))

    return spend(table(spark, folder, "orders"))


@query
def write_conformed(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table written from one table and read back through its declared schema."""
    path = st.working_folder(spark, "lines")
    name = "lines_" + path[-12:]
    spark.sql(f"CREATE TABLE {name} ({LINE_SCHEMA}) USING parquet LOCATION '{path}/rows'")
    # The columns go to their names, not to their places.
    shuffled = "l_shipdate date, l_quantity int, l_extendedprice decimal(12,2), l_orderkey int, l_linenumber bigint"
    st.write_conformed(table(spark, folder, "lineitem"), name, shuffled)
    declared = "l_shipdate string, l_orderkey bigint, l_extendedprice string"
    return st.read_conformed(spark, name, declared)


@query
def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table replaced twice, the second time by a frame that reads it."""
    path = st.working_folder(spark, "balances")
    name = "balances_" + path[-12:]
    spark.sql(f"CREATE TABLE {name} (c_custkey bigint, c_acctbal double) USING parquet LOCATION '{path}/v=0'")
    st.replace_table(table(spark, folder, "customer"), name, path)
    positive = spark.table(name).filter("c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    st.replace_table(positive, name, path)
    return spark.table(name)


# -- typed tables and products ---------------------------------------------------------


def _dated_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


@query
def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    path = st.working_folder(spark, "raw")
    table(spark, folder, "orders").write.json(path)
    schema = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_clerk string"
    return st.read_raw(spark, path, schema)


@query
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    raw = _dated_text(table(spark, folder, "orders"), "o_orderdate")
    spoiled = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_orderdate"))
    raw = raw.withColumn("o_orderdate", spoiled)
    columns = {"order_id": "o_orderkey", "placed_on": "o_orderdate", "customer_id": "o_custkey"}
    typed = st.standardize(raw, columns, {"placed_on": "yyyy-MM-dd"})
    return typed.withColumns(_text("placed_on"))


@query
def load_typed_table(spark: SparkSession, folder: str) -> DataFrame:
    path = st.working_folder(spark, "typed")
    name = "typed_" + path[-12:]
    raw = _dated_text(table(spark, folder, "orders"), "o_orderdate")
    raw.write.json(f"{path}/landing")
    spark.sql(
        f"CREATE TABLE {name} (order_id bigint, placed_on date, customer_id bigint)"
        f" USING parquet LOCATION '{path}/rows/v=0'"
    )
    st.load_typed_table(
        spark,
        f"{path}/landing",
        "o_orderkey string, o_orderdate string, o_custkey string",
        {"order_id": "o_orderkey", "placed_on": "o_orderdate", "customer_id": "o_custkey"},
        {"placed_on": "yyyy-MM-dd"},
        name,
        f"{path}/rows",
    )
    return spark.table(name).withColumns(_text("placed_on"))


def _product(spark: SparkSession, folder: str) -> DataFrame:
    """All orders; some of them are of customers that the base table has but the lookup lacks."""
    orders = table(spark, folder, "orders")
    unknown = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).otherwise(-1 - F.col("o_custkey"))
    return st.wide_product(
        orders.withColumn("o_custkey", unknown),
        [
            st.Enrichment(
                table(spark, folder, "customer"),
                {"o_custkey": "c_custkey"},
                {"customer_name": "c_name", "nation_key": "c_nationkey"},
            ),
            st.Enrichment(
                table(spark, folder, "nation"),
                {"nation_key": "n_nationkey"},
                {"nation": "n_name", "region_key": "n_regionkey"},
            ),
            st.Enrichment(
                table(spark, folder, "region"), {"region_key": "r_regionkey"}, {"region": "r_name"}
            ),
        ],
    )


@query
def wide_product(spark: SparkSession, folder: str) -> DataFrame:
    return _product(spark, folder).select(
        "o_orderkey", "o_totalprice", "customer_name", "nation", "region"
    )


@query
def wide_product_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken when the looked-up side is too large to broadcast: one user has one event in 300."""
    customer = table(spark, folder, "customer")
    busy = F.when(F.col("event_id") % 300 == 0, F.lit(1).cast("long")).otherwise(F.col("user_id"))
    return st.wide_product(
        table(spark, folder, "events").select("event_id", busy.alias("user_id"), "event_type"),
        [
            st.Enrichment(
                customer,
                {"user_id": "c_custkey"},
                {"customer_name": "c_name", "nation_key": "c_nationkey"},
                split_hot=True,
            ),
            st.Enrichment(
                table(spark, folder, "nation"),
                {"nation_key": "n_nationkey"},
                {"nation": "n_name"},
                split_hot=True,
            ),
        ],
    ).drop("nation_key")


@query
def build_product(spark: SparkSession, folder: str) -> DataFrame:
    path = st.working_folder(spark, "product")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    part = st.Enrichment(
        table(spark, folder, "part"), {"l_partkey": "p_partkey"}, {"part": "p_name", "brand": "p_brand"}
    )
    supplier = st.Enrichment(
        table(spark, folder, "supplier"), {"l_suppkey": "s_suppkey"}, {"supplier": "s_name"}
    )
    st.build_product(lines, [part, supplier], path)
    return st.read_snapshot(spark, path)


@query
def grain_check(spark: SparkSession, folder: str) -> DataFrame:
    return st.grain_check(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def grain_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive by day of the month: users and types that come again in a later append."""
    keys = ["user_id", "event_type", "hour"]
    events = table(spark, folder, "events").select("user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"), "value")
    path = st.working_folder(spark, "appends")
    day = F.dayofmonth("hour")
    for part in (events.filter(day < 12), events.filter((day >= 12) & (day < 24)), events.filter(day >= 24), events.filter(day == 3)):
        st.publish_append(part, path, keys)
    return st.grain_violations(spark, path, keys)


@query
def grain_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return st.grain_coverage(
        table(spark, folder, "orders"), table(spark, folder, "lineitem"), {"o_orderkey": "l_orderkey"}
    )


@query
def nest_attribute(spark: SparkSession, folder: str) -> DataFrame:
    nested = st.nest_attribute(table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority", "labels")
    return nested.withColumn("labels", F.array_join("labels", "|"))


@query
def attach_nested(spark: SparkSession, folder: str) -> DataFrame:
    """All lines by order; an order of status P is looked up under a key that no line has."""
    orders = table(spark, folder, "orders")
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).otherwise(-1 - F.col("o_orderkey"))
    product = st.attach_nested(
        orders.select(key.alias("o_orderkey"), "o_orderstatus"),
        table(spark, folder, "lineitem"),
        {"o_orderkey": "l_orderkey"},
        "l_partkey",
        "parts",
    )
    return product.withColumn("parts", F.array_join(F.col("parts").cast("array<string>"), "|"))


@query
def array_filter(spark: SparkSession, folder: str) -> DataFrame:
    nested = st.nest_attribute(table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority", "labels")
    return st.array_filter(nested, "labels", "1-URGENT").select(
        "o_custkey", F.size("labels").alias("n_labels")
    )


@query
def product_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rolled = st.product_rollup(
        _product(spark, folder),
        {"region": "region", "month": st.period_of(F.col("o_orderdate"))},
        {
            "n_orders": F.count(F.lit(1)),
            "revenue": F.sum(F.col("o_totalprice").cast("decimal(18,2)")),
        },
    )
    return rolled.withColumns(_text("month", "revenue"))


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "event_type", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k")
    )


@query
def bronze_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    silver = st.bronze_to_silver(_bronze(spark, folder), ["k", "user_id"], "click", "event_type")
    return silver.drop("event_type")


@query
def route(spark: SparkSession, folder: str) -> DataFrame:
    path = st.working_folder(spark, "silver")
    st.route(st.bronze_to_silver(_bronze(spark, folder), ["k", "user_id"]), "event_type", path)
    return st.read_snapshot(spark, path)


# -- point in time ---------------------------------------------------------------------

PIT = {"keys": ["o_custkey"], "order": ["o_orderdate", "o_orderkey"], "order_is_total": True}
PIT_COLUMNS = ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"]


def _order_changes(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select(*PIT_COLUMNS, (F.col("o_orderstatus") == "F").alias("gone"), "o_orderpriority")


def _last_month(changes: DataFrame) -> dt.date:
    return changes.agg(F.trunc(F.max("o_orderdate"), "month").alias("last")).first()["last"]


def _two_months_after(spark: SparkSession, month: dt.date) -> dt.date:
    return spark.range(1).select(F.add_months(F.lit(month), 2)).first()[0]


def _is_late() -> Column:
    recent = F.col("o_orderdate") >= F.lit("2000-06-01").cast("timestamp_ntz")
    return recent & (F.col("o_orderpriority") == "1-URGENT")


@query
def affected_partitions(spark: SparkSession, folder: str) -> DataFrame:
    late = _order_changes(spark, folder).filter(_is_late())
    return st.affected_partitions(late, "o_orderdate").withColumns(_text("period"))


@query
def pit_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    changes = _order_changes(spark, folder).drop("o_orderpriority")
    snapshots = st.pit_snapshots(changes, upto=_last_month(changes), deleted="gone", **PIT)
    return snapshots.withColumns(_text("period"))


@query
def pit_partition(spark: SparkSession, folder: str) -> DataFrame:
    changes = _order_changes(spark, folder).drop("o_orderpriority")
    day = F.col("o_orderdate").cast("date")
    old = changes.filter(day < "2000-01-01")
    middle = changes.filter((day >= "2000-01-01") & (day < "2001-01-01"))
    new = changes.filter(day >= "2001-01-01")
    kept = {"deleted": "gone", "keep_tombstones": True, **PIT}
    return st.pit_partition(
        new, st.retain_last(old, **kept), st.retain_last(middle, **kept), deleted="gone", **PIT
    )


def _stored_snapshots(spark: SparkSession, changes: DataFrame, upto: dt.date) -> DataFrame:
    """Snapshots written by an earlier run, one folder per month."""
    path = st.working_folder(spark, "snapshots")
    snapshots = st.pit_snapshots(changes, upto=upto, deleted="gone", keep_tombstones=True, **PIT)
    st.publish_snapshot(snapshots, path, partition_by=["period"])
    return st.read_snapshot(spark, path)


@query
def snapshot_at(spark: SparkSession, folder: str) -> DataFrame:
    changes = _order_changes(spark, folder).drop("o_orderpriority")
    stored = _stored_snapshots(spark, changes, _last_month(changes))
    return st.snapshot_at(stored, dt.date(1999, 5, 17), deleted="gone")


@query
def roll_forward(spark: SparkSession, folder: str) -> DataFrame:
    """Late rows merged into stored months, which also gain all months up to two quiet ones."""
    changes = _order_changes(spark, folder)
    month = dt.date(2001, 3, 1)
    known = ~_is_late() & (F.col("o_orderdate").cast("date") < "2001-04-01")
    stored = _stored_snapshots(spark, changes.filter(known).drop("o_orderpriority"), month)
    rolled = st.roll_forward(
        stored,
        changes.filter(~known).drop("o_orderpriority"),
        stored_upto=month,
        upto=_two_months_after(spark, _last_month(changes)),
        deleted="gone",
        keep_tombstones=False,
        **PIT,
    )
    return rolled.select(*PIT_COLUMNS, F.col("period").cast("string"))


@query
def roll_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot table in four runs: a gap of months, then late rows for it, then no rows at all."""
    path = st.working_folder(spark, "rolled")
    changes = _order_changes(spark, folder)
    last = _last_month(changes)
    late, day = _is_late(), F.col("o_orderdate").cast("date")
    old, new = day < "2001-01-01", day >= "2001-04-01"
    settings = {**PIT, "deleted": "gone"}
    runs = [
        (changes.filter(old & ~late), dt.date(2000, 12, 1)),
        (changes.filter(new & ~late), last),
        (changes.filter(late | ~(old | new)), last),
        (changes.limit(0), _two_months_after(spark, last)),
    ]
    for rows, upto in runs:
        st.roll_snapshots(rows.drop("o_orderpriority"), path, upto, **settings)
    return _live_snapshots(spark, path)


def _live_snapshots(spark: SparkSession, path: str) -> DataFrame:
    columns = "o_custkey long, o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double"
    table = spark.read.schema(f"{columns}, gone boolean, period date").parquet(path)
    return table.filter(is_live("gone")).select(*PIT_COLUMNS, F.col("period").cast("string"))


@query
def load_period(spark: SparkSession, folder: str) -> DataFrame:
    """Years loaded one after the other, each from its own orders and the year before."""
    path = st.working_folder(spark, "yearly")
    changes = _order_changes(spark, folder).drop("o_orderpriority")
    years = changes.select(F.year("o_orderdate").alias("y")).distinct().collect()
    for year in sorted(row["y"] for row in years):
        if year == 1998:  # a run that did not happen: its orders come with the next one
            continue
        known = (F.year("o_orderdate") == year) | ((F.year("o_orderdate") == 1998) & F.lit(year == 1999))
        st.load_period(
            changes.filter(known),
            path,
            dt.date(year, 7, 1),
            keys=PIT["keys"],
            order=PIT["order"],
            deleted="gone",
            unit="year",
        )
    return _live_snapshots(spark, path)


# -- publishing, rebuilding, reading what is new ---------------------------------------


@query
def publish_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A state merged with itself as target: the second version reads the first."""
    path = st.working_folder(spark, "published")
    early, late = _halves(_versions(spark, folder))
    settings = {"deleted": "deleted", "keep_tombstones": True, **EVENT_ORDER}
    st.publish_snapshot(st.retain_last(early, **settings), path)
    target = st.read_snapshot(spark, path)
    merged = st.retain_last(late, target, existing_unique=True, **settings)
    st.publish_snapshot(merged, path)
    st.purge_versions(spark, path, keep=1)
    return st.read_snapshot(spark, path)


def _rebuilt_years(source: DataFrame) -> DataFrame:
    """1997 with doubled prices; 1998 turns out to be empty."""
    years = source.filter(F.col("o_year").isin(1997, 1998)).filter(F.col("o_year") != 1998)
    return years.withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query
def rebuild_partitions(spark: SparkSession, folder: str) -> DataFrame:
    path = st.working_folder(spark, "years")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    by_year = orders.withColumn("o_year", F.year("o_orderdate"))
    by_year.hint("rebalance", "o_year").write.partitionBy("o_year").parquet(path)
    st.rebuild_partitions(_rebuilt_years(spark.read.parquet(path)), path, "o_year", [1997, 1998])
    return spark.read.parquet(path).drop("o_orderdate")


@query
def reprocess(spark: SparkSession, folder: str) -> DataFrame:
    """Typed events by day, three days of which are built again by corrected code."""
    path = st.working_folder(spark, "days")
    raw = table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    columns = ["event_id", "user_id", "value", "day"]
    raw.select(*columns).hint("rebalance", "day").write.partitionBy("day").parquet(path)

    def corrected(events: DataFrame) -> DataFrame:
        valid = events.filter((F.col("event_type") != "error") & (F.col("day") != "2024-01-04"))
        return valid.withColumn("value", -F.col("value")).select(*columns)

    for _ in range(2):
        st.reprocess(raw, corrected, path, "day", ["2024-01-03", "2024-01-04", "2024-01-05"])
    return spark.read.schema("event_id long, user_id long, value double, day string").parquet(path)


@query
def rebuild_table_partitions(spark: SparkSession, folder: str) -> DataFrame:
    path = st.working_folder(spark, "table-years")
    name = "years_" + path[-12:]
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    spark.sql(
        f"CREATE TABLE {name} (o_orderkey bigint, o_totalprice double, o_year int)"
        f" USING parquet PARTITIONED BY (o_year) LOCATION '{path}'"
    )
    by_year = orders.withColumn("o_year", F.year("o_orderdate")).drop("o_orderdate")
    by_year.hint("rebalance", "o_year").write.insertInto(name)
    st.rebuild_table_partitions(_rebuilt_years(spark.table(name)), name, "o_year", [1997, 1998])
    return spark.table(name)


@query
def read_unprocessed(spark: SparkSession, folder: str) -> DataFrame:
    """Files that landed since the last successful run; a failed run is not remembered."""
    path = st.working_folder(spark, "landing")
    events = table(spark, folder, "events")
    early, late = _halves(events)
    ledger = st.RunLedger(spark, f"{path}/runs")
    schema = events.schema
    early.write.mode("append").parquet(f"{path}/files")
    with ledger.run("ingest") as run:
        st.read_unprocessed(run, spark, f"{path}/files", schema, "parquet").write.parquet(f"{path}/first")
    try:
        with ledger.run("ingest"):
            raise InterruptedError("this run fails")
    except InterruptedError:
        pass
    late.write.mode("append").parquet(f"{path}/files")
    with ledger.run("ingest") as run:
        fresh = st.read_unprocessed(run, spark, f"{path}/files", schema, "parquet")
        fresh.write.parquet(f"{path}/second")
    return spark.read.parquet(f"{path}/second")


@query
def unprocessed(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    early, _ = _halves(events)
    return st.unprocessed(events, early.select("event_id"), ["event_id"])


@query
def replay_range(spark: SparkSession, folder: str) -> DataFrame:
    path = st.working_folder(spark, "ledger")
    ledger = st.RunLedger(spark, path)
    for day in (4, 8, 12):
        ledger.record("daily", dt.datetime(2024, 1, day, 6, tzinfo=dt.UTC), run_id=f"run-{day}")
    return st.replay_range(table(spark, folder, "events"), ledger, "daily", "run-4", "run-8", "ts")


@query
def replay_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that landed between two runs, of three that landed in all."""
    path = st.working_folder(spark, "replay")
    events = table(spark, folder, "events")
    ledger = st.RunLedger(spark, f"{path}/runs")
    kinds = (["click", "view"], ["purchase", "signup"], ["error"])
    for number, chosen in enumerate(kinds):
        with ledger.run("ingest", run_id=f"run-{number}"):
            part = events.filter(F.col("event_type").isin(chosen))
            part.write.mode("append").parquet(f"{path}/files")
    return st.replay_files(
        ledger, "ingest", "run-1", "run-2", f"{path}/files", events.schema, "parquet"
    )


# -- sensitive values ------------------------------------------------------------------


@query
def pii_remove(spark: SparkSession, folder: str) -> DataFrame:
    return st.pii_remove(table(spark, folder, "customer"), ["c_name", "c_acctbal"])


@query
def pii_encrypt(spark: SparkSession, folder: str) -> DataFrame:
    """Encrypted under an old and a new master key, then read with both."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    recent = F.col("c_mktsegment") == "BUILDING"
    parts = [
        st.pii_encrypt(part, ["c_name"], MASTER_KEYS[key_id], key_id)
        for part, key_id in ((customer.filter(recent), "2024"), (customer.filter(~recent), "2023"))
    ]
    sealed = parts[0].unionByName(parts[1]).withColumns(
        {
            "key_id": F.col("c_name.key_id"),
            "sealed_bytes": F.octet_length("c_name.payload"),
        }
    )
    return st.pii_decrypt(sealed, ["c_name"], MASTER_KEYS)


@query
def pii_tokenize(spark: SparkSession, folder: str) -> DataFrame:
    return st.pii_tokenize(table(spark, folder, "customer"), ["c_name"], HMAC_KEY).select(
        "c_custkey", "c_name"
    )


@query
def pii_vault(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of orders' clerks of two runs: the second adds only what is new."""
    path = st.working_folder(spark, "vault")
    orders = table(spark, folder, "orders").select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("label"))
    secret = {"column": "label", "key": HMAC_KEY, "key_id": "2024", "master": MASTER_KEYS["2024"]}
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT").filter(F.col("label") < "1999-01")
    st.vault_additions(urgent, **secret).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    st.vault_additions(orders, vault=stored, **secret).write.mode("append").parquet(path)
    return spark.read.parquet(path).select("token", "key_id")


@query
def pii_detokenize(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type")
    path = st.working_folder(spark, "vault")
    secret = {"column": "event_type", "key": HMAC_KEY, "key_id": "2024", "master": MASTER_KEYS["2024"]}
    st.vault_additions(events, **secret).write.parquet(path)
    tokens = st.pii_tokenize(events, ["event_type"], HMAC_KEY)
    return st.pii_detokenize(
        tokens, "event_type", spark.read.parquet(path), "2024", MASTER_KEYS, split_hot=True
    )


@query
def pii_redact(spark: SparkSession, folder: str) -> DataFrame:
    return st.pii_redact(table(spark, folder, "documents"), ["text"]).select("doc_id", "text")


@query
def pii_redact_known(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the hosts of all nations and without any passage of the benchmark."""
    host = F.concat(F.lit("mail"), F.col("n_nationkey"), F.lit(".example.com"))
    values = table(spark, folder, "nation").select(host.alias("value"))
    values = values.unionByName(table(spark, folder, "benchmark").select(F.col("text").alias("value")))
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return st.pii_redact_known(documents, "text", values, "value")


@query
def pii_scan(spark: SparkSession, folder: str) -> DataFrame:
    return st.pii_scan(table(spark, folder, "documents"), "text", ["lang"])


# -- comparing versions ----------------------------------------------------------------


def _two_editions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    before = orders.filter(F.col("o_orderpriority") != "5-LOW")
    raised = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1)
    unknown = F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderstatus"))
    after = orders.filter(F.col("o_orderstatus") != "P").withColumns(
        {
            "o_totalprice": F.coalesce(raised, F.col("o_totalprice")),
            "o_orderstatus": unknown,
        }
    )
    return before, after


@query
def dataset_diff(spark: SparkSession, folder: str) -> DataFrame:
    before, after = _two_editions(spark, folder)
    return st.dataset_diff(before, after, ["o_orderkey"]).select(
        "o_orderkey",
        "change",
        F.col("before.o_totalprice").alias("old_price"),
        F.col("after.o_totalprice").alias("new_price"),
        F.col("after.o_orderstatus").alias("new_status"),
    )


@query
def multiset_diff(spark: SparkSession, folder: str) -> DataFrame:
    before, after = _two_editions(spark, folder)
    columns = ["o_orderstatus", "o_orderpriority"]
    return st.multiset_diff(before.select(*columns), after.select(*columns))


@query
def dataset_diff_digest(spark: SparkSession, folder: str) -> DataFrame:
    """The same comparison of two published versions, down a tree of digests."""
    before, after = _two_editions(spark, folder)
    path = st.working_folder(spark, "editions")
    for edition in (before, after):
        st.publish_digested(edition, path, ["o_orderkey"], rows_per_leaf=256)
    return st.dataset_diff_digest(spark, path, ["o_orderkey"]).select(
        "o_orderkey",
        "change",
        F.col("before.o_totalprice").alias("old_price"),
        F.col("after.o_totalprice").alias("new_price"),
        F.col("after.o_orderstatus").alias("new_status"),
    )


# -- snapshots from a chain of deltas ----------------------------------------------------

CHAIN = {"keys": ["o_custkey"], "order": ["o_orderdate", "o_orderkey"], "deleted": "gone"}


def _first_month(changes: DataFrame) -> dt.date:
    return changes.agg(F.trunc(F.min("o_orderdate"), "month").alias("first")).first()["first"]


def _stored_chain(spark: SparkSession, chain: DataFrame) -> DataFrame:
    path = st.working_folder(spark, "chain")
    st.publish_snapshot(chain, path, partition_by=["node"])
    return st.read_snapshot(spark, path)


@query
def snapshot_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Every month's snapshot, each from the few nodes that it is made of."""
    changes = _order_changes(spark, folder).drop("o_orderpriority")
    first, last = _first_month(changes), _last_month(changes)
    options = {"origin": first, **CHAIN}
    chain = _stored_chain(spark, st.delta_chain(changes, upto=last, **options))
    return st.snapshots_between(chain, first, last, **options).withColumns(_text("period"))


@query
def roll_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Late rows taken into a stored chain, which also gains all months up to two quiet ones."""
    changes = _order_changes(spark, folder)
    first, month = _first_month(changes), dt.date(2001, 3, 1)
    last = _two_months_after(spark, _last_month(changes))
    options = {"origin": first, **CHAIN}
    known = ~_is_late() & (F.col("o_orderdate").cast("date") < "2001-04-01")
    stored = changes.filter(known).drop("o_orderpriority")
    chain = _stored_chain(spark, st.delta_chain(stored, upto=month, **options))
    late = changes.filter(~known).drop("o_orderpriority")
    rebuilt, touched = st.roll_chain(chain, late, stored_upto=month, upto=last, **options)
    rolled = chain.where(~F.col("node").isin(touched)).unionByName(rebuilt)
    return st.snapshots_between(_stored_chain(spark, rolled), first, last, **options).withColumns(_text("period"))


# -- files that arrive late, attributes at a moment --------------------------------------


@query
def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over a folder: the second one finds the files that came after the first, whatever their times."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    base = st.working_folder(spark, "arrivals")
    manifest = st.FileManifest(spark, f"{base}/manifest")
    runs = []
    for number, part in enumerate(reversed(_halves(events)), 1):
        part.write.mode("append").parquet(f"{base}/files")
        with manifest.run("events", f"{base}/files") as run:
            rows = run.read(spark, events.schema).withColumn("run", F.lit(number))
            rows.write.parquet(f"{base}/run{number}")
        runs.append(spark.read.parquet(f"{base}/run{number}"))
    return runs[0].unionByName(runs[1]).select("event_id", "event_type", "run")


@query
def asof_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    """Each purchase with the user's newest click up to then."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts", "value")
    bought = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    clicks = events.filter(F.col("event_type") == "click")
    return st.asof_join(
        bought, clicks, {"user_id": "user_id"}, {"ts": "ts"}, {"click_at": "ts", "click_id": "event_id"}, slice_seconds=86_400
    )


@query
def conform_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text, some of it broken: what fits, and what is put aside with its reasons."""
    orders = table(spark, folder, "orders")
    broken = F.col("o_orderkey") % 10 == 0
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(broken, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    schema = "o_orderkey bigint, o_totalprice double, o_orderpriority string"
    done = st.write_or_reject(text, schema, st.working_folder(spark, "judged"), required=["o_orderpriority"])
    good = done.good.select("o_orderkey", F.col("o_totalprice").alias("price"), F.lit("").alias("reasons"))
    bad = done.rejected.select(
        F.col("raw.o_orderkey").cast("long").alias("o_orderkey"),
        F.lit(None).cast("double").alias("price"),
        F.array_join("reasons", ", ").alias("reasons"),
    )
    return good.unionByName(bad)


@query
def partition_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """What to rebuild when the last month of orders has changed: its year, then the priorities of that year."""
    orders = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.year("o_orderdate").cast("string").alias("year"), "o_orderpriority"
    )
    lineage = st.PartitionLineage(spark, st.working_folder(spark, "lineage"))

    def made(source: str, part: str, target: str, target_part: str) -> None:
        ends = {"source": F.lit(source), "source_part": F.col(part), "target": F.lit(target), "target_part": F.col(target_part)}
        lineage.record(target, orders.select(*[cell.alias(name) for name, cell in ends.items()]))

    made("orders", "month", "years", "year")
    made("years", "year", "priorities", "o_orderpriority")
    changed = orders.agg(F.max("month").alias("part")).select(F.lit("orders").alias("table"), "part")
    return st.downstream(lineage.links(), changed).select("table", "part", F.col("step").cast("long").alias("step"))

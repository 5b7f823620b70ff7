"""SQL that gives the same rows as each query of ``spark_queries``, for DuckDB."""

from __future__ import annotations

from workload.spark_queries import HMAC_KEY

ORACLE: dict[str, str] = {}

SPLIT = "timestamp '2024-01-16'"

# -- merging ---------------------------------------------------------------------------

_LATEST_EVENT = """
    select user_id, ts, event_id, event_type, value, event_type = 'error' as deleted,
           row_number() over (partition by user_id order by ts desc nulls last, event_id desc) as rn
    from events
"""

_CURRENT = f"""
select user_id, ts, event_id, event_type, value from ({_LATEST_EVENT}) where rn = 1 and not deleted
"""
ORACLE["merge_latest"] = _CURRENT
ORACLE["merge_both_ways"] = f"select way, s.* from ({_CURRENT}) s, (values ('broadcast'), ('joined')) w(way)"
ORACLE["current_state_incremental"] = _CURRENT
ORACLE["current_state_partitioned"] = _CURRENT

# The stored state has no error rows, only the incoming half has.
ORACLE["merge_missing_flag"] = f"""
with kept as (
    select * from events where ts >= {SPLIT} or event_type <> 'error'
), ranked as (
    select *, row_number() over (partition by user_id order by ts desc nulls last, event_id desc) as rn
    from kept
)
select user_id, ts, event_id, event_type, value from ranked where rn = 1 and event_type <> 'error'
"""

ORACLE["merge_tiebreak"] = """
with ranked as (
    select *, row_number() over (
        partition by o_custkey
        order by o_orderdate desc nulls last,
                 (o_orderpriority in ('1-URGENT', '2-HIGH')) desc,
                 (o_orderstatus = 'F') desc,
                 o_orderkey desc) as rn
    from orders
)
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from ranked where rn = 1 and o_orderstatus <> 'F'
"""

ORACLE["merge_null_sort"] = """
with known as (
    select * replace (case when o_orderstatus <> 'P' then o_orderdate end as o_orderdate) from orders
), ranked as (
    select *, row_number() over (
        partition by o_custkey order by o_orderdate desc nulls last, o_orderkey desc) as rn
    from known
)
select * exclude (rn) from ranked where rn = 1
"""

ORACLE["merge_null_flag"] = """
with ranked as (
    select *, row_number() over (
        partition by o_custkey order by o_orderdate desc nulls last, o_orderkey desc) as rn
    from orders
)
select * exclude (rn) from ranked where rn = 1 and o_orderstatus <> 'F'
"""

ORACLE["merge_tombstones"] = f"""
select user_id, ts, event_id, event_type, value, deleted from ({_LATEST_EVENT}) where rn = 1
"""

ORACLE["publish_snapshot"] = ORACLE["merge_tombstones"]


def _flattened(image: str) -> str:
    view = "null" if image == "row" else "'old view'"
    return f"""
    select event_id, user_id,
           case event_type when 'error' then 'old error' when 'view' then {view}
                           else event_type end as event_type,
           case when event_type = 'error' then -value else value end as value,
           date_trunc('millisecond', ts) as _as_of,
           event_type = 'error' as _deleted
    from events
    """


def _state(image: str) -> str:
    return f"""
    with ranked as (
        select *, row_number() over (partition by user_id order by _as_of desc, event_id desc) as rn
        from ({_flattened(image)})
    )
    select event_id, user_id, event_type, value, _as_of from ranked where rn = 1 and not _deleted
    """


ORACLE["flatten_changes_row"] = _flattened("row")
ORACLE["flatten_changes_field"] = _flattened("field")
ORACLE["current_state"] = _state("row")
ORACLE["current_state_field"] = _state("field")
ORACLE["apply_changes"] = _state("row")

ORACLE["merge_partitions"] = """
with orders_now as (
    select *, o_orderpriority = '1-URGENT' and year(o_orderdate) >= 1999 as again from orders
)
select o_orderkey, case when again then o_totalprice * 2 else o_totalprice end as o_totalprice,
       case when again then 2 else 1 end as version, year(o_orderdate)::int as o_year
from orders_now where not (again and o_orderstatus = 'F')
"""

ORACLE["merge_table_partitions"] = ORACLE["merge_partitions"]
ORACLE["merge_committed"] = ORACLE["merge_partitions"]

# -- schemas ---------------------------------------------------------------------------

ORACLE["conform_flat"] = """
select l_orderkey::int as l_orderkey, l_linenumber::bigint as l_linenumber,
       l_quantity::int as l_quantity,
       l_extendedprice::decimal(12,2)::varchar as l_extendedprice,
       l_shipdate::date::varchar as l_shipdate
from lineitem
"""

ORACLE["conform_lenient"] = """
select try_cast(o_orderkey as tinyint) as o_orderkey, try_cast(o_custkey as smallint) as o_custkey,
       try_cast(o_orderstatus as int) as o_orderstatus, o_orderdate
from orders
"""

ORACLE["conform_losses"] = """
select 'o_orderkey' as column_name, count(*) filter (try_cast(o_orderkey as tinyint) is null) as lost
from orders
union all
select 'o_custkey', count(*) filter (try_cast(o_custkey as smallint) is null) from orders
union all
select 'o_orderstatus', count(*) filter (try_cast(o_orderstatus as int) is null) from orders
union all
select 'o_orderdate', 0
"""

ORACLE["conform_nested"] = """
select c_custkey, c_acctbal < 0 as no_account,
       case when c_acctbal >= 0 then c_name end as name,
       case when c_acctbal >= 0 then c_acctbal::decimal(12,2)::varchar end as balance,
       case when c_acctbal >= 0 then c_nationkey::bigint end as nation_key,
       case when c_acctbal >= 0 then c_custkey::varchar end as cust_text,
       c_mktsegment as segment, 'nation' as second_key, c_nationkey::varchar as nation_text
from customer
"""

ORACLE["with_schema"] = """
select o_custkey::int as o_custkey, sum(o_totalprice::decimal(14,2))::varchar as spend
from orders group by 1
"""

ORACLE["write_conformed"] = """
select l_shipdate::date::varchar as l_shipdate, l_orderkey::bigint as l_orderkey,
       l_extendedprice::decimal(12,2)::varchar as l_extendedprice
from lineitem
"""

ORACLE["replace_table"] = """
select c_custkey, c_acctbal * 2 as c_acctbal from customer where c_acctbal > 0
"""

# -- typed tables and products ---------------------------------------------------------

ORACLE["read_raw"] = """
select o_orderkey, o_totalprice, o_orderdate, cast(null as varchar) as o_clerk from orders
"""

ORACLE["standardize"] = """
with raw as (
    select *, case when o_orderstatus = 'P' then 'unknown'
                   else strftime(o_orderdate, '%Y-%m-%d') end as placed
    from orders
)
select o_orderkey as order_id, try_strptime(placed, '%Y-%m-%d')::date::varchar as placed_on,
       o_custkey as customer_id
from raw
"""

ORACLE["load_typed_table"] = """
select o_orderkey as order_id, o_orderdate::date::varchar as placed_on, o_custkey as customer_id
from orders
"""

_PRODUCT = """
    select o.*, c.c_name as customer_name, n.n_name as nation, r.r_name as region
    from orders o
    left join customer c on o.o_custkey = c.c_custkey and o.o_orderstatus <> 'P'
    left join nation n on c.c_nationkey = n.n_nationkey
    left join region r on n.n_regionkey = r.r_regionkey
"""

ORACLE["wide_product"] = f"""
select o_orderkey, o_totalprice, customer_name, nation, region from ({_PRODUCT})
"""

ORACLE["wide_product_hot"] = """
select event_id, user_id, event_type, c_name as customer_name, n_name as nation
from (select event_id, event_type, case when event_id % 300 = 0 then 1 else user_id end as user_id from events)
left join customer on user_id = c_custkey
left join nation on c_nationkey = n_nationkey
"""

ORACLE["build_product"] = """
select l_orderkey, l_partkey, l_suppkey, l_quantity, p_name as part, p_brand as brand, s_name as supplier
from lineitem left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey
"""

ORACLE["grain_check"] = """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1
"""

ORACLE["grain_violations"] = """
with arrived as (
    select user_id, event_type, date_trunc('hour', ts) as hour from events
    union all
    select user_id, event_type, date_trunc('hour', ts) as hour from events where day(ts) = 3
)
select user_id, event_type, hour, count(*) as n from arrived group by 1, 2, 3 having count(*) > 1
"""

ORACLE["grain_coverage"] = """
select distinct o_orderkey from orders
where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
"""

_LABELS = "select o_custkey, list_sort(list(distinct o_orderpriority)) as labels from orders group by 1"

ORACLE["nest_attribute"] = f"""
select o_custkey, array_to_string(labels, '|') as labels from ({_LABELS})
"""

ORACLE["attach_nested"] = """
with nested as (
    select l_orderkey, list_sort(list(distinct l_partkey)) as parts
    from lineitem group by 1
), keyed as (
    select case when o_orderstatus <> 'P' then o_orderkey else -1 - o_orderkey end as o_orderkey, o_orderstatus from orders
)
select o_orderkey, o_orderstatus, coalesce(array_to_string(nested.parts, '|'), '') as parts
from keyed left join nested on o_orderkey = l_orderkey
"""

ORACLE["array_filter"] = f"""
select o_custkey, len(labels)::int as n_labels from ({_LABELS}) where list_contains(labels, '1-URGENT')
"""

ORACLE["product_rollup"] = f"""
select region, date_trunc('month', o_orderdate)::date::varchar as month, count(*) as n_orders,
       sum(o_totalprice::decimal(18,2))::varchar as revenue
from ({_PRODUCT}) group by 1, 2
"""

_SILVER = """
    select event_id, event_type, user_id, json_extract_string(props, '$.k')::int as k
    from events where json_extract_string(props, '$.k') is not null and user_id is not null
"""

ORACLE["bronze_to_silver"] = f"""
select event_id, user_id, k from ({_SILVER}) where event_type = 'click'
"""

ORACLE["route"] = _SILVER

# -- point in time ---------------------------------------------------------------------

_IS_LATE = "(o_orderdate >= timestamp '2000-06-01' and o_orderpriority = '1-URGENT')"

ORACLE["affected_partitions"] = f"""
select distinct date_trunc('month', o_orderdate)::date::varchar as period from orders where {_IS_LATE}
"""

# Rank all orders up to the end of each month, for every month.
_MONTHLY = """
    select m.period, o.*, row_number() over (
        partition by m.period, o.o_custkey order by o.o_orderdate desc, o.o_orderkey desc) as rn
    from (
        select unnest(generate_series(
            date_trunc('month', min(o_orderdate))::timestamp,
            date_trunc('month', max(o_orderdate))::timestamp, interval 1 month)) as period
        from orders
    ) m join orders o on o.o_orderdate < m.period + interval 1 month
"""

_PIT = f"""
    select o_custkey, o_orderkey, o_orderdate, o_totalprice, period::date::varchar as period
    from ({_MONTHLY}) where rn = 1 and o_orderstatus <> 'F'
"""

ORACLE["pit_snapshots"] = _PIT

# Two months after the last order that have none.
_PIT_LONGER = _PIT.replace(
    "date_trunc('month', max(o_orderdate))::timestamp", "date_trunc('month', max(o_orderdate))::timestamp + interval 2 month"
)

ORACLE["roll_snapshots"] = _PIT_LONGER

ORACLE["load_period"] = """
with ranked as (
    select y.period, o.*, row_number() over (
        partition by y.period, o.o_custkey order by o.o_orderdate desc, o.o_orderkey desc) as rn
    from (select distinct year(o_orderdate) as period from orders where year(o_orderdate) <> 1998) y
    join orders o on year(o.o_orderdate) <= y.period
)
select o_custkey, o_orderkey, o_orderdate, o_totalprice, period || '-01-01' as period
from ranked where rn = 1 and o_orderstatus <> 'F'
"""

ORACLE["pit_partition"] = """
with ranked as (
    select *, row_number() over (
        partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
    from orders
)
select o_custkey, o_orderkey, o_orderdate, o_totalprice from ranked where rn = 1 and o_orderstatus <> 'F'
"""

ORACLE["snapshot_at"] = f"""
select o_custkey, o_orderkey, o_orderdate, o_totalprice from ({_PIT}) where period = '1999-05-01'
"""

ORACLE["roll_forward"] = f"""
select * from ({_PIT_LONGER})
where period >= (
    select least(min(date_trunc('month', o_orderdate)), timestamp '2001-04-01')::date::varchar
    from orders where {_IS_LATE})
"""

# -- publishing, rebuilding, reading what is new ---------------------------------------

ORACLE["rebuild_partitions"] = """
select o_orderkey,
       case when year(o_orderdate) = 1997 then o_totalprice * 2 else o_totalprice end as o_totalprice,
       year(o_orderdate)::int as o_year
from orders where year(o_orderdate) <> 1998
"""
ORACLE["rebuild_table_partitions"] = ORACLE["rebuild_partitions"]

ORACLE["reprocess"] = """
with days as (select *, strftime(ts, '%Y-%m-%d') as day from events)
select event_id, user_id, day,
       case when day in ('2024-01-03', '2024-01-05') then -value else value end as value
from days
where day not in ('2024-01-03', '2024-01-04', '2024-01-05')
   or (day <> '2024-01-04' and event_type <> 'error')
"""

ORACLE["read_unprocessed"] = f"select * from events where ts >= {SPLIT}"

ORACLE["unprocessed"] = f"""
select * from events e
where not exists (select 1 from events p where p.ts < {SPLIT} and p.event_id = e.event_id)
"""

ORACLE["replay_range"] = """
select * from events where ts >= timestamp '2024-01-04 06:00:00' and ts < timestamp '2024-01-08 06:00:00'
"""

ORACLE["replay_files"] = "select * from events where event_type in ('purchase', 'signup')"

# -- sensitive values ------------------------------------------------------------------

ORACLE["pii_remove"] = "select c_custkey, c_nationkey, c_mktsegment from customer"

# 12 bytes of nonce before the text and 16 bytes of tag after it.
ORACLE["pii_encrypt"] = """
select c_custkey, c_name, c_mktsegment,
       case when c_mktsegment = 'BUILDING' then '2024' else '2023' end as key_id,
       octet_length(encode(c_name))::int + 28 as sealed_bytes
from customer
"""


def _hmac(expression: str) -> str:
    block = HMAC_KEY.ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in block).hex()
    outer = bytes(b ^ 0x5C for b in block).hex()
    digest = f"unhex(sha256(unhex('{inner}') || encode({expression})))"
    return f"sha256(unhex('{outer}') || {digest})"


ORACLE["pii_tokenize"] = f"select c_custkey, {_hmac('c_name')} as c_name from customer"

ORACLE["pii_vault"] = f"""
select distinct {_hmac("strftime(o_orderdate, '%Y-%m')")} as token, '2024' as key_id from orders
"""

ORACLE["pii_detokenize"] = "select event_id, event_type from events"


# Written for RE2, which has no look-around; its \b knows ASCII word characters only.
_PATTERNS = {
    "EMAIL": r"[\pL\pM\pN._%+-]+@([\pL\pM\pN-]+[.])+\pL([\pL\pM\pN]|-+[\pL\pM\pN])+",
    "SECRET": r'token = "[0-9a-f]{40}"',
    "CREDIT_CARD": r"\b(3[47]\d{2}[ -]?\d{6}[ -]?\d{5}|(\d{4}[ -]?){3}\d{4}([ -]?\d{3})?)\b",
    "IP_ADDRESS": r"\b(\d{1,3}[.]){3}\d{1,3}\b",
    "SSN": r"\b\d{3}-\d{2}-\d{4}\b",
}


def _redacted(expression: str) -> str:
    for kind, pattern in _PATTERNS.items():
        expression = f"regexp_replace({expression}, '{pattern}', '[{kind}]', 'g')"
    return expression


ORACLE["pii_redact"] = f"select doc_id, {_redacted('text')} as text from documents"

# Every value against every document. Runs of letters and digits are put between marks, in values
# and texts alike, so that a value is found between whole runs only.
ORACLE["pii_redact_known"] = r"""
with known as (
    select distinct value, regexp_replace(value, '([\pL\pM\pN]+)', chr(1) || '\1' || chr(2), 'g') as marked
    from (
        select 'mail' || n_nationkey || '.example.com' as value from nation
        union all select text from benchmark
    ) where value <> ''
), texts as (
    select doc_id, text, regexp_replace(text, '([\pL\pM\pN]+)', chr(1) || '\1' || chr(2), 'g') as marked
    from documents
), held as (
    select t.doc_id, string_agg(regexp_escape(k.marked), '|' order by length(k.value) desc, k.value) as pattern
    from texts t, known k where contains(t.marked, k.marked) group by t.doc_id
)
select t.doc_id,
       case when h.pattern is null then t.text
            else replace(replace(regexp_replace(t.marked, h.pattern, '[KNOWN]', 'g'), chr(1), ''), chr(2), '')
       end as text
from texts t left join held h on t.doc_id is not distinct from h.doc_id
"""

ORACLE["pii_scan"] = " union all ".join(
    f"""
select lang, '{kind}' as kind, sum(hits)::bigint as hits, count(*) filter (hits > 0) as rows_hit
from (select lang, len(regexp_extract_all(text, '{pattern}')) as hits from documents) group by lang
"""
    for kind, pattern in _PATTERNS.items()
)

# -- comparing versions ----------------------------------------------------------------

_EDITIONS = """
before as (
    select o_orderkey, o_orderstatus, o_orderpriority, o_totalprice
    from orders where o_orderpriority <> '5-LOW'
), after as (
    select o_orderkey,
           case when o_orderpriority <> '2-HIGH' then o_orderstatus end as o_orderstatus,
           o_orderpriority,
           case when o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end
               as o_totalprice
    from orders where o_orderstatus <> 'P'
)
"""

ORACLE["dataset_diff"] = f"""
with {_EDITIONS}
select coalesce(b.o_orderkey, a.o_orderkey) as o_orderkey,
       case when b.o_orderkey is null then 'added' when a.o_orderkey is null then 'removed'
            else 'changed' end as change,
       b.o_totalprice as old_price, a.o_totalprice as new_price, a.o_orderstatus as new_status
from before b full join after a on b.o_orderkey = a.o_orderkey
where b.o_orderkey is null or a.o_orderkey is null
   or b.o_orderstatus is distinct from a.o_orderstatus
   or b.o_orderpriority is distinct from a.o_orderpriority
   or b.o_totalprice is distinct from a.o_totalprice
"""

ORACLE["multiset_diff"] = f"""
with {_EDITIONS}, signed as (
    select o_orderstatus, o_orderpriority, -1 as n from before
    union all select o_orderstatus, o_orderpriority, 1 from after
)
select o_orderstatus, o_orderpriority, sum(n)::bigint as surplus
from signed group by 1, 2 having sum(n) <> 0
"""

ORACLE["dataset_diff_digest"] = ORACLE["dataset_diff"]

# -- snapshots from a chain of deltas ----------------------------------------------------

ORACLE["snapshot_chain"] = _PIT
ORACLE["roll_chain"] = _PIT_LONGER

# -- files that arrive late, attributes at a moment --------------------------------------

ORACLE["read_manifest"] = f"select event_id, event_type, case when ts >= {SPLIT} then 1 else 2 end::int as run from events"

ORACLE["asof_enrichment"] = """
with clicks as (
    select user_id, ts, max(event_id) as event_id from events where event_type = 'click' group by user_id, ts
)
select p.event_id, p.user_id, p.ts, c.ts as click_at, c.event_id as click_id
from (select * from events where event_type = 'purchase') p
asof left join clicks c on p.user_id = c.user_id and p.ts >= c.ts
"""

ORACLE["conform_quarantine"] = """
select o_orderkey,
       case when o_orderkey % 10 <> 0 and o_orderpriority <> '5-LOW' then o_totalprice::double end as price,
       concat_ws(', ', case when o_orderkey % 10 = 0 then 'o_totalprice: does not fit' end,
                 case when o_orderpriority = '5-LOW' then 'o_orderpriority: is null' end) as reasons
from orders
"""

ORACLE["partition_lineage"] = """
with dated as (
    select strftime(o_orderdate, '%Y-%m') as month, cast(year(o_orderdate) as varchar) as year, o_orderpriority from orders
), last_year as (
    select distinct year from dated where month = (select max(month) from dated)
)
select 'years' as "table", year as part, 1 as step from last_year
union all
select distinct 'priorities', o_orderpriority, 2 from dated where year in (select year from last_year)
"""

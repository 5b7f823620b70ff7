"""DuckDB SQL of those queries that SQL can express."""

#: CRC-32 of the bytes of x: the polynomial of zip files, a bit at a time.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, strlen({0})), lambda i: ascii(substring({0}, i::integer + 1, 1))::bigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(0, 8)),
        lambda x, bit: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)
), 4294967295)"""
_NOWHERE = "{'cost': 1000000000, 'edits': '', 'lines': ''}"
_USER, _ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"


def _way(state: str, letter: str, cost: str, line: str = "''") -> str:
    return f"{{'cost': {state}.cost + {cost}, 'edits': {state}.edits || '{letter}', 'lines': {state}.lines || {line}}}"


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _inserted(ways: str) -> str:
    """Ways to the four states with inserted rows: after e, s, u and a."""
    more_u = _least("u", *[_way(x, "I", "3", _USER) for x in "esa"])
    more_a = _least("a", _way("u", "I", "3", _ASSISTANT))
    once = f"select conv_id, n, e, s, u, {more_a} as a from (select conv_id, n, e, s, {more_u} as u, a from ({ways}))"
    return f"select conv_id, n, e, s, {more_u} as u, a from ({once})"


def _step() -> str:
    """Ways to the four states after one more row."""
    kept, extra = "chr(10) || role || ':' || text", "case when fault = 'truncated' then 3 else 0 end"
    stays = "fault not in ('blank', 'duplicate')"

    def keep(state: str, initial: str) -> str:
        way = _way(state, "K", f"({extra})", kept)
        return f"case when {stays} and left(role, 1) = '{initial}' then {way} else {_NOWHERE} end"

    def change(state: str, name: str) -> str:
        way = _way(state, "R", f"(3 + {extra})", f"{name} || text")
        return f"case when {stays} then {way} else {_NOWHERE} end"

    after = {
        "e": _way("e", "D", "4"),
        "s": _least(_way("s", "D", "4"), keep("e", "s")),
        "u": _least(_way("u", "D", "4"), *[keep(x, "u") for x in "esa"], *[change(x, _USER) for x in "esa"]),
        "a": _least(_way("a", "D", "4"), keep("u", "a"), change("u", _ASSISTANT)),
    }
    return ", ".join(f"{way} as {state}" for state, way in after.items())


_CONVERSATIONS = f"""
    with recursive damaged as (
        select conv_id, turn, {_CRC32.format("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as way,
               coalesce(role, ' ') as role, coalesce(text, ' ') as text
        from conversations
    ), given as (
        select conv_id, turn, case when way = 4 then 'user' else role end as role,
               case when way = 1 then '' when way = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
               unnest(case when way = 3 then [1, 2] else [1] end) as copy
        from damaged where way <> 0
    ), placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n from given
    ), faulty as (
        select *, left(role, 1) as initial,
               lag(left(role, 1)) over (partition by conv_id order by n) as before,
               case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
                    when row_number() over (partition by conv_id, role, text order by n) > 1 then 'duplicate'
                    when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then 'truncated'
                    else '' end as fault
        from placed
    ), counted as (
        select conv_id, max(n) as n_rows,
               coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
               count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
               count(*) filter (fault = 'truncated') as truncated,
               count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
        from faulty group by conv_id
    ), ids as (
        select distinct conv_id from conversations
    ), ways as (
        {_inserted(f"select conv_id, 0::bigint as n, {{'cost': 0, 'edits': '', 'lines': ''}} as e, {_NOWHERE} as s, {_NOWHERE} as u, {_NOWHERE} as a from ids")}
        union all
        {_inserted(f"select w.conv_id, f.n, {_step()} from ways w join faulty f on f.conv_id is not distinct from w.conv_id and f.n = w.n + 1")}
    ), ends as (
        select w.conv_id, {_least('e', 'a')} as best
        from ways w left join counted c on c.conv_id is not distinct from w.conv_id
        where w.n = coalesce(c.n_rows, 0)
    )
    select ids.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
           coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
           coalesce(illegal, 0)::bigint as illegal, best.cost::bigint as cost, best.edits as audit,
           sha256(best.lines[2:]) as repaired_sha256
    from ids
    left join counted c on c.conv_id is not distinct from ids.conv_id
    join ends on ends.conv_id is not distinct from ids.conv_id
"""


ORACLE: dict[str, str] = {
    "op13_ngram_join": """
        with recursive words as (
            select row_number() over () as r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') as w
            from documents
        ), sets as (
            select r, doc_id, list_distinct(list_transform(
                range(0, case when len(w) = 0 then 0 else greatest(1, len(w) - 3) end),
                lambda i: array_to_string(w[i + 1 : i + 4], ' '))) as s
            from words
        ), shared as (
            select r, unnest(s) as shingle, len(s) as n from sets
        ), links as (
            select a.r as a, b.r as b from shared a join shared b on a.shingle = b.shingle and a.r <> b.r
            group by a.r, b.r, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reached as (
            select r, doc_id as seen from sets
            union
            select links.b, reached.seen from reached join links on links.a = reached.r
        )
        select sets.doc_id, len(s)::bigint as n_shingles, min(seen) as component_id
        from sets join reached using (r) group by sets.r, sets.doc_id, len(s)
    """,
    "op12_conversation_repair": _CONVERSATIONS,
    "op9_top_k": """
        with whole as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and list_count(embedding) = len(embedding)
              and not list_bool_or(list_transform(embedding, lambda x: coalesce(not isfinite(x), true)))
        ), scored as (
            select q.vec_id as query_id, e.vec_id, list_inner_product(q.v, e.v)::bigint as score
            from whole q join whole e on q.vec_id <> e.vec_id
            where q.vec_id % 100 = 0
        )
        select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank,
               vec_id, score
        from scored
        qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
    """,
}

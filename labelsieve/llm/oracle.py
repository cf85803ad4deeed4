"""DuckDB SQL of the queries that SQL can express (over whole tables)."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Of equal texts the row with the largest id stays; a null text is empty.
ORACLE["op10_grace_dedup"] = """
with d as (select doc_id, coalesce(text, '') as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from d group by t)
select d.doc_id, g.keep_id, g.group_size, d.doc_id is not distinct from g.keep_id as kept, sha256(d.t) as text_sha256
from d join g on d.t = g.t
"""

# Sorting sources by size over weight shows at once which of them stop at three times their size.
ORACLE["op7_source_mix"] = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(concat_ws(':', '42', doc_id::varchar)) as k
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
p as (select *, case (row_number() over (order by source nulls last) - 1) % 3
                when 0 then 5 when 1 then 2 else 1 end as w from s),
o as (select *, sum(source_size) over () as total,
             coalesce(sum(3 * source_size) over (order by source_size::double / w, source nulls last
                      rows between unbounded preceding and 1 preceding), 0) as full_before,
             sum(w) over (order by source_size::double / w, source nulls last
                          rows between current row and unbounded following) as w_left
      from p),
r as (select coalesce(arg_min((total - full_before)::double / w_left, (source_size::double / w, coalesce(source, chr(1114111)))), 0)
             as rate from o where (total - full_before)::double / w_left * w <= 3 * source_size),
t as (select source, source_size, least((3 * source_size)::double, rate * w) as target,
             round(least((3 * source_size)::double, rate * w))::bigint as budget
      from o, r),
x as (select d.*, t.source_size, t.target, t.budget,
             coalesce(sum(size) over (partition by d.source order by k, doc_id, size
                      rows between unbounded preceding and 1 preceding), 0)::bigint as start
      from d join t on d.source is not distinct from t.source),
e as (select *, case when source_size > 0 then budget // source_size else 0 end as epochs from x)
select doc_id, size, source_size, target,
       (epochs * size + least(greatest(budget - epochs * source_size - start, 0), size))::bigint as taken
from e
"""

ORACLE["op9_pivot_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x::double) or isinf(x::double))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(range(1, 1 + least(len(q.v), len(c.v))), lambda i: q.v[i] * c.v[i]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""

# The digests follow from the rows; the length from the template's marks and the escapes.
ORACLE["op12_chat_format"] = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, turn, role, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(turn, role)),
e as (
  select *, row_number() over w as r, lag(role) over w is distinct from role as starts,
         lead(role) over w is distinct from role as ends,
         length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t')) as body,
         length(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c')) as head
  from c window w as (partition by conv_id order by turn nulls first, role, text))
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by r)) as turns_sha256,
       sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by r) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(body + 7 + case when starts then head + 6 else 0 end + case when ends then 1 else 0 end)::bigint as formatted_chars
from e group by conv_id
"""

ORACLE["op13_best_position"] = r"""
with terms_of_docs as (
  select row_number() over () as r, doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
items as (
  select distinct item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
tf as (select r, doc_id, term, count(*) as tf from terms_of_docs group by all),
n as (select r, sum(tf)::bigint as n from tf group by r),
c as (select count(*)::bigint as docs, sum(n)::bigint as total from n),
w as (select term, floor(1000 * ln((2 * (select docs from c) + 2)::double / (2 * count(*) + 1)))::bigint as w
      from tf group by term),
s as (
  select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::bigint as score
  from items join tf using (term) join w using (term) join n using (r), c
  group by item_id, r, doc_id),
k as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
      from s where score > 0)
select item_id, rank::int as rank, doc_id, score from k where rank <= 10
"""


def _more(state: str, cost: str, letter: str, turn: str | None) -> str:
    """``state`` (12 digits of cost, audit, chr(1), repaired text) after one more edit."""
    text = "" if turn is None else f" || case when length({state}) = instr({state}, chr(1)) then '' else chr(10) end || {turn}"
    return (f"(printf('%012d', substr({state}, 1, 12)::bigint + {cost}) || substr({state}, 13, instr({state}, chr(1)) - 13)"
            f" || '{letter}' || substr({state}, instr({state}, chr(1))){text})")


def _inserted() -> str:
    """States b, s, u, a with as many empty turns inserted as help."""
    user, assistant = "'user:'", "'assistant:'"
    return (f"select * replace(least(a, {_more('u', '2', 'I', assistant)}) as a) from (select * replace(least(u, "
            f"{_more('b', '2', 'I', user)}, {_more('s', '2', 'I', user)}, {_more('a', '2', 'I', user)}) as u)")


def _turn_repair() -> str:
    """The grammar as an automaton with the points b(egin), behind s, u and a; one turn per step of the recursion."""
    own = "role || ':' || text"

    def to(letter: str, point: str) -> str:  # keep or rerole a turn as ``letter``
        named = {"u": "'user:' || text", "a": "'assistant:' || text"}[letter]
        return (f"case when gone then null when initial = '{letter}' then {_more(point, 'late', 'K', own)} "
                f"else {_more(point, '2 + late', 'R', named)} end")
    return rf"""
with recursive raw as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
hashed as (
  select *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(name, ''), lambda c: ord(c)::bigint)),
    lambda acc, c: list_reduce(list_prepend(xor(acc, c), range(8)),
      lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end)), 4294967295::bigint) % 20 as kind
  from raw),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from hashed where kind <> 0),
numbered as (
  select *, left(role, 1) as initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
         row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as r,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as nth
  from damaged),
turns as (
  select *, body = '' as blank, body <> '' and nth > 1 as duplicate,
         body <> '' and nth = 1 and right(body, 1) not in ('.', '!', '?') as truncated, body = '' or nth > 1 as gone,
         case when body <> '' and nth = 1 and right(body, 1) not in ('.', '!', '?') then 1 else 0 end as late,
         lag(initial) over (partition by conv_id order by r) || initial not in ('su', 'ua', 'au') as illegal
  from numbered),
runs as (
  select distinct conv_id, 0::bigint as r, printf('%012d', 0) || chr(1) as b, null::varchar as s, null::varchar as u,
         null::varchar as a from conversations
  union all
  select conv_id, r, {_more('b', '3', 'D', None)} as b,
         least({_more('s', '3', 'D', None)}, case when not gone and initial = 's' then {_more('b', 'late', 'K', own)} end) as s,
         least({_more('u', '3', 'D', None)}, {to('u', 'b')}, {to('u', 's')}, {to('u', 'a')}) as u,
         least({_more('a', '3', 'D', None)}, {to('a', 'u')}) as a
  from ({_inserted()} from (
    select runs.conv_id, t.r, b, s, u, a, role, text, initial, gone, late
    from runs join turns t on t.conv_id is not distinct from runs.conv_id and t.r = runs.r + 1) j) p) q),
ends as (
  select conv_id, least(b, a) as state
  from ({_inserted()} from (
    select conv_id, r, b, s, u, a from runs
    qualify row_number() over (partition by conv_id order by r desc) = 1) j) p) q),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank,
         count_if(duplicate) as duplicate, count_if(truncated) as truncated, count_if(illegal) as illegal
  from turns group by conv_id)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
       coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, substr(state, 1, 12)::bigint as cost,
       substr(state, 13, instr(state, chr(1)) - 13) as audit, sha256(substr(state, instr(state, chr(1)) + 1)) as repaired_sha256
from ends e left join counts c on c.conv_id is not distinct from e.conv_id
"""


ORACLE["op11_turn_repair"] = _turn_repair()

"""The collapse of conversations in SQL, by whole prefixes instead of hashes."""

SQL = r"""
with turns as (
  select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as position,
    count(*) over (partition by conv_id) as n_turns
  from conversations
), prefixes as (
  select *, list({'r': role, 't': text}) over (partition by conv_id order by position) as so_far from turns
), whole as (
  select so_far, n_turns, min(conv_id) as conv_id, count(*) as n_copies
  from prefixes where position = n_turns group by so_far, n_turns
), kept as (
  select conv_id, n_copies from whole w
  where not exists (select 1 from prefixes p where p.position = w.n_turns and p.position < p.n_turns and p.so_far = w.so_far)
)
select t.conv_id, cast((position - 1) // 512 as bigint) as part, t.n_turns, k.n_copies,
  string_agg('<|' || regexp_replace(coalesce(role, ''), '\|(\\*)>', '|\\\1>', 'g') || '|>' || chr(10) ||
    regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10), '' order by position) as text
from turns t join kept k on t.conv_id is not distinct from k.conv_id
group by 1, 2, 3, 4
"""

"""The filter audit in SQL, document by document and order by order."""

SQL = r"""
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), least as (
  select text, min(doc_id) as least_id from words group by text
), marked as (
  select w.part,
    exists (select 1 from labels l where l.doc_id = w.doc_id and l.quality = 1) as good,
    exists (select 1 from labels l where l.doc_id = w.doc_id and l.toxic = 1) as toxic,
    (case when len(words) < 100 then 'A' else '' end)
    || (case when 100 * len(list_distinct(words)) < 80 * len(words) then 'B' else '' end)
    || (case when 100 * (length(w.text) - length(regexp_replace(w.text, '[A-Z]', '', 'g'))) > 10 * length(w.text) then 'C' else '' end)
    || (case when regexp_matches(w.text, '[#$%&*|]') then 'D' else '' end)
    || (case when w.doc_id > l.least_id then 'E' else '' end) as failed
  from words w join least l using (text)
), counts as (
  select part, failed, count(*) as docs, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from marked group by 1, 2
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a join letters b on b.x <> a.x join letters c on c.x not in (a.x, b.x)
    join letters d on d.x not in (a.x, b.x, c.x) join letters e on e.x not in (a.x, b.x, c.x, d.x)
), steps as (
  select filter_order, step, substr(filter_order, step, 1) as letter,
    substr(filter_order, 1, step - 1) as earlier
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)
), judged as (
  select part, filter_order, step, letter, docs, good, toxic, failed, contains(failed, letter) as fails,
    earlier <> '' and failed <> '' and regexp_matches(earlier, '[' || failed || 'x]') as gone
  from counts, steps
), found as (
  select part, filter_order, cast(step as integer) as step, letter,
    sum(docs) filter (not fails and not gone) as kept, sum(docs) filter (fails and not gone) as removed,
    sum(docs) filter (fails and gone) as redundant, sum(docs) filter (failed = letter) as unique_fails,
    sum(good) filter (fails and not gone) as good_lost, sum(toxic) filter (fails and not gone) as toxic_lost
  from judged group by 1, 2, 3, 4
)
select part, filter_order, step, cast(coalesce(kept, 0) as bigint) as kept,
  cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
  cast(coalesce(unique_fails, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost,
  cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(coalesce(sum(removed) over (partition by part, letter), 0) as bigint) as shapley
from found
"""

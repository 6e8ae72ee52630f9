"""What the records of the WARC files say, in SQL."""

SQL = """
with payloads as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages
), bits as (
  select *, [instr('0123456789abcdef', substr(hex, i + 1, 1)) - 1 for i in range(40)] as nibbles from payloads
), digests as (
  select page_id, payload, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((nibbles[1 + (5 * i) // 4] * 16 + nibbles[2 + (5 * i) // 4]) >> (3 - (5 * i) % 4)) & 31)::integer, 1)
    for i in range(32)], '') as payload_digest
  from bits
), ranked as (
  select *, row_number() over (partition by payload order by page_id nulls last) as place,
    first_value(page_id) over (partition by payload order by page_id nulls last) as least_id
  from digests
)
select page_id, cast(strlen(payload) as bigint) as payload_bytes, payload_digest,
  case when place = 1 then 'response' else 'revisit' end as record_type,
  case when place > 1 then least_id end as refers_to
from ranked
"""

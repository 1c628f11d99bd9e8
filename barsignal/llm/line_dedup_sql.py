"""DuckDB SQL for the line dedup query: the same windows and extensions, whole in place of hashes, without fingerprints."""

from barsignal.llm.line_dedup import MIN_WORDS


LINE_DEDUP = f"""
with l as (
  select doc_id, i - 1 as line, trim(x, ' ') as t from (
    select doc_id, unnest(a) as x, generate_subscripts(a, 1) as i
    from (select doc_id, string_split(text, chr(10)) as a from documents where text is not null))
  where trim(x, ' ') <> ''),
w as (select *, length(t) - length(replace(t, ' ', '')) + 1 as n from l),
p as (
  select *, cast(sum(n) over (partition by doc_id order by line) as bigint) - n as a,
    cast(sum(n) over (partition by doc_id) as bigint) as total from w),
win as (
  select doc_id, line, a, total, list(t) over f as content, list(line) over f as ls, last(a + n) over f as e,
    list({{'t': t, 'line': line}}) over g as lft
  from p window
    f as (partition by doc_id order by a range between current row and {MIN_WORDS - 1} following),
    g as (partition by doc_id order by a range between {MIN_WORDS} preceding and 1 preceding)),
complete as (
  select win.doc_id, win.line, any_value(content) as content, any_value(ls) as ls, coalesce(list_reverse(any_value(lft)), []) as lr,
    coalesce(list({{'t': p.t, 'line': p.line}} order by p.line) filter (where p.line is not null), []) as rr
  from win left join p on p.doc_id = win.doc_id and p.a between win.e and win.e + {MIN_WORDS}
  where win.a + {MIN_WORDS} <= win.total group by win.doc_id, win.line),
runs as (
  select doc_id, line, 'window' as side, content, ls as gone from complete
  union all
  select doc_id, line, 'left', content || list_transform(lr[1 : j], lambda x: x.t), [lr[j].line]
  from (select *, unnest(range(1, len(lr) + 1)) as j from complete)
  union all
  select doc_id, line, 'right', content || list_transform(rr[1 : j], lambda x: x.t), [rr[j].line]
  from (select *, unnest(range(1, len(rr) + 1)) as j from complete)),
met as (
  select *, first_value({{'d': doc_id, 'k': line}}) over (partition by side, content order by doc_id, line) as first from runs),
gone as (
  select doc_id, list(distinct line) as lines from (
    select doc_id, first, line as k, unnest(gone) as line from met)
  where doc_id <> first.d or k <> first.k
  group by doc_id),
counted as (select doc_id, count(*) as n_lines from l group by doc_id)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(len(lines), 0) as n_removed,
  md5(case when lines is null then text else coalesce(array_to_string(
    list_transform(list_filter(range(1, len(string_split(text, chr(10))) + 1), lambda i: not list_contains(lines, i - 1)),
      lambda i: string_split(text, chr(10))[i]), chr(10)), '') end) as text_md5
from documents d left join gone using (doc_id) left join counted using (doc_id)
"""

"""DuckDB SQL for the license scan: the same rules on rows in place of arrays."""

from barsignal.llm.license_rules import BASE, REACH, RULES
from barsignal.llm.license_scan import BASE_SCORE


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_RULES = ",\n".join(
    f"({r.order}, {_text(r.label)}, {r.priority}, {_text(anchor)}, {_text(f' {r.gate} ')}, {_text(r.pattern)})" for r in RULES for anchor in r.anchors
)
_BASE = ", ".join(f"({_text(phrase + ' ')}, {_text(label)}, {_text(phrase.split(' ')[0])})" for phrase, label in BASE.items())

LICENSE_SCAN = f"""
with rules(o, label, p, anchor, gate, pattern) as (values {_RULES}),
base(phrase, label, anchor) as (values {_BASE}),
texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
each as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from texts),
anchored as (select * from each where w[i] in (select anchor from rules union select anchor from base)),
places as (select doc_id, i - 1 as s, w[i] as anchor, array_to_string(w[i : i + {REACH - 1}], ' ') || ' ' as tail from anchored),
tried as (
  select doc_id, s, o, label, p, regexp_extract(tail, pattern) as m
  from places join rules using (anchor) where contains(' ' || tail, gate)),
met as (select doc_id, s, s + length(m) - length(replace(m, ' ', '')) as e, o, label, p from tried where m <> ''),
kept as (
  select * from met d where not exists (
    select 1 from met x where x.doc_id = d.doc_id
      and ((x.s <= d.s and x.e >= d.e) or (d.s <= x.s and d.e >= x.e))
      and (x.p > d.p or (x.p = d.p and (x.e - x.s > d.e - d.s or (x.e - x.s = d.e - d.s and x.o < d.o)))))),
found as (select doc_id, s, base.label from places join base on starts_with(tail, phrase)),
by_base as (
  select doc_id, count(*) as n, min(s) as a, max(s) as b, array_to_string(list_sort(list(distinct label)), ',') as labels
  from found group by doc_id),
by_rule as (select doc_id, max(p) / 100.0 as score from kept group by doc_id),
every as (
  select doc_id, array_to_string(list_sort(list(distinct label)), ',') as labels
  from (select doc_id, label from found union all select doc_id, label from kept) group by doc_id)
select t.doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_base, a as first_word, b as last_word,
  coalesce(by_base.labels, '') as base_labels, coalesce(every.labels, '') as labels,
  cast(greatest(coalesce(score, 0), case when n > 0 then {BASE_SCORE} else 0 end) as double) as score
from texts t left join by_base using (doc_id) left join every using (doc_id) left join by_rule using (doc_id)
"""

"""DuckDB SQL for ranked search: every term of every document, scored."""

from barsignal.llm.ranked_search import TOP


def _terms(x: str) -> str:
    lower = f"translate(coalesce({x}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


RANKED_SEARCH = f"""
with d as (select row_number() over () as r, doc_id, {_terms('text')} as ts from documents),
sized as (select r, doc_id, len(ts) as n from d where len(ts) > 0),
corpus as (select count(*) as big_n, cast(sum(n) as bigint) as big_l from sized),
asked as (select distinct item_id, unnest({_terms('text')}) as term from benchmark where item_id is not null),
tf as (select r, term, count(*) as tf from (select r, unnest(ts) as term from d) where term in (select term from asked) group by r, term),
df as (select term, count(*) as df from tf group by term),
weights as (select term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) as bigint) as w from df, corpus),
scores as (
  select item_id, r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * big_n) // big_l))))) as bigint) as score
  from asked join tf using (term) join weights using (term) join sized using (r), corpus group by item_id, r),
ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls first) as rank
  from scores join sized using (r) where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {TOP}
"""

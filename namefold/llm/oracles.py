"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from __future__ import annotations

import string

from namefold.llm.decontam import SPAN
from namefold.llm.urls import RULES, SOFT, STRICT, UrlFilter
from namefold.llm.divergence import ALPHA, MIN_DOCS, SCALE, TERM, TOP
from namefold.llm.substring import WINDOW
from namefold.llm.words import PLAIN_WORD, SPACED_WORD

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_STANDS = "lambda t: regexp_matches(low, '(^|[^\\p{L}\\p{N}])' || t || '([^\\p{L}\\p{N}]|$)')"

URLS = f"""
with parts as (
  select page_id, url, coalesce(lower(url), '') as low,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), hosts as (
  select *, regexp_extract(rest, '^[^/?#]*') as raw from parts
), paths as (
  select page_id, low, translate(raw, {_LOWER}) as host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path,
    list_filter({_list(STRICT)}, {_STANDS}) as strict, list_filter({_list(SOFT)}, {_STANDS}) as soft
  from hosts
), rules(rule_host, rule_path, rule_verdict) as (
  values {", ".join(str(r) for r in RULES)}
), fits as (
  select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) as rule_verdict
  from paths join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by page_id
)
select page_id, host, path, rule,
  coalesce(rule_verdict, case when len(strict) > 0 or len(soft) >= {UrlFilter.soft_limit} then 'block' else 'allow' end) as verdict,
  len(strict)::int as n_strict, len(soft)::int as n_soft,
  array_to_string(list_sort(list_concat(strict, soft)), ',') as terms
from paths left join fits using (page_id)
"""

HITS = f"""
with doc as (
  select doc_id, coalesce(regexp_extract_all(translate(text, {_LOWER}), '{PLAIN_WORD}'), []) as w from documents
), item as (
  select item_id, w, least({SPAN}, len(w)) as m
  from (select item_id, regexp_extract_all(translate(text, {_LOWER}), '{PLAIN_WORD}') as w from benchmark) where len(w) > 0
), item_window as (
  select distinct item_id, m, array_to_string(w[s:s + m - 1], ' ') as win
  from (select item_id, w, m, unnest(range(1, len(w) - m + 2)) as s from item)
), width as (
  select distinct m from item
), doc_window as (
  select doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') as win
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as s from doc, width where len(w) >= m)
), met as (
  select doc_id, s, m, item_id from doc_window join item_window using (m, win)
), hit as (
  select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(s, s + m)) as place from met) group by doc_id
), named as (
  select doc_id, count(*) as n_items, sha256(string_agg(id, ',' order by id)) as items_sha256
  from (select distinct doc_id, item_id::varchar as id from met) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join hit using (doc_id) left join named using (doc_id)
"""

_D = f"""
with d as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text, row_number() over () as rid
  from documents
), t as (
  select lang, source, rid, unnest(regexp_extract_all(translate(text, {_LOWER}), '{TERM.pattern}')) as term from d
), groups as (
  select distinct lang, source from d
), cnt as (
  select lang, source, term, count(*) as n, count(distinct rid) as docs from t group by lang, source, term
), kept as (
  select lang, term from cnt group by lang, term having sum(docs) >= {MIN_DOCS}
), v as (
  select lang, count(*) as v from kept group by lang
), gc as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n
  from groups g join kept k on g.lang = k.lang
  left join cnt c on c.lang = g.lang and c.source = g.source and c.term = k.term
), gt as (
  select lang, source, sum(n) as total from gc group by lang, source
), gp as (
  select gc.lang, gc.source, gc.term, gc.n, 1 + ({SCALE}::hugeint * (gc.n + {ALPHA})) // (gt.total + {ALPHA} * v.v) as p
  from gc join gt on gc.lang = gt.lang and gc.source = gt.source join v on gc.lang = v.lang
), lc as (
  select lang, term, sum(n) as n from gc group by lang, term
), lt as (
  select lang, sum(n) as total from lc group by lang
), lp as (
  select lc.lang, lc.term, 1 + ({SCALE}::hugeint * (lc.n + {ALPHA})) // (lt.total + {ALPHA} * v.v) as q
  from lc join lt on lc.lang = lt.lang join v on lc.lang = v.lang
), pair as (
  select g1.lang, g1.source, g2.source as item, coalesce(sum(abs(a.p - b.p)), 0) as value
  from groups g1 join groups g2 on g1.lang = g2.lang and g1.source <> g2.source
  left join gp a on a.lang = g1.lang and a.source = g1.source
  left join gp b on b.lang = g2.lang and b.source = g2.source and b.term = a.term
  group by g1.lang, g1.source, g2.source
), term as (
  select gp.lang, gp.source, gp.term as item, gp.p - lp.q as value
  from gp join lp on gp.lang = lp.lang and gp.term = lp.term where gp.n > 0 and gp.p > lp.q
), ranked as (
  select lang, source, 'pair' as part, item, value,
    row_number() over (partition by lang, source order by value desc, encode(item)) as rank from pair
  union all
  select * from (
    select lang, source, 'term' as part, item, value,
      row_number() over (partition by lang, source order by value desc, encode(item)) as rank from term
  ) where rank <= {TOP}
)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked
"""

_S = f"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(regexp_extract_all(text, '{SPACED_WORD}'), []) as w from documents
), win as (
  select rid, doc_id, s, md5(array_to_string(w[s:s + {WINDOW - 1}], ' ')) as k
  from (select rid, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as s from d where len(w) >= {WINDOW} and doc_id is not null)
), firsts as (
  select k, min(doc_id) as m from win group by k
), covered as (
  select distinct rid, p from (
    select rid, unnest(range(s, s + {WINDOW})) as p from win join firsts using (k) where win.doc_id > firsts.m
  )
), words as (
  select rid, unnest(w) as x, unnest(range(1, len(w) + 1)) as p from d
), kept as (
  select rid, string_agg(x, ' ' order by p) as t from words anti join covered using (rid, p) group by rid
), removed as (
  select rid, count(*) as n from covered group by rid
)
select doc_id, len(w)::bigint as n_words, coalesce(removed.n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (rid) left join removed using (rid)
"""

ORACLES: dict[str, str] = {"op7_winnowing": HITS, "op8_url_filter": URLS, "op11_source_divergence": _D, "op12_substring_dedup": _S}

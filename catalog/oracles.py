"""The same results as SQL text for DuckDB, over the same tables.

Written as chains of common table expressions. Nothing here is pruned or indexed: similarities come from
the full gram join, components from plain reachability, so the SQL checks the Spark side independently.
"""

from __future__ import annotations

from catalog.fixtures import HARD_ROWS, PAYEE_NAMES, PAYEE_TX
from namefold.config import PassParams, ResolveConfig

CFG = ResolveConfig()

# The cleaning patterns in RE2 syntax (ASCII input).
MONTH = "(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
DATES = (
    r"\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4}|\d{4}[/\-.]\d{1,2}[/\-.]\d{1,2}"
    rf"|\d{{1,2}}\s*{MONTH}(?:\s+\d{{2,4}})?|{MONTH}\s+\d{{1,2}},?\s*\d{{0,4}}|\d{{8}}"
)
PREFIXES = r"\b(?:mr|mrs|miss|ms|dr|moham)\b\.?\s*"
JUNK = r"\b(?:bacs|micl|postcodeservices|postcode\s*services|ltd|limited)\b\.?\s*"


def dates(x: str) -> str:
    return f"regexp_replace({x}, '{DATES}', '', 'gi')"


def prefixes(x: str) -> str:
    return f"regexp_replace({x}, '{PREFIXES}', '', 'gi')"


def junk_words(x: str) -> str:
    return f"regexp_replace({x}, '{JUNK}', '', 'gi')"


def brackets(x: str) -> str:
    return rf"regexp_replace({x}, '[(){{}}\[\]]', '', 'g')"


def digits(x: str) -> str:
    return rf"regexp_replace({x}, '\d+', '', 'g')"


def edge_noise(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[^a-zA-Z]+', ''), '[^a-zA-Z]+$', '')"


def standardize(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '\s{{2,}}', ' ', 'g'))"


def clean(x: str) -> str:
    for step in (dates, prefixes, junk_words, brackets, digits, edge_noise, standardize):
        x = step(x)
    return x


def _with(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n"


PAYEES = f"payee_names as ({PAYEE_NAMES})"
ROWS = f"payee_tx as ({PAYEE_TX})"
ORIGINALS = "originals as (select distinct payee_name as original_name from payee_tx where payee_name is not null)"
CLEANED = f"cleaned as materialized (select original_name, {clean('original_name')} as cleaned_name from originals)"
NAMES = """
names as materialized (
  select row_number() over (order by length(name), name) as id, name,
         array_to_string(list_sort(string_split_regex(name, '\\s+')), ' ') as tkey
  from (select distinct cleaned_name as name from cleaned where trim(cleaned_name) <> '')
)"""
BASE = (PAYEES, ROWS, ORIGINALS, CLEANED)
BASE_NAMES = (*BASE, NAMES)


def grams(p: str, src: str, params: PassParams) -> tuple[str, ...]:
    """Occurrences, counts and weights of the n-grams of the names in ``src``."""
    lo, hi = params.ngram_range
    return (
        f"""
{p}_words as (
  select id, ' ' || w || ' ' as w
  from (select id, unnest(string_split_regex(lower(name), '\\s+')) as w from {src}) where w <> ''
)""",
        f"""
{p}_gram as materialized (
  select id, substring(w, o + 1, n) as gram
  from (select id, w, n, unnest(range(0, greatest(0, length(w) - n) + 1)) as o
        from (select id, w, unnest(range({lo}, least({hi}, greatest({lo}, length(w))) + 1)) as n from {p}_words))
)""",
        f"{p}_tf as materialized (select id, gram, count(*) as tf from {p}_gram group by id, gram)",
        f"{p}_n as (select count(*) as n from {src})",
        f"""
{p}_df as materialized (
  select gram, count(*) as df, any_value(n) as n from {p}_tf, {p}_n
  group by gram having count(*) <= cast({CFG.max_df} as double) * any_value(n)
)""",
        f"""
{p}_w as materialized (
  select id, gram, raw / sqrt(sum(raw * raw) over (partition by id)) as w
  from (select id, t.gram, (1 + ln(tf)) * (ln((1.0::double + n) / (1.0::double + df)) + 1) as raw
        from {p}_tf t join {p}_df d on t.gram = d.gram)
)""",
    )


def similar(p: str, params: PassParams) -> str:
    """All directed pairs above the threshold, each name with itself included."""
    return f"""
{p}_sim as materialized (
  select a, b, sim from (
    select x.id as a, y.id as b, round(sum(x.w * y.w), 9) as sim
    from {p}_w x join {p}_w y on x.gram = y.gram group by x.id, y.id)
  where sim > cast({params.threshold} as double)
)"""


def graph(p: str, src: str, params: PassParams) -> tuple[str, ...]:
    """Ranked neighbours, undirected edges, and the smallest reachable id of every name."""
    return (
        f"""
{p}_top as materialized (
  select a, b, sim from (
    select *, row_number() over (partition by a order by sim desc, b) as place from {p}_sim)
  where place <= {params.top_n} and a <> b
)""",
        f"""
{p}_edge as materialized (
  select distinct greatest(a, b) as u, least(a, b) as v from {p}_top
)""",
        f"{p}_both as materialized (select u as a, v as b from {p}_edge union select v, u from {p}_edge)",
        f"""
{p}_reach as (
  select id, id as seen from {src}
  union
  select r.id, e.b from {p}_reach r join {p}_both e on e.a = r.seen
)""",
        f"{p}_root as materialized (select id, min(seen) as root from {p}_reach group by id)",
    )


def lcs(p: str, pairs: str) -> tuple[str, ...]:
    """Longest-common-subsequence length of the text pairs ``(x, y)`` of a table, row by row."""
    return (
        f"""
{p}_rows as (
  select x, y, 0 as i, list_transform(range(length(y) + 1), lambda k: 0) as cells from {pairs}
  union all
  select x, y, i + 1,
    list_reduce(
      list_prepend([0], list_transform(range(1, length(y) + 1), lambda k: [k::int])),
      lambda acc, k: list_append(acc, case when substring(x, i + 1, 1) = substring(y, k[1], 1)
        then cells[k[1]] + 1 else greatest(cells[k[1] + 1], acc[-1]) end))
  from {p}_rows where i < length(x)
)""",
        f"{p}_lcs as materialized (select x, y, cells[-1] as lcs from {p}_rows where i = length(x))",
    )


def verified(p: str, src: str, params: PassParams) -> tuple[str, ...]:
    """Labels after members too far from their anchor became clusters of their own."""
    return (
        f"""
{p}_pair as materialized (
  select distinct a.tkey as x, m.tkey as y
  from {p}_root r join {src} m on m.id = r.id join {src} a on a.id = r.root where r.id <> r.root
)""",
        *lcs(p, f"{p}_pair"),
        f"""
{p}_label as materialized (
  select r.id, r.root, case when l.lcs * 200 < (length(l.x) + length(l.y)) * {params.fuzz} then r.id else r.root end as label
  from {p}_root r join {src} m on m.id = r.id join {src} a on a.id = r.root
  left join {p}_lcs l on l.x = a.tkey and l.y = m.tkey
)""",
    )


def one_round(p: str, src: str, params: PassParams) -> tuple[str, ...]:
    return (*grams(p, src, params), similar(p, params), *graph(p, src, params), *verified(p, src, params))


def next_names(p: str, src: str) -> str:
    return f"{p}_names as materialized (select n.* from {src} n join {p}_label l on l.id = n.id and l.label = l.id)"


ROUND1 = one_round("r1", "names", CFG.precision)
ROUND2 = (next_names("r1", "names"), *one_round("r2", "r1_names", CFG.recall))
ROUND3 = (next_names("r2", "r1_names"), *one_round("r3", "r2_names", CFG.merge))

# The first round with overrides; no override keeps its number of neighbours.
LOOSE1 = one_round("r1", "names", CFG.with_precision(0.60, (2, 4)).precision)

# Similarity of all names with the recall settings: more edges and larger components to check.
LOOSE = (*grams("q", "names", CFG.recall), similar("q", CFG.recall))
LOOSE_GRAPH = (*LOOSE, *graph("q", "names", CFG.recall))

FINAL = (
    """
label as materialized (
  select a.id, c.label from r1_label a join r2_label b on b.id = a.label join r3_label c on c.id = b.label
)""",
    """
rep as materialized (
  select id, name, row_number() over (order by name) - 1 as cluster_id
  from names where id in (select label from label)
)""",
    """
clusters as materialized (
  select n.name as cleaned_name, r.cluster_id, r.name as representative_name
  from label l join names n on n.id = l.id join rep r on r.id = l.label
)""",
    """
mapping as materialized (
  select original_name, cleaned.cleaned_name, cluster_id, representative_name
  from cleaned left join clusters on cleaned.cleaned_name = clusters.cleaned_name
)""",
    """
final as materialized (
  select t.*, cleaned_name, cluster_id, representative_name
  from payee_tx t left join mapping on payee_name = original_name
)""",
)
ALL = (*BASE_NAMES, *ROUND1, *ROUND2, *ROUND3, *FINAL)


def _step(expression: str) -> str:
    return _with(*BASE[:3]) + f"select original_name, {expression} as result from originals"


def _named_labels(p: str, columns: str) -> str:
    return f"select n.name as cleaned_name, {columns} from {p}_label l join names n on n.id = l.id"


ORACLES: dict[str, str] = {
    "csv_source": _with(PAYEES, ROWS)
    + f"""select l_orderkey, l_linenumber, l_extendedprice,
  case when payee_name not in ('N/A', 'nan') then payee_name end as payee_name from ({HARD_ROWS})""",
    "table_source": "select * from part",
    "unique_names": _with(*BASE[:3]) + "select original_name from originals",
    "unique_cleaned_names": _with(*BASE_NAMES) + "select name as cleaned_name from names",
    "dedupe_by_key": _with(*BASE) + "select original_name, cleaned_name from cleaned",
    "clean_null_safe": _with(PAYEES) + "select p_partkey, case when p_partkey % 12 = 0 then '' else coalesce(payee_name, '') end as result from payee_names",
    "clean_dates": _step(dates("original_name")),
    "clean_prefixes": _step(prefixes("original_name")),
    "clean_junk_words": _step(junk_words("original_name")),
    "clean_brackets": _step(brackets("original_name")),
    "clean_digits": _step(digits("original_name")),
    "clean_edge_noise": _step(edge_noise("original_name")),
    "clean_standardize": _step(standardize("original_name")),
    "clean_names": _with(PAYEES)
    + f"select p_partkey, {clean('coalesce(payee_name, chr(32))')} as cleaned_name from payee_names",
    "cleaning_map": _with(*BASE) + "select original_name, cleaned_name from cleaned",
    "char_wb_ngrams": _with(*BASE_NAMES, *grams("q", "names", CFG.precision))
    + "select name as cleaned_name, gram from q_gram g join names n on n.id = g.id",
    "term_freq": _with(*BASE_NAMES, *grams("q", "names", CFG.precision))
    + "select name as cleaned_name, gram, tf, round(1 + ln(tf), 6) as sublinear_tf from q_tf g join names n on n.id = g.id",
    "doc_freq_idf": _with(*BASE_NAMES, *grams("q", "names", CFG.precision))
    + "select gram, df, round(ln((1.0::double + n) / (1.0::double + df)) + 1, 6) as idf from q_df",
    "tfidf_weights": _with(*BASE_NAMES, *grams("q", "names", CFG.precision))
    + "select name as cleaned_name, gram, round(w, 6) as weight from q_w g join names n on n.id = g.id",
    "tfidf_stats": _with(*BASE_NAMES, *grams("q", "names", CFG.precision))
    + """select (select count(*) from names) as names, count(distinct gram) as features, count(*) as nonzeros,
  round(count(*) / ((select count(*) from names) * count(distinct gram))::double, 9) as density from q_w""",
    "cosine_pairs": _with(*BASE_NAMES, *LOOSE_GRAPH)
    + """select distinct a.name as name_a, b.name as name_b, round(s.sim, 6) as cosine from q_top s
join names a on a.id = least(s.a, s.b) join names b on b.id = greatest(s.a, s.b)""",
    "topn_neighbours": _with(*BASE_NAMES, *LOOSE_GRAPH)
    + """select a.name as name, b.name as neighbour, round(s.sim, 6) as cosine from q_top s
join names a on a.id = s.a join names b on b.id = s.b""",
    "symmetric_edges": _with(*BASE_NAMES, *LOOSE_GRAPH)
    + """select a.name as name_a, b.name as name_b from q_edge e
join names a on a.id = e.v join names b on b.id = e.u""",
    "connected_components": _with(*BASE_NAMES, *LOOSE_GRAPH)
    + """select a.name as cleaned_name, b.name as component from q_root r
join names a on a.id = r.id join names b on b.id = r.root""",
    "cluster_size_stats": _with(*BASE_NAMES, *ROUND1)
    + """, sizes as (select root, count(*) as size from r1_root group by root)
select count(*) as clusters, count(*) filter (size = 1) as singletons,
  count(*) filter (size > 1) as multi_member_clusters, round(avg(size) filter (size > 1), 6) as avg_multi_size,
  max(size) filter (size > 1) as max_size from sizes""",
    "token_sort_ratio": _with(
        PAYEES,
        """
spellings as materialized (
  select distinct payee_name as name_a, p_name || ' ' || p_type as name_b,
    array_to_string(list_sort(list_filter(string_split_regex(payee_name, '\\s+'), lambda t: t <> '')), ' ') as x,
    array_to_string(list_sort(list_filter(string_split_regex(p_name || ' ' || p_type, '\\s+'), lambda t: t <> '')), ' ') as y
  from payee_names f join part p on f.p_partkey = p.p_partkey where payee_name is not null
)""",
        "keys as materialized (select distinct x, y from spellings)",
        *lcs("s", "keys"),
    )
    + """select name_a, name_b, round(200.0 * lcs / (length(s.x) + length(s.y)), 6) as score
from spellings s join s_lcs l on l.x = s.x and l.y = s.y""",
    "cluster_anchor": _with(*BASE_NAMES, *ROUND1)
    + """select n.name as anchor, count(*) as members from r1_label r join names n on n.id = r.root group by n.name""",
    "split_weak_members": _with(*BASE_NAMES, *LOOSE_GRAPH, *verified("q", "names", CFG.recall))
    + """select n.name as cleaned_name, a.name as anchor, c.name as cluster from q_label l
join names n on n.id = l.id join names a on a.id = l.root join names c on c.id = l.label""",
    "select_representatives": _with(*BASE_NAMES, *ROUND1)
    + """select distinct r.name as representative_name, count(*) over (partition by l.label) as members
from r1_label l join names r on r.id = l.label""",
    "attach_representative": _with(*BASE_NAMES, *ROUND1)
    + _named_labels("r1", "r.name as representative_name")
    + " join names r on r.id = l.label",
    "compose_labels": _with(*BASE_NAMES, *ROUND1, *ROUND2)
    + _named_labels("r1", "r.name as representative_name")
    + " join r2_label k on k.id = l.label join names r on r.id = k.label",
    "pass1_precision": _with(*BASE_NAMES, *ROUND1)
    + _named_labels("r1", "r.name as component")
    + " join names r on r.id = l.root",
    "pass2_verify": _with(*BASE_NAMES, *ROUND1)
    + _named_labels("r1", "r.name as representative_name")
    + " join names r on r.id = l.label",
    "pass3_recall": _with(*BASE_NAMES, *ROUND1, *ROUND2)
    + _named_labels("r2", "r.name as component, s.name as representative_name")
    + " join names r on r.id = l.root join names s on s.id = l.label",
    "pass4_merge": _with(*BASE_NAMES, *ROUND1, *ROUND2, *ROUND3)
    + _named_labels("r3", "r.name as component, s.name as representative_name")
    + " join names r on r.id = l.root join names s on s.id = l.label",
    "cluster_names": _with(*ALL) + "select * from clusters",
    "cluster_names_overridden": _with(*BASE_NAMES, *LOOSE1, *ROUND2, *ROUND3, *FINAL) + "select * from clusters",
    "attach_clusters": _with(*ALL) + "select * from mapping",
    "mapping_table": _with(*ALL) + "select * from mapping",
    "merge_back": _with(*ALL) + "select * from final",
    "resolve_payees": _with(*ALL) + "select * from final",
    "mapping_csv_sink": _with(*ALL) + "select * from mapping",
    "dataset_sink": _with(*ALL) + "select * from final",
    "table_sinks": _with(*ALL)
    + """select 'mapping' as written, original_name, cleaned_name, cluster_id, representative_name from mapping
union all select 'final', payee_name, cleaned_name, cluster_id, representative_name from final""",
    "largest_clusters": _with(*ALL)
    + """, top as (select cluster_id, representative_name, count(*) as members from mapping
  where cluster_id is not null group by all order by members desc, cluster_id limit 5)
select * from (
  select cluster_id, t.representative_name, members,
    row_number() over (partition by cluster_id order by original_name) as sample, original_name
  from top t join mapping m using (cluster_id)) where sample <= 5""",
    "browse_mapping": _with(*ALL) + "select * from mapping order by cluster_id, original_name",
    "source_profile": _with(PAYEES, ROWS)
    + """select count(*) as total_rows, count(distinct payee_name) as unique_names,
  round(100.0 * (count(*) - count(distinct payee_name)) / count(*), 6) as reduction_pct from payee_tx""",
    "cleaning_profile": _with(*BASE)
    + """select count(*) as names, count(*) filter (lower(trim(original_name)) <> cleaned_name) as modified,
  count(distinct cleaned_name) as unique_cleaned,
  round(100.0 * count(*) filter (lower(trim(original_name)) <> cleaned_name) / count(*), 6) as modified_pct from cleaned""",
    "mapping_profile": _with(*ALL)
    + """select count(*) as entries, count(distinct cluster_id) as clusters,
  count(distinct representative_name) as representatives from mapping""",
    "pass_summary": _with(*ALL)
    + " union all ".join(
        f"""select {i} as round, count(*) as names, count(*) filter (id = root) as components,
  count(*) filter (label <> root) as split_names, count(*) filter (id = label) as clusters,
  count(*) - count(*) filter (id = label) as merged_names from r{i}_label"""
        for i in (1, 2, 3)
    ),
    "run_summary": _with(*ALL)
    + """select (select count(*) from payee_tx) as input_rows, count(*) as mapping_entries,
  count(distinct cluster_id) as clusters, (select count(*) from final) as output_rows from mapping""",
}

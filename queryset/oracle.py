"""DuckDB SQL for the registered queries.

Written in another style than the Spark side on purpose: exploded rows, joins
and window functions instead of per-row arrays, and brute-force pair joins
instead of the closed forms, so that an agreement means something.
"""

from __future__ import annotations

from queryset.inputs import CLAUSE_BREAK, FIXED_TERMS, PEOPLE_SELECT, PEOPLE_TEXT
from veilspark import constants as K

# The engine has no lookahead: the same numbers spelled out.
_SSN = (
    r"\b(?:00[1-9]|0[1-9]\d|[1-57-8]\d{2}|6[0-57-9]\d|66[0-57-9])[-.\s]?"
    r"(?:0[1-9]|[1-9]\d)[-.\s]?(?:000[1-9]|00[1-9]\d|0[1-9]\d{2}|[1-9]\d{3})\b"
)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _regex(patterns: dict, name: str) -> str:
    pattern, flags = patterns[name]
    if name == "ssn":
        pattern = _SSN
    return _q(f"(?{flags}){pattern}" if flags else pattern)


# Word edges see ASCII only, so letters outside ASCII become underscores first.
def _ascii(text: str) -> str:
    return rf"regexp_replace({text}, '[^\P{{L}}a-zA-Z]', '_', 'g')"


DOC_CELLS = """cells as (
 select doc_id as row_id, 0 as col_idx, 'text' as "column", text from documents
 where text is not null and text <> '')"""

PEOPLE = f"people as ({PEOPLE_SELECT} from customer)"

PEOPLE_CELLS = (
    PEOPLE
    + ", cells as (select * from ("
    + " union all ".join(
        f"select row_id, {i} as col_idx, '{c}' as \"column\", {c} as text from people"
        for i, c in enumerate(PEOPLE_TEXT)
    )
    + ") where text is not null and text <> '')"
)

DOC_TEXT = "rt as (select row_id, text as row_text from cells)"
PEOPLE_TEXT_CTE = (
    "rt as (select row_id, concat_ws(' ', "
    + ", ".join(PEOPLE_TEXT)
    + ", cast(balance as varchar)) as row_text from people)"
)


def _spans(name: str, source: str = "cells") -> str:
    """Rows (row_id, col_idx, column, start, end, text) of one pattern."""
    seen = "text" if name == "email" else _ascii("text")
    rx = _regex(K.DETECTION_PATTERNS, name)
    return f"""
 select row_id, col_idx, "column", cast(s as bigint) as "start", cast(s + length(hit) as bigint) as "end",
   substring(text, cast(s + 1 as bigint), length(hit)) as text
 from (select *, sum(length(gap) + length(hit)) over (partition by row_id, col_idx order by i) - length(hit) as s
  from (select row_id, col_idx, "column", text, unnest(hits) as hit, unnest(gaps[1:len(hits)]) as gap,
          unnest(range(1, len(hits) + 1)) as i
   from (select *, regexp_extract_all({seen}, {rx}) as hits,
           regexp_split_to_array({seen}, {rx}) as gaps from {source})
   where len(hits) > 0))"""


def _det(order: list[str] | None = None) -> str:
    order = order or list(K.DETECTION_PATTERNS)
    union = " union all ".join(
        f"select *, {i + 1} as rank, '{n}' as type from ({_spans(n)})"
        for i, n in enumerate(order)
    )
    return f"""raw as ({union}),
 uniq as (select * from raw qualify row_number() over (
   partition by row_id, col_idx, "start", "end" order by rank) = 1),
 det as (select *, cast(row_number() over (partition by row_id order by col_idx, "start", rank) - 1 as bigint) as ent_ord,
   upper(type) as label, 0.8::double as confidence, 'regex' as method from uniq)"""


DOCS = f"with {DOC_CELLS}, {_det()}, {DOC_TEXT}"
FOLK = f"with {PEOPLE_CELLS}, {_det()}, {PEOPLE_TEXT_CTE}"

_DET_OUT = (
    'select row_id, ent_ord, "column", "start", "end", text, label, type, confidence, method from det'
)


def _in_pairs(a: str, b: str, pairs) -> str:
    tests = [
        f"({a} = '{x}' and {b} = '{y}') or ({a} = '{y}' and {b} = '{x}')" for x, y in pairs
    ]
    return "(" + " or ".join(tests) + ")"


_HALF = K.WINDOW // 2
REL = f"""rel as (
 select a.row_id, a.ent_ord as ord1, b.ent_ord as ord2, a.text as text1, b.text as text2,
  a.type as type1, b.type as type2, a."start" as s1, b."start" as s2, a."end" as e1, b."end" as e2,
  cast(abs(a."start" - b."start") as bigint) as distance
 from det a join det b on a.row_id = b.row_id and a.ent_ord < b.ent_ord
 where abs(a."start" - b."start") <= {K.WINDOW})"""

RISKED = f"""risked as (select *, case when {_in_pairs('type1', 'type2', K.HIGH_RISK_PAIRS)} then 'high'
  when distance < {_HALF} then 'medium' else 'low' end as risk_level from rel)"""

_PAIRS_OUT = """select row_id, ord1, ord2, text1, text2, distance,
 substring(row_text, cast(least(e1, e2) + 1 as bigint), cast(greatest(0, greatest(s1, s2) - least(e1, e2)) as bigint)) as text_between
 from rel join rt using (row_id)"""

_RISK_OUT = """select row_id, ord1, ord2, type1, type2, distance, risk_level,
 'Proximity of ' || type1 || ' and ' || type2 as reason from risked"""

# --- inferred entities ---------------------------------------------------------------


def _pattern_spans(i: int, name: str) -> str:
    rx = _q("(?is)" + K.COMBINATION_PATTERNS[name])
    return f"""
 select row_id, {i} as pat, '{name}' as pattern, '{K.COMBINATION_TYPES[name]}' as type, hit as text,
   cast(s as bigint) as "start", cast(s + length(hit) as bigint) as "end"
 from (select *, sum(length(gap) + length(hit)) over (partition by row_id order by i) - length(hit) as s
  from (select row_id, unnest(hits) as hit, unnest(gaps[1:len(hits)]) as gap, unnest(range(1, len(hits) + 1)) as i
   from (select row_id, regexp_extract_all(row_text, {rx}) as hits, regexp_split_to_array(row_text, {rx}) as gaps
    from rt semi join det using (row_id)) where len(hits) > 0))"""


PAT = "pat as (" + " union all ".join(
    _pattern_spans(i, n) for i, n in enumerate(K.COMBINATION_PATTERNS)
) + ")"

_KEYWORDS = [(c, w) for c, words in K.CONTEXT_KEYWORDS.items() for w in words]
KW = "kw(k, category, keyword) as (values " + ", ".join(
    f"({i}, '{c}', '{w}')" for i, (c, w) in enumerate(_KEYWORDS)
) + ")"

CTX = f"""ctx as (
 select row_id, ent_ord, type, text, "start", "end",
  substring(row_text, cast(greatest("start" - {_HALF}, 0) + 1 as bigint),
   cast(greatest(0, least("end" + {_HALF}, length(row_text)) - greatest("start" - {_HALF}, 0)) as bigint)) as context
 from det join rt using (row_id)),
 {KW},
 ind as (select row_id, ent_ord, string_agg(category || ': ' || keyword, '; ' order by k) as indicators
  from ctx join kw on contains(lower(context), keyword) group by all)"""

INF = f"""{PAT}, {CTX},
 inf_raw as (
  select row_id, 0 as kind, pat as o1, "start" as o2, text, type, pattern, cast(null as varchar) as context_indicators,
   "start", "end", 0.7::double as confidence, 'proximity_inference' as method, 'high' as risk_level from pat
  union all
  select row_id, 1, 0, ent_ord, text, type, null, indicators, "start", "end", 0.6::double, 'context_inference', 'medium'
  from ctx join ind using (row_id, ent_ord)),
 inf as (select *, cast(row_number() over (partition by row_id order by kind, o1, o2) - 1 as bigint) as inf_ord from inf_raw)"""

_INF_OUT = """select row_id, {ord} as inf_ord, text, type, pattern, context_indicators, "start", "end",
 confidence, method, risk_level from inf where {test}"""


def _inf_out(head: str, kind: int | None) -> str:
    if kind is None:
        return f"{head}, {INF} " + _INF_OUT.format(ord="inf_ord", test="true")
    ord_ = "cast(row_number() over (partition by row_id order by inf_ord) - 1 as bigint)"
    return f"{head}, {INF} " + _INF_OUT.format(ord=ord_, test=f"kind = {kind}")


# --- row risk -----------------------------------------------------------------------------

_CATS = list(K.CONTEXT_KEYWORDS)


def _cat_count(category: str, text: str) -> str:
    return "(" + " + ".join(
        f"cast(contains(lower({text}), '{w}') as int)" for w in K.CONTEXT_KEYWORDS[category]
    ) + ")"


def _scores(source: str, text: str) -> str:
    counts = ", ".join(f"{_cat_count(c, text)} as c{i}" for i, c in enumerate(_CATS))
    joined = ", ".join(
        f"case when c{i} > 0 then '{c}:' || c{i} end" for i, c in enumerate(_CATS)
    )
    total = " + ".join(f"c{i}" for i in range(len(_CATS)))
    return f"""(select row_id, concat_ws(',', {joined}) as sensitive_categories,
  least(({total}) / 10.0::double, 1.0::double) as raw_score from (select row_id, {counts} from {source}))"""


RISK = f"""sc as {_scores('rt', 'row_text')},
 cnt as (select row_id, count(*) as n_pairs, count_if(risk_level = 'high') as n_high,
  count_if(risk_level = 'medium') as n_medium, count_if(risk_level = 'low') as n_low from risked group by row_id),
 rr as (select d.row_id, coalesce(n_pairs, 0)::bigint as n_pairs, coalesce(n_high, 0)::bigint as n_high,
  coalesce(n_medium, 0)::bigint as n_medium, coalesce(n_low, 0)::bigint as n_low, sensitive_categories,
  round(raw_score, 6) as context_score,
  case when n_pairs is null then 'low' when n_high > 0 or raw_score > 0.7 then 'high'
   when n_medium > 2 or raw_score > 0.4 then 'medium' else 'low' end as overall_risk
  from (select distinct row_id from det) d join sc using (row_id) left join cnt using (row_id))"""


def _risk(head: str) -> str:
    return f"{head}, {REL}, {RISKED}, {RISK}"


_SUMMARY_OUT = """select count(*)::bigint as total_analyses,
 count_if(overall_risk = 'high')::bigint as high_risk_rows, count_if(overall_risk = 'medium')::bigint as medium_risk_rows,
 count_if(overall_risk = 'low')::bigint as low_risk_rows from rr"""

# --- graph: nodes and edges by brute force ------------------------------------------------

_WEIGHT = "case {t} " + " ".join(
    f"when '{t}' then {w}::double" for t, w in K.RISK_WEIGHTS.items()
) + f" else {K.DEFAULT_WEIGHT}::double end"


def _w(column: str) -> str:
    return _WEIGHT.format(t=column)


NODES_LIST = """lst as (
 select row_id, 0 as kind, ent_ord as ord, concat_ws('_', row_id, "start", "end", text) as node_id,
  "column", text, type, "start", "end", confidence, method, cast(null as varchar) as risk_level from det
 {inferred})"""
_INF_NODES = """union all
 select row_id, 1, inf_ord, concat_ws('_', 'inf', row_id, "start", "end", text), null, text, type, "start", "end",
  confidence, 'proximity_inference', risk_level from inf"""
NODES = """nodes as (
 select l.* exclude (ord), f.node_ord, f.self_loop from lst l
 join (select node_id, min(ord) as node_ord, max(ord) as last_ord, count(*) > 1 as self_loop from lst group by node_id) f
  on l.node_id = f.node_id and l.ord = f.last_ord)"""

EDGES = f"""pairs as (
 select a.row_id, least(a.node_id, b.node_id) as src, greatest(a.node_id, b.node_id) as dst
 from lst a join lst b on a.row_id = b.row_id and (a.kind, a.ord) < (b.kind, b.ord)),
 cooc as (select distinct p.row_id, src, dst,
  sqrt({_w('x.type')} * {_w('y.type')}) * case when {_in_pairs('x.type', 'y.type', K.BOOSTED_PAIRS)} then {K.BOOST} else 1 end as w
  from pairs p join nodes x on x.node_id = src join nodes y on y.node_id = dst)"""
PROX = f"""prel as (
 select r.*, concat_ws('_', row_id, s1, e1, text1) as n1, concat_ws('_', row_id, s2, e2, text2) as n2 from rel r),
 prox as (select row_id, least(n1, n2) as src, greatest(n1, n2) as dst, distance,
  sqrt({_w('type1')} * {_w('type2')}) * greatest(0.1::double, 1.0::double - distance / {K.WINDOW}::double) as w
  from prel qualify row_number() over (partition by row_id, least(n1, n2), greatest(n1, n2) order by ord1 desc, ord2 desc) = 1),
 edges as (select c.row_id, c.src, c.dst, round(coalesce(p.w, c.w), 6) as weight,
  case when p.w is null then 'cooccurrence' else 'proximity' end as relation_type, p.distance
  from cooc c left join prox p on c.src = p.src and c.dst = p.dst)"""


def _graph(head: str) -> str:
    lst = NODES_LIST.format(inferred=_INF_NODES)
    return f"{head}, {REL}, {INF}, {lst}, {NODES}, {EDGES}, {PROX}"


_NBR = """nbr as (select node_id, count(*) as k from (
  select src as node_id from edges where src <> dst union all select dst from edges where src <> dst) group by node_id),
 deg as (select n.*, coalesce(k, 0) + case when self_loop then 2 else 0 end as degree, coalesce(k, 0) as near
  from nodes n left join nbr using (node_id)),
 tot as (select count(*) as n, (select count(*) from edges) as e from nodes)"""

_STATS_OUT = """select n::bigint as nodes, e::bigint as edges,
 round(case when n > 1 then 2.0::double * e / (n * (n - 1)) else 0 end, 6) as density,
 round((select count(*) from deg where near >= 2) / n::double, 6) as average_clustering,
 (select count(distinct row_id) = 1 from nodes) as is_connected from tot"""

_REID = f"""reid as (select case when n > 1 then least(e / (n * (n - 1) / 2.0::double), 1.0::double) else 0.0::double end as c,
  (select count(*) from nodes where type in ('ssn', 'credit_card', 'name')) / n::double as v,
  (select max(k) from (select count(*) as k from nodes group by row_id)) / n::double as m from tot),
 reid2 as (select *, c * 0.4::double + v * 0.4::double + m * 0.2::double as score from reid)"""
_LEVEL = "case when score > 0.7 then 'high' when score > 0.4 then 'medium' else 'low' end"
_REID_OUT = f"""select {_LEVEL} as risk_level, round(score, 6) as score, round(c, 6) as connectivity_risk,
 round(v, 6) as entity_risk, round(m, 6) as component_risk from reid2"""


def _top(measure: str) -> str:
    by = {"degree": "degree", "betweenness": "near * 0", "closeness": "near"}[measure]
    return f"""{_graph(DOCS)}, {_NBR}
 select node_id, row_id, round(cast({by} as double) / (n - 1), 6) as centrality from deg, tot
 order by {by} desc, kind, row_id, node_ord limit {K.TOP_CENTRAL}"""


_COMPONENTS = """, cnt as (select row_id, type, count(*) as c from nodes group by all),
 ty as (select row_id, string_agg(type || ':' || c, ',' order by type || ':' || c) as entity_types from cnt group by row_id)
 select n.row_id as component_id, count(*)::bigint as size, any_value(entity_types) as entity_types,
  round(avg({w}), 6) as risk_score, string_agg(node_id, '|' order by node_id) as nodes
 from nodes n join ty using (row_id) group by n.row_id"""

_CLUSTERS = """ select row_id, count(*)::bigint as size, string_agg(distinct type, ',' order by type) as entity_types,
 round(count(distinct type) * 0.2::double + case when bool_or(type in ('ssn', 'credit_card', 'name')) then 0.5 else 0 end, 6) as risk_score,
 'clique' as cluster_type from nodes group by row_id having count(*) >= 2"""

# --- masking ----------------------------------------------------------------------------------

_SPANS_OF = """spans as (select row_id, col_idx, list("start" || ':' || "end" order by "start" desc, rank) as sp
 from det group by all)"""


def _fold(text: str) -> str:
    return (
        f"case when sp is null then {text} else list_reduce(sp, lambda a, x: substring(a, 1, cast(split_part(x, ':', 1) as bigint)) "
        f"|| '***' || substring(a, cast(split_part(x, ':', 2) as bigint) + 1), {text}) end"
    )


def _mask_patterns(text: str) -> str:
    for name in K.MASK_PATTERNS:
        if name == "credit_card":
            rx = _q(K.MASK_PATTERNS[name][0])
        else:
            rx = _regex(K.MASK_PATTERNS, name)
        text = f"regexp_replace({text}, {rx}, '***', 'g')"
    return text


_NAME = _regex(K.DETECTION_PATTERNS, "name")


def _mask_names(text: str) -> str:
    return (
        f"list_reduce(regexp_extract_all({_ascii(text)}, {_NAME}), "
        f"lambda a, x: replace(a, x, '***'), {text})"
    )


_MASKED_CELLS = f"""{_SPANS_OF},
 m1 as (select c.row_id, c.col_idx, {_fold('c.text')} as t from cells c left join spans using (row_id, col_idx)),
 m2 as (select row_id, col_idx, {_mask_patterns('t')} as t from m1),
 m3 as (select row_id, col_idx, {_mask_names('t')} as t from m2)"""

_WIDE = ", ".join(
    f"max(case when col_idx = {i} then t end) as {c}" for i, c in enumerate(PEOPLE_TEXT)
)

_MERGED = """ov as (select *, max("end") over (partition by row_id, col_idx order by "start", rank
   rows between unbounded preceding and 1 preceding) as before from det),
 grp as (select *, sum(case when before is null or "start" >= before then 1 else 0 end) over (
   partition by row_id, col_idx order by "start", rank) as g from ov),
 iv as (select row_id, col_idx, min("start") as s, max("end") as e from grp group by row_id, col_idx, g),
 spans as (select row_id, col_idx, list(s || ':' || e order by s desc) as sp from iv group by all)"""

# --- gazetteer --------------------------------------------------------------------------------

_TOKEN = r"'[\p{L}\p{N}_]+'"
_FIXED = ", ".join(f"({_q(t)}, {_q(label)})" for t, label in FIXED_TERMS)
_LABEL_TYPE = "case label " + " ".join(
    f"when '{x}' then '{t}'" for x, t in (K.LABEL_TYPES | K.OWN_LABELS).items()
) + " end"
# Every run of words up to the longest term, where no gap passes three characters; hits
# inside a longer hit go.
GAZ = rf"""dict as (select array_to_string(w, ' ') as norm, len(w) as n, min(label) as label from (
  select w, case len(w) % 3 when 0 then 'LOC' when 1 then 'PERSON' else 'ORG' end as label from (
   select regexp_extract_all(unnest(regexp_split_to_array(text, '{CLAUSE_BREAK}')), {_TOKEN}) as w from benchmark) where len(w) >= 2
  union all select regexp_extract_all(term, {_TOKEN}), label from (values {_FIXED}) x(term, label))
  group by all),
 tok as (select row_id, col_idx, i, hit, gap, cast(s as bigint) as "start", cast(s + length(hit) as bigint) as "end" from (
  select *, sum(length(gap) + length(hit)) over (partition by row_id, col_idx order by i) - length(hit) as s from (
   select row_id, col_idx, unnest(hits) as hit, unnest(gaps[1:len(hits)]) as gap, unnest(range(1, len(hits) + 1)) as i
   from (select row_id, col_idx, regexp_extract_all(text, {_TOKEN}) as hits, regexp_split_to_array(text, {_TOKEN}) as gaps from cells)))),
 head as (select distinct string_split(norm, ' ')[1] as hit, n from dict),
 gram as (select t.row_id, t.col_idx, t."start", max(b."end") as "end", string_agg(b.hit, ' ' order by b.i) as norm
  from tok t join head using (hit) join tok b on b.row_id = t.row_id and b.col_idx = t.col_idx and b.i >= t.i and b.i < t.i + n
  group by t.row_id, t.col_idx, t.i, t."start", n
  having count(*) = n and count_if(b.i > t.i and length(b.gap) > 3) = 0),
 met as (select g.*, label from gram g join dict d using (norm)),
 gaz as (select m.row_id, m.col_idx, c."column", m."start", m."end",
   substring(c.text, cast(m."start" + 1 as bigint), cast(m."end" - m."start" as bigint)) as text, label,
   {_LABEL_TYPE} as type, 0.9::double as confidence, 'gazetteer' as method
  from met m join cells c on c.row_id = m.row_id and c.col_idx = m.col_idx
  where not exists (select 1 from met b where b.row_id = m.row_id and b.col_idx = m.col_idx and b."start" <= m."start"
    and b."end" >= m."end" and (b."start" < m."start" or b."end" > m."end")))"""
GAZ_BOTH = """one as (select * from (
   select row_id, col_idx, "column", "start", "end", text, label, type, confidence, method, 0 as rank from gaz
   union all select row_id, col_idx, "column", "start", "end", text, label, type, confidence, method, rank from det0)
  qualify row_number() over (partition by row_id, col_idx, "start", "end" order by rank) = 1),
 det as (select *, cast(row_number() over (partition by row_id order by col_idx, "start", rank, "end") - 1 as bigint) as ent_ord
  from one)"""
_BOTH = f"{_det().replace('det as (', 'det0 as (')}, {GAZ}, {GAZ_BOTH}"
_DOCS_BOTH = f"with {DOC_CELLS}, {_BOTH}, {DOC_TEXT}"
_FOLK_BOTH = f"with {PEOPLE_CELLS}, {_BOTH}, {PEOPLE_TEXT_CTE}"
_GAZ_OUT = f'with {DOC_CELLS}, {GAZ} select row_id, "start", "end", text, label, type, confidence from gaz'

# --- report -----------------------------------------------------------------------------------

_ADVICE = f"""adv as (select unnest([0, 1, 2, 3, 4, 5]) as o, unnest([
  case when total > 0 then {_q(K.FOUND_ENTITIES.split('%d')[0])} || total || {_q(K.FOUND_ENTITIES.split('%d')[1])} end,
  case when high > 0 then {_q(K.FOUND_HIGH_ROWS.split('%d')[0])} || high || {_q(K.FOUND_HIGH_ROWS.split('%d')[1])} end,
  case when {_LEVEL} = 'high' then {_q(K.FOUND_HIGH_REID)} end,
  {', '.join(_q(x) for x in K.GENERAL_ADVICE)}]) as line
  from (select (select count(*) from det) as total, (select count_if(overall_risk = 'high') from rr) as high, score from reid2)),
 advice as (select cast(row_number() over (order by o) - 1 as bigint) as ord, line from adv where line is not null)"""
_FULL = f"{_graph(FOLK)}, {_NBR}, {_REID}, {RISKED}, {RISK}, {_ADVICE}"
_TYPES = """(select string_agg(type || ':' || c, ',' order by type || ':' || c) from (select type, count(*) as c from det group by type))"""

_REPORT = f"""{_FULL}
 select 'people' as input_file, {K.WINDOW}::bigint as proximity_window,
  (select count(*) from det)::bigint as total_detections, (select count(distinct row_id) from det)::bigint as n_rows_affected,
  {_TYPES} as detection_types,
  (select count(*) from rr)::bigint as total_analyses, (select count_if(overall_risk = 'high') from rr)::bigint as high_risk_rows,
  (select count_if(overall_risk = 'medium') from rr)::bigint as medium_risk_rows, (select count_if(overall_risk = 'low') from rr)::bigint as low_risk_rows,
  n::bigint as nodes, e::bigint as edges, round(2.0::double * e / (n * (n - 1)), 6) as density,
  (select round(score, 6) from reid2) as score, (select {_LEVEL} from reid2) as risk_level,
  (select string_agg(line, '|' order by ord) from advice) as recommendations from tot"""

_TEXT = f"""{_FULL},
 ty as (select row_number() over (order by type) as i, array_to_string(list_transform(str_split(type, '_'), lambda w: upper(w[1]) || lower(w[2:])), '_') as t, count(*) as c from det group by type),
 lines as (
  select 0 as a, 0 as b, 'Total PII Entities Detected: ' || (select count(*) from det) as line
  union all select 1, i, t || ': ' || c from ty
  union all select 2, 0, 'High Risk Rows: ' || (select count_if(overall_risk = 'high') from rr)
  union all select 2, 1, 'Medium Risk Rows: ' || (select count_if(overall_risk = 'medium') from rr)
  union all select 2, 2, 'Low Risk Rows: ' || (select count_if(overall_risk = 'low') from rr)
  union all select 2, 3, 'Total Nodes: ' || n from tot
  union all select 2, 4, 'Total Edges: ' || e from tot
  union all select 2, 5, printf('Graph Density: %.3f', 2.0::double * e / (n * (n - 1))) from tot
  union all select 2, 6, 'Re-identification Risk: ' || upper({_LEVEL}) from reid2
  union all select 3, ord, (ord + 1) || '. ' || line from advice)
 select cast(row_number() over (order by a, b) - 1 as bigint) as ord, line from lines"""



def _exact(graph: str) -> str:
    """Sums are taken of weights that are not rounded yet."""
    return graph.replace("round(coalesce(p.w, c.w), 6) as weight", "coalesce(p.w, c.w) as weight")


_EDGE_TYPES = """kinds as (select e.row_id, least(a.type, b.type) as type1, greatest(a.type, b.type) as type2, weight, relation_type,
  src = dst or relation_type = 'proximity' as own
 from edges e join nodes a on a.node_id = e.src join nodes b on b.node_id = e.dst)"""

# --- edges from elsewhere -----------------------------------------------------------------------

_PART_LINKS = """with e as (select distinct least(a.l_partkey, b.l_partkey)::bigint as x, greatest(a.l_partkey, b.l_partkey)::bigint as y
  from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1),
 near as (select x as node, y as other from e where x <> y union all select y, x from e where x <> y),
 nodes as (select node, count_if(not l) as d, count_if(l) as loops from (
  select x as node, x = y as l from e union all select y, false from e where x <> y) group by node),
 tri as (select a.node, count(*) as t from near a join near b on a.node = b.node and a.other < b.other
  join e on e.x = a.other and e.y = b.other group by a.node),
 full_ as (select node, (d + 2 * loops)::bigint as degree, coalesce(t, 0)::bigint as triangles,
  case when d > 1 then 2.0::double * coalesce(t, 0) / (d * (d - 1)) else 0 end as clustering
  from nodes left join tri using (node)),
 reach as (select count(*) as n from (
  with recursive r(node) as (select min(node) from nodes union select near.other from r join near on near.node = r.node)
  select node from r))"""
_TURN_LINKS = """with e as (select printf('%08d:%06d', a.conv_id::bigint, a.turn::bigint) as x, printf('%08d:%06d', b.conv_id::bigint, b.turn::bigint) as y
  from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1),
 near as (select x as a, y as b from e union select y, x from e),
 walk as (with recursive r(a, b) as (select a, a from near union select r.a, near.b from r join near on near.a = r.b) select a, b from r),
 home as (select a as node, min(b) as component_id, count(*)::bigint as size from walk group by a)"""

_BADGE = "case overall_risk when 'low' then 'badge-success' when 'medium' then 'badge-warning' when 'high' then 'badge-danger' end"


def _base(column: str) -> str:
    before = PEOPLE_TEXT[: PEOPLE_TEXT.index(column)]
    return " + ".join(["0"] + [f"coalesce(length({c}) + 1, 0)" for c in before])


_SHARED = (
    f"with {PEOPLE_CELLS}, {_det().replace('det as (', 'det0 as (')}, {PEOPLE_TEXT_CTE}, bases as ("
    + " union all ".join(
        f"select row_id, {i} as col_idx, {_base(c)} as base from people"
        for i, c in enumerate(PEOPLE_TEXT)
    )
    + """), det as (select d.* replace (d."start" + base as "start", d."end" + base as "end")
   from det0 d join bases using (row_id, col_idx))"""
)

ORACLE: dict[str, str] = {
    **{
        f"detect_{n}": f"""with {DOC_CELLS.replace('cells as', 'dc as')}, {PEOPLE_CELLS.replace('cells as', 'pc as')}
 select 'documents' as source, row_id, "column", "start", "end", text from ({_spans(n, 'dc')})
 union all select 'people', row_id, "column", "start", "end", text from ({_spans(n, 'pc')})"""
        for n in K.DETECTION_PATTERNS
    },
    "detect_all": f"{DOCS} {_DET_OUT}",
    "detect_cells": f"{FOLK} {_DET_OUT}",
    "detect_specific": f"with {PEOPLE_CELLS}, {_det(K.SPECIFIC_ORDER)} {_DET_OUT}",
    "text_cells": f'with {PEOPLE_CELLS} select row_id, col_idx::bigint as col_idx, "column", text from cells',
    "gazetteer_entities": _GAZ_OUT,
    "gazetteer_large": _GAZ_OUT,
    "detect_with_gazetteer": f'{_DOCS_BOTH} select row_id, ent_ord, "start", "end", text, label, type, confidence from det',
    "gazetteer_risk": f"{_risk(_DOCS_BOTH)} select * from rr",
    "gazetteer_pair_risk": f"{_FOLK_BOTH}, {REL}, {RISKED} {_RISK_OUT}",
    "mask_with_gazetteer": f"""{_FOLK_BOTH}, {_MASKED_CELLS}, w as (select row_id, {_WIDE} from m3 group by row_id)
 select w.*, p.balance from w join people p using (row_id)""",
    "mask_documents_with_gazetteer": f"{_DOCS_BOTH}, {_MASKED_CELLS} select row_id, t as text from m3",
    "graph_with_gazetteer": f"""{_graph(_FOLK_BOTH)} select node_id, row_id, "column", text, type, "start", "end", confidence, method,
 risk_level, self_loop, {_w('type')} as weight from nodes""",
    "components_ranked": f"""{_graph(DOCS)}, scored as (select row_id as component_id, count(*)::bigint as size,
  round(avg({_w('type')}), 9) as risk_score from nodes group by row_id)
 select row_number() over (order by risk_score desc, component_id) as rank, component_id, size, round(risk_score, 6) as risk_score from scored""",
    "clusters_ranked": f"""{_graph(DOCS)}, scored as (select row_id, count(*)::bigint as size,
  round(count(distinct type) * 0.2::double + case when bool_or(type in ('ssn', 'credit_card', 'name')) then 0.5 else 0 end, 9) as risk_score
  from nodes group by row_id having count(*) >= 2)
 select row_number() over (order by risk_score desc, row_id) as rank, row_id, size, round(risk_score, 6) as risk_score from scored""",
    "job_masked_subset": f"""{FOLK}, {_SPANS_OF},
 m1 as (select c.row_id, c.col_idx, case when "column" in ('notes', 'ssn') then {_fold('c.text')} else c.text end as t
  from cells c left join spans using (row_id, col_idx)),
 m2 as (select row_id, col_idx, {_mask_patterns('t')} as t from m1),
 m3 as (select row_id, col_idx, {_mask_names('t')} as t from m2),
 w as (select row_id, {_WIDE} from m3 group by row_id)
 select w.*, p.balance from w join people p using (row_id)""",
    "job_components": f"""{_graph(FOLK)}{_COMPONENTS.format(w=_w('n.type'))}""",
    "job_clusters": f"{_graph(FOLK)}{_CLUSTERS}",
    "detection_summary": f"""{FOLK} select count(*)::bigint as total_detections, count(distinct row_id)::bigint as n_rows_affected,
 {_TYPES} as detection_types, string_agg(distinct "column", ',' order by "column") as columns_affected from det""",
    "detection_by_type": f"{FOLK} select type, count(*)::bigint as n from det group by type",
    "affected_columns": f'{FOLK} select "column", count(*)::bigint as n from det group by "column"',
    "affected_rows": f"{FOLK} select row_id, count(*)::bigint as n from det group by row_id",
    "row_text": f"{FOLK} select row_id, row_text from rt semi join det using (row_id)",
    "proximity_pairs": f"{DOCS}, {REL} {_PAIRS_OUT}",
    "proximity_pairs_wide": f"{FOLK}, {REL} {_PAIRS_OUT}",
    "pair_risk": f"{FOLK}, {REL}, {RISKED} {_RISK_OUT}",
    "band_join_pairs": f"{FOLK}, {REL}, {RISKED} {_RISK_OUT}",
    "inferred_patterns": _inf_out(FOLK, 0),
    "inferred_patterns_documents": _inf_out(DOCS, 0),
    "context_window": f"{FOLK}, {CTX} select row_id, ent_ord, type, context from ctx",
    "context_indicators": f"{FOLK}, {CTX} select row_id, ent_ord, indicators from ind",
    "inferred_context": _inf_out(FOLK, 1),
    "inferred_all": _inf_out(FOLK, None),
    "context_indicators_shared_basis": f"{_SHARED}, {CTX} select row_id, ent_ord, indicators from ind",
    "inferred_all_shared_basis": _inf_out(_SHARED, None),
    "context_score": f"""with rt as (select doc_id as row_id, text as row_text from documents)
 select row_id, sensitive_categories, round(raw_score, 6) as context_score from {_scores('rt', 'row_text')}""",
    "row_risk": f"{_risk(FOLK)} select * from rr",
    "row_risk_documents": f"{_risk(DOCS)} select * from rr",
    "row_risk_shared_basis": f"{_risk(_SHARED)} select * from rr",
    "proximity_summary": f"{_risk(FOLK)} {_SUMMARY_OUT}",
    "proximity_summary_documents": f"{_risk(DOCS)} {_SUMMARY_OUT}",
    "graph_nodes": f"""{_graph(FOLK)} select node_id, row_id, "column", text, type, "start", "end", confidence, method,
 risk_level, self_loop, {_w('type')} as weight from nodes""",
    "graph_edges": f"{_graph(FOLK)} select row_id, src, dst, weight, relation_type, distance from edges",
    "graph_edges_detected": f"""{FOLK}, {NODES_LIST.format(inferred='')}, {NODES}, {EDGES}
 select row_id, src, dst, round(w, 6) as weight, 'cooccurrence' as relation_type from cooc""",
    "graph_stats": f"{_graph(DOCS)}, {_NBR} {_STATS_OUT}",
    "graph_stats_people": f"{_graph(FOLK)}, {_NBR} {_STATS_OUT}",
    "components": f"{_graph(DOCS)}{_COMPONENTS.format(w=_w('n.type'))}",
    "top_degree": _top("degree"),
    "top_betweenness": _top("betweenness"),
    "top_closeness": _top("closeness"),
    "risk_clusters": f"{_graph(DOCS)}{_CLUSTERS}",
    "reid_risk": f"{_graph(DOCS)}, {_NBR}, {_REID} {_REID_OUT}",
    "reid_risk_people": f"{_graph(FOLK)}, {_NBR}, {_REID} {_REID_OUT}",
    "graph_top_nodes": f"""{_graph(DOCS)}, {_NBR},
 top as (select node_id from deg order by degree desc, kind, row_id, node_ord limit {K.MAX_GRAPH_NODES})
 select src, dst, weight, relation_type from edges
 where src in (select node_id from top) and dst in (select node_id from top)""",
    "cliques_hold": f"""{_graph(DOCS)}, {_NBR},
 byrow as (select row_id, count(*) as n from edges where src <> dst group by row_id),
 sizes as (select row_id, count(*) as k from nodes group by row_id)
 select count(*) as rows_not_cliques from byrow join sizes using (row_id) where n <> k * (k - 1) // 2""",
    "mask_spans": f"""{DOCS}, {_SPANS_OF}
 select d.doc_id as row_id, {_fold('d.text')} as text from documents d left join spans on spans.row_id = d.doc_id""",
    "mask_from_detections": f"""{DOCS}, {_SPANS_OF}
 select d.doc_id as row_id, {_fold('d.text')} as text from documents d left join spans on spans.row_id = d.doc_id""",
    "mask_merged": f"""{FOLK}, {_MERGED},
 m as (select c.row_id, c.col_idx, {_fold('c.text')} as t from cells c left join spans using (row_id, col_idx))
 select row_id, {_WIDE} from m group by row_id""",
    "mask_patterns": f"select doc_id as row_id, {_mask_patterns('text')} as text from documents",
    "mask_names": f"select doc_id as row_id, {_mask_names('text')} as text from documents",
    "mask_full": f"""{FOLK}, {_MASKED_CELLS}, w as (select row_id, {_WIDE} from m3 group by row_id)
 select w.*, p.balance from w join people p using (row_id)""",
    "mask_full_documents": f"{DOCS}, {_MASKED_CELLS} select row_id, t as text from m3",
    "recommendations": f"{_FULL} select ord, line from advice",
    "report_row": _REPORT,
    "report_text": _TEXT,
    "report_file": f"""{_FULL} select (select count(*) from det)::bigint as total_detections, (select round(score, 6) from reid2) as score,
 (select string_agg(line, '|' order by ord) from advice) as recommendations""",
    "sanitize_text": r"""select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '[<>]', '', 'g'),
 '(?i)javascript:', '', 'g'), '(?i)on\w+=', '', 'g'), '^[\s\x{0B}\x{FEFF}\x{2028}\x{2029}\p{Zs}]+|[\s\x{0B}\x{FEFF}\x{2028}\x{2029}\p{Zs}]+$', '', 'g') as clean from pages""",
    "sanitize_filename": "select page_id, regexp_replace(url, '[^a-zA-Z0-9._-]', '_', 'g') as filename from pages",
    "risk_badge": f"{_risk(FOLK)} select row_id, {_BADGE} as badge, printf('%.1f%%', context_score * 100) as score_pct from rr",
    "csv_quoted_breaks": """select doc_id as row_id, length(t)::bigint as n, md5(t) as digest
 from (select doc_id, text || chr(10) || '"said", she' as t from documents where text is not null)""",
    "csv_keyless": """select count(*) as n_rows, 0::bigint as "first", count(*) - 1 as "last", count(*) as n_numbers,
 count(distinct doc_id) as n_ids from documents where text is not null""",
    "csv_round_trip": f"{FOLK}, {_MASKED_CELLS} select row_id, {_WIDE} from m3 group by row_id",
    "graph_compact": f"""{_exact(_graph(FOLK))}, {_EDGE_TYPES} select row_id, type1, type2, count_if(not own)::bigint as n_plain,
 coalesce(round(sum(weight) filter (not own), 6), 0) as plain_weight, count_if(own)::bigint as n_own,
 coalesce(round(sum(weight) filter (own), 6), 0) as own_weight from kinds group by all""",
    "graph_expanded": f"{_graph(DOCS)} select row_id, src, dst, weight, relation_type, distance from edges",
    "graph_export_compact": f"""{_exact(_graph(FOLK))}, {_EDGE_TYPES} select case when own then relation_type else type1 || '|' || type2 end as kind,
 count(*)::bigint as n, round(sum(weight), 4) as weight from kinds group by 1""",
    "edges_stats": f"""{_PART_LINKS} select (select count(*) from nodes)::bigint as nodes, (select count(*) from e)::bigint as edges,
 round(2.0::double * (select count(*) from e) / ((select count(*) from nodes) * ((select count(*) from nodes) - 1)), 6) as density,
 round(avg(clustering), 6) as average_clustering, (select n from reach) = (select count(*) from nodes) as is_connected from full_""",
    "edges_degree": f"{_PART_LINKS} select node, degree, triangles, round(clustering, 6) as clustering from full_",
    "edges_top": f"""{_PART_LINKS} select node, round(degree::double / ((select count(*) from nodes) - 1), 6) as centrality from full_
 order by degree desc, node limit {K.TOP_CENTRAL}""",
    "edges_components": f"{_TURN_LINKS} select node, component_id, size from home",
    "edges_uneven": f"""{_TURN_LINKS} select component_id, any_value(size) as size, count(*)::bigint as n_edges
 from home join e on e.x = home.node group by component_id having count(*) <> any_value(size) * (any_value(size) - 1) / 2""",
    "graph_export": f"""{_graph(FOLK)} select 'node' as part, node_id as id, null::varchar as target, type as kind, null::double as weight from nodes
 union all select 'edge', src, dst, relation_type, weight from edges""",
}

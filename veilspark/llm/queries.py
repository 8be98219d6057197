"""The registered queries of this package."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from veilspark.llm.alignment import alignment_scores
from veilspark.llm.bpe import bpe_round_trip
from veilspark.llm.collocations import collocations
from veilspark.llm.decontaminate import leaks
from veilspark.llm.frames import table
from veilspark.llm.jaccard import jaccard_components
from veilspark.llm.language import identify
from veilspark.llm.lines import line_report
from veilspark.llm.ppm import ppm_scores
from veilspark.llm.quality_model import quality_scores
from veilspark.llm.quality_rules import quality_verdicts
from veilspark.llm.repeats import remove_repeats
from veilspark.llm.token_counts import token_counts
from veilspark.llm.topk import top_k


def op1_line_dedup(spark, sf_dir):
    return line_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks(docs, table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_verdicts(docs).drop("n_lines", "n_upper", "n_distinct")


def op4_ppm(spark, sf_dir):
    return ppm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_round_trip(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op6_language(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op7_repeats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs, keep=["doc_id"])


def op9_quality_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels"))


def op10_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op11_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment_scores(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality_rules": op3_quality_rules,
    "op4_ppm": op4_ppm,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_repeats": op7_repeats,
    "op8_jaccard": op8_jaccard,
    "op9_quality_model": op9_quality_model,
    "op10_token_counts": op10_token_counts,
    "op11_alignment": op11_alignment,
    "op12_collocations": op12_collocations,
    "op13_top_k": op13_top_k,
}

ORACLE: dict[str, str] = {
    "op7_repeats": r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 34], ' ') as s
        from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
rep as (select doc_id, i from win where s in (select s from win group by s having count(*) > 1)),
cov as (select distinct doc_id, unnest(range(i, i + 35)) as k from rep),
word as (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as k from d),
kept as (select doc_id, string_agg(x, ' ' order by k) as t
         from word anti join cov using (doc_id, k) group by doc_id),
gone as (select doc_id, count(*) as n from cov group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(gone.n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id) left join gone using (doc_id)
""",
    "op8_jaccard": r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as g from d),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select x.doc_id as a, y.doc_id as b, count(*) as k
      from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
link as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b
         where 100 * k >= 90 * (na.n + nb.n - k)),
edge as (select a, b from link union all select b, a from link),
reach as (select doc_id as a, doc_id as b from d union select r.a, e.b from reach r join edge e on r.b = e.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id
from d left join n using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by a) c using (doc_id)
""",
    "op12_collocations": r"""
with piece as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as s
  from documents),
w as (select lang, regexp_extract_all(s, '[^\x20\x09]+') as w from piece),
gram as (select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as p
         from w, range(1, 6) t(m)),
f as (select lang, m, p, count(*) as f from gram group by all),
n as (select lang, sum(f) as n from f where m = 1 group by lang),
c as (select lang, m, p, f as a, string_split(p, ' ') as x from f where m > 1 and f >= 100),
inside as (
  select lang, array_to_string(x[1:m - 1], ' ') as p, a from c where m > 2
  union all select lang, array_to_string(x[2:m], ' ') as p, a from c where m > 2),
longer as (select lang, p, max(a) as most from inside group by all),
kept as (select c.* from c left join longer using (lang, p) where most is null or most < a),
part as (select lang, p, a, k, array_to_string(x[1:k], ' ') as lp, array_to_string(x[k + 1:m], ' ') as rp
         from (select *, unnest(range(1, m)) as k from kept)),
score as (select part.*, fl.f as l, fr.f as r, n.n,
          (1000::hugeint * a * n.n) // (fl.f::hugeint * fr.f) as s
          from part join f fl on fl.lang = part.lang and fl.p = lp join f fr on fr.lang = part.lang and fr.p = rp
          join n on n.lang = part.lang),
best as (select * from score qualify row_number() over (partition by lang, p order by s, k) = 1)
select lang, row_number() over (partition by lang order by s desc, a desc, p) as rank, p as phrase, a, l, r,
       cast(n as bigint) as n, cast(s as bigint) as score
from best qualify rank <= 2000
""",
    "op13_top_k": r"""
with v as (select row_number() over () as rid, vec_id, embedding as e from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
i as (select rid, vec_id, list_transform(e, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e from v),
s as (select q.rid, q.vec_id as query_id, c.vec_id, c.rid as other,
      cast(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1] * z[2], 0))), 0) as bigint) as score
      from i q join i c on q.rid <> c.rid where q.vec_id % 100 = 0)
select query_id, cast(row_number() over (partition by rid order by score desc, vec_id, other) as integer) as rank, vec_id, score
from s qualify rank <= 10
""",
}

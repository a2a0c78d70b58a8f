"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from turnlake.llm import mixing, rules, urls

WORD = r"[^\x20\x09-\x0D]+"


def _list(values) -> str:
    return "[" + ", ".join(repr(v) for v in values) + "]"


def _by_language(values: dict) -> str:
    return "case lang " + " ".join(f"when '{k}' then {_list(v)}" for k, v in values.items()) + " end"


def _distance(p: str, q: str, n: int) -> str:
    part = lambda a, b: f"case when {a}[i] > 0 then {a}[i] * log2(2.0::double * {a}[i] / ({a}[i] + {b}[i])) else 0 end"
    return f"sqrt(greatest(list_sum(list_transform(range(1, {n + 1}), lambda i: {part(p, q)} + {part(q, p)})) / 2, 0))"


_K = len(rules.COMMON_WORDS["en"])
_EXPECTED = [rules.TOP_SHARE / (i + 1) for i in range(_K)]

QUALITY = f"""
with d as (select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{WORD}') as w, row_number() over () as r from documents),
b as (select *, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, list_filter(str_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines from d),
g as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select r, w, unnest(range(1, len(w) - 1)) as i from b where len(w) > 2)),
f as (select r, i from (select r, i, count(*) over (partition by r, g) as n from g) where n > 1),
c as (select r, count(distinct i + k)::bigint as n_repeat_words from f, range(3) x(k) group by r),
m as (select b.*, coalesce(c.n_repeat_words, 0)::bigint as n_repeat_words, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    greatest(length(text), 1)::double as chars, {_by_language(rules.CHAR_REFERENCE)} as ref, {_by_language(rules.COMMON_WORDS)} as common,
    list_transform(w, lambda x: lower(x)) as lw from b left join c using (r)),
s as (select *, [len(regexp_extract_all(text, '\\p{{Lu}}')) / chars, len(regexp_extract_all(text, '[0-9]')) / chars, n_symbols / chars,
    (len(regexp_extract_all(text, '[!-/:-@\\[-`{{-~]')) - n_symbols) / chars, (length(text) - word_chars) / chars] as p,
    list_transform(common, lambda x: len(list_filter(lw, lambda y: y = x)) / greatest(n_words, 1)::double) as t from m),
v as (select *, list_append(p, greatest(1.0::double - list_sum(p), 0)) as p6, list_append(t, greatest(1.0::double - list_sum(t), 0)) as t13, {_list([*_EXPECTED, 1 - sum(_EXPECTED)])} as q13,
    n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words as base_failed from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed
  and not coalesce(n_words >= {rules.MIN_CHAR_WORDS} and ref is not null and {_distance("p6", "ref", 6)} > {rules.MAX_CHAR_DISTANCE}, false)
  and not coalesce(n_words >= {rules.MIN_WORD_WORDS} and common is not null and {_distance("t13", "q13", _K + 1)} > {rules.MAX_WORD_DISTANCE}, false) as kept from v
"""

VECTORS = """
with recursive v as (select vec_id, label, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n from embeddings
    where label is not null and embedding is not null),
k as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where a.n > 0 and b.n > 0 and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
r as (select a, b from k union select r.a, k.b from r join k on r.b = k.a),
c as (select a, least(a, min(b)) as component_id from r group by a), l as (select a, count(*) as n from k group by a)
select vec_id, coalesce(l.n, 0)::bigint as n_links, coalesce(c.component_id, vec_id) as component_id, coalesce(c.component_id, vec_id) = vec_id as kept
from embeddings left join l on l.a = vec_id left join c on c.a = vec_id
"""

_RULES = ", ".join("('{}', '/{}', '{}', '{}')".format(*text.partition("/")[::2], text, verdict) for text, verdict in urls.RULES)
_LETTERS = "".join(map(chr, range(65, 91)))

URLS = f"""
with u as (select page_id, row_number() over () as r, case when contains(coalesce(url, ''), '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, r, translate(regexp_extract(rest, '^[^/?#]*'), '{_LETTERS}', '{_LETTERS.lower()}') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
f as (select r, max_by({{'rule': rule, 'verdict': verdict}}, length(rule)) as best from h, (values {_RULES}) t(rh, rp, rule, verdict)
    where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by r)
select page_id, host, path, best['rule'] as rule, coalesce(best['verdict'], case when list_has_any(string_split_regex(host, '[.-]'), {_list(urls.HOST_WORDS)}) then 'block' else 'allow' end) as verdict
from h left join f using (r)
"""

MIX = f"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size, md5('0:' || coalesce(doc_id::varchar, '')) as key from documents),
s as (select source, sum(size)::bigint as total, count(*) as docs, row_number() over (order by source nulls last) - 1 as src from d group by source),
w as (select *, [3, 1, 2][src % 3 + 1] as weight, 1.5 * (select sum(total) from s) as budget from s),
o as (select *, coalesce(sum(2.0 * total) over (order by 2.0 * total / weight, src rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (order by 2.0 * total / weight, src rows between current row and unbounded following) as after from w),
x as (select *, (budget - before) * weight / after > 2.0 * total as capped from o),
t as (select *, case when capped then 2.0 * total else (budget - coalesce((select sum(2.0 * total) from x where capped), 0)) * weight / (select sum(weight) from x where not capped) end::double as target from x),
e as (select *, sum(target / (select sum(target) from t)) over (order by src) as border, lag(src) over (order by src) as prior from t),
b as (select *, coalesce(lag(border) over (order by src), 0) as low, row_number() over (order by src desc) = 1 as final from e),
i as (select (i::hugeint * {mixing.GOLDEN}::hugeint) % {2**64}::hugeint as x from range((select round(sum(target) / 64)::bigint from t)) r(i)),
n as (select src, count(*) as slots from i join b on x >= (low * {2**64}::double)::hugeint and (x < (border * {2**64}::double)::hugeint or final) group by src),
y as (select b.*, least(coalesce(n.slots, 0) * 64, 2 * total) as words, greatest(1, docs // 1000) as buckets from b left join n using (src)),
p as (select d.doc_id, d.size, y.total, y.target, y.words,
    sum(d.size) over (partition by y.src order by ('0x' || substr(key, 1, 8))::bigint % buckets, key, doc_id, size rows between unbounded preceding and current row) - d.size as start
    from d join y on d.source is not distinct from y.source)
select doc_id, size, total as source_size, target, (greatest(0, least(start + size, words) - start) + greatest(0, least(total + start + size, words) - total - start))::bigint as taken from p
"""

NEGATIVES = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding::double[], lambda x: floor(256 * x)) as e
    from embeddings where label is not null and embedding is not null and len(list_filter(embedding::double[], lambda x: x is null or not isfinite(x))) = 0),
k as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, list_dot_product(a.e, b.e)::bigint as s from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where a.vec_id % 50 = 0),
p as (select a, b, s from k where same qualify row_number() over (partition by a order by s desc, b) <= 5)
select p.a as anchor_id, p.b as positive_id, (row_number() over (partition by p.a, p.b order by k.s desc, k.b))::integer as rank, k.b as negative_id, p.s as positive_score, k.s as negative_score
from p join k on p.a = k.a and not k.same where 50 * p.s <= 100 * k.s and 100 * k.s <= 95 * p.s
qualify row_number() over (partition by p.a, p.b order by k.s desc, k.b) <= 3
"""

PHRASES = f"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}') as text from documents),
p as (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
o as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from (select lang, w, unnest(range(1, len(w) + 1)) as i from w), range(1, 4) t(k) where i + k - 1 <= len(w)),
f as (select lang, k, phrase, count(*)::bigint as n from o group by all having count(*) >= 10),
t as (select lang, count(*)::bigint as n from o where k = 1 group by lang),
c as (select f.*, j, array_to_string(string_split(phrase, ' ')[:j], ' ') as x, array_to_string(string_split(phrase, ' ')[j + 1:], ' ') as y from f, range(1, 3) s(j) where j < k),
s as (select c.lang, c.k, c.phrase, c.n as a, l.n as l, r.n as r, (1000000::hugeint * c.n * c.n // (l.n::hugeint * r.n))::bigint as score from c
    join f l on l.lang = c.lang and l.phrase = c.x join f r on r.lang = c.lang and r.phrase = c.y
    qualify row_number() over (partition by c.lang, c.phrase order by score, j) = 1),
b as (select lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') as phrase, max(n) as n from f, range(1, 3) t(i) where k = 3 group by all),
m as (select s.* from s left join b using (lang, phrase) where b.n is null or 100 * b.n < 50 * s.a)
select m.lang, row_number() over (partition by m.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, t.n, score from m join t using (lang)
qualify rank <= 2000
"""

ORACLES = {"op5_quality_rules": QUALITY, "op6_embedding_dedup": VECTORS, "op7_url_filter": URLS, "op8_source_mix": MIX, "op11_phrases": PHRASES, "op13_hard_negatives": NEGATIVES}

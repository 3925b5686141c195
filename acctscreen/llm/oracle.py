"""DuckDB SQL for the queries that SQL can express.

Written from the rules, not from the operators: entropy, for one, is taken
window by window here, and targets by recursion.
"""

from __future__ import annotations

from acctscreen.llm.op13_licenses import PHRASES, TEMPLATES, needed, width

_ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']?" r"\x20*[:=]\x20*" "[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def _found(name: str, pattern: str) -> str:
    return f"""
{name}_r as materialized (select doc_id, regexp_extract_all(t, '{pattern}') as m, regexp_split_to_array(t, '{pattern}') as p
    from d where regexp_matches(t, '{pattern}')),
{name} as materialized (select doc_id, m[i] as s,
    coalesce(list_sum(list_transform(p[1 : i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) as a
    from (select *, unnest(range(1, len(m) + 1)) as i from {name}_r))"""


def _entropy(name: str, alphabet: str, window: int, bits: float, needs: tuple[str, ...]) -> str:
    ok = " and ".join(f"regexp_matches(s, '{x}')" for x in needs)
    return _found(f"{name}_c", f"{alphabet}{{{window},}}") + f""",
{name}_w as (select doc_id, a, s, unnest(range(length(s) - {window} + 1)) as i from {name}_c where {ok}
    and not regexp_matches(s, 'EXAMPLE|[Ee]xample|PLACEHOLDER|[Pp]laceholder|CHANGEME|changeme')
    and not regexp_matches(s, '[Xx]{{6}}|0123456789|[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh]')
    and not regexp_matches(s, '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$')
    and not (regexp_matches(s, '^[A-Za-z0-9_-]*/[a-z/_-]*/[A-Za-z0-9/_-]*$') and not regexp_matches(s, '[A-Za-z0-9_-]{{20}}'))),
{name}_h as (select doc_id, a, i from {name}_w where list_aggregate(regexp_extract_all(substring(s, i + 1, {window}), '.'), 'entropy') >= {bits}),
{name}_g as (select *, sum(new) over (partition by doc_id, a order by i) as g from (
    select *, case when i - lag(i) over (partition by doc_id, a order by i) <= {window} then 0 else 1 end as new from {name}_h)),
{name} as (select doc_id, a + min(i) as a, a + max(i) + {window} as b from {name}_g group by doc_id, a, g)"""


_SECRETS = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
{_found('assign', _ASSIGN)},
{_found('access', 'AKIA[A-Z0-9]+')},
{_found('hex', '[0-9a-f]+')},
{_entropy('ehex', '[0-9A-Fa-f]', 16, 2.72, ('[0-9]', '[A-Fa-f]'))},
{_entropy('eb64', '[A-Za-z0-9+/_-]', 20, 3.77, ('[0-9]', '[a-z]', '[A-Z]'))},
spans as (
    select doc_id, 0 as k, 'assign' as kind, a, a + length(s) as b from assign where length(regexp_extract(s, '{_ASSIGN}', 2)) >= 12
    union all select doc_id, 1, 'access', a, a + length(s) from access where length(s) >= 18
    union all select doc_id, 2, 'hex', a, a + length(s) from hex where length(s) >= 16
    union all select doc_id, 3, 'entropy_hex', a, b from ehex
    union all select doc_id, 4, 'entropy_base64', a, b from eb64),
per as (select doc_id, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access, count(*) filter (where k = 2) as n_hex,
    coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, k) filter (where k < 3), '') as base,
    string_agg(kind || ':' || a || ':' || b, ',' order by a, k) as spans from spans group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join per using (doc_id)
"""

_MIX = r"""
with recursive d as (select doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
s as (select source, sum(size)::bigint as source_size, [3, 1, 2][(row_number() over (order by source collate "C" nulls last) - 1) % 3 + 1] as w from d group by source),
r(round, full_n, rate) as (
    select 0, -1, 0::double
    union all
    select r.round + 1, x.n, x.rate from r, lateral (
        select count(*) filter (where s.source_size * 2.0::double <= s.w * r.rate and r.round > 0) as n,
            (sum(s.source_size)::double * 1.5::double - coalesce(sum(s.source_size * 2.0::double) filter (where s.source_size * 2.0::double <= s.w * r.rate and r.round > 0), 0))
            / sum(s.w) filter (where s.source_size * 2.0::double > s.w * r.rate or r.round = 0) as rate from s) x
    where x.rate is not null and x.n > r.full_n),
t as (select source, source_size, least(source_size * 2.0::double, w * (select arg_max(rate, round) from r)) as target from s),
e as (select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0 end as rate,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 13))::bigint / 4503599627370496::double as u
    from d join t on d.source is not distinct from t.source)
select doc_id, size::bigint as size, source_size, target::double as target, ((floor(rate) + (u < rate - floor(rate))::int) * size)::bigint as taken from e
"""

_WARC = """
with p as (select page_id, coalesce(html, '') as h, sha1(coalesce(html, '')) as x from pages),
g as (select x, max(page_id) as last from p group by x)
select page_id, strlen(h)::bigint as payload_bytes,
    list_aggregate(list_transform(range(8), lambda k: list_aggregate(list_transform([15, 10, 5, 0], lambda b:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, (k * 5 + 1)::int, 5))::int >> b) & 31) + 1, 1)), 'string_agg', '')), 'string_agg', '') as payload_digest,
    case when page_id = last then 'response' else 'revisit' end as record_type,
    case when page_id = last then null else last end as refers_to
from p join g using (x)
"""

_TOPK = """
with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))::bigint as score
    from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, rank::int as rank, vec_id, score from (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""

_COLLOCATIONS = r"""
with pieces as (select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p from documents),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
total as (select lang, sum(len(w))::bigint as n from w group by lang),
g as (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from (select lang, w, unnest([1, 2, 3, 4]) as k from w)),
f as materialized (select lang, phrase, string_split(phrase, ' ') as ws, count(*) as a from (select lang, array_to_string(w[i : i + k - 1], ' ') as phrase from g) group by lang, phrase having count(*) >= 30),
c as materialized (select * from f where len(ws) >= 2),
cuts as (select lang, phrase, a, k, array_to_string(ws[1 : k], ' ') as x, array_to_string(ws[k + 1 :], ' ') as y from (select *, unnest(range(1, len(ws))) as k from c)),
best as (select lang, phrase, a, l, r, score from (
    select cuts.lang, cuts.phrase, cuts.a, f1.a as l, f2.a as r, (2000000::hugeint * cuts.a) // (f1.a + f2.a) as score,
        row_number() over (partition by cuts.lang, cuts.phrase order by (2000000::hugeint * cuts.a) // (f1.a + f2.a), k) as o
    from cuts join f f1 on f1.lang = cuts.lang and f1.phrase = cuts.x join f f2 on f2.lang = cuts.lang and f2.phrase = cuts.y) where o = 1),
inside as (select lang, array_to_string(ws[i : i + k - 1], ' ') as phrase, max(a) as most from (
    select lang, ws, a, k, unnest(range(1, len(ws) - k + 2)) as i from (select *, unnest([2, 3]) as k from c) where k < len(ws)) group by all),
kept as (select best.* from best left join inside using (lang, phrase) where most is null or 100 * most < 80 * a)
select lang, rank, phrase, a, l, r, n, score::bigint as score from (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) join total using (lang) where rank <= 2000
"""

_TRIE = r"""
with t as (select conv_id, coalesce(role, '') as r, coalesce(text, '') as x,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i from conversations where conv_id is not null),
o as (select conv_id, list({'r': r, 'x': x} order by i) as s,
    xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(conv_id::varchar, ''), lambda ch: [ord(ch)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384)), 4294967295::bigint) % 4 as h from t group by conv_id),
b as materialized (select o.conv_id, list_concat(coalesce(p.s[1 : o.h], []), o.s[o.h + 1 :]) as s from o left join o p on p.conv_id = o.conv_id - o.conv_id % 20),
m as (select conv_id, d, s[1 : d] as k, len(s) = d as last from (select *, unnest(range(len(s) + 1)) as d from b)),
nodes as materialized (select k, d, count(*) as n, min(conv_id) as conv_id, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where last), '')) as ends,
    (count(*) - 1) * (case when d = 0 then 0 else len(regexp_extract_all(k[d].x, '[^\x20\x09-\x0D]+')) end) as saved from m group by k, d),
kids as (select k[1 : d - 1] as k, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all),
sub as (select u.k[1 : a] as k, a as d, count(*) filter (where kids.d is null) as n_leaves, sum(saved) as saved_tokens
    from (select *, unnest(range(d + 1)) as a from nodes) u left join kids on kids.k = u.k and kids.d = u.d group by all)
select nodes.conv_id, nodes.d as depth, up.conv_id as parent_conv_id, nodes.n as n_convs, coalesce(n_children, 0) as n_children, n_leaves,
    saved_tokens::bigint as saved_tokens, nodes.ends as ends_sha256
from nodes join sub on sub.k = nodes.k and sub.d = nodes.d left join kids on kids.k = nodes.k and kids.d = nodes.d
left join nodes up on up.d = nodes.d - 1 and up.k = nodes.k[1 : nodes.d - 1]
"""


def _licenses() -> str:
    texts = [(label, text.split()) for label, text in TEMPLATES]
    template = ", ".join(f"({i}, '{label}', {len(set(w))}, {needed(len(set(w)))}, {width(len(w))})" for i, (label, w) in enumerate(texts))
    term = ", ".join(f"({i}, '{w}')" for i, (_, ws) in enumerate(texts) for w in sorted(set(ws)))
    phrase = ", ".join(f"('{label}', {text.split()})" for label, text in PHRASES.items())
    return f"""
with template(id, label, n, needed, width) as (values {template}),
term(id, word) as (values {term}),
phrase(label, words) as (values {phrase}),
d as materialized (select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
w as materialized (select row, word, i - 1 as i from (select row, unnest(w) as word, generate_subscripts(w, 1) as i from d)
    where word in (select word from term union all select unnest(words) from phrase)),
base as (select w.row, label, w.i from w join phrase on words[1] = w.word join d on d.row = w.row where d.w[w.i + 1 : w.i + len(words)] = words),
bases as (select row, count(*) as n_base, min(i) as first_word, max(i) as last_word, list_distinct(list(label)) as labels from base group by row),
hit as materialized (select id, row, i, word from w join term using (word)),
seen as (select x.id, x.row, x.i, count(distinct y.word) as have from hit x join template t on t.id = x.id
    join hit y on y.id = x.id and y.row = x.row and y.i >= x.i and y.i < x.i + t.width group by all),
blocks as (select row, list_distinct(list(label)) as labels, max(have / n) as score from seen join template using (id) where have >= needed group by row)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
    coalesce(array_to_string(list_sort(bases.labels), ','), '') as base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bases.labels, []), coalesce(blocks.labels, [])))), ','), '') as labels,
    case when n_base > 0 then 1 else coalesce(score, 0) end::double as score
from d left join bases on bases.row = d.row left join blocks on blocks.row = d.row
"""


ORACLE: dict[str, str] = {
    "op1_secret_scan": _SECRETS,
    "op2_source_mix": _MIX,
    "op7_warc_roundtrip": _WARC,
    "op10_exact_topk": _TOPK,
    "op11_phrase_collocations": _COLLOCATIONS,
    "op12_conversation_trie": _TRIE,
    "op13_license_scan": _licenses(),
}

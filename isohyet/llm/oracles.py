"""SQL equivalents of the numbered queries that SQL can express, for small tables: all pairs and all substrings."""

from __future__ import annotations

# Components: every id with all ids it reaches, then the smallest.
_REACH = """reach(id, c) as (select id, id from nodes union select r.id, l.b from reach r join links l on r.c = l.a),
    part as (select id, min(c) as component_id from reach group by id)"""

_USABLE = """vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0"""

EMBEDDINGS = f"""with recursive v as (select vec_id as id, embedding::double[] as e from embeddings where {_USABLE}),
    nodes as (select distinct id from v),
    links as (select a.id as a, b.id as b from v a join v b on a.id <> b.id and len(a.e) = len(b.e)
        where list_cosine_similarity(a.e, b.e) >= 0.9),
    {_REACH}
    select t.vec_id, coalesce(n, 0)::bigint as n_links, coalesce(component_id, t.vec_id) as component_id,
        coalesce(component_id, t.vec_id) = t.vec_id as kept
    from embeddings t left join part on part.id = t.vec_id left join (select a, count(*) as n from links group by a) on a = t.vec_id"""

_WORDS = r"""select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents"""

NEAR_DUPLICATES = f"""with recursive s as (select distinct doc_id, case when len(w) > 1 then w[i] || ' ' || w[i + 1] else w[1] end as shingle
        from ({_WORDS}), unnest(range(1, greatest(len(w), 2))) t(i) where len(w) > 0),
    nodes as (select doc_id as id, count(*) as n from s group by 1),
    pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
    near as (select a, b from pairs join nodes x on x.id = a join nodes y on y.id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
    links as (select a, b from near union all select b, a from near),
    {_REACH}
    select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, d.doc_id) as component_id,
        coalesce(component_id, d.doc_id) = d.doc_id as kept
    from documents d left join nodes on nodes.id = d.doc_id left join part on part.id = d.doc_id"""

PASSAGES = """with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
    bytes as (select doc_id, p, n, substr(h, 2*p + 1, 2) as byte, case when p + 200 <= n then md5(substr(h, 2*p + 1, 400)) end as string
        from d, unnest(range(n)) t(p)),
    again as (select string from bytes where string is not null group by 1 having count(*) > 1),
    marked as (select doc_id, p, byte, max(case when a.string is not null then 1 else 0 end) over (
        partition by doc_id order by p rows between 199 preceding and current row) as gone from bytes left join again a using (string)),
    spans as (select *, lag(gone, 1, 0) over (partition by doc_id order by p) as before from marked),
    done as (select doc_id, sum(gone)::bigint as n_removed, count(*) filter (where gone = 1 and before = 0) as n_spans,
        coalesce(string_agg(byte, '' order by p) filter (where gone = 0), '') as kept from spans group by 1)
    select d.doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
        sha256(unhex(coalesce(kept, ''))) as kept_sha256 from d left join done using (doc_id)"""

DIVERGENCE = r"""with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as doc, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
    t as (select lang, source, doc, unnest(w) as term from d),
    k as (select lang, term, count(*) as total from t group by 1, 2 having count(distinct doc) >= 3),
    c as (select lang, source, term, count(*) as n from t semi join k using (lang, term) group by 1, 2, 3),
    v as (select lang, count(*) as v, sum(total) as n from k group by 1),
    g as (select d.lang, d.source, (select coalesce(sum(c.n), 0) from c where c.lang = d.lang and c.source = d.source) as n from d group by 1, 2),
    p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as own, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.n + v.v) as p,
            1 + (1000000000::hugeint * (k.total + 1)) // (v.n + v.v) as q
        from g join k using (lang) join v using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
    pairs as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
        from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
    rows as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
            from g a join g b on a.lang = b.lang and a.source <> b.source left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
        union all select lang, source, 'term', term, (((p - q) * (p - q)) // q)::bigint from p where own > 0 and p > q),
    ranked as (select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from rows)
    select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 200"""

# CRC-32 bit by bit; then, row by row, the cheapest (cost, audit, rows) of every state, an edit and the insertions behind it at a time.
CONVERSATIONS = r"""with recursive key as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as s from conversations),
    damaged as (select *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(s) + 1), lambda i: ascii(s[i])::bigint)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
            lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)), 4294967295) % 20 as kind from key),
    copies as (select conv_id, turn, case when kind = 4 then 'user' else role end as role, case when kind = 1 then '' when kind = 2
        then replace(replace(replace(text, '.', ''), '!', ''), '?', '') else text end as text
        from damaged, unnest(range(case when kind = 3 then 2 else 1 end)) where kind <> 0),
    numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') as body from copies),
    met as (select *, row_number() over (partition by conv_id, role, text order by i) as seen from numbered),
    faults as (select *, role[1] as x, case when body = '' then 'blank' when seen > 1 then 'duplicate' when body[-1] not in ('.', '!', '?') then 'truncated' else 'none' end as fault,
        lag(role[1]) over (partition by conv_id order by i) || role[1] as pair from met),
    stats as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
        count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
        count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal from faults group by 1),
    step(p, x, q) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    gap(p, q, c, a, b) as (values (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 2, 'I', chr(10) || 'user:'), (1, 2, 2, 'I', chr(10) || 'user:'),
        (2, 3, 2, 'I', chr(10) || 'assistant:'), (3, 2, 2, 'I', chr(10) || 'user:'), (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
        (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
    edits as (select f.conv_id, f.i, s.p, s.q, (case when s.x = f.x then 0 else 2 end) + (f.fault = 'truncated')::int as c, case when s.x = f.x then 'K' else 'R' end as a,
            chr(10) || case when s.x = f.x then f.role when s.x = 'u' then 'user' else 'assistant' end || ':' || f.text as b
            from faults f join step s on f.fault in ('none', 'truncated') and (s.x = f.x or s.x <> 's')
        union all select conv_id, i, p, p, 3, 'D', '' from faults, (values (0), (1), (2), (3)) v(p)),
    best as (select conv_id, 0::bigint as i, q, {'c': c, 'a': a, 'b': b} as v from (select conv_id from stats), gap where p = 0
        union all select d.conv_id, d.i + 1, g.q, min({'c': d.v.c + e.c + g.c, 'a': d.v.a || e.a || g.a, 'b': d.v.b || e.b || g.b})
        from best d join edits e on e.conv_id is not distinct from d.conv_id and e.i = d.i + 1 and e.p = d.q join gap g on g.p = e.q group by d.conv_id, d.i + 1, g.q),
    last as (select b.conv_id, min(v) as v from best b join stats s on s.conv_id is not distinct from b.conv_id and s.n = b.i where q in (0, 3) group by 1)
    select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
        coalesce(illegal, 0) as illegal, coalesce(v.c, 0)::bigint as cost, coalesce(v.a, '') as audit, sha256(coalesce(v.b[2:], '')) as repaired_sha256
    from (select distinct conv_id from conversations) c left join stats s on s.conv_id is not distinct from c.conv_id left join last l on l.conv_id is not distinct from c.conv_id"""

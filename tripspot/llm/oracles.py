"""The rows of the queries that SQL can express, in DuckDB SQL."""

NEAR_DEDUP = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents),
shingles as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
    from words),
sizes as (select doc_id, count(s) as n from words left join shingles using (doc_id) group by doc_id),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as k
    from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (
    select a, b from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id
    where 100 * k >= 80 * (x.n + y.n - k)),
reach as (
    select doc_id as a, doc_id as b from words
    union
    select r.a, l.b from reach r join links l on r.b = l.a)
select a as doc_id, n as n_shingles, min(b) as component_id, a = min(b) as kept
from reach join sizes on a = doc_id group by a, n
"""

WARC = """
select page_id, payload_bytes, payload_digest, case when page_id = f then 'response' else 'revisit' end as record_type,
       case when page_id <> f then f end as refers_to
from (
    select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as f
    from (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                 sha256(coalesce(html, '')) as payload_digest from pages))
"""

TOP_K = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
    from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cells as (select vec_id, unnest(v) as x, unnest(range(len(v))) as i from whole),
scores as (
    select q.vec_id as query_id, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
    from cells q join cells c on q.i = c.i and q.vec_id <> c.vec_id where q.vec_id % 100 = 0 group by all)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 10
"""

# The checksum byte by byte, with its table made from the polynomial.
SHARDING = """
with crc_table as (
    select list(c order by i) as t from (
        select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
        from range(256) r(i))),
bytes as (
    select doc_id, octet_length(encode(coalesce(text, ''))) as n, hex(encode(coalesce(text, ''))) as h from documents),
sums as (
    select doc_id, n + 8 as size,
           xor(list_reduce(list_transform(regexp_extract_all(h, '..'), lambda x: cast('0x' || x as bigint)),
                           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), cast(4294967295 as bigint)), 4294967295) as text_crc32
    from bytes, crc_table),
placed as (
    select *, sum(size) over (order by doc_id) - size as before, sum(size) over () as total,
           row_number() over (order by doc_id) - 1 as position from sums),
cut as (select *, least(23, ((2 * before + size) * 24) // (2 * total)) as s from placed)
select doc_id, size, text_crc32, 'bytes' as law, cast(s as integer) as shard,
       position - min(position) over (partition by s) as slot, cast(null as integer) as grown_shard
from cut
"""

MIXING = r"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
sources as (
    select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as number
    from sized group by source),
weighted as (
    select *, case number % 3 when 1 then 3 when 2 then 1 else 2 end as weight, 2 * source_size as cap,
           1.5::double * sum(source_size) over () as total
    from sources),
levels as (
    select *, (total - coalesce(sum(cap) over (order by cap / weight, number rows between unbounded preceding and 1 preceding), 0))
              / sum(weight) over (order by cap / weight, number rows between current row and unbounded following) as level
    from weighted),
capped as (select *, cap <= level * weight as is_capped from levels),
targets as (
    select source, source_size,
           case when is_capped then cap::double
                else weight * (select level from capped where not is_capped order by cap / weight, number limit 1) end as target,
           cast('0x' || substr(md5('17:' || coalesce(source, 'null')), 1, 8) as bigint) / 4294967296.0::double as u
    from capped),
placed as (
    select s.doc_id, s.source, s.size, t.source_size, t.target, t.u,
           case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
           row_number() over (partition by s.source order by s.size, s.doc_id) as k
    from sized s join targets t on s.source is not distinct from t.source)
select doc_id, source, size, source_size, target, copies, copies * size as taken
from (select *, cast(floor(k * rate + u) - floor((k - 1) * rate + u) as bigint) as copies from placed)
"""

REPAIR = r"""
with recursive crc_table as (
    select list(c order by i) as t from (
        select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
        from range(256) r(i))),
keyed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           hex(encode(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))) as h
    from conversations),
hit as (
    select conv_id, turn, role, text,
           xor(list_reduce(list_transform(regexp_extract_all(h, '..'), lambda x: cast('0x' || x as bigint)),
                           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), cast(4294967295 as bigint)), 4294967295) % 20 as f
    from keyed, crc_table),
damaged as (
    select conv_id, turn, case when f = 4 then 'user' else role end as role,
           case f when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(range(case f when 0 then 0 when 3 then 2 else 1 end)) as copy
    from hit),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as i,
           count(*) over (partition by conv_id) as n, rtrim(text, e' \t\n\x0b\x0c\r') as seen
    from damaged),
judged as (
    select *, case when seen = '' then 1 when row_number() over (partition by conv_id, role, text order by i) > 1 then 3
                   when right(seen, 1) not in ('.', '!', '?') then 2 else 0 end as fault,
           case left(role, 1) when 's' then 2 when 'u' then 3 when 'a' then 4 else 1 end as init,
           lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
    from placed),
report as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 1) as blank,
           count(*) filter (where fault = 3) as duplicate, count(*) filter (where fault = 2) as truncated,
           count(*) filter (where i > 1 and pair not in ('su', 'ua', 'au')) as illegal
    from judged group by conv_id),
-- Cheapest ends, from the last row to the first: for each state (nothing, s, u, a) cost, audit and lines.
back(conv_id, i, d) as (
    select conv_id, n + 1, [{'c': 0, 'a': '', 'l': []::varchar[]}, {'c': 4, 'a': 'II', 'l': ['user:', 'assistant:']},
                            {'c': 2, 'a': 'I', 'l': ['assistant:']}, {'c': 0, 'a': '', 'l': []::varchar[]}]
    from judged where i = n
    union all
    select conv_id, i, list_transform([1, 2, 3, 4], lambda s: list_min([
        e[s], {'c': 2 + e[if(s = 3, 4, 3)].c, 'a': 'I' || e[if(s = 3, 4, 3)].a, 'l': [if(s = 3, 'assistant:', 'user:')] || e[if(s = 3, 4, 3)].l},
        {'c': 4 + e[if(s = 3, 3, 4)].c, 'a': 'II' || e[if(s = 3, 3, 4)].a,
         'l': [if(s = 3, 'assistant:', 'user:'), if(s = 3, 'user:', 'assistant:')] || e[if(s = 3, 3, 4)].l}]))
    from (
        select j.conv_id, j.i, list_transform([1, 2, 3, 4], lambda s: list_min(list_filter([
            {'c': 3 + d[s].c, 'a': 'D' || d[s].a, 'l': d[s].l},
            case when fault in (0, 2) and ((s <> 3 and init = 3) or (s = 1 and init = 2) or (s = 3 and init = 4))
                 then {'c': if(fault = 2, 1, 0) + d[init].c, 'a': 'K' || d[init].a, 'l': [role || ':' || text] || d[init].l} end,
            case when fault in (0, 2)
                 then {'c': if(fault = 2, 3, 2) + d[if(s = 3, 4, 3)].c, 'a': 'R' || d[if(s = 3, 4, 3)].a,
                       'l': [if(s = 3, 'assistant:', 'user:') || text] || d[if(s = 3, 4, 3)].l} end],
            lambda x: x is not null))) as e
        from back b join judged j on b.conv_id is not distinct from j.conv_id and j.i = b.i - 1))
select k.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(d[1].c, 0) as bigint) as cost,
       coalesce(d[1].a, '') as audit, sha256(coalesce(array_to_string(d[1].l, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) k
left join report r on k.conv_id is not distinct from r.conv_id
left join back b on k.conv_id is not distinct from b.conv_id and b.i = 1
"""

CHAT = r"""
with own as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'),
-- A text with a control string, or with one behind backslashes, gets a backslash more in each.
written as (
    select *, length(text) + len(regexp_extract_all(text, '<\\*\|im_(start|end)\|>')) as chars from own)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, md5(text))) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, md5(text)) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(12 + length(role) + 1 + chars + 10 + 1) as bigint) as formatted_chars
from written group by conv_id
"""

COLLOCATIONS = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
    select lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: array_to_string(w[i:i + k - 1], ' '))) as p
    from words, range(1, 4) r(k)),
counted as (select lang, k, p, count(*) as f from grams group by all),
totals as (select lang, cast(sum(f) as bigint) as n from counted where k = 1 group by lang),
candidates as (select lang, k, p, f as a, string_split(p, ' ') as w from counted where k > 1 and f >= 10),
cuts as (
    select lang, p, a, c, array_to_string(w[:c], ' ') as first, array_to_string(w[c + 1:], ' ') as rest
    from (select *, unnest(range(1, k)) as c from candidates)),
scored as (
    select x.lang, x.p, x.a, c, l.f as l, r.f as r, cast((1000000::hugeint * x.a * x.a) // (l.f::hugeint * r.f) as bigint) as score
    from cuts x join counted l on l.lang = x.lang and l.p = x.first and l.k = x.c
    join counted r on r.lang = x.lang and r.p = x.rest),
lowest as (select * from (select *, row_number() over (partition by lang, p order by score, c) as o from scored) where o = 1),
parts as (
    select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as p, a as longer from candidates where k = 3),
covered as (select lang, p, max(longer) as longer from parts group by all)
select lang, rank, phrase, a, l, r, n, score from (
    select s.lang, row_number() over (partition by s.lang order by score desc, s.a desc, encode(s.p)) as rank, s.p as phrase, s.a, l, r, n, score
    from lowest s join totals using (lang) left join covered v on v.lang = s.lang and v.p = s.p
    where longer is null or 100 * longer < 50 * s.a)
where rank <= 2000
"""

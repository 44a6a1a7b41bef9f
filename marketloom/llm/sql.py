"""DuckDB SQL of the text queries that SQL can express, for the comparison run."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
with doc_terms as (
    select doc_id, row_number() over () as no,
        regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents where text is not null
), lengths as (
    select no, doc_id, len(terms)::bigint as n from doc_terms where len(terms) > 0
), totals as (
    select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from lengths
), tf as (
    select no, term, count(*)::bigint as tf from (select no, unnest(terms) as term from doc_terms) group by all
), weights as (
    select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
    from tf, totals group by term, n_docs
), wanted as (
    select distinct item_id, unnest(
        regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark where text is not null
), scores as (
    select item_id, doc_id, no, sum(
        w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::bigint as score
    from wanted join tf using (term) join weights using (term) join lengths using (no), totals
    group by item_id, doc_id, no
), ranked as (
    select item_id, row_number() over (
        partition by item_id order by score desc, doc_id nulls last)::integer as rank, doc_id, score
    from scores where score > 0
)
select * from ranked where rank <= 10
"""

#: CRC-32 of an ASCII text: eight shifts for each of its characters.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), range(8)),
        lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""

OP11 = f"""
with own as (
    select conv_id as conv, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first,
            md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
    from conversations where conv_id is not null
), convs as (
    select conv, {_CRC32.format(text="conv::varchar")} % 6 as h, conv - conv % 100 as base
    from (select distinct conv from own)
), built as (
    select c.conv, 0 as part, o.pos, o.role, o.text from convs c join own o on o.conv = c.base and o.pos <= c.h
    union all
    select c.conv, 1, o.pos, o.role, o.text from convs c join own o on o.conv = c.conv and o.pos > c.h
), turns as (
    select conv, row_number() over w as depth, length(text) as chars,
        list(md5(length(role) || ':' || role || text)) over (w rows unbounded preceding) as path
    from built window w as (partition by conv order by part, pos)
), paths as (
    select conv, depth, chars, path from turns union all select conv, 0, 0, []::varchar[] from convs
), lengths as (
    select conv, max(depth) as len from paths group by conv
), nodes as (
    select path, depth, min(conv) as conv_id, count(*) as n_convs, max(chars) as chars,
        sha256(coalesce(string_agg(conv::varchar, ',' order by conv) filter (where depth = len), '')) as ends_sha256
    from paths join lengths using (conv) group by path, depth
), children as (
    select path[1:depth - 1] as path, count(*) as n from nodes where depth > 0 group by all
), below as (
    select path[1:d] as path, sum((c.n is null)::bigint)::bigint as n_leaves, sum((n_convs - 1) * chars)::bigint as saved_tokens
    from (select *, unnest(range(0, depth + 1)) as d from nodes) x left join children c using (path) group by all
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0)::bigint as n_children,
    b.n_leaves, b.saved_tokens, n.ends_sha256
from nodes n join below b using (path) left join children c using (path)
left join nodes p on n.depth > 0 and p.path = n.path[1:n.depth - 1]
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = f"""
with docs as materialized (
    select row_number() over () as no, doc_id, {_WORDS.format("coalesce(text, '')")} as words from documents
), windows as (
    select no, p, md5(array_to_string(words[p:p + 34], ' ')) as h
    from (select *, unnest(range(1, len(words) - 33)) as p from docs)
), repeated as (
    select no, p from windows qualify count(*) over (partition by h) > 1
), placed as (
    select no, unnest(words) as word, generate_subscripts(words, 1) as i from docs
), judged as (
    select no, i, word, max(p) over (partition by no order by i rows 34 preceding) is null as kept
    from (select w.*, r.p from placed w left join repeated r on r.no = w.no and r.p = w.i)
), summed as (
    select no, count(*) as n_words, count(*) filter (not kept) as n_removed,
        string_agg(word, ' ' order by i) filter (kept) as kept_text
    from judged group by no
)
select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
    sha256(coalesce(kept_text, '')) as kept_sha256
from docs left join summed using (no)
"""

OP2 = f"""
with recursive docs as materialized (
    select row_number() over () as no, doc_id,
        {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as words from documents
), shingles as (
    select distinct no, array_to_string(words[p:p + 4], ' ') as shingle
    from (select *, unnest(range(1, greatest(len(words) - 3, 2))) as p from docs where len(words) > 0)
), sizes as (
    select no, count(*)::bigint as n from shingles group by no
), links as (
    select a, b from (
        select x.no as a, y.no as b, count(*) as shared from shingles x join shingles y using (shingle)
        where x.no <> y.no group by all)
    join sizes s on s.no = a join sizes t on t.no = b
    where 100 * shared >= 80 * (s.n + t.n - shared)
), reached as (
    select no as a, no as b from docs
    union
    select r.a, l.b from reached r join links l on l.a = r.b
), components as (
    select a as no, min(doc_id) as component_id from reached join docs on docs.no = b group by a
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
from docs join components using (no) left join sizes using (no)
"""

#: Base 32 of a SHA-1: each five hexadecimal digits are four letters.
_BASE32 = """list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (31 &
    (('0x' || substr({sha1}, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))))::bigint, 1)), lambda a, b: a || b)"""

OP5 = f"""
with payloads as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages
), firsts as (
    select *, max(page_id) over (partition by h) as response from payloads
)
select page_id, payload_bytes::bigint as payload_bytes, {_BASE32.format(sha1="h")} as payload_digest,
    case when page_id = response then 'response' else 'revisit' end as record_type,
    case when page_id <> response then response end as refers_to
from firsts
"""

_TOKENS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(
    _LOWER.format("coalesce(text, '')"))

OP6 = f"""
with docs as materialized (
    select row_number() over () as no, doc_id, {_TOKENS} as words from documents
), items as (
    select item_id, {_TOKENS} as words from benchmark
), item_windows as (
    select distinct item_id, least(len(words), 10) as width, array_to_string(words[p:p + 9], ' ') as phrase
    from (select *, unnest(range(1, greatest(len(words) - 8, 2))) as p from items where len(words) > 0)
), doc_windows as (
    select no, width, p, array_to_string(words[p:p + width - 1], ' ') as phrase from (
        select *, unnest(range(1, len(words) - width + 2)) as p
        from docs, (select distinct width from item_windows))
), found as (
    select no, p, width, item_id from doc_windows join item_windows using (width, phrase)
), hits as (
    select no, count(distinct place)::bigint as n_hit
    from (select no, unnest(range(p, p + width)) as place from found) group by no
), held as (
    select no, count(*)::bigint as n_items, sha256(string_agg(item_id::varchar, ',' order by item_id::varchar)) as ids
    from (select distinct no, item_id from found) group by no
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, coalesce(ids, sha256('')) as items_sha256, n_hit is not null as contaminated
from docs left join hits using (no) left join held using (no)
"""

SQL = {
    "op1_substring_dedup": OP1,
    "op2_jaccard_join": OP2,
    "op5_warc": OP5,
    "op6_decontamination": OP6,
    "op11_conversation_trie": OP11,
    "op12_ranked_search": OP12,
}

"""DuckDB SQL of the registered queries that SQL can express, written apart from the operators."""

from __future__ import annotations

_OP2 = r"""
with words as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents),
windows as (
    select doc_id, i, w[i:i + 4] as five, count(*) over (partition by doc_id, w[i:i + 4]) as times
    from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from words)),
repeated as (
    select doc_id, count(distinct p) as n_repeat_words
    from (select doc_id, unnest(range(i, i + 5)) as p from windows where times > 1) group by doc_id),
lines as (
    select doc_id, count(*) as n_lines, count(*) - count(distinct l) as n_dup_lines
    from (select doc_id, unnest(string_split(text, chr(10))) as l from words)
    where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id),
measured as (
    select doc_id, len(w)::bigint as n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
           coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
           coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
           coalesce(n_lines, 0) as n_lines,
           length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) as n_letters,
           length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
           length(regexp_replace(text, '[^!]', '', 'g')) as n_bangs
    from words left join lines using (doc_id) left join repeated using (doc_id)),
rules as (
    select *, (n_words < 10)::bigint + 2 * (100 * n_repeat_words > 20 * n_words)::bigint
           + 4 * (100 * n_symbols > 10 * word_chars)::bigint + 8 * (word_chars > 15 * n_words)::bigint
           + 16 * (word_chars < 2 * n_words)::bigint + 32 * (100 * n_letters < 40 * word_chars)::bigint
           + 64 * (2 * n_upper > n_letters)::bigint + 128 * (5 * n_bangs > n_words)::bigint
           + 256 * (2 * n_dup_lines > n_lines)::bigint as failed_rules
    from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_rules & 3) <> 0 as base_failed,
       failed_rules = 0 as kept, failed_rules
from rules
"""

_OP3 = r"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as line, unnest(range(len(ls))) as i from split),
keyed as (
    select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
firsts as (select key, min(doc_id) as keeper from keyed where length(key) >= 10 group by key
           having count(distinct doc_id) > 1),
fates as (select k.*, keeper is not null and keeper <> doc_id as gone from keyed k left join firsts using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from fates group by doc_id
"""

_OP4 = r"""
with dw as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
    select distinct item_id, w[i:i + least(len(w), 10) - 1] as g, least(len(w), 10) as n
    from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from bw where len(w) > 0)),
found as (
    select doc_id, i, d.n, item_id
    from (select doc_id, i, n, w[i:i + n - 1] as g
          from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, (select distinct n from windows))
         ) d join windows b on d.n = b.n and d.g = b.g),
hits as (select doc_id, count(distinct p) as n_hit
         from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(k, ',' order by k) as ids
          from (select distinct doc_id, item_id::varchar as k from found) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join hits using (doc_id) left join items using (doc_id)
"""



def _find(name: str, pattern: str) -> str:
    """CTEs with the matches of a pattern: ``rid, m, before, a, b``; a text is split at marks put around them."""
    pattern = pattern.replace("'", "''")
    return rf"""
{name}_p as (
    select rid, unnest(p) as m, unnest(range(len(p))) as k
    from (select rid, string_split(regexp_replace(translate(text, chr(1), chr(2)), '{pattern}',
                 chr(1) || '\0' || chr(1), 'g'), chr(1)) as p from d)),
{name} as (
    select rid, m, before, a, a + length(m) as b
    from (select rid, k, m, lag(m) over w as before, sum(length(m)) over w - length(m) as a
          from {name}_p window w as (partition by rid order by k))
    where k % 2 = 1)"""


_DOCS = "d as (select doc_id, row_number() over () as rid, coalesce(text, '') as text from documents)"
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_BYTE = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
    case when i % 2 = 0 and substr(reverse({_DIGITS}), i, 1)::int > 4 then 2 * substr(reverse({_DIGITS}), i, 1)::int - 9
         when i % 2 = 0 then 2 * substr(reverse({_DIGITS}), i, 1)::int
         else substr(reverse({_DIGITS}), i, 1)::int end)) % 10 = 0"""
_TURNED = "substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4)"
_MOD_97 = f"""list_reduce(list_transform(string_split(array_to_string(list_transform(string_split({_TURNED}, ''),
    lambda c: case when c between '0' and '9' then c else (ascii(c) - 55)::varchar end), ''), ''), lambda x: x::int),
    lambda t, x: (t * 10 + x) % 97) = 1"""

_OP5 = f"""
with {_DOCS},
{_find("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")},
{_find("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")},
{_find("card", r"[0-9]([\x20-]?[0-9])+")},
{_find("phone", r"\+[0-9][\x20().0-9-]+[0-9]")},
{_find("iban", r"[A-Z]{2}[0-9]{2}((?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})")},
{_find("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}")},
every as (
    select rid, 0 as o, 'email' as kind, a, b from email
    union all select rid, 1, 'ip', a, b from ip where regexp_full_match(m, '{_BYTE}(\\.{_BYTE}){{3}}')
    union all select rid, 2, 'card', a, b from card where length({_DIGITS}) between 16 and 19 and {_LUHN}
    union all select rid, 3, 'phone', a, b from phone where length({_DIGITS}) between 8 and 15
    union all select rid, 4, 'iban', a, b from iban where {_MOD_97}
    union all select rid, 5, 'ssn', a, b from ssn
              where regexp_matches(right(before, 40), '[Ss][Ss][Nn]|[Ss][Oo][Cc][Ii][Aa][Ll] [Ss][Ee][Cc][Uu][Rr][Ii][Tt][Yy]')),
told as (
    select rid, count(*) filter (o = 0) as n_email, count(*) filter (o = 1) as n_ip, count(*) filter (o = 2) as n_card,
           count(*) filter (o = 3) as n_phone,
           string_agg(kind || ':' || a || ':' || b, ',' order by o, a) filter (o < 4) as base,
           string_agg(kind || ':' || a || ':' || b, ',' order by o, a) as spans
    from every group by rid)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card,
       coalesce(n_phone, 0) as n_phone, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join told using (rid)
"""

_VALUE = "[\"']?\\x20*[:=]\\x20*[\"']?"
_NAMES = (
    "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
)
_PEOPLE = (
    "[Uu][Ss][Ee][Rr]|[Uu][Ss][Ee][Rr][Nn][Aa][Mm][Ee]|[Ll][Oo][Gg][Ii][Nn]|[Cc][Ll][Ii][Ee][Nn][Tt]_[Ii][Dd]"
    "|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]_[Ii][Dd]"
)
_ASSIGN = f"({_NAMES}){_VALUE}([A-Za-z0-9+/_.=-]+)"


def _near(*kinds: str) -> str:
    names = ", ".join(f"'{k}'" for k in kinds)
    return f"exists (select 1 from every q where q.rid = p.rid and q.kind in ({names}) and q.a < p.b + 200 and q.b > p.a - 200)"


_OP7 = f"""
with {_DOCS},
{_find("assign", _ASSIGN)},
{_find("access", "AKIA[A-Z0-9]+")},
{_find("hexa", "[0-9a-f]+")},
{_find("keys", "[A-Za-z0-9+/]{40,}")},
{_find("endpoint", "https?://[A-Za-z0-9./:_-]+")},
{_find("ident", f"({_PEOPLE}){_VALUE}[A-Za-z0-9@._-]+")},
every as (
    select rid, 0 as o, 'assign' as kind, a, b from assign
    where length(regexp_extract(m, '{_ASSIGN.replace("'", "''")}', 2)) >= 6
    union all select rid, 1, 'access', a, b from access where length(m) >= 20
    union all select rid, 2, 'hex', a, b from hexa where length(m) >= 24
    union all select rid, 3, 'key', a, b from keys
              where regexp_matches(m, '[0-9]') and regexp_matches(m, '[A-Z]') and regexp_matches(m, '[a-z]')
    union all select rid, 4, 'endpoint', a, b from endpoint
    union all select rid, 5, 'ident', a, b from ident),
linked as (
    select * from every p
    where o < 3 or (o = 3 and {_near("access", "ident")})
       or (o = 4 and {_near("access", "ident")} and {_near("assign", "hex", "key")})
       or (o = 5 and {_near("assign", "hex", "key")} and {_near("endpoint")})),
told as (
    select rid, count(*) filter (o = 0) as n_assign, count(*) filter (o = 1) as n_access, count(*) filter (o = 2) as n_hex,
           string_agg(kind || ':' || a || ':' || b, ',' order by a, o) filter (o < 3) as base,
           string_agg(kind || ':' || a || ':' || b, ',' order by a, o) as spans
    from linked group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join told using (rid)
"""



_OP9 = r"""
with recursive words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
    select distinct doc_id, w[i:i + 4] as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
    select a, b
    from (select x.doc_id as a, y.doc_id as b, count(*) as common
          from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all) p
    join sizes m on m.doc_id = a join sizes n on n.doc_id = b
    where 5 * common >= 4 * (m.n + n.n - common)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
classes as (select a, min(b) as first from reach group by a),
counts as (select a, count(*) as n_links from links group by a)
select doc_id, least(doc_id, coalesce(first, doc_id)) as class_id, coalesce(n_links, 0) as n_links
from documents d left join classes c on c.a = d.doc_id left join counts n on n.a = d.doc_id
"""


def _smoothed(k: int) -> str:
    """Probabilities after contexts of ``k`` signs, from those after one sign less."""
    size = 32 ** (k + 1)
    below = "select 0 as gram, 1.0::double / 32 as pa, 1.0::double / 32 as pr" if not k else f"select * from p{k - 1}"
    return f"""
p{k} as (
    select gram, if(sum(a) over w > 0, (a + sum((a > 0)::int) over w * qa) / (sum(a) over w + sum((a > 0)::int) over w), qa)
           as pa,
           if(sum(r) over w > 0, (r + sum((r > 0)::int) over w * qr) / (sum(r) over w + sum((r > 0)::int) over w), qr) as pr
    from (select g.gram, coalesce(a, 0) as a, coalesce(r, 0) as r, b.pa as qa, b.pr as qr
          from (select unnest(range({size})) as gram) g
          left join (select gram % {size} as gram, sum(accepted::int) as a, sum((not accepted)::int) as r
                     from trained group by all) c using (gram)
          join ({below}) b on b.gram = g.gram % {size // 32})
    window w as (partition by gram // 32))"""


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}'))"


_OP8 = f"""
with u as (
    select page_id, row_number() over () as rid, url,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path
    from pages),
ruled as (
    select *, case when {_fits("example.net", "/en/")} then 'example.net/en/'
                   when {_fits("example.com", "/de/")} then 'example.com/de/'
                   when {_fits("org", "/fr/")} then 'org/fr/' when {_fits("net", "/")} then 'net/' end as rule
    from u),
signs as (
    select rid, list_transform(string_split('```' || translate(regexp_replace(translate(
           regexp_replace(coalesce(url, ''), '^[^/?#]*?://', ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9./_-]', chr(127), 'g'),
           '0123456789./-_', '{{{{{{{{{{{{{{{{{{{{|}}~~') || '`', ''), lambda c: ascii(c) - 96) as s
    from u),
grams as (
    select rid, unnest(list_transform(range(4, len(s) + 1),
           lambda i: s[i] + 32 * s[i - 1] + 1024 * s[i - 2] + 32768 * s[i - 3])) as gram from signs),
labelled as (
    select rid, rule in ('example.net/en/', 'org/fr/') as accepted, url from ruled where rule is not null),
held as (select rid, accepted from labelled where substr(md5(url), 1, 1) in ('0', '1', '2', '3')),
trained as (select accepted, gram from labelled join grams using (rid) where rid not in (select rid from held)),
{_smoothed(0)},{_smoothed(1)},{_smoothed(2)},{_smoothed(3)},
scores as (select rid, avg(ln(pa) - ln(pr)) as score from grams join p3 using (gram) group by rid),
bins as (select floor(score / 0.01) as bin, sum(accepted::int) as a, sum((not accepted)::int) as r
         from held join scores using (rid) group by all),
cuts as (select bin, sum(a) over w / sum(a) over () - sum(r) over w / sum(r) over () as good
         from bins window w as (order by bin desc)),
cut as (select coalesce((select bin from cuts where good is not null order by good desc, bin limit 1), 0) * 0.01 as least)
select page_id, host, path, rule,
       case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
            when score >= least then 'allow' else 'block' end as verdict
from ruled join scores using (rid), cut
"""

_OP11 = r"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
    select doc_id, i, array_to_string(w[i:i + 12], ' ') as s
    from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words)),
firsts as (select s, min(doc_id) as holder from windows group by s having count(distinct doc_id) > 1),
gone as (
    select distinct doc_id, unnest(range(i, i + 13)) as p from windows join firsts using (s) where holder < doc_id),
placed as (
    select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from words),
kept as (
    select doc_id, count(*) as n_kept, string_agg(word, ' ' order by p) as text
    from placed anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n_kept, 0))::bigint as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from words left join kept using (doc_id)
"""

_OP12 = r"""
with docs as (
    select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
           coalesce(text, '') as text
    from documents),
tokens as (
    select rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
counts as (select lang, source, term, count(*) as n from tokens group by all),
kept as (select lang, term, count(*) as n from tokens group by all having count(distinct rid) >= 30),
langs as (select lang, count(*) as v, sum(n) as total from kept group by lang),
groups as (select distinct lang, source from docs),
cells as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as n_lang
    from groups g join kept k using (lang) left join counts c using (lang, source, term)),
sizes as (select lang, source, sum(n) as total from cells group by all),
shares as (
    select c.lang, c.source, term, n,
           (1 + 1000000000::hugeint * (n + 5) // (s.total + 5 * v)::hugeint)::bigint as p,
           (1 + 1000000000::hugeint * (n_lang + 5) // (l.total + 5 * v)::hugeint)::bigint as q
    from cells c join sizes s using (lang, source) join langs l using (lang)),
apart as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from shares a join shares b using (lang, term) where a.source <> b.source group by all),
pairs as (
    select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
every as (
    select lang, source, 'pair' as part, item, value from pairs
    union all select lang, source, 'term', term, p - q from shares where n > 0 and p > q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank from every)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""

_OP13 = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
grams as (
    select lang, k, w[i:i + k - 1] as g
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from words, (select unnest([1, 2, 3, 4]) as k))),
found as (select lang, k, g, array_to_string(g, ' ') as phrase, count(*) as f from grams group by all having count(*) >= 30),
cuts as (
    select lang, k, g, phrase, f as a, c, array_to_string(g[1:c], ' ') as head, array_to_string(g[c + 1:k], ' ') as tail
    from (select *, unnest(range(1, k)) as c from found where k > 1)),
scores as (
    select t.lang, t.phrase, t.k, a, c, x.f as l, y.f as r, (2000000::hugeint * a // (x.f + y.f)::hugeint)::bigint as score
    from cuts t join found x on x.lang = t.lang and x.phrase = t.head join found y on y.lang = t.lang and y.phrase = t.tail),
lowest as (
    select * from scores qualify row_number() over (partition by lang, phrase order by score, c) = 1),
inside as (
    select lang, array_to_string(g[i:i + s - 1], ' ') as phrase, max(f) as cover
    from (select *, unnest(range(1, k - s + 2)) as i from (select *, unnest(range(2, k)) as s from found where k > 2))
    group by all),
ranked as (
    select lang, phrase, a, l, r, score,
           row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank
    from lowest left join inside using (lang, phrase) where cover is null or 100 * cover < 80 * a)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": _OP2,
    "op3_line_dedup": _OP3,
    "op4_decontamination": _OP4,
    "op5_pii": _OP5,
    "op7_secrets": _OP7,
    "op8_url_filter": _OP8,
    "op9_jaccard_join": _OP9,
    "op11_substring_dedup": _OP11,
    "op12_source_divergence": _OP12,
    "op13_collocations": _OP13,
}

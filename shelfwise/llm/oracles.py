"""SQL with the results of the queries of this subpackage, where SQL can express them."""

from __future__ import annotations

_URL_FILTERS = """
with rules(verdict, rule) as (values
    ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
    ('allow', 'com/fr/'), ('block', 'com/de/')),
rest as (
    select row_number() over () as row, page_id,
        case when position('://' in url) > 0 then substr(url, position('://' in url) + 3)
             else '' end as rest
    from pages),
parts as (
    select row, page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from rest),
fitting as (
    select p.row, r.rule, r.verdict,
        row_number() over (partition by p.row order by length(r.rule) desc, r.verdict desc) as k
    from parts p join rules r
        on (p.host = split_part(r.rule, '/', 1)
            or ends_with(p.host, '.' || split_part(r.rule, '/', 1)))
        and starts_with(p.path, substr(r.rule, position('/' in r.rule))))
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parts p left join fitting f on f.row = p.row and f.k = 1
"""

_DECONTAMINATION = r"""
with doc_words as (
    select row_number() over () as row, doc_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents),
items as (
    select distinct item_id, text from benchmark),
item_words as (
    select item_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from items),
sized as (
    select item_id, words, least(13, len(words)) as size from item_words where len(words) > 0),
windows as (
    select distinct item_id, size, array_to_string(words[i : i + size - 1], ' ') as content
    from (select item_id, words, size, unnest(range(1, len(words) - size + 2)) as i from sized)),
sizes as (select distinct size from windows),
doc_windows as (
    select row, i, size, array_to_string(words[i : i + size - 1], ' ') as content
    from (select row, words, size, unnest(range(1, len(words) - size + 2)) as i
          from doc_words, sizes where len(words) >= size)),
hits as (
    select d.row, d.i, d.size, w.item_id
    from doc_windows d join windows w on d.size = w.size and d.content = w.content),
hit_words as (
    select row, count(distinct place) as n_hit
    from (select row, unnest(range(i, i + size)) as place from hits) group by row),
hit_items as (
    select row, count(*) as n_items, string_agg(item_id, ',' order by item_id) as item_list
    from (select distinct row, cast(item_id as varchar) as item_id from hits
          where item_id is not null) group by row)
select d.doc_id, cast(len(d.words) as bigint) as n_words,
    cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
    cast(coalesce(i.n_items, 0) as bigint) as n_items,
    sha256(coalesce(i.item_list, '')) as items_sha256,
    coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.words) as contaminated
from doc_words d left join hit_words h using (row) left join hit_items i using (row)
"""

_NGRAM_JACCARD = r"""
with recursive words as (
    select row_number() over () as row, doc_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') as words
    from documents),
shingles as (
    select distinct row, array_to_string(words[i : i + 4], ' ') as shingle
    from (select row, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i
          from words where len(words) > 0)),
sizes as (select row, count(*) as n from shingles group by row),
shared as (
    select a.row as a, b.row as b, count(*) as n
    from shingles a join shingles b on a.shingle = b.shingle and a.row < b.row group by all),
links as (
    select s.a, s.b from shared s join sizes x on x.row = s.a join sizes y on y.row = s.b
    where 100 * s.n >= 80 * (x.n + y.n - s.n)),
edges as (select a, b from links union select b, a from links),
reached(row, other) as (
    select row, row from words
    union
    select r.row, e.b from reached r join edges e on e.a = r.other),
components as (
    select r.row, min(w.doc_id) as component_id
    from reached r join words w on w.row = r.other group by r.row)
select w.doc_id, cast(coalesce(s.n, 0) as bigint) as n_shingles, c.component_id
from words w left join sizes s using (row) join components c using (row)
"""

_QUALITY_RULES = r"""
with texts as (
    select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
words as (
    select row, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
        list_filter(string_split(text, chr(10)),
                    lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) as lines
    from texts),
places as (
    select row, i, words[i : i + 2] as content
    from (select row, words, unnest(range(1, len(words) - 1)) as i from words
          where len(words) > 2)),
repeated as (
    select row, i from places qualify count(*) over (partition by row, content) > 1),
covered as (
    select row, count(distinct place) as n
    from (select row, unnest(range(i, i + 3)) as place from repeated) group by row),
measured as (
    select doc_id, cast(len(words) as bigint) as n_words,
        cast(length(array_to_string(words, '')) as bigint) as word_chars,
        cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'gs')) as bigint) as n_symbols,
        cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
        cast(coalesce(c.n, 0) as bigint) as n_repeat_words, len(lines) as n_lines
    from words left join covered c using (row)),
judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        n_words > 1000000 or word_chars < 3 * n_words or word_chars > 10 * n_words
            or 10 * n_symbols > n_words or 10 * n_dup_lines > 3 * n_lines as fatal,
        [100 * n_repeat_words > 20 * n_words, 100 * n_symbols > 5 * n_words,
         100 * n_dup_lines > 15 * n_lines] as counted
    from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and not fatal and len(list_filter(counted, lambda x: x)) <= 1 as kept,
    cast((n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int
        + 4 * (n_words > 1000000)::int + 8 * (word_chars < 3 * n_words)::int
        + 16 * (word_chars > 10 * n_words)::int + 32 * (10 * n_symbols > n_words)::int
        + 64 * (10 * n_dup_lines > 3 * n_lines)::int + 128 * counted[1]::int
        + 256 * counted[2]::int + 512 * counted[3]::int as bigint) as failed
from judged
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_quality_rules": _QUALITY_RULES,
        "op2_url_filters": _URL_FILTERS,
        "op4_ngram_jaccard": _NGRAM_JACCARD,
        "op6_decontamination": _DECONTAMINATION,
    }

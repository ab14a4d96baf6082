"""SQL counterparts of the queries that SQL can express, for an independent engine over the same tables."""

from __future__ import annotations

from wardline.llm import chat_template, decontamination, license_scan, url_filter

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), '" + _UPPER + "', '" + _UPPER.lower() + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(column: str) -> str:
    return _WORDS.format(column)


def op1() -> str:
    """Sizes follow from the template: every turn has a head and an end, every control string one more character."""
    template = chat_template.turns_template()
    bare = len(template.render(messages=[])[0])
    frame = len(template.render(messages=[{"role": "user", "text": ""}])[0]) - bare - len("user")
    found = " + ".join(
        f"len(regexp_extract_all({{0}}, {_text(pattern)}))" for pattern in (r"<\\*s>", r"<\\*/s>", r"\[\\*INST\]", r"\[\\*/INST\]")
    )
    role, body = "coalesce(role, '')", "coalesce(text, '')"
    order = "order by turn nulls first, role nulls first, text nulls first"
    return f"""
with told as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg({role} || chr(10) || {body} || chr(10), '' {order})) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg({body}, '' {order}) filter (where role = 'assistant'), '')) as loss_sha256,
  ({bare} + sum({frame} + length({role}) + length({body}) + {found.format(role)} + {found.format(body)}))::bigint
    as formatted_chars
from told group by conv_id"""


def op4() -> str:
    """Rules by a join on host ends; aliases by a closure over the links of the pages."""
    rules = ", ".join(f"({_text(h)}, {_text(p)}, {_text(v)})" for h, p, v in url_filter.RULES)
    lower = "translate({0}, '" + _UPPER + "', '" + _UPPER.lower() + "')"
    scheme = lower.format("regexp_extract(url, '^(.*?)://', 1, 's')")
    host = lower.format("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")
    path = "regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's')"
    query = r"regexp_extract(url, '^.*?://[^/?#]*[^?#]*(\?[^#]*)', 1, 's')"
    node = f"case when {host} <> '' and {scheme} in ('http', 'https') then {scheme} || '://' || {host} || case when {path} = '' then '/' else {path} end || {query} end"
    quoted = r"""(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    href = " || ".join(f"regexp_extract(tag, '\\bhref\\s*=\\s*{quoted}', {k}, 'is')" for k in (1, 2, 3))
    refresh = r"""regexp_extract(tag, '\bcontent\s*=\s*["'']?[^"''>]*?\burl\s*=\s*["'']?([^"''>\s]+)', 1, 'is')"""
    return f"""
with recursive rules(rule_host, rule_path, action) as (values {rules}),
seen as (
  select row_number() over () as n, page_id, url, html, coalesce({host}, '') as host, coalesce({path}, '') as path, {node} as node
  from pages
),
tags as (select url, node, unnest(regexp_extract_all(html, '<(?:link|meta)\\b[^>]*>', 0, 'is')) as tag from seen),
targets as (
  select url as base, node, trim(replace(case
    when regexp_matches(tag, '^<link\\b.*\\brel\\s*=\\s*["'']?[^"''>]*\\bcanonical\\b', 'is') then {href}
    when regexp_matches(tag, '^<meta\\b.*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b', 'is') then {refresh} else '' end, '&amp;', '&')) as way
  from tags
),
whole as (
  select node as a, case when regexp_matches(way, '^[A-Za-z][A-Za-z0-9+.\\-]*:') then way
    when starts_with(way, '//') then split_part(base, '//', 1) || way
    when starts_with(way, '/') then regexp_extract(base, '^(.*?://[^/?#]*)', 1, 's') || way
    else regexp_extract(base, '^(.*?://[^/?#]*)', 1, 's')
      || coalesce(nullif(regexp_extract(base, '^.*?://[^/?#]*(/[^?#]*/|/)?', 1, 's'), ''), '/') || way end as url
  from targets where way <> '' and node is not null
),
links as (select distinct a, {node} as b from whole),
ends as (select a, b from links where b is not null union select b, a from links where b is not null),
reach(a, b) as (select a, b from ends union select reach.a, ends.b from reach join ends on reach.b = ends.a),
nodes as (select distinct a as node, a as url from ends),
judged as (
  select kind, key, arg_max(rule, length(rule)) as rule, arg_max(action, length(rule)) as action
  from (
    select kind, key, rule_host || rule_path as rule, action
    from (
      select 'page' as kind, n::varchar as key, host, path from seen
      union all select 'node', node, {host}, {path} from nodes
    ) join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  ) group by kind, key
),
shared as (
  select a as node, min(action) as decision
  from (select a, b from reach union select a, a from ends) join judged on kind = 'node' and key = b group by a
)
select page_id, host, path, rule, coalesce(action, decision, 'allow') as verdict
from seen left join judged on kind = 'page' and key = n::varchar left join shared on shared.node = seen.node"""


def op6() -> str:
    width = decontamination.WINDOW
    return f"""
with docs as (select row_number() over () as n, doc_id, {words("text")} as w from documents),
items as (select coalesce(item_id::varchar, '') as item, {words("text")} as w from benchmark),
windows as (
  select distinct item, least(len(w), {width}) as size, array_to_string(w[k : k + {width} - 1], ' ') as run
  from (select item, w, unnest(generate_series(1, greatest(len(w) - {width} + 1, 1))) as k from items where len(w) > 0)
),
runs as (
  select n, k, size, array_to_string(w[k : k + size - 1], ' ') as run
  from (
    select n, w, size, unnest(generate_series(1, len(w) - size + 1)) as k
    from docs cross join (select distinct size from windows)
    where len(w) >= size
  )
),
hits as (select n, k, runs.size, item from runs join windows using (run)),
covered as (
  select n, count(distinct k + i) as n_hit
  from (select n, k, unnest(range(size)) as i from (select distinct n, k, size from hits)) group by n
),
named as (select n, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by n)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (n) left join named using (n)"""


def op10() -> str:
    """Votes, diagonals and spans as in the operator, over all runs of words of every text."""
    rows, least, stretch = [], license_scan.LEAST_COVER, license_scan.MOST_STRETCH
    near, gap = license_scan.NEAR_DIAGONALS, license_scan.NEAR_WORDS
    for number, (text, label) in enumerate([*license_scan.PHRASES, *license_scan.NOTICES]):
        told = license_scan.plain_words(text)
        k = min(license_scan.RUN, len(told))
        phrase = number < len(license_scan.PHRASES)
        for place in range(len(told) - k + 1):
            run = " ".join(told[place : place + k])
            rows.append(f"({number}, {_text(label)}, {phrase}, {len(told)}, {len(told) - k + 1}, {place}, {k}, {_text(run)})")
    return f"""
with recursive templates(template, label, phrase, size, runs, place, k, run) as (values {", ".join(rows)}),
docs as (select row_number() over () as n, doc_id, {words("text")} as w from documents),
runs as (
  select n, pos, k, array_to_string(w[pos + 1 : pos + k], ' ') as run
  from (select n, w, k, unnest(range(len(w) - k + 1)) as pos from docs cross join (select distinct k from templates) where len(w) >= k)
),
votes as (
  select n, template, label, phrase, size, t.runs, pos - place as diagonal, min(pos) as start, max(pos + t.k) as stop,
    list(distinct place) as places
  from runs r join templates t on r.run = t.run and r.k = t.k group by all
),
marked as (
  select *, case when abs(diagonal - lag(diagonal) over o) <= {near}
    and start <= max(stop) over (partition by n, template order by start, diagonal rows between unbounded preceding and 1 preceding) + {gap}
    then 0 else 1 end as fresh
  from votes where not phrase window o as (partition by n, template order by start, diagonal)
),
spans as (
  select n, template, label, size, runs, span, min(start) as start, max(stop) as stop,
    list_distinct(flatten(list(places))) as all_places, len(list_distinct(flatten(list(places)))) / any_value(runs) as cover
  from (select *, sum(fresh) over (partition by n, template order by start, diagonal rows unbounded preceding) as span from marked)
  group by n, template, label, size, runs, span
),
shared as (
  select a.template, b.template as other from templates a join templates b on a.run = b.run and a.label <> b.label
  where not a.phrase and not b.phrase
  group by a.template, b.template, a.runs, b.runs having count(distinct a.place) >= {least} * least(a.runs, b.runs)
),
telling as (
  select t.template, list(t.place) as wanted from templates t
  where t.template in (select template from shared) and (t.template, t.run) not in
    (select s.template, o.run from shared s join templates o on s.other = o.template)
  group by t.template
),
fitting as (
  select n, label, start, stop, cover, row_number() over (partition by n order by cover desc, stop - start desc, template, start) as place
  from spans left join telling using (template)
  where cover >= {least} and stop - start <= {stretch} * size + {near}
    and (wanted is null or len(list_intersect(all_places, wanted)) = len(wanted))
),
picked(n, place, kept) as (
  select n, place, [place] from fitting where place = 1
  union all
  select p.n, f.place, case when len(list_intersect(p.kept, coalesce(f.rivals, []::bigint[]))) > 0 then p.kept else list_append(p.kept, f.place) end
  from picked p join (
    select x.n, x.place, x.start, x.stop, list(y.place) filter (where y.start < x.stop and x.start < y.stop) as rivals
    from fitting x join fitting y on x.n = y.n and y.place < x.place group by x.n, x.place, x.start, x.stop
  ) f on p.n = f.n and f.place = p.place + 1
),
chosen as (select n, arg_max(kept, place) as kept from picked group by n),
found as (
  select n, label, start, true as phrase, 1.0::double as cover from votes where phrase
  union all
  select n, label, start, false, cover from fitting join chosen using (n) where list_contains(kept, place)
),
told as (
  select n, count(*) filter (where phrase) as n_base, min(start) filter (where phrase)::bigint as first_word,
    max(start) filter (where phrase)::bigint as last_word,
    string_agg(distinct label, ',' order by label) filter (where phrase) as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(cover) as score
  from found group by n
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from docs left join told using (n)"""


_SPACED = r"regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _UPPER.lower() + r"'), '[^\x20\x09-\x0D]+')"


def op11() -> str:
    """Shingles as texts; every pair of distinct sets with a common shingle is counted, components by a closure over the links."""
    return f"""
with recursive docs as (select row_number() over () as n, doc_id, {_SPACED} as w from documents),
sets as (
  select n, doc_id, case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k : k + 4], ' ')))) end as own
  from docs
),
classes as (select min(n) as c, own, len(own) as size from sets where len(own) > 0 group by own),
parts as (select c, size, unnest(own) as shingle from classes),
links as (
  select x.c as a, y.c as b from parts x join parts y on x.shingle = y.shingle and x.c < y.c
  group by x.c, y.c, x.size, y.size having 100 * count(*) >= 80 * (x.size + y.size - count(*))
),
ends as (select a, b from links union all select b, a from links),
reach(a, b) as (select c, c from classes union select reach.a, ends.b from reach join ends on reach.b = ends.a),
roots as (select a as c, min(b) as root from reach group by a),
named as (
  select s.n, s.doc_id, len(s.own) as size, coalesce(r.root, -s.n) as root
  from sets s left join classes k on s.own = k.own left join roots r on k.c = r.c
)
select doc_id, size::bigint as n_shingles, min(doc_id) over (partition by root) as component_id from named"""


def op12() -> str:
    """Scores of all pairs of an item and a document that share a term."""
    return f"""
with docs as (select row_number() over () as n, doc_id, {words("text")} as w from documents),
items as (select row_number() over () as q, item_id, {words("text")} as w from benchmark),
counts as (select count(*) filter (where len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from docs),
asked as (select q, term, count(*) as times from (select q, unnest(w) as term from items) group by q, term),
held as (
  select n, size, term, count(*) as tf from (select n, len(w) as size, unnest(w) as term from docs)
  where term in (select term from asked) group by n, size, term
),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as weight
  from (select term, count(*) as df from held group by term), counts
),
scores as (
  select q, n, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * n_docs) // n_terms))))::bigint as score
  from held join asked using (term) join weights using (term), counts group by q, n
),
ranked as (
  select item_id, row_number() over (partition by q order by score desc, doc_id nulls last)::int as rank, doc_id, score
  from scores join items using (q) join docs using (n) where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20"""


def op13() -> str:
    """The checksum is spelled out bit by bit over the bytes of each distinct word."""
    polynomial, full = 3988292384, 4294967295
    byte = "(('0x' || substr(h, k, 2))::bigint)"
    return f"""
with told as (
  select list(value order by i) as t from (
    select i, list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, b: case when c & 1 = 1 then xor(c >> 1, {polynomial}::bigint) else c >> 1 end) as value
    from range(256) r(i)
  )
),
docs as (select row_number() over () as n, doc_id, {words("text")} as w from documents),
own as (select n, word, count(*) as times from (select n, unnest(w) as word from docs) group by n, word),
target as (select word, count(*) as times from (select unnest({words("text")}) as word from benchmark) group by word),
vocabulary as (select word, hex(encode(word)) as h from (select word from own union select word from target)),
buckets as (
  select word, xor(list_reduce([{full}::bigint] || list_transform(range(1, len(h), 2), lambda k: {byte}),
    lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::bigint])), {full}::bigint) % 10000 as bucket
  from vocabulary, told
),
source_counts as (select bucket, sum(times)::bigint as s from own join buckets using (word) group by bucket),
target_counts as (select bucket, sum(times)::bigint as t from target join buckets using (word) group by bucket),
totals as (select (select coalesce(sum(s), 0) from source_counts)::bigint as a, (select coalesce(sum(t), 0) from target_counts)::bigint as b),
gains as (
  select bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (a + 10000))::double / ((s + 1) * (b + 10000))::double))::bigint as gain
  from source_counts left join target_counts using (bucket), totals
),
weights as (
  select n, sum(times)::bigint as n_features, floor(sum(times * gain)::double / sum(times)::double)::bigint as weight
  from own join buckets using (word) join gains using (bucket) group by n
),
scored as (
  select n, doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
      / 4294967296::double)))::bigint as score
  from docs left join weights using (n)
),
ranked as (
  select *, row_number() over (order by score desc, doc_id nulls last) as place, (10 * count(*) over ()) // 100 as drawn
  from scored where n_features >= 20
)
select s.doc_id, s.n_features, s.weight, s.score, case when r.place <= r.drawn then r.place end as rank
from scored s left join ranked r using (n)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": op1(),
        "op4_url_filter": op4(),
        "op6_decontamination": op6(),
        "op10_license_scan": op10(),
        "op11_ngram_join": op11(),
        "op12_lexical_search": op12(),
        "op13_resampling": op13(),
    }

"""DuckDB SQL that gives the same rows as the registered queries, by plain comparison of everything with everything."""

from __future__ import annotations

from scanforge.llm import quality

BLANK = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quality_rules() -> str:
    top = lambda m: f"({m[0]} * {m[2]}) // greatest({m[1]}, 1)"
    metrics = {name: top(m) for name, m in quality.METRICS.items()}
    entries = " union all ".join(f"select lang, source, '{name}' as metric, {name} as v from m where not base_failed" for name in metrics)

    def quartiles(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        columns = ", ".join(
            f"min(case when metric = '{m}' and 4 * upto >= {q} * n_rows then cell end) as {m}_q{q}" for m in metrics for q in (1, 3)
        )
        return f"""
{name}_n as (select {by}metric, cell, count(*) as n from cells group by all),
{name}_c as (select *, sum(n) over (partition by {by}metric order by cell rows unbounded preceding) as upto, sum(n) over (partition by {by}metric) as n_rows from {name}_n),
{name} as (select {by}max(n_rows) as n_rows, {columns} from {name}_c {f"group by {keys}" if keys else ""})"""

    pick = lambda c: f"case when o.n_rows >= {quality.MIN_ROWS} then o.{c} when l.n_rows >= {quality.MIN_ROWS} then l.{c} else a.{c} end"
    inside = []
    for name, (_, _, _, least, has_low) in quality.METRICS.items():
        low, high = pick(f"{name}_q1"), pick(f"{name}_q3")
        spread = f"{quality.FENCE} * greatest({high} - {low}, {least})"
        inside.append(f"m.{name} <= {high} + {spread}")
        if has_low:
            inside.append(f"m.{name} >= {low} - {spread}")
    return f"""
with w as (
  select doc_id, coalesce(lang, chr(0)) as lang, coalesce(source, chr(0)) as source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{BLANK}') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{BLANK}')) as ls
  from documents),
win as (select doc_id, i, array_to_string(ws[i:i+7], ' ') as g from w, unnest(range(1, len(ws) - 6)) t(i) where len(ws) >= 9),
rep as (select doc_id, i from win qualify count(*) over (partition by doc_id, g) > 1),
cov as (select doc_id, count(distinct i + k) as n from rep, range(0, 8) r(k) group by doc_id),
c as (
  select w.doc_id, lang, source, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
         len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words, len(ls) as n_lines,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i-1])) as n_stutters
  from w left join cov using (doc_id)),
m as (
  select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed,
         {", ".join(f"{e} as {name}" for name, e in metrics.items())}
  from c),
cells as (
  select lang, source, metric, (v >> greatest(length(bin(v)) - {quality.BITS}, 0)) << greatest(length(bin(v)) - {quality.BITS}, 0) as cell from ({entries})),
{quartiles("own", "lang, source")},
{quartiles("bylang", "lang")},
{quartiles("total", "")}
select m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.n_lines, m.n_stutters, m.base_failed,
       not m.base_failed and coalesce({" and ".join(inside)}, false) as kept
from m left join own o on m.lang = o.lang and m.source = o.source left join bylang l on m.lang = l.lang cross join total a
"""


CONNECT = """
reach(node, other) as (select id, id from nodes union select l.b, r.other from reach r join both_ways l on l.a = r.node),
least as (select node, min(other) as component from reach group by node)"""


def near_vectors() -> str:
    return f"""
with recursive v as (select vec_id as id, embedding::double[] as e from embeddings),
nodes as (select id from v),
both_ways as (select x.id as a, y.id as b from v x join v y on x.id <> y.id and list_cosine_similarity(x.e, y.e) >= 0.95),
n as (select a, count(*) as n from both_ways group by a),{CONNECT}
select id as vec_id, coalesce(n.n, 0) as n_links, component as component_id, id = component as kept
from nodes join least on node = id left join n on n.a = id
"""


def near_texts(width: int = 4, percent: int = 80) -> str:
    return f"""
with recursive w as (select doc_id as id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BLANK}') as ws from documents),
nodes as (select id from w),
s as (select distinct id, array_to_string(ws[i:i+{width - 1}], ' ') as g from w, unnest(range(1, greatest(len(ws) - {width - 2}, 2))) t(i) where len(ws) > 0),
size as (select id, count(*) as n from s group by id),
common as (select x.id as a, y.id as b, count(*) as n from s x join s y on x.g = y.g and x.id <> y.id group by all),
both_ways as (
  select a, b from common c join size p on p.id = a join size q on q.id = b where 100 * c.n >= {percent} * (p.n + q.n - c.n)),{CONNECT}
select nodes.id as doc_id, coalesce(size.n, 0) as n_shingles, component as component_id, nodes.id = component as kept
from nodes join least on node = nodes.id left join size on size.id = nodes.id
"""


def mixing_sources(domain: str, path: list[str], weights: list[str], percent: int, epochs: int, seed: int) -> str:
    levels = []
    for depth, weight in enumerate(weights, 1):
        parent, key = path[: depth - 1], path[depth - 1]
        by = ", ".join(parent) or "1"
        order = f"partition by {by} order by ratio, {key} rows between"
        budget = f"join k{depth - 1} using ({', '.join(parent)})" if parent else f"cross join (select (sum(supply) * {percent}) // 100 as budget from leaves)"
        levels.append(f"""
l{depth} as (select {", ".join(path[:depth])}, sum(supply) * {epochs} as capacity, sum(supply) as supply from leaves group by all),
w{depth} as (select l{depth}.*, ({weight})::hugeint as weight from l{depth}),
f{depth} as (select w{depth}.*, budget, capacity::double / weight as ratio from w{depth} {budget} where weight > 0),
g{depth} as (select *, coalesce(sum(capacity) over ({order} unbounded preceding and 1 preceding), 0) as held, sum(weight) over ({order} current row and unbounded following) as weights from f{depth}),
h{depth} as (select *, capacity * weights <= (budget - held) * weight as filled from g{depth}),
i{depth} as (select *, greatest(budget - coalesce(sum(case when filled then capacity end) over (partition by {by}), 0), 0) as rest, case when filled then 0 else weight end as opened from h{depth}),
j{depth} as (select *, sum(opened) over ({order} unbounded preceding and current row) as upto, greatest(sum(opened) over (partition by {by}), 1) as all_open from i{depth}),
k{depth} as (select {", ".join(path[:depth])}, case when filled then capacity else (rest * upto) // all_open - (rest * (upto - opened)) // all_open end as budget{", supply" if depth == len(path) else ""} from j{depth})""")
    on = ", ".join(path)
    return f"""
with t as (
  select doc_id, coalesce({domain}, chr(0)) as domain, coalesce(lang, chr(0)) as lang, coalesce(source, chr(0)) as source,
         len(regexp_extract_all(coalesce(text, ''), '{BLANK}')) as n_tokens
  from documents),
r as (select * from t where n_tokens > 0),
leaves as (select {on}, sum(n_tokens) as supply from r group by all),{",".join(levels)},
b as (select {on}, budget // supply as passes, budget % supply as rest from k{len(path)}),
o as (select r.*, passes, rest, md5('{seed}:' || passes || ':' || coalesce(doc_id::varchar, '')) as key from r join b using ({on})),
c as (select *, sum(n_tokens) over (partition by {on} order by key range unbounded preceding) <= rest as more from o)
select doc_id, {on}, n_tokens, epoch::int as epoch from c, unnest(range(0, (passes + case when more then 1 else 0 end)::bigint)) t(epoch)
"""


def collocations(min_count: int = 100, top: int = 2000, longest: int = 5) -> str:
    grams = " union all ".join(
        f"select lang, {k} as k, ws[i:i+{k - 1}] as p from w, unnest(range(1, len(ws) - {k - 2})) t(i) where len(ws) >= {k}" for k in range(1, longest + 1)
    )
    return f"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as ws from p),
n as (select lang, sum(len(ws)) as n from w group by lang),
f as (select lang, k, p, count(*) as f from ({grams}) group by all having count(*) >= {min_count}),
covers as (
  select lang, part, max(f) as cover from (
    select lang, f, p[i:j] as part from f, unnest(range(1, k)) s(i), unnest(range(i + 1, k + 1)) e(j) where k > 2 and j - i + 1 < k)
  group by all),
free as (select f.* from f left join covers c on f.lang = c.lang and f.p = c.part where k > 1 and coalesce(100 * cover < 100 * f, true)),
cuts as (
  select c.lang, c.p, c.f as a, l.f as l, r.f as r, cut, (1000::hugeint * c.f * n.n) // (l.f::hugeint * r.f) as score
  from (select *, unnest(range(1, k)) as cut from free) c
  join f l on l.lang = c.lang and l.p = c.p[1:cut] join f r on r.lang = c.lang and r.p = c.p[cut+1:] join n on n.lang = c.lang),
lowest as (select * from cuts qualify row_number() over (partition by lang, p order by score, cut) = 1),
named as (select *, array_to_string(p, ' ') as phrase from lowest),
ranks as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from named)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranks join n using (lang) where rank <= {top}
"""


def variants() -> str:
    """crc32 by its table, near words by removing one code point from either or both."""
    return f"""
with recursive crc(i, turn, c) as (
  select i, 0, i from unnest(range(256)) t(i)
  union all select i, turn + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc where turn < 8),
bits as (select list(c order by i) as t from crc where turn = 8),
runs as (
  select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\u00C0-\u00FF]+')) as run
  from documents),
counted as (select id, run, count(*) as n from runs group by all),
bytes as (
  select run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda x: case when ord(x) < 128 then [ord(x)] else [195, ord(x) - 64] end)) as b from counted),
hashed as (
  select run, n, xor(list_reduce(b, lambda h, x: xor(t[(xor(h, x::bigint) & 255) + 1], h >> 8), 4294967295::bigint), 4294967295) as h from bytes, bits),
kept as (select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed),
words as (select word, sum(n)::bigint as n from kept group by word having sum(n) >= 3 and length(word) >= 5),
cut as (select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from words, unnest(range(1, length(word) + 1)) t(i)),
near as (
  select a.word, b.word as other from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word from cut a join words b on a.rest = b.word
  union select b.word, a.word from cut a join words b on a.rest = b.word),
best as (select near.word, count(*) as n_near, arg_max(struct_pack(w := other, n := o.n), (o.n, -place)) as top from near join (
  select word, n, row_number() over (order by word) as place from words) o on o.word = other group by near.word),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when top.n >= 2 * w.n then top.w end as form, case when top.n >= 2 * w.n then top.n end as form_n
  from words w left join best using (word)),
walk(word, step, held) as (
  select word, 0, word from formed
  union all select walk.word, step + 1, formed.form from walk join formed on formed.word = walk.held where formed.form is not null),
ends as (select word, arg_max(held, step) as root from walk group by word)
select word, form, root, n, n_near, form_n from formed join ends using (word)
"""

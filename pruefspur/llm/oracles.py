"""SQL (DuckDB) that the queries of the operators are compared with.

Written from the results the queries promise, with other means than theirs: windows are compared as
texts and not as hashes, spans are found by joins on words.
"""

from __future__ import annotations

from .licenses import COVERAGE, TEMPLATES, band

# The words of the rules: the white space of ASCII parts them.
QUALITY = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
),
w as (
  select r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d
),
pos as (
  select r, words, unnest(range(1, len(words) - 6)) as i from w where len(words) >= 8
),
win as (select r, i, array_to_string(words[i:i + 7], ' ') as g from pos),
again as (
  select r, i from win qualify count(*) over (partition by r, g) > 1
),
steps as (
  select r, least(8, coalesce(lead(i) over (partition by r order by i) - i, 8)) as step from again
),
rep as (select r, sum(step)::bigint as n_repeat_words from steps group by r),
m as (
  select w.r, doc_id, len(words)::bigint as n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    len(lines) as n_lines,
    length(regexp_replace(t, '[^\p{L}]+', '', 'g')) as n_letters,
    length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) as n_upper,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) as n_alpha
  from w left join rep on rep.r = w.r
),
f as (
  select *, (
    (case when n_words < 20 then 1 else 0 end)
    + (case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end)
    + (case when 100 * n_symbols > 10 * n_words then 4 else 0 end)
    + (case when 100 * n_dup_lines > 30 * n_lines then 8 else 0 end)
    + (case when word_chars < 3 * n_words then 16 else 0 end)
    + (case when word_chars > 12 * n_words then 32 else 0 end)
    + (case when 100 * n_alpha < 70 * n_words then 64 else 0 end)
    + (case when 100 * n_upper > 40 * n_letters then 128 else 0 end)
  )::bigint as failures
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failures & 3) > 0 as base_failed, failures = 0 as kept, failures
from f
"""

_TEMPLATES = ",\n    ".join(
    f"({number}, '{t.label}', {str(t.base).lower()}, {band(len(t.words.split(' ')), t.base)}, '{t.words}')"
    for number, t in enumerate(TEMPLATES)
)

LICENSES = rf"""
with tpl(template, t_label, t_base, t_band, t_text) as (
  values {_TEMPLATES}
),
tw as (select *, string_split(t_text, ' ') as tw from tpl),
ti as (select *, unnest(range(1, len(tw))) as j from tw),
tp as (select template, t_label, t_base, t_band, len(tw) as t_words, j - 1 as t_pos, tw[j] as a, tw[j + 1] as b from ti),
d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
),
p as (select r, words, unnest(range(1, len(words))) as i from d),
dp as (select r, i - 1 as pos, words[i] as a, words[i + 1] as b from p),
hits as (select r, template, t_label, t_base, t_band, t_words, t_pos, pos, pos - t_pos as diagonal from dp join tp using (a, b)),
bands as (select distinct r, template, diagonal as band from hits),
firsts as (
  select r, template, t_label, t_base, t_words, band, t_pos, min(pos) as place
  from bands join hits using (r, template)
  where diagonal between band and band + t_band
  group by all
),
held as (
  select r, template, t_label, t_base, t_words, band, list(place order by t_pos) as places from firsts group by all
),
scored as (
  select *, len(list_filter(places, lambda x, i: i = 1 or x > list_max(places[1:i - 1]))) as votes,
    list_min(places) as start, floor(100.0 * votes / (t_words - 1)) as coverage
  from held
),
spans as (
  select * from scored
  where case when t_base then votes = t_words - 1 else coverage >= {COVERAGE} end
),
per as (
  select r, count(*) filter (t_base) as n_base,
    min(start) filter (t_base) as first_word, max(start) filter (t_base) as last_word,
    string_agg(distinct t_label, ',' order by t_label) filter (t_base) as base_labels,
    string_agg(distinct t_label, ',' order by t_label) as labels,
    max(coverage) / 100 as score
  from spans group by r
)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
  first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(score, 0)::double as score
from d left join per on per.r = d.r
"""

# Every diagonal on which a document and an item have words in common that could make an overlap, and
# every window along it.
LEAKS = r"""
with items as (
  select item_id as item, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as iw from benchmark
),
d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as dw
  from documents
),
ipos as (select item, len(iw) as ni, unnest(range(1, len(iw) + 1)) as i, unnest(iw) as w from items where len(iw) >= 12),
dpos as (select r, unnest(range(1, len(dw) + 1)) as j, unnest(dw) as w from d where len(dw) >= 12),
diagonals as (
  select r, item, j - i as shift from ipos join dpos using (w) group by all having count(*) >= 11
),
windows as (
  select x.r, x.item, x.shift, iw, dw, unnest(range(greatest(1, 1 - x.shift), least(len(iw), len(dw) - x.shift) - 10)) as i
  from diagonals x join items on items.item is not distinct from x.item join d on d.r = x.r
),
spread as (
  select *, i + shift as j, least(i - 1, i + shift - 1, 12) as before,
    least(len(iw) - i, len(dw) - i - shift, 23) as after
  from windows
),
compared as (
  select r, item, i, j, before + after + 1 as n,
    len(list_filter(range(-before, after + 1), lambda o: iw[i + o] = dw[j + o])) as total,
    len(list_filter(range(0, 12), lambda o: iw[i + o] = dw[j + o])) as inside
  from spread
),
leaks as (
  select distinct r, item, i, j, total from compared
  where inside >= 11 or (n >= 20 and 100 * total >= 80 * n)
),
per as (
  select r, list_sort(list(distinct item)) as items, (min(j) - 1)::bigint as first_word,
    count(*)::bigint as n_hits
  from leaks group by r
)
select doc_id, n_hits is not null as contaminated, coalesce(items, []) as items, first_word,
  coalesce(n_hits, 0)::bigint as n_hits
from d left join per on per.r = d.r
"""

CHAT = r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
),
escaped as (
  select *,
    regexp_replace(replace(text, '\', '\\'), '([<\[])(/?s>|/?INST\]|/?TURN\]|/?SYS>|\|)', '\1\\\2', 'g') as body,
    replace(
      regexp_replace(replace(role, '\', '\\'), '([<\[])(/?s>|/?INST\]|/?TURN\]|/?SYS>|\|)', '\1\\\2', 'g'),
      chr(10), '\n') as head,
    row_number() over w as i, count(*) over (partition by conv_id) as n
  from rows_
  window w as (partition by conv_id order by turn nulls first, role, text)
),
sized as (
  select *,
    sum(length('[TURN]') + length(head) + 1 + length(body) + length('</s>'))
      over (partition by conv_id order by i) as upto
  from escaped
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(upto) filter (role = 'assistant' or i = n))::bigint as formatted_chars
from sized
group by conv_id
"""

# Every pair of texts with a shingle in common, its overlap counted, and the groups followed link by
# link.
JACCARD = r"""
with recursive d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as (
  select r, doc_id, case
      when len(w) = 0 then []
      when len(w) < 3 then [array_to_string(w, ' ')]
      else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    end as s
  from d
),
classes as (select list_sort(s) as s, min(r) as k, len(s) as n, min(doc_id) as first from sets where len(s) > 0 group by 1, 3),
held as (select k, n, unnest(s) as g from classes),
common as (
  select a.k as a, b.k as b, a.n as na, b.n as nb, count(*) as c
  from held a join held b on a.g = b.g and a.k < b.k and 100 * a.n >= 90 * b.n and 100 * b.n >= 90 * a.n
  group by all
),
links as (select a, b from common where 100 * c >= 90 * (na + nb - c)),
edges as (select a, b from links union all select b, a from links),
reach(a, b) as (
  select a, b from edges union select reach.a, edges.b from reach join edges on reach.b = edges.a
),
lowest as (
  select x.k, least(x.first, min(y.first)) as component_id
  from classes x left join reach on reach.a = x.k left join classes y on y.k = reach.b group by x.k, x.first
)
select sets.doc_id, len(sets.s)::bigint as n_shingles, coalesce(component_id, sets.doc_id) as component_id
from sets left join classes on classes.s = list_sort(sets.s) left join lowest on lowest.k = classes.k
"""

# The CRC of each distinct word byte by byte, with a table made by its polynomial.
RESAMPLING = r"""
with recursive steps(i, c, k) as (
  select i, i::ubigint, 0 from range(256) as t(i)
  union all
  select i, case when c % 2 = 1 then xor(c // 2, 3988292384::ubigint) else c // 2 end, k + 1 from steps where k < 8
),
crc as (select list(c order by i) as t from steps where k = 8),
texts as (
  select row_number() over () as r, true as ours, doc_id, coalesce(text, '') as text from documents
  union all
  select -row_number() over (), false, null, coalesce(text, '') from benchmark
),
words as (
  select r, ours, doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from texts
),
each_ as (select r, ours, unnest(w) as f from words),
known as (select distinct f from each_),
hexed as (select f, hex(encode(f)) as h from known),
hashed as (
  select f, (xor(list_reduce(
      list_prepend(4294967295::ubigint, list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::ubigint)),
      lambda x, y: xor(x // 256, t[(xor(x, y) % 256)::bigint + 1])), 4294967295::ubigint) % 10000)::bigint as bucket
  from hexed, crc
),
counts as (
  select bucket, count(*) filter (ours) as s, count(*) filter (not ours) as t
  from each_ join hashed using (f) group by bucket
),
total as (select coalesce(sum(s), 0) + 10000 as s_all, coalesce(sum(t), 0) + 10000 as t_all from counts),
gain as (
  select bucket, floor(1000 * ln(((t + 1) * s_all)::double / ((s + 1) * t_all)::double))::bigint as g from counts, total
),
weights as (
  select r, sum(g)::bigint as weight from each_ join hashed using (f) join gain using (bucket) where ours group by r
),
scored as (
  select words.r, doc_id, len(w)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || sha256('2024:' || coalesce(doc_id::varchar, ''))[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from words left join weights on weights.r = words.r where ours
),
placed as (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last, r) as place,
    count(*) over (partition by n_features >= 20) as n
  from scored
)
select doc_id, n_features, weight, score,
  case when n_features >= 20 and place <= n * 10 // 100 then place end as rank
from placed
"""


def _clusters(rounds: int = 3) -> str:
    """The rounds written out one after the other."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} as (
  select r, c, dist from (
    select v.r, m.c, list_sum(list_transform(range(1, 65), lambda j: (v.x[j] - m.x[j]) * (v.x[j] - m.x[j])))::bigint as dist
    from kept v, m{i} m
  ) qualify row_number() over (partition by r order by dist, c) = 1
)""")
        if i < rounds:
            # // cuts towards zero; the remainder's sign tells where the floor is one less.
            steps.append(f"""
parts{i} as (
  select c, j, sum(x[j])::bigint as s, count(*) as n from near{i} join kept using (r), range(1, 65) as t(j) group by c, j
),
m{i + 1} as (
  select m.c, coalesce(p.x, m.x) as x from m{i} m left join (
    select c, list((s - ((s % n) + n) % n) // n order by j) as x from parts{i} group by c
  ) p using (c)
)""")
    return f"""
with v as (select row_number() over () as r, vec_id, embedding as e from embeddings),
kept as (
  select r, vec_id, list_transform(e, lambda x: floor(64 * x::double)::bigint) as x
  from v where len(e) = 64 and len(list_filter(e, lambda x: x is not null and isfinite(x))) = 64
),
m0 as (
  select row_number() over (order by h, x) - 1 as c, x
  from (select sha256('1:' || coalesce(vec_id::varchar, '')) as h, x from kept) order by h, x limit 16
),{",".join(steps)}
select vec_id, near{rounds}.c::integer as cluster, dist as distance,
  (sum(dist) over (partition by near{rounds}.c))::bigint as cluster_inertia, (sum(dist) over ())::bigint as inertia,
  sha256(array_to_string(m.x, ',')) as centroid_sha256
from near{rounds} join kept using (r) join m{rounds} m on m.c = near{rounds}.c
"""


ORACLES: dict[str, str] = {
    "op3_license_scan": LICENSES,
    "op4_chat_format": CHAT,
    "op5_decontamination": LEAKS,
    "op7_quality_rules": QUALITY,
    "op11_jaccard_join": JACCARD,
    "op12_importance_resampling": RESAMPLING,
    "op13_centroid_clustering": _clusters(),
}

"""SQL of the registered queries that SQL can express, written from their contracts."""

from __future__ import annotations

from reqmill.llm import licenses

WORD = r"[^\x20\x09-\x0D]+"

QUALITY_RULES = rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
w as (
  select *, regexp_extract_all(text, '{WORD}') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines
  from d),
spot as (
  select rid, words, unnest(range(len(words) - 2)) as p from w where len(words) >= 3),
win as (
  select rid, p, count(*) over (partition by rid, words[p + 1], words[p + 2], words[p + 3]) as n from spot),
covered as (
  select rid, count(distinct p + k) as n from win, range(3) as r(k) where n > 1 group by rid),
m as (
  select doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(lines)::bigint as n_lines,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words
  from w left join covered using (rid)),
f as (
  select *, (n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int + 4 * (10 * n_symbols > n_words)::int
         + 8 * (10 * n_dup_lines > 3 * n_lines)::int + 16 * (word_chars < 2 * n_words)::int
         + 32 * (word_chars > 12 * n_words)::int
         + 64 * (n_dup_lines > 2 and 10 * n_dup_lines > 3 * n_lines)::int as failures
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures % 4 <> 0 as base_failed,
       failures in (0, 8) as kept, failures::bigint as failures
from f
"""

# One step for each slot: the shard whose turn it is takes its first free preference.
SHARDING = """
with recursive shards as (
  select s::int as s, 'shard-' || lpad(s::varchar, 5, '0') as shard from range(32) as r(s)),
prefs as (
  select s, shard, list_transform(range(8209), lambda j: (('0x' || md5(shard)[1:15])::bigint % 8209
         + j * (('0x' || md5(shard)[17:31])::bigint % 8208 + 1)) % 8209) as liked
  from shards),
fill(k, slot, taken) as (
  select -1::bigint, -1::bigint, list_transform(range(8209), lambda x: false)
  union all
  select k + 1, got, list_concat(taken[:got], [true], taken[got + 2:])
  from (select k, taken, list_filter(liked, lambda x: not taken[x + 1])[1] as got
        from fill join prefs on s = (k + 1) % 32 where k < 8208)),
held as (
  select slot::int as slot, shard from fill join prefs on s = k % 32 where k >= 0)
select doc_id, slot, shard
from (select doc_id, (('0x' || md5(coalesce(doc_id::varchar, ''))[1:15])::bigint % 8209)::int as slot from documents) d
join held using (slot)
"""



def _licenses() -> str:
    """Both sequences of every text, then one step for each rule."""
    known = ", ".join(f"('{t}', '{name}')" for name, texts in licenses.SENTENCES.items() for t in texts)
    steps, last = [], "seq0"
    for k, (licence, ids) in enumerate(licenses.RULES, 1):
        at = licenses.pattern(ids)
        steps.append(f"""seq{k} as (select rid, way, case when contains(s, '{at}') then list_append(found, '{licence}') else found end as found,
  replace(s, '{at}', '<->') as s from {last})""")
        last = f"seq{k}"
    return rf"""with known(t, name) as (values {known}),
d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
ways as (select rid, 1 as way, text from d union all select rid, 2, regexp_replace(text, '[\r\n]+', ' ', 'g') from d),
parts as (select rid, way, unnest(l) as raw, generate_subscripts(l, 1) as n
          from (select rid, way, regexp_split_to_array(text, '[.!?;:]+[ \t\r\n]+|[\r\n]+') as l from ways)),
clean as (select rid, way, n, trim(regexp_replace(lower(raw), '[^a-z0-9.]+', ' ', 'g'), ' .') as t from parts),
named as (select rid, way, n, '<' || coalesce(name, '?') || '>' as mark, name from clean left join known using (t) where t <> ''),
seq0 as (select rid, way, []::varchar[] as found, regexp_replace(string_agg(mark, '' order by n), '(<\?>)+', '<?>', 'g') as s
         from named group by rid, way),
{", ".join(steps)},
licences as (select rid, list_sort(list_distinct(flatten(list(found)))) as l from {last} group by rid),
ids as (select rid, string_agg(name, ',' order by n) as ids, count(name) as n from named where way = 1 group by rid)
select doc_id, coalesce(ids.n, 0)::bigint as n_sentences, coalesce(ids.ids, '') as identifiers,
       coalesce(array_to_string(l, ','), '') as licences
from d left join ids using (rid) left join licences using (rid)"""


# Every pair of an anchor and a row, in exact integers.
HARD_NEGATIVES = """
with r as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::hugeint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label,
         coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])), 0)::bigint as score
  from r a join r b on len(a.v) = len(b.v)
  where a.vec_id % 100 = 0),
pos as (
  select anchor_id, anchor_label, vec_id as positive_id, score as positive_score
  from pairs where vec_id <> anchor_id and label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
neg as (
  select pos.anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
         row_number() over (partition by pos.anchor_id, positive_id order by score desc, vec_id) as rank
  from pos join pairs on pairs.anchor_id = pos.anchor_id and label <> pos.anchor_label
   and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from neg where rank <= 5
"""

_SENTENCE = "[.,;:!?\x0A-\x0D]"

# Phrases of each length counted apart, cuts and containments joined.
COLLOCATIONS = rf"""
with d as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
p as (select lang, unnest(regexp_split_to_array(text, '{_SENTENCE}')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from p),
grams as (
  select lang, m, array_to_string(words[i:i + m - 1], ' ') as phrase
  from (select lang, words, m, unnest(range(1, len(words) - m + 2)) as i from w, range(1, 6) as r(m) where len(words) >= m)),
f as (select lang, m, phrase, count(*) as f from grams group by lang, m, phrase having count(*) >= 100),
n as (select lang, sum(len(words))::bigint as n from w group by lang),
c as (select lang, m, phrase, f as a, string_split(phrase, ' ') as words from f where m >= 2),
cuts as (
  select c.lang, c.phrase, c.m, a, n, k, x.f as l, y.f as r, ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
  from (select *, unnest(range(1, m)) as k from c) c join n on n.lang = c.lang
  join f x on x.lang = c.lang and x.phrase = array_to_string(words[1:k], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(words[k + 1:], ' ')),
inner_phrases as (
  select lang, array_to_string(words[i:i + size - 1], ' ') as phrase, max(a) as longer
  from (select lang, words, a, size, unnest(range(1, m - size + 2)) as i
        from (select *, unnest(range(2, m)) as size from c where m > 2)) group by all),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select b.lang, row_number() over (partition by b.lang order by score desc, a desc, b.phrase)::int as rank, b.phrase, a, l, r, n, score
from best b left join inner_phrases i on i.lang = b.lang and i.phrase = b.phrase
where longer is null or 100 * longer < 100 * a
qualify row_number() over (partition by b.lang order by score desc, a desc, b.phrase) <= 2000
"""


ORACLES: dict[str, str] = {
    "op2_licenses": _licenses(), "op4_quality_rules": QUALITY_RULES, "op6_sharding": SHARDING,
    "op11_hard_negatives": HARD_NEGATIVES, "op13_collocations": COLLOCATIONS}

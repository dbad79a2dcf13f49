"""The same queries as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from folioflow.llm import chat

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
with doc as (
    select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from documents
),
item as (
    select item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from benchmark
),
phrase as (
    select distinct item_id, array_to_string(w[i:i + 9], ' ') as p, least(len(w), 10) as n
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item where len(w) > 0)
),
place as (
    select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as p
    from (
        select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from doc, (select distinct n from phrase) where len(w) >= n
    )
),
hit as (select place.doc_id, item_id, i, place.n from place join phrase on place.p = phrase.p and place.n = phrase.n),
words as (
    select doc_id, count(distinct k) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as k from (select distinct doc_id, i, n from hit)) group by doc_id
),
items as (
    select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct doc_id, item_id::varchar as id from hit) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (doc_id) left join items using (doc_id)
"""


def _escaped(text: str) -> str:
    tail = r"(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"
    return rf"regexp_replace({text}, '([<\[])(\\*){tail}', '\1\\\2\3', 'g')"


_MARKS = len(chat.TURN) + len(chat.TEXT) + len(chat.END)

OP4 = f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn), '')) as loss_sha256,
       sum({_MARKS} + length({_escaped("role")}) + length({_escaped("text")}))::bigint as formatted_chars
from turns group by conv_id
"""

OP5 = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::bigint as score
    from v q join v c on q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
)
select query_id, rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
where rank <= 5
"""

OP9 = f"""
with line as (
    select doc_id, i, unnest(l) as line, unnest(range(1, len(l) + 1)) as no
    from (select doc_id, doc_id as i, string_split(coalesce(text, ''), chr(10)) as l from documents)
),
keyed as (
    select doc_id, no, line, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key
    from line
),
repeated as (
    select key, max(doc_id) as last from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
)
select doc_id, count(*) as n_lines, count(last) filter (last <> doc_id) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by no) filter (last is null or last = doc_id), '')) as kept_sha256
from keyed left join repeated using (key) group by doc_id
"""

OP11 = """
with doc as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
    from documents
),
mark as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
failed as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
           case when len(w) < 200 then 'A' else '' end
           || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
           || case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) then 'C' else '' end
           || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
           || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as fails
    from doc left join mark using (doc_id)
),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order
    from letter a, letter b, letter c, letter d, letter e
    where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps as (
    select filter_order, step, filter_order[step] as own, filter_order[1:step - 1] as earlier
    from (select filter_order, unnest(range(1, 6))::int as step from orders)
),
kinds as (select part, good, toxic, fails, count(*) as n from failed group by all),
met as (
    select kinds.*, steps.*, contains(fails, own) as bad,
           len(list_intersect(regexp_extract_all(fails, '.'), regexp_extract_all(earlier, '.'))) > 0 as gone
    from kinds, steps
),
counted as (
    select part, filter_order, step, own,
           coalesce(sum(n) filter (not bad and not gone), 0)::bigint as kept,
           coalesce(sum(n) filter (bad and not gone), 0)::bigint as removed,
           coalesce(sum(n) filter (bad and gone), 0)::bigint as redundant,
           coalesce(sum(n) filter (fails = own), 0)::bigint as unique_fails,
           coalesce(sum(n) filter (bad and not gone and good), 0)::bigint as good_lost,
           coalesce(sum(n) filter (bad and not gone and toxic), 0)::bigint as toxic_lost
    from met group by all
)
select * exclude (own), (sum(removed) over (partition by part, own))::bigint as shapley from counted
"""

OP12 = f"""
with piece as (
    select coalesce(lang, 'und') as lang,
           regexp_extract_all(unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') as w
    from documents
),
found as (
    select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase, count(*) as a
    from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from piece, (select unnest(range(1, 5)) as size) where len(w) >= size)
    group by all
),
total as (select lang, sum(len(w))::bigint as n from piece group by lang),
long as (select *, string_split(phrase, ' ') as words from found where size > 1 and a >= 30),
cuts as (
    select lang, phrase, a, k, array_to_string(words[1:k], ' ') as head, array_to_string(words[k + 1:], ' ') as tail
    from (select *, unnest(range(1, size)) as k from long)
),
scored as (
    select cuts.*, h.a as l, t.a as r, ((2000000::hugeint * cuts.a) // (h.a + t.a))::bigint as score
    from cuts join found h on h.lang = cuts.lang and h.phrase = cuts.head join found t on t.lang = cuts.lang and t.phrase = cuts.tail
),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
covered as (
    select lang, array_to_string(words[i:i + m - 1], ' ') as phrase, max(a) as outer_a
    from (select *, unnest(range(1, size - m + 2)) as i from (select *, unnest(range(2, size)) as m from long))
    group by all
),
ranked as (
    select best.*, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from best left join covered using (lang, phrase)
    where outer_a is null or 100::hugeint * outer_a < 80::hugeint * a
)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""

ORACLES = {
    "op1_benchmark_decontamination": OP1,
    "op4_chat_formatting": OP4,
    "op5_exact_topk": OP5,
    "op9_line_dedup": OP9,
    "op11_filter_audit": OP11,
    "op12_phrase_collocations": OP12,
}

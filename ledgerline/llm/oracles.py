"""SQL of the training-data queries whose results plain SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from ledgerline.llm import chat

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CHAT_SQL = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, turn, role, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) as t(turn, role)),
marked as (
  select *, greatest(ceil(length(text) / 4)::bigint + 2, 1) as tokens,
         length('### ' || if(regexp_full_match(role, '[A-Za-z0-9_-]+'), role, '=' || hex(encode(role))) || ': '
           || replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</', '<\/') || '</turn>' || chr(10)) as chars,
         row_number() over (partition by conv_id order by turn nulls first, role, text) as position
  from turns),
summed as (
  select *, sum(tokens) over (partition by conv_id order by position) - tokens as first_token,
         position = 1 and role = '{chat.SYSTEM}' as is_system
  from marked),
cut as (
  select *, max(if(is_system, chars, null)) over (partition by conv_id) as system_chars,
         greatest(1, floor(({chat.BUDGET - chat.HISTORY} - coalesce(max(if(is_system, tokens, null)) over (partition by conv_id), 0)) / 2)) as stretch,
         coalesce(sum(if(is_system, 0, chars)) over (
           partition by conv_id order by first_token range between {chat.HISTORY} preceding and 1 preceding), 0) as history_chars
  from summed),
placed as (select *, tokens > stretch as long, floor(first_token / stretch) as stretch_no from cut),
starts as (
  select *, position = 1 or long or lag(stretch_no) over w <> stretch_no or lag(long) over w <> long as starts
  from placed window w as (partition by conv_id order by position))
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by position)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = '{chat.TARGET}'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by position) filter (role = '{chat.TARGET}'), '')) as loss_sha256,
       sum(chars + if(starts, history_chars, 0) + if(starts and position > 1, coalesce(system_chars, 0), 0))::bigint as formatted_chars
from starts group by conv_id"""

DECONTAMINATION_SQL = f"""
with docs as (select row_number() over () as row, doc_id, coalesce({_WORDS}, []) as w from documents),
items as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, k, array_to_string(w[i + 1:i + k], ' ') as words
  from (select item_id, w, least(10, len(w)) as k, unnest(range(len(w) - least(10, len(w)) + 1)) as i from items where len(w) > 0)),
places as (
  select row, k, i, array_to_string(w[i + 1:i + k], ' ') as words
  from (select row, w, k, unnest(range(len(w) - k + 1)) as i from docs, (select distinct k from windows) where len(w) >= k)),
found as (select row, i, k, item_id from places join windows using (k, words)),
hits as (
  select row, count(distinct word) as n_hit from (select row, unnest(range(i, i + k)) as word from found) group by row),
named as (
  select row, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items
  from (select distinct row, item_id from found) group by row)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (row) left join named using (row)"""

WARC_SQL = """
with records as (
  select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as bytes from pages),
kept as (select *, if(bytes >= 1000, max(page_id) over (partition by payload), page_id) as response from records)
select page_id, bytes as payload_bytes, sha1(payload) as payload_digest,
       if(page_id = response, 'response', 'revisit') as record_type, if(page_id = response, null, response) as refers_to
from kept"""

TOP_K_SQL = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, max(list_dot_product(q.v, c.v))::bigint as score
  from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 50 = 0 group by q.vec_id, c.vec_id)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 5"""

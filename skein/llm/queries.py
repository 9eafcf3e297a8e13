"""One query per operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skein.llm import (arc, bpe, cotrain, deobfuscate, edit_counts, guess_cost, phrase_index, prefix_trie, quotient, simhash, snapshots,
                       suffix_tree, turn_repair)

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

# A to Z in lower case; null as empty.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 of a text of ASCII characters, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295::bigint, list_transform(range(1, length({s}) + 1), lambda i: ascii(({s})[i])::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)),
                           lambda x, i: xor(x >> 1, case when x % 2 = 1 then 3988292384 else 0 end))))"""

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        LLM_QUERIES[function.__name__] = function
        if sql:
            LLM_ORACLES[function.__name__] = sql
        return function
    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(read(spark, sf_dir, "documents"))


@query("""
with words as (select doc_id, regexp_extract_all({body}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
item_words as (select item_id, regexp_extract_all({body}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 13) as size, array_to_string(w[i:i + 12], ' ') as phrase
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from item_words where len(w) > 0)),
sizes as (select distinct size from windows),
places as (
  select doc_id, size, unnest(range(1, len(w) - size + 2)) as i, w from words, sizes where len(w) >= size),
found as (
  select p.doc_id, p.i, p.size, v.item_id
  from (select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as phrase from places) p
  join windows v on p.phrase = v.phrase and p.size = v.size),
hits as (
  select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as pos from found) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(n.n_items, 0) as n_items,
  sha256(coalesce(n.list, '')) as items_sha256,
  coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.w) as contaminated
from words d left join hits h using (doc_id) left join items n using (doc_id)
""".replace("{body}", LOWER))
def op2_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deobfuscate.digest(deobfuscate.find(read(spark, sf_dir, "documents")), deobfuscate.KINDS)


@query()
def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


@query()
def op5_edited_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after the edits of a clean-up job."""
    docs = read(spark, sf_dir, "documents").withColumn("edits", edit_counts.house_edits())
    edited = edit_counts.apply_edits(edit_counts.build(docs, BYTE_RANKS, keep=("edits",)), BYTE_RANKS)
    return edited.select("doc_id", "n_before", "n_after", "n_encoded")


@query("""
with t as (
  select conv_id, greatest(floor(coalesce(turn, -1) / 1024), -1)::bigint as part,
    row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as k,
    coalesce(role, '') as role, coalesce(text, '') as text,
    hash(role is null, text is null) || chr(1) || coalesce(role, '') || chr(2) || coalesce(text, '') || chr(3) as piece
  from conversations where conv_id is not null),
p as (select *, string_agg(piece, '') over (partition by conv_id order by k) as prefix,
        max(k) over (partition by conv_id) as n_turns from t),
ends as (select min(conv_id) as conv_id, prefix, n_turns, count(*) as n_copies from p where k = n_turns group by prefix, n_turns),
kept as (select * from ends where prefix not in (select prefix from p where k < n_turns))
select t.conv_id, t.part, k.n_turns, k.n_copies,
  string_agg('<|im_start|>' || replace(t.role, '<|', '< |') || chr(10) || replace(t.text, '<|', '< |') || '<|im_end|>' || chr(10), '' order by t.k) as rendered
from t join kept k using (conv_id) group by t.conv_id, t.part, k.n_turns, k.n_copies
""")
def op6_collapsed_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.collapse(read(spark, sf_dir, "conversations"))


@query()
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = guess_cost.find(read(spark, sf_dir, "documents"), WORD_BPE, plain_costs=False)
    return deobfuscate.digest(found, guess_cost.KINDS)


@query()
def op8_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read(spark, sf_dir, "documents"), WORD_BPE)


@query(f"""
with n as (select doc_id, sha256({LOWER}) as text_sha256, {LOWER} as body from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, text_sha256
from n window w as (partition by body)
""")
def op10_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient.exact_groups(read(spark, sf_dir, "documents"))


@query("""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k
  from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 20 as donor, {crc} % 4 as h from t group by conv_id),
built as (
  select c.conv_id, t.k, t.role, t.text from c join t on t.conv_id = c.donor and t.k <= c.h
  union all select t.conv_id, t.k, t.role, t.text from c join t on t.conv_id = c.conv_id and t.k > c.h),
d as (select conv_id, row_number() over (partition by conv_id order by k) as depth, role, text from built),
p as (
  select conv_id, depth, list([role, text]) over (partition by conv_id order by depth) as prefix,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words from d),
n as (select depth, prefix, min(conv_id) as node, count(*) as n_convs, min(words) as words from p group by depth, prefix),
m as (
  select p.conv_id, p.depth, n.node from p join n on p.depth = n.depth and p.prefix = n.prefix
  union all select conv_id, 0, (select min(conv_id) from c) from c),
nodes as (
  select n.node as conv_id, n.depth, m.node as parent_conv_id, n.n_convs, n.words from n join m on m.conv_id = n.node and m.depth = n.depth - 1
  union all select min(conv_id), 0, null, count(*), 0 from c having count(*) > 0),
kids as (select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all),
whole as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (conv_id, depth)),
sums as (
  select m.node as conv_id, m.depth, count(*) filter (w.n_children = 0) as n_leaves, sum((w.n_convs - 1) * w.words)::bigint as saved_tokens
  from whole w join m on m.conv_id = w.conv_id and m.depth <= w.depth group by m.node, m.depth),
ends as (
  select node as conv_id, depth, string_agg(member::varchar, ',' order by member) as list
  from (select conv_id as member, arg_max(node, depth) as node, max(depth) as depth from m group by conv_id) group by node, depth)
select w.conv_id, w.depth, w.parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.list, '')) as ends_sha256
from whole w join sums s using (conv_id, depth) left join ends e using (conv_id, depth)
""".replace("{crc}", CRC32.replace("{s}", "conv_id::varchar")))
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


# The cheapest edits so far, by the state they end in, as (c: cost, a: letters, r: lines that stay); far is out of reach.
_FAR = "{'c': 1000000000, 'a': '', 'r': []::varchar[]}"
_DELETE = lambda v: f"{{'c': {v}.c + 4, 'a': {v}.a || 'D', 'r': {v}.r}}"
_INSERT = lambda v, role: f"{{'c': {v}.c + 3, 'a': {v}.a || 'I', 'r': list_append({v}.r, '{role}:')}}"
_KEEP = lambda v, x: (f"case when not x.gone and x.initial = '{x}' then {{'c': {v}.c + x.add, 'a': {v}.a || 'K', "  # noqa: E731
                      f"'r': list_append({v}.r, x.role || ':' || x.text)}} else {_FAR} end")
_REROLE = lambda v, role: (f"case when not x.gone then {{'c': {v}.c + x.add + 3, 'a': {v}.a || 'R', "  # noqa: E731
                           f"'r': list_append({v}.r, '{role}:' || x.text)}} else {_FAR} end")
_BEST = lambda *options: f"list_sort([{', '.join(options)}])[1]"
_REPAIRS = f"""
dp as (
  select conv, 0::bigint as k, {{'c': 0, 'a': '', 'r': []::varchar[]}} as n, {_FAR} as s, {{'c': 3, 'a': 'I', 'r': ['user:']}} as u,
    {{'c': 6, 'a': 'II', 'r': ['user:', 'assistant:']}} as a from ids
  union all
  select conv, k, n, s, {_BEST('u', _INSERT('a0', 'user'))}, {_BEST('a0', _INSERT('u', 'assistant'))} from (
    select conv, k, n, s, {_BEST('u0', _INSERT('n', 'user'), _INSERT('s', 'user'), _INSERT('a0', 'user'))} as u, a0 from (
      select conv, x.k, {_DELETE('n')} as n, {_BEST(_DELETE('s'), _KEEP('n', 's'))} as s,
        {_BEST(_DELETE('u'), *[f(v, x) for v in ('n', 's', 'a') for f, x in ((_KEEP, 'u'), (_REROLE, 'user'))])} as u0,
        {_BEST(_DELETE('a'), _KEEP('u', 'a'), _REROLE('u', 'assistant'))} as a0
      from dp join marked x using (conv) where x.k = dp.k + 1)))"""


@query("""
with recursive raw as (
  select conv_id, coalesce(conv_id::varchar, ' ') as conv, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
drawn as (select *, {crc} % 20 as draw from raw),
hurt as (
  select conv, turn, case when draw = 4 then 'user' else role end as role,
    case draw when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when draw = 3 then 2 else 1 end)) as copy
  from drawn where draw != 0),
placed as (select *, row_number() over (partition by conv order by turn nulls first, role, text) as k from hurt),
numbered as (select *, row_number() over (partition by conv, role, text order by k) as nth, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body from placed),
fault as (select *, case when body = '' then 'blank' when nth > 1 then 'duplicate' when body[-1] not in ('.', '!', '?') then 'truncated' else '' end as fault,
    role[1] as initial, lag(role[1]) over (partition by conv order by k) as before from numbered),
marked as (select *, fault in ('blank', 'duplicate') as gone, case when fault = 'truncated' then 3 else 0 end as add from fault),
ids as (select distinct conv_id, conv from raw),
{repairs},
sums as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal, max(k) as n from marked group by conv),
ends as (select conv, list_sort([dp.n, dp.a])[1] as best from dp left join sums using (conv) where dp.k = coalesce(sums.n, 0))
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.c::bigint as cost, best.a as audit,
  sha256(array_to_string(best.r, chr(10))) as repaired_sha256
from ids join ends using (conv) left join sums using (conv)
""".replace("{crc}", CRC32.replace("{s}", "name")).replace("{repairs}", _REPAIRS))
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.audit(read(spark, sf_dir, "conversations"))


# Twenty bits in hex as four signs of base 32.
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {at}, 5))::bigint >> {shift}) & 31)::int + 1, 1)"
                      for at in range(1, 41, 5) for shift in (15, 10, 5, 0))


@query(f"""
with p as (select page_id, coalesce(html, '') as body, encode(coalesce(html, '')) as data, sha1(coalesce(html, '')) as h from pages)
select page_id, octet_length(data)::bigint as payload_bytes, {_BASE32} as payload_digest,
  case when page_id = max(page_id) over w then 'response' else 'revisit' end as record_type,
  case when page_id != max(page_id) over w then max(page_id) over w end as refers_to
from p window w as (partition by body)
""")
def op13_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.convert_pages(read(spark, sf_dir, "pages"))

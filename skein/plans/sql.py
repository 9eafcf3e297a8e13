"""Text shared by the SQL checks."""

from __future__ import annotations

from skein.functions.fixed import CZECH_LETTERS
from skein.plans.tables import ARTICLE_SELECT, DEFAULT_NOW, SITE_PREFIX

# Whitespace as in skein.functions.fixed, in the regex dialect of the SQL engine.
SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+"

RAW = f"raw_articles as ({ARTICLE_SELECT.format(documents='documents')})"

CLEAN = RAW + f""", articles as (
  select pos, url, title, text, photo_count, comment_count,
    case when time is null or time = '' then '{DEFAULT_NOW}'
         when right(time, 6) in ('+01:00', '+02:00', '+00:00') then time
         else time || '+01:00' end as time,
    case when starts_with(url, '{SITE_PREFIX}')
         then split_part(substr(url, {len(SITE_PREFIX) + 1}), '/', 1) end as category
  from raw_articles)"""

COLLIDING = """colliding as (
  select doc_id as pos, source || '/' || cast(doc_id % 300 as varchar) as url,
    split_part(text, chr(10), 1) as title, text
  from documents)"""

NODES = """nodes as (
  select s_suppkey * 3 as id, 'Person' as label, s_name as name, 1940 + 2 * s_nationkey as birth_year
  from supplier
  union all select p_partkey * 3 + 1, 'Movie', p_name, null from part
  union all select c_custkey * 3 + 2, 'Person', c_name, 1940 + 2 * c_nationkey from customer)"""

EDGES = """edges as (
  select l_suppkey * 3 as src, l_partkey * 3 + 1 as dst, 'ACTED_IN' as type, l_extendedprice as earnings
  from lineitem
  union all
  select o_custkey * 3 + 2, l_suppkey * 3, 'CONTACT', null
  from lineitem join orders on l_orderkey = o_orderkey)"""

# With edges of the same type into persons and from movies, which conditions on labels must leave out.
PRIZED = EDGES + """, prized as (
  select * from edges
  union all
  select l_suppkey * 3, o_custkey * 3 + 2, 'ACTED_IN', l_extendedprice * 2 from lineitem join orders on l_orderkey = o_orderkey
  union all
  select l_partkey * 3 + 1, l_suppkey * 3, 'CONTACT', null from lineitem
  union all
  select l_partkey * 3 + 1, l_partkey * 3 + 1, 'ACTED_IN', l_extendedprice * 100 from lineitem)"""

LINES = """lines as (
  select o_orderkey as id, 0 as connections from orders
  union all select l_orderkey, 1 from lineitem),
degree as (select id, cast(sum(connections) as bigint) as connections from lines group by id),
names as (select o_orderkey as id, 'Order ' || o_orderkey as name from orders)"""


def words(text: str, table: str, columns: str = "") -> str:
    """Select of one row per whitespace word of ``text``, in column ``word``."""
    listed = f"{columns}, " if columns else ""
    return (f"select * from (select {listed}unnest(regexp_split_to_array({text}, '{SPACE}')) as word "
            f"from {table}) where word <> ''")


def clean_words(text: str, table: str, columns: str = "") -> str:
    """Select of one row per clean word of ``text``."""
    listed = f"{columns}, " if columns else ""
    spaced = f"regexp_replace(lower({text}), '[^a-z{CZECH_LETTERS}0-9\\s]', ' ', 'g')"
    return (f"select * from (select {listed}unnest(regexp_split_to_array({spaced}, '\\s+')) as word "
            f"from {table}) where regexp_matches(word, '^[a-z{CZECH_LETTERS}]+$')")

"""Word and letter queries over whole article texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions.fixed import PUNCTUATION
from skein.operators import words as w
from skein.operators.aggregates import in_year
from skein.plans.registry import query
from skein.plans.sql import CLEAN, SPACE, clean_words, words
from skein.plans import tables
from skein.plans.tables import table
from skein.session import spread



def articles(spark, sf_dir):
    """Articles on all cores: splitting texts is the heavy part of every query here."""
    return spread(tables.articles(spark, sf_dir))


TOKENS = f"list_filter(regexp_split_to_array(text, '{SPACE}'), lambda x: x <> '')"


@query("word_rows", f"""
select doc_id as pos, count(*) as n, max(word) as last_word, cast(sum(length(word)) as bigint) as n_chars
from ({words('text', 'documents', 'doc_id')}) group by 1""")
def word_rows(spark, sf_dir):
    rows = w.explode_words(articles(spark, sf_dir), "text", keep=["pos"])
    return rows.groupBy("pos").agg(
        F.count(F.lit(1)).alias("n"), F.max("word").alias("last_word"),
        F.sum(F.length("word")).alias("n_chars"))


@query("word_count", f"select word, count(*) as n from ({words('text', 'documents')}) group by 1")
def word_count(spark, sf_dir):
    return w.word_count(articles(spark, sf_dir), "text")


@query("normalised_word_count", f"""
select word, count(*) as n from (
  select case when starts_with(plain, 'http') then ''
    else regexp_replace(lower(plain), '[{PUNCTUATION}]', '', 'g') end as word
  from (select regexp_replace(word, '[^\\x00-\\x7F]', '', 'g') as plain from ({words('text', 'documents')})))
where word <> '' group by 1 order by n desc, word limit 20""")
def normalised_word_count(spark, sf_dir):
    return w.normalised_word_count(articles(spark, sf_dir), "text")


def first_seen(text: str, table: str, where: str, k: int) -> str:
    """The ``k`` most frequent words; the one seen first wins ties."""
    split = f"regexp_split_to_array({text}, '{SPACE}')"
    return f"""
select word, n from (
  select word, count(*) as n, min(pos) as pos, arg_min(place, pos * 1000000000 + place) as place
  from (select pos, unnest({split}) as word, generate_subscripts({split}, 1) as place from {table})
  where word <> '' and {where} group by word)
order by n desc, pos, place limit {k}"""


@query("top_title_words", f"with {CLEAN}, chosen as (select * from articles where starts_with(time, '2020'))"
       + first_seen("title", "chosen", "true", 5))
def top_title_words(spark, sf_dir):
    return w.top_words(in_year(articles(spark, sf_dir), "2020"), "title", 5, order="pos")


@query("top_long_words", f"with {CLEAN}" + first_seen("lower(text)", "articles", "length(word) >= 6", 8))
def top_long_words(spark, sf_dir):
    return w.top_words(articles(spark, sf_dir), "text", 8, order="pos", min_len=6, lower=True)


@query("total_words", f"select cast(sum(len({TOKENS})) as bigint) as n_words from documents")
def total_words(spark, sf_dir):
    return w.total_words(articles(spark, sf_dir), "text")


@query("mean_word_length", f"select avg(length(word)) as mean_length from ({words('text', 'documents')})")
def mean_word_length(spark, sf_dir):
    return w.mean_word_length(articles(spark, sf_dir), "text")


@query("most_and_least_words", f"""with {CLEAN},
counted as (select pos, title, cast(len({TOKENS}) as int) as n_words from articles)
select * from (
  (select 'most' as which, pos, title, n_words from counted order by n_words desc, pos limit 1)
  union all
  (select 'least', pos, title, n_words from counted order by n_words, pos limit 1))""")
def most_and_least_words(spark, sf_dir):
    return w.most_and_least_words(articles(spark, sf_dir).select("pos", "title", "text"), "text", "pos").drop("text")


@query("top_by_occurrences", f"""with {CLEAN}
select title, hits from (
  select title, arg_max(cast((length(text) - length(replace(text, 'the', ''))) / 3 as int), pos) as hits,
    min(pos) as first
  from articles group by title)
order by hits desc, first limit 3""")
def top_by_occurrences(spark, sf_dir):
    return w.top_by_occurrences(articles(spark, sf_dir), "the", 3)


@query("words_per_article_hist", f"""
select n_words, count(*) as n from (select cast(len({TOKENS}) as int) as n_words from documents) group by 1""")
def words_per_article_hist(spark, sf_dir):
    return w.words_per_row_histogram(articles(spark, sf_dir), "text")


@query("word_length_hist", f"""
select cast(length(word) as int) as word_length, count(*) as n from ({words('text', 'documents')}) group by 1""")
def word_length_hist(spark, sf_dir):
    return w.word_length_histogram(articles(spark, sf_dir), "text")


@query("word_length_buckets", f"""
select cast(length(word) // 5 * 5 as int) as word_length, count(*) as n
from ({words('text', 'documents')}) group by 1""")
def word_length_buckets(spark, sf_dir):
    return w.word_length_histogram(articles(spark, sf_dir), "text", width=5)


@query("first_letter_count", f"""
select letter, count(*) as n from (
  select substr(word, 1, 1) as letter from ({words('lower(text)', 'documents')}))
where regexp_matches(letter, '^\\p{{L}}$') group by 1""")
def first_letter_count(spark, sf_dir):
    return w.first_letter_count(articles(spark, sf_dir), "text")


@query("clean_word_count", f"""
select word, count(*) as n from ({clean_words('text', 'documents')}) group by 1""")
def clean_word_count(spark, sf_dir):
    return w.clean_word_count(articles(spark, sf_dir), "text")


@query("conversation_words", f"""
select word, count(*) as n from ({words('text', 'conversations')}) group by 1""")
def conversation_words(spark, sf_dir):
    return w.word_count(table(spark, sf_dir, "conversations"), "text")

"""Queries over articles and stored pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions.text import ascii_only, occurrences
from skein.functions.timeparts import instant, local_date, month_text, weekday_number, year_text
from skein.operators import aggregates as agg
from skein.operators import articles as art
from skein.operators import dedupe, shape
from skein.operators.order import arg_extreme, top_k
from skein.plans.registry import query
from skein.plans.sql import CLEAN, COLLIDING, RAW
from skein.plans.tables import (DEFAULT_NOW, SITE_PREFIX, articles, colliding_articles, raw_articles,
                                table)
from skein.session import new_folder, spread

# Layout of the driver's pages.
PAGE_RULES = {"title": "article h1", "paragraphs": "article p", "tags": "nav a"}
PAGE_LINKS = ("nav a",)

UNESCAPED = ("replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), "
             "'&quot;', chr(34)), '&#x27;', chr(39)), '&amp;', '&')")


@query("extract_articles", f"""
with cut as (
  select page_id, url, split_part(split_part(html, '<article>', 2), '</article>', 1) as body,
    list_transform(regexp_extract_all(split_part(split_part(html, '<nav>', 2), '</nav>', 1), '<a href="[^"]*">([^<]*)</a>', 1),
      lambda t: trim(regexp_replace(t, '\\s+', ' ', 'g'))) as tags
  from pages),
parts as (
  select url, tags, split_part(split_part(body, '<h1>', 2), '</h1>', 1) as title,
    string_split(body, '<p>')[2:] as pieces
  from cut),
plain as (
  select url, tags, title, list_transform(pieces, lambda p:
    trim(regexp_replace(regexp_replace(regexp_replace(
      split_part(p, '</p>', 1), '\\s+', ' ', 'g'), ' ?<br> ?', chr(10), 'g'), '<[^>]*>', '', 'g'),
      ' ' || chr(10))) as pieces
  from parts)
select url, trim({UNESCAPED.format('title')}) as title,
  {UNESCAPED.format("chr(10) || array_to_string(pieces, chr(10))")} as text,
  cast(len(pieces) as int) as n_paragraphs, 0 as photo_count, cast(null as varchar) as time,
  0 as comment_count, coalesce(array_to_string(tags, chr(10)), '') as tags
from plain""")
def extract_articles(spark, sf_dir):
    found = art.extract_articles(spread(table(spark, sf_dir, "pages")), PAGE_RULES)
    return found.select(
        "url", "title", F.array_join("text", "\n").alias("text"),
        (F.size("text") - 1).alias("n_paragraphs"), "photo_count", "time", "comment_count",
        F.array_join("tags", "\n").alias("tags"))


LINKS_SQL = """select page_id, unnest(regexp_extract_all(
    split_part(split_part(html, '<nav>', 2), '</nav>', 1), '<a href="([^"]*)"', 1)) as href from pages"""


@query("extract_links", LINKS_SQL)
def extract_links(spark, sf_dir):
    return art.extract_links(spread(table(spark, sf_dir, "pages")), PAGE_LINKS)


@query("frontier_anti_join", f"""
select distinct href from ({LINKS_SQL})
where href not in (select '/' || word from (select unnest(string_split(text, ' ')) as word from benchmark))""")
def frontier_anti_join(spark, sf_dir):
    links = art.extract_links(spread(table(spark, sf_dir, "pages")), PAGE_LINKS)
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("word"))
    return art.frontier(links, words.select(F.concat(F.lit("/"), "word").alias("url")))


# Row by row: a row is kept when neither its url nor its title is among those of kept rows.
WALK = f"""
with recursive {COLLIDING},
numbered as (
  select pos, row_number() over (order by pos) as n,
    dense_rank() over (order by url) as u, dense_rank() over (order by title) as t
  from colliding),
walk as (
  select cast(0 as bigint) as n, cast([] as bigint[]) as urls, cast([] as bigint[]) as titles,
    cast(null as bigint) as kept
  union all
  select numbered.n,
    case when list_contains(urls, u) or list_contains(titles, t) then urls else list_append(urls, u) end,
    case when list_contains(urls, u) or list_contains(titles, t) then titles else list_append(titles, t) end,
    case when list_contains(urls, u) or list_contains(titles, t) then null else pos end
  from walk join numbered on numbered.n = walk.n + 1)
"""


@query("dedupe_greedy", WALK + """
select pos, url, title from colliding where pos in (select kept from walk where kept is not null)""")
def dedupe_greedy(spark, sf_dir):
    rows = colliding_articles(spark, sf_dir).select("pos", "url", "title")
    return dedupe.dedupe_greedy(rows, ["url", "title"], "pos")


@query("duplicate_count", WALK + """
select (select count(*) from colliding) - (select count(kept) from walk) as n_duplicates""")
def duplicate_count(spark, sf_dir):
    return dedupe.duplicate_count(colliding_articles(spark, sf_dir), ["url", "title"], "pos")


@query("article_category", f"with {CLEAN} select pos, url, category from articles")
def article_category(spark, sf_dir):
    return art.with_category(raw_articles(spark, sf_dir), SITE_PREFIX).select("pos", "url", "category")


@query("flatten_text", "select doc_id as pos, text, len(string_split(text, chr(10))) as n_paragraphs from documents")
def flatten_text(spark, sf_dir):
    lists = raw_articles(spark, sf_dir).select("pos", F.split("text", "\n").alias("text"))
    counted = lists.withColumn("n_paragraphs", F.size("text").cast("bigint"))
    return art.flatten_text(counted)


@query("normalise_time", f"with {CLEAN} select pos, time from articles")
def normalise_time(spark, sf_dir):
    return art.normalise_time(raw_articles(spark, sf_dir), DEFAULT_NOW).select("pos", "time")


@query("replicate_rows", """
select doc_id as pos, text, copy from documents,
  range(1, cast(ceil(5000.0 / (select count(*) from documents)) as bigint) + 1) as r(copy)""")
def replicate_rows(spark, sf_dir):
    return art.replicate(raw_articles(spark, sf_dir).select("pos", "text"), 5000)


@query("append_articles", WALK + "select url, count(*) as n from colliding "
       "where pos in (select kept from walk where kept is not null) group by url")
def append_articles(spark, sf_dir):
    rows = colliding_articles(spark, sf_dir).select("pos", "url", "title")
    store = new_folder(spark, "store")
    art.append_articles(rows, store, "pos")
    art.append_articles(rows, store, "pos")  # nothing is new the second time
    return spark.read.parquet(store).groupBy("url").agg(F.count(F.lit(1)).alias("n"))


@query("count_rows", "select count(*) as n from documents")
def count_rows(spark, sf_dir):
    return agg.count_rows(articles(spark, sf_dir))


@query("count_over_threshold", f"with {CLEAN} select count(*) as n from articles where comment_count > 100")
def count_over_threshold(spark, sf_dir):
    return agg.count_over_threshold(articles(spark, sf_dir), "comment_count", 100)


@query("avg_photos", f"with {CLEAN} select avg(photo_count) as avg_photos from articles")
def avg_photos(spark, sf_dir):
    return agg.mean(articles(spark, sf_dir), "photo_count", "avg_photos")


@query("total_comments", f"with {CLEAN} select cast(sum(comment_count) as bigint) as total_comments from articles")
def total_comments(spark, sf_dir):
    return agg.total(articles(spark, sf_dir), "comment_count", "total_comments")


@query("oldest_article", f"""with {CLEAN}
select pos, title, time from articles order by cast(time as timestamptz), pos limit 1""")
def oldest_article(spark, sf_dir):
    return arg_extreme(articles(spark, sf_dir), instant("time"), "min", "pos").select("pos", "title", "time")


@query("most_commented", f"""with {CLEAN}
select pos, title, comment_count from articles order by comment_count desc, pos limit 1""")
def most_commented(spark, sf_dir):
    return arg_extreme(articles(spark, sf_dir), "comment_count", "max", "pos").select(
        "pos", "title", "comment_count")


@query("most_photos", f"""with {CLEAN}
select pos, title, photo_count from articles order by photo_count desc, pos limit 1""")
def most_photos(spark, sf_dir):
    return arg_extreme(articles(spark, sf_dir), "photo_count", "max", "pos").select(
        "pos", "title", "photo_count")


@query("articles_by_year", f"with {RAW} select substr(time, 1, 4) as year, count(*) as n from raw_articles group by 1")
def articles_by_year(spark, sf_dir):
    return agg.count_by_time_part(raw_articles(spark, sf_dir), "year", keep_null=True)


@query("articles_by_day", f"""with {RAW} select substr(time, 1, 10) as day, count(*) as n from raw_articles
where time is not null group by 1 order by 1""")
def articles_by_day(spark, sf_dir):
    return agg.count_by_time_part(raw_articles(spark, sf_dir), "day")


@query("articles_by_weekday", f"""with {CLEAN}
select cast(isodow(cast(substr(time, 1, 10) as date)) - 1 as int) as weekday, count(*) as n
from articles group by 1 order by 1""")
def articles_by_weekday(spark, sf_dir):
    return agg.count_by_time_part(articles(spark, sf_dir), "weekday")


@query("extreme_months", f"""with {RAW},
months as (select substr(time, 6, 2) as month, count(*) as n, min(pos) as first from raw_articles group by 1)
select (select month from months order by n desc, first limit 1) as most, max(n) as most_n,
  (select month from months order by n, first limit 1) as least, min(n) as least_n from months""")
def extreme_months(spark, sf_dir):
    return agg.extreme_months(raw_articles(spark, sf_dir))


@query("articles_by_category", f"""with {CLEAN}
select category, count(*) as n from articles where category is not null group by 1""")
def articles_by_category(spark, sf_dir):
    return agg.value_counts(articles(spark, sf_dir), "category", "category", keep_null=False)


@query("category_share", f"""with {CLEAN}
select category, count(*) as n, count(*) / (select count(*) from articles) as share from articles group by 1""")
def category_share(spark, sf_dir):
    return agg.category_share(articles(spark, sf_dir), "category", "category")


@query("category_groups", f"""with {CLEAN}
select (select count(*) from (select distinct category from articles)) as n_groups,
  count(distinct category) as n_categories from articles""")
def category_groups(spark, sf_dir):
    rows = articles(spark, sf_dir)
    with_null = agg.group_count(rows, "category")
    return agg.group_count(rows, "category", count_null=False, name="n_categories").select(
        with_null.scalar().alias("n_groups"), "n_categories")


@query("category_counts_in_year", f"""with {CLEAN}
select category, count(*) as n from articles where starts_with(time, '2020') group by 1 order by n desc, 1""")
def category_counts_in_year(spark, sf_dir):
    return agg.category_counts_in_year(articles(spark, sf_dir), "2020")


@query("comments_by_length", f"""with {CLEAN}
select length(text) as text_length, cast(sum(comment_count) as bigint) as comments from articles group by 1""")
def comments_by_length(spark, sf_dir):
    measured = articles(spark, sf_dir).select(F.length("text").cast("bigint").alias("len"), "comment_count")
    return agg.sum_by_key(measured, "len", "comment_count", "comments", key_name="text_length")


@query("keyword_timeline", f"""with {CLEAN}
select keyword, substr(time, 1, 10) as day, count(*) as n
from articles, (values ('the'), ('de')) as k(keyword) where contains(title, keyword) group by 1, 2""")
def keyword_timeline(spark, sf_dir):
    return agg.keyword_timeline(articles(spark, sf_dir), ["the", "de"])


@query("text_predicates", f"""with {CLEAN}
select pos, contains(title, 'the') as holds, text like '% a %' as fits, starts_with(time, '2020') as opens,
  regexp_matches(title, '^[A-Z][a-z]+ ') as matches
from articles""")
def text_predicates(spark, sf_dir):
    title, text, time = F.col("title"), F.col("text"), F.col("time")
    return articles(spark, sf_dir).select(
        "pos", title.contains("the").alias("holds"), text.like("% a %").alias("fits"),
        time.startswith("2020").alias("opens"), title.rlike("^[A-Z][a-z]+ ").alias("matches"))


@query("text_filter", f"""with {CLEAN}
select pos, title from articles where contains(title, 'the') and title like '% of%'
  and regexp_matches(title, '^[A-Z][a-z]+ ')""")
def text_filter(spark, sf_dir):
    return shape.text_filter(articles(spark, sf_dir), "title", contains="the", like="% of%",
                             regex="^[A-Z][a-z]+ ").select("pos", "title")


@query("sample_n", f"""with {CLEAN}
select pos, url from articles
order by ('0x' || substr(md5('7:' || url), 1, 8))::bigint, url limit 5""")
def sample_n(spark, sf_dir):
    return shape.sample_n(articles(spark, sf_dir), 5, seed=7, keys=["url"]).select("pos", "url")


@query("top_k", f"""with {CLEAN}
select pos, title, comment_count from articles order by comment_count desc, pos limit 10""")
def top_commented(spark, sf_dir):
    return top_k(articles(spark, sf_dir), "comment_count", 10, ["pos"]).select("pos", "title", "comment_count")


@query("scalar_text", f"""with {CLEAN}
select pos, lower(title) as lowered, trim(title) as trimmed, replace(title, 'the', '_') as replaced,
  split_part(title, ' ', 1) as first_word, substr(title, 1, 5) as head, length(text) as n_chars,
  regexp_replace(title, '[aeiou]+', '-', 'g') as devowelled,
  regexp_replace(title, '[^\\x00-\\x7F]', '', 'g') as plain,
  len(string_split(title, ' ')) as n_parts,
  cast((length(text) - length(replace(text, 'an', ''))) / 2 as int) as hits,
  round(length(text) / 7.0, 2) as rounded
from articles""")
def scalar_text(spark, sf_dir):
    title = F.col("title")
    return articles(spark, sf_dir).select(
        "pos", F.lower(title).alias("lowered"), F.trim(title).alias("trimmed"),
        F.replace(title, F.lit("the"), F.lit("_")).alias("replaced"),
        F.split(title, " ").getItem(0).alias("first_word"), F.substring(title, 1, 5).alias("head"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.regexp_replace(title, "[aeiou]+", "-").alias("devowelled"), ascii_only(title).alias("plain"),
        F.size(F.split(title, " ")).cast("bigint").alias("n_parts"),
        occurrences("text", "an").alias("hits"),
        F.round(F.length("text") / F.lit(7.0), 2).alias("rounded"))


@query("scalar_time", f"""with {CLEAN}
select pos, cast(epoch(cast(time as timestamptz)) as bigint) as instant, substr(time, 1, 4) as year,
  substr(time, 6, 2) as month, cast(substr(time, 1, 10) as date) as local_day,
  cast(isodow(cast(substr(time, 1, 10) as date)) - 1 as int) as weekday
from articles""")
def scalar_time(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "pos", F.unix_timestamp(instant("time")).alias("instant"), year_text("time").alias("year"),
        month_text("time").alias("month"), local_date("time").alias("local_day"),
        weekday_number("time").alias("weekday"))

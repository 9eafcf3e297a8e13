"""The driver tables, and the views of them that stand for articles, pages, ratings and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.skew import lookup
from skein.operators.articles import normalise_time, with_category
from skein.session import spread

SITE_PREFIX = "https://site.example/"
DEFAULT_NOW = "2024-01-01T00:00:00+00:00"

# One article per document; the same text runs in Spark and in the SQL check. Half past midnight
# makes the day in UTC differ from the day in the writer's offset.
ARTICLE_SELECT = """
select doc_id as pos,
  case when doc_id % 17 = 0 then 'https://other.example/' else 'https://site.example/' end
    || source || '/' || cast(doc_id as varchar(20)) as url,
  split_part(text, chr(10), 1) as title, text,
  cast(doc_id * 31 % 17 as int) as photo_count,
  cast(doc_id * 7919 % 250 as int) as comment_count,
  case when doc_id % 97 = 0 then null else
    cast(date '2019-01-01' + cast(doc_id * 7919 % 1460 as int) as varchar(10)) || 'T00:30:00' ||
    case when doc_id % 13 = 0 then '' when doc_id % 5 = 0 then '+02:00' else '+01:00' end
  end as time
from {documents}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as collected: time may be missing or lack its offset."""
    return spark.sql(ARTICLE_SELECT, documents=table(spark, sf_dir, "documents"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean articles: with category, and with an offset in every time."""
    return normalise_time(with_category(raw_articles(spark, sf_dir), SITE_PREFIX), DEFAULT_NOW)


def colliding_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles whose urls and titles both repeat."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"),
        F.concat_ws("/", "source", (F.col("doc_id") % 300).cast("string")).alias("url"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        "text",
    )


RATING_ORDER = ["l_orderkey", "l_linenumber", "item", "user"]


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("user"), F.col("l_partkey").alias("item"),
        (1 + F.col("l_linenumber") % 5).alias("rating"), F.col("l_shipdate").alias("rated"),
        "l_orderkey", "l_linenumber", "l_extendedprice")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


# Node ids: suppliers, parts and customers share one id space.
def person_id(supplier: str) -> F.Column:
    return F.col(supplier) * 3


def movie_id(part: str) -> F.Column:
    return F.col(part) * 3 + 1


def viewer_id(customer: str) -> F.Column:
    return F.col(customer) * 3 + 2


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons (suppliers and customers) and movies (parts)."""
    born = F.lit(1940)
    people = table(spark, sf_dir, "supplier").select(
        person_id("s_suppkey").alias("id"), F.array(F.lit("Person")).alias("labels"),
        F.col("s_name").alias("name"), (born + 2 * F.col("s_nationkey")).alias("birth_year"))
    movies = table(spark, sf_dir, "part").select(
        movie_id("p_partkey").alias("id"), F.array(F.lit("Movie")).alias("labels"),
        F.col("p_name").alias("name"), F.lit(None).cast("int").alias("birth_year"))
    viewers = table(spark, sf_dir, "customer").select(
        viewer_id("c_custkey").alias("id"), F.array(F.lit("Person")).alias("labels"),
        F.col("c_name").alias("name"), (born + 2 * F.col("c_nationkey")).alias("birth_year"))
    return people.unionAll(movies).unionAll(viewers)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTED_IN from supplier to part with earnings; CONTACT from customer to supplier."""
    lines = table(spark, sf_dir, "lineitem")
    acted = lines.select(
        person_id("l_suppkey").alias("src"), movie_id("l_partkey").alias("dst"),
        F.lit("ACTED_IN").alias("type"), F.col("l_extendedprice").alias("earnings"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    contact = lookup(lines.select("l_orderkey", "l_suppkey", "l_linenumber"), orders, "l_orderkey").select(
        viewer_id("o_custkey").alias("src"), person_id("l_suppkey").alias("dst"),
        F.lit("CONTACT").alias("type"), F.lit(None).cast("double").alias("earnings"))
    return acted.unionAll(contact)


def prized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges, and ones of the same types between nodes of other labels."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    nothing = F.lit(None).cast("double").alias("earnings")
    prizes = lookup(lines.select("l_orderkey", "l_suppkey", "l_extendedprice"), orders, "l_orderkey").select(
        person_id("l_suppkey").alias("src"), viewer_id("o_custkey").alias("dst"), F.lit("ACTED_IN").alias("type"),
        (F.col("l_extendedprice") * 2).alias("earnings"))
    talks = lines.select(movie_id("l_partkey").alias("src"), person_id("l_suppkey").alias("dst"),
                         F.lit("CONTACT").alias("type"), nothing)
    loops = lines.select(movie_id("l_partkey").alias("src"), movie_id("l_partkey").alias("dst"),
                         F.lit("ACTED_IN").alias("type"), (F.col("l_extendedprice") * 100).alias("earnings"))
    return edges(spark, sf_dir).unionAll(prizes).unionAll(talks).unionAll(loops)


def adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order without neighbours, and one per lineitem with its part as neighbour."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"))
    lines = spread(table(spark, sf_dir, "lineitem")).select(
        F.concat_ws(" ", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")).alias("value"))
    return orders.unionAll(lines)


def order_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("Order "), F.col("o_orderkey")).alias("name"))

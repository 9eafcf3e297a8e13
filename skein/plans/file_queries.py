"""Queries that write tables as files in the shapes of the inputs, and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import articles as art
from skein.operators import words as w
from skein.operators.aggregates import counts_by, value_counts
from skein.plans.registry import query
from skein.plans.sql import CLEAN
from skein.plans.tables import DEFAULT_NOW, SITE_PREFIX, articles, ratings, raw_articles, table
from skein.session import new_folder
from skein.sources import files, json_pieces, store
from skein.streaming import sinks

ARTICLE_JSON = ("pos bigint, url string, title string, text string, photo_count int, comment_count int, "
                "time string, category string")


@query("read_delimited", "select p_partkey as id, p_name as name from part")
def read_delimited(spark, sf_dir):
    folder = new_folder(spark, "delimited")
    sinks.write_csv(table(spark, sf_dir, "part").select("p_partkey", "p_name"), folder, "|")
    return files.read_delimited(spark, folder, "id bigint, name string", "|")


@query("read_csv_inferred", "select c_custkey::int as c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def read_csv_inferred(spark, sf_dir):
    folder = new_folder(spark, "csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(folder)
    return files.read_csv(spark, folder)


@query("read_csv_named", "select o_custkey::int as customer_id, o_orderkey::int as order_id, o_totalprice as amount "
       "from orders")
def read_csv_named(spark, sf_dir):
    folder = new_folder(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), folder, ",")
    return files.read_csv(spark, folder, header=False, names=["customer_id", "order_id", "amount"])


@query("read_lines", "select line, count(*) as n from (select unnest(string_split(text, chr(10))) as line "
       "from documents) group by 1")
def read_lines(spark, sf_dir):
    folder = new_folder(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(folder)
    return value_counts(files.read_lines(spark, folder), "value", "line", order=None)


@query("parse_lines", "select l_suppkey as user, l_partkey as item, 1 + l_linenumber % 5 as rating, "
       "count(*) as n, count(*) * 0 as n_bad from lineitem group by 1, 2, 3")
def parse_lines(spark, sf_dir):
    folder = new_folder(spark, "lines")
    rows = ratings(spark, sf_dir).select(F.concat_ws("\t", "user", "item", "rating", "rated"))
    rows.write.text(folder)
    parsed = files.parse_lines(files.read_lines(spark, folder), r"\t", {
        "user": (0, "bigint"), "item": (1, "bigint"), "rating": (2, "int"), "bad": (3, "int")})
    return parsed.groupBy("user", "item", "rating").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("n_bad"))


@query("json_store", f"with {CLEAN} select * from articles")
def json_store(spark, sf_dir):
    folder = new_folder(spark, "json")
    sinks.write_json(articles(spark, sf_dir), folder)
    return files.read_json_lines(spark, folder, ARTICLE_JSON)


@query("export_text", "select line, count(*) * cast(ceil(3000.0 / (select count(*) from documents)) as bigint) as n "
       "from (select unnest(string_split(text, chr(10))) as line from documents) group by 1")
def export_text(spark, sf_dir):
    folder = new_folder(spark, "export")
    art.export_text(table(spark, sf_dir, "documents"), folder, at_least=3000)
    return value_counts(files.read_lines(spark, folder), "value", "line", order=None)


@query("text_sink", """
select '(' || o_orderpriority || ',' || count(*) || ')' as value from orders group by o_orderpriority""")
def text_sink(spark, sf_dir):
    folder = new_folder(spark, "text")
    sinks.write_text(counts_by(table(spark, sf_dir, "orders"), ["o_orderpriority"]), folder)
    return files.read_lines(spark, folder)


@query("text_sink_nulls", """
select '(' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'null') || ',' || c_custkey || ',' ||
  case when c_acctbal < 0 then 'null' else c_nationkey::varchar end || ')' as value, true as suffixed from customer""")
def text_sink_nulls(spark, sf_dir):
    folder = new_folder(spark, "text")
    rows = table(spark, sf_dir, "customer").select(
        F.nullif("c_mktsegment", F.lit("BUILDING")), "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")))
    sinks.write_text(rows, folder, "log")
    return files.read_lines(spark, folder).select("value", F.endswith(F.input_file_name(), F.lit(".log")).alias("suffixed"))


def rolled_lines(spark, folder: str, name: str, max_rows: int, max_bytes: int):
    """Lines of rolled files, with whether their file's name fits and whether it keeps both bounds."""
    lines = files.read_lines(spark, folder).withColumn("file", F.input_file_name())
    sizes = lines.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("value") + 1).alias("bytes"))
    return lines.join(sizes, "file").select(
        "value", F.element_at(F.split("file", "/"), -1).rlike(f"^{name}$").alias("named"),
        ((F.col("rows") <= max_rows) & (F.col("bytes") <= max_bytes)).alias("bounded"))


@query("rolled_text", "select '(' || c_custkey || ',' || c_name || ')' as value, true as named, true as bounded from customer")
def rolled_text(spark, sf_dir):
    folder = new_folder(spark, "rolled")
    sinks.write_rolled(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), folder, "customer", ".txt",
                       max_rows=500, max_bytes=8_000)
    return rolled_lines(spark, folder, r"customer-0-\d+-\d+\.txt", 500, 8_000)


@query("rewrite_store", f"with {CLEAN} select pos, url, title, text, photo_count, comment_count, time, category from articles")
def rewrite_store(spark, sf_dir):
    """The store of articles as collected is read, cleaned and rewritten where it lies."""
    folder = new_folder(spark, "store")
    raw = raw_articles(spark, sf_dir)
    store.rewrite_store(raw, folder)
    stored = store.read_store(spark, folder, raw.schema)
    clean = art.normalise_time(art.with_category(stored, SITE_PREFIX), DEFAULT_NOW)
    store.rewrite_store(clean, folder)
    return store.read_store(spark, folder, clean.schema)


ARRAY_JSON = "pos bigint, title string, n_chars bigint"


def json_arrays(spark, sf_dir, per_file: int) -> str:
    """Files of one JSON array of objects each, with at most ``per_file`` articles; their number grows with the table."""
    folder = new_folder(spark, "json")
    rows = articles(spark, sf_dir).join(
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "n_chars"), "pos")
    piece = F.floor(F.col("pos") / per_file)
    rows.groupBy(piece.alias("piece")).agg(F.to_json(F.collect_list(F.struct("pos", "title", "n_chars"))).alias("value")).write.partitionBy(
        "piece").text(folder)
    return folder


@query("read_json_array", f"with {CLEAN} select pos, title, n_chars from articles join documents on pos = doc_id")
def read_json_array(spark, sf_dir):
    return files.read_json_array(spark, json_arrays(spark, sf_dir, 10_000), ARRAY_JSON).drop("piece")


@query("read_json_array_split", f"with {CLEAN} select pos, title, n_chars from articles join documents on pos = doc_id")
def read_json_array_split(spark, sf_dir):
    """The same rows, each file read by as many tasks as it has byte ranges."""
    return json_pieces.read_json_array_split(spark, json_arrays(spark, sf_dir, 100_000), ARRAY_JSON)


@query("lines_first_letters", """
select letter, count(*) as n from (
  select substr(word, 1, 1) as letter from (
    select unnest(string_split(lower(event_type), ' ')) as word from events)) group by 1""")
def lines_first_letters(spark, sf_dir):
    folder = new_folder(spark, "lines")
    table(spark, sf_dir, "events").select("event_type").write.text(folder)
    return w.first_letter_count(files.lines_or_default(spark, folder), "value")

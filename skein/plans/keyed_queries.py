"""Queries over orders, ratings, measurements and other keyed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions.skew import lookup
from skein.operators import aggregates as agg
from skein.operators import joins, shape, splits
from skein.operators.order import advanced_since_previous, first_ranks, with_row_index
from skein.plans.registry import query
from skein.plans.tables import RATING_ORDER, items, ratings, table
from skein.sources.files import union_all

RATINGS = """ratings as (
  select l_suppkey as user, l_partkey as item, 1 + l_linenumber % 5 as rating, l_shipdate as rated,
    l_orderkey, l_linenumber, l_extendedprice from lineitem)"""


@query("spent_by_customer", """
select o_custkey as customer_id, round(sum(o_totalprice), 2) as total_spent
from orders group by 1 order by 1""")
def spent_by_customer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return agg.sum_by_key(orders, "o_custkey", "o_totalprice", "total_spent", "customer_id", round_to=2)


@query("spent_by_customer_rounded", """
select o_custkey as customer_id, round(sum(o_totalprice), 2) as total_spent
from orders group by 1 order by 2, 1""")
def spent_by_customer_rounded(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return agg.sum_by_key(orders, "o_custkey", "o_totalprice", "total_spent", "customer_id", round_to=2,
                          order="total")


@query("top_spenders", """
select o_custkey as customer_id, round(sum(o_totalprice), 2) as total_spent
from orders group by 1 order by 2 desc, 1""")
def top_spenders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return agg.sum_by_key(orders, "o_custkey", "o_totalprice", "total_spent", "customer_id", round_to=2,
                          order="total_desc")


@query("group_count", "select count(distinct o_custkey) as n_groups from orders")
def group_count(spark, sf_dir):
    return agg.group_count(table(spark, sf_dir, "orders"), "o_custkey")


@query("value_counts", f"with {RATINGS} select rating, count(*) as n from ratings group by 1 order by 1")
def value_counts(spark, sf_dir):
    return agg.value_counts(ratings(spark, sf_dir), "rating", "rating")


@query("avg_by_key", """
select c_nationkey, round(avg(c_acctbal), 6) as average from customer group by 1 order by 1""")
def avg_by_key(spark, sf_dir):
    return agg.avg_by_key(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", round_to=6)


FAHRENHEIT = "value * 0.1 * (9.0 / 5.0) + 32.0"


@query("max_by_key", f"""
select user_id, round(max(({FAHRENHEIT} - 32.0) * 5.0 / 9.0), 6) as extreme from events
where contains(event_type, 'view') group by 1""")
def max_by_key(spark, sf_dir):
    rows = shape.text_filter(table(spark, sf_dir, "events"), "event_type", contains="view")
    return agg.extreme_by_key(rows, "user_id", shape.to_celsius(shape.to_fahrenheit("value")), "max").select(
        "user_id", F.round("extreme", 6).alias("extreme"))


@query("min_by_key", f"""
select user_id, round(min(({FAHRENHEIT} - 32.0) * 5.0 / 9.0), 6) as extreme from events
where contains(event_type, 'view') group by 1""")
def min_by_key(spark, sf_dir):
    rows = shape.text_filter(table(spark, sf_dir, "events"), "event_type", contains="view")
    return agg.extreme_by_key(rows, "user_id", shape.to_celsius(shape.to_fahrenheit("value")), "min").select(
        "user_id", F.round("extreme", 6).alias("extreme"))


@query("unit_convert", f"""
select event_id, round({FAHRENHEIT}, 6) as fahrenheit, round(({FAHRENHEIT} - 32.0) * 5.0 / 9.0, 6) as celsius
from events""")
def unit_convert(spark, sf_dir):
    fahrenheit = shape.to_fahrenheit("value")
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(fahrenheit, 6).alias("fahrenheit"),
        F.round(shape.to_celsius(fahrenheit), 6).alias("celsius"))


@query("counts_by_two_keys", f"with {RATINGS} select item, rating, count(*) as n from ratings group by 1, 2")
def counts_by_two_keys(spark, sf_dir):
    return agg.counts_by(ratings(spark, sf_dir), ["item", "rating"])


SHARES = f"""{RATINGS}, shares as (
  select item, count(*) filter (rating = 5) as top_count, count(rating) as n_ratings,
    count(*) filter (rating = 5) / count(rating) as top_share from ratings group by 1)"""


@query("top_rating_share", f"with {SHARES} select * from shares")
def top_rating_share(spark, sf_dir):
    return agg.top_rating_share(ratings(spark, sf_dir))


@query("hyped_items", f"""with {SHARES}
select item, p_name as name, top_count, top_share from shares join part on item = p_partkey
where top_count > 0 order by top_count desc, top_share desc, item limit 10""")
def hyped_items(spark, sf_dir):
    return joins.hyped_items(ratings(spark, sf_dir), items(spark, sf_dir))


@query("hyped_items_all", f"""with {SHARES}
select item, p_name as name, top_count, top_share from shares join part on item = p_partkey
where top_count > 0""")
def hyped_items_all(spark, sf_dir):
    return joins.hyped_items(ratings(spark, sf_dir), items(spark, sf_dir), k=None)


@query("join_names", f"""with {RATINGS}
select l_orderkey, l_linenumber, user, item, rating, p_name as name from ratings join part on item = p_partkey""")
def join_names(spark, sf_dir):
    names = items(spark, sf_dir).withColumnRenamed("id", "item")
    rows = ratings(spark, sf_dir).select("l_orderkey", "l_linenumber", "user", "item", "rating")
    return joins.join_names(rows, names, "item")


@query("most_popular_name", f"""with {RATINGS}
select item, count(*) as n, any_value(p_name) as name from ratings join part on item = p_partkey
group by 1 order by n desc, item limit 1""")
def most_popular_name(spark, sf_dir):
    counted = agg.value_counts(ratings(spark, sf_dir), "item", "item", order=None)
    return joins.name_of_top(counted, items(spark, sf_dir).withColumnRenamed("id", "item"), "n", "item")


@query("union_years", """
select extract(year from day) as year, count(*) as n, round(sum(amount), 2) as amount from (
  select o_orderdate as day, o_totalprice as amount from orders
  union all select l_shipdate, l_extendedprice from lineitem)
group by 1""")
def union_years(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice").toDF("day", "amount")
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_extendedprice")
    return union_all([orders, lines]).groupBy(F.year("day").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


@query("union_by_name", """
select place, count(*) as n, round(sum(balance), 2) as balance from (
  select c_nationkey as place, c_acctbal as balance from customer
  union all select s_nationkey, s_acctbal from supplier)
group by 1""")
def union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("place"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("place"), F.col("s_acctbal").alias("balance"))
    return union_all([customers, suppliers], by_name=True).groupBy("place").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("balance"), 2).alias("balance"))


@query("project_rename", "select p_partkey as id, p_size as size, p_retailprice as price from part")
def project_rename(spark, sf_dir):
    return shape.project(table(spark, sf_dir, "part"),
                         {"p_partkey": "id", "p_size": "size", "p_retailprice": "price"})


@query("try_cast", """
select event_id, try_cast(substr(props, 7) as int) as bad, try_cast(regexp_extract(props, '[0-9]+') as int) as good
from events""")
def try_cast(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select(
        "event_id", F.expr("substring(props, 7)").alias("bad"), F.regexp_extract("props", "[0-9]+", 0).alias("good"))
    return shape.try_numeric(texts, ["bad", "good"], "int")


@query("binarise", "select l_orderkey, l_linenumber, case when l_quantity > 25 then 1.0::double else 0.0::double end "
       "as big from lineitem")
def binarise(spark, sf_dir):
    return shape.binarise(table(spark, sf_dir, "lineitem"), "l_quantity", 25, name="big").select(
        "l_orderkey", "l_linenumber", "big")


@query("require_not_null", """
select c_custkey, o_orderkey, o_totalprice from customer left join orders on o_custkey = c_custkey
where o_orderkey is not null and o_totalprice is not null""")
def require_not_null(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    without = lookup(customers, orders.select("c_custkey").distinct(), "c_custkey", "left_anti")
    joined = lookup(orders, customers, "c_custkey").unionByName(without, allowMissingColumns=True)
    return shape.require_not_null(joined, ["o_orderkey", "o_totalprice"]).select(
        "c_custkey", "o_orderkey", "o_totalprice")


@query("date_advances", """
select event_id, user_id, event_date, previous_date from (
  select event_id, user_id, cast(ts as date) as event_date,
    lag(cast(ts as date)) over (partition by user_id order by event_id) as previous_date from events)
where previous_date < event_date""")
def date_advances(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return advanced_since_previous(events, "ts", ["event_id"], "user_id").drop("ts")


@query("date_advances_overall", """
select event_id, event_date, previous_date from (
  select event_id, cast(ts as date) as event_date,
    lag(cast(ts as date)) over (order by event_id) as previous_date from events)
where previous_date < event_date""")
def date_advances_overall(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return advanced_since_previous(events, "ts", ["event_id"]).drop("ts")


ORDERED = "l_orderkey, l_linenumber, item, user"


@query("row_numbers", f"""with {RATINGS}
select user, item, l_orderkey, l_linenumber, row_number() over (order by {ORDERED}) - 1 as row_index
from ratings""")
def row_numbers(spark, sf_dir):
    rows = ratings(spark, sf_dir).select("user", "item", "l_orderkey", "l_linenumber")
    return with_row_index(rows, RATING_ORDER)


@query("contiguous_folds", f"""with {RATINGS}
select user, item, rating, l_orderkey, l_linenumber, cast(ntile(7) over (order by {ORDERED}) as int) as fold
from ratings""")
def contiguous_folds(spark, sf_dir):
    rows = ratings(spark, sf_dir).select("user", "item", "rating", "l_orderkey", "l_linenumber")
    return splits.contiguous_folds(rows, 7, RATING_ORDER)


@query("fold_pair", f"""with {RATINGS}, folds as (
  select user, item, rating, ntile(5) over (order by {ORDERED}) as fold from ratings)
select fold = 2 as is_test, user, item, rating, count(*) as n from folds group by all""")
def fold_pair(spark, sf_dir):
    rows = ratings(spark, sf_dir).select("user", "item", "rating", "l_orderkey", "l_linenumber")
    test, train = splits.fold_pair(splits.contiguous_folds(rows, 5, RATING_ORDER), 2, ["user", "item"])
    both = test.withColumn("is_test", F.lit(True)).unionAll(train.withColumn("is_test", F.lit(False)))
    return agg.counts_by(both, ["is_test", "user", "item", "rating"])


# Rows of the same user are ordered by the rest of the columns.
@query("leave_n_per_user", f"""with {RATINGS}
select user, item, rating, l_orderkey, l_linenumber,
  row_number() over (partition by user order by {ORDERED}) between 11 and 20 as is_test
from ratings""")
def leave_n_per_user(spark, sf_dir):
    rows = ratings(spark, sf_dir).select("user", "item", "rating", "l_orderkey", "l_linenumber")
    return splits.leave_n_per_user(rows, "user", RATING_ORDER, 11, 20)


@query("leave_n_capped", f"""with {RATINGS}, ranked as (
  select *, row_number() over (partition by user order by {ORDERED}) as r from ratings),
tested as (
  select *, case when r between 1 and 10 then
    row_number() over (partition by r between 1 and 10 order by {ORDERED}) end as t from ranked)
select user, item, rating, l_orderkey, l_linenumber, coalesce(t <= 77, false) as is_test from tested""")
def leave_n_capped(spark, sf_dir):
    rows = ratings(spark, sf_dir).select("user", "item", "rating", "l_orderkey", "l_linenumber")
    return splits.leave_n_per_user(rows, "user", RATING_ORDER, 1, 10, max_test=77)


@query("first_ranks", f"""with {RATINGS}
select user, item, l_orderkey, l_linenumber, rank from (
  select *, cast(row_number() over (partition by user order by {ORDERED}) as int) as rank from ratings)
where rank <= 3""")
def ranks(spark, sf_dir):
    rows = ratings(spark, sf_dir).select("user", "item", "l_orderkey", "l_linenumber")
    return first_ranks(rows, "user", RATING_ORDER, 1, 3).withColumn("rank", F.col("_rank").cast("int")).drop("_rank")


@query("random_split", """
select o_orderkey, case when ('0x' || substr(md5('42:' || o_orderkey), 1, 8))::bigint / 4294967296 >= 0.9
  then 1 else 0 end as part from orders""")
def random_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = splits.random_split(orders, [0.9, 0.1], seed=42, keys=["o_orderkey"])
    return train.withColumn("part", F.lit(0)).unionAll(test.withColumn("part", F.lit(1)))


@query("json_extract", """
select event_id, props ->> '$.k' as k_text, try_cast(props ->> '$.k' as int) as k_number,
  props ->> '$.none' as missing from events""")
def json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", F.get_json_object("props", "$.k").alias("k_text"),
        F.from_json("props", "k int")["k"].alias("k_number"),
        F.get_json_object("props", "$.none").alias("missing"))

"""Queries that prepare features, train and measure models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skein.functions.skew import lookup
from skein.operators import learn, splits
from skein.plans.registry import query
from skein.plans.tables import table
from skein.session import cut, spread

ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

DELAYS = learn.DelaySpec(
    delay="days", plain=["year", "month", "day", "weekday"], numeric=["price", "quantity"],
    categories=["l_returnflag", "l_linestatus", "o_orderpriority"], threshold=0)


def deliveries(spark, sf_dir):
    """Order lines with the days between order and shipping; pending orders count as cancelled."""
    lines = spread(table(spark, sf_dir, "lineitem")).select(
        *ROW, "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority", "o_orderstatus")
    return lookup(lines, orders, "l_orderkey").select(
        *ROW, F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"), F.weekday("o_orderdate").alias("weekday"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_quantity").cast("string").alias("quantity"),
        "l_returnflag", "l_linestatus", "o_orderpriority",
        F.date_diff("l_shipdate", "o_orderdate").cast("string").alias("days"),
        (F.col("o_orderstatus") == "P").cast("int").alias("cancelled"))


def delay_features(spark, sf_dir):
    spec = replace(DELAYS, keep=F.col("cancelled") == 0)
    return learn.prepare_delay_features([deliveries(spark, sf_dir)], spec, ROW)


def ranks(column: str) -> str:
    return (f"select {column} as value, cast(row_number() over (order by count(*) desc, {column}) - 1 as int) as at "
            f"from kept group by 1")


@query("delay_features", f"""
with kept as (
  select * from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus <> 'P'),
flags as ({ranks('l_returnflag')}), states as ({ranks('l_linestatus')}), urgency as ({ranks('o_orderpriority')})
select {', '.join(ROW)}, cast(extract(year from o_orderdate) as int) as year,
  cast(extract(month from o_orderdate) as int) as month, cast(extract(day from o_orderdate) as int) as day,
  cast(isodow(o_orderdate) - 1 as int) as weekday, cast(trunc(l_extendedprice) as int) as price,
  cast(trunc(l_quantity) as int) as quantity,
  case when date_diff('day', o_orderdate, l_shipdate) > 0 then 1.0::double else 0.0::double end as days,
  flags.at as "l_returnflagIndex", states.at as "l_linestatusIndex", urgency.at as "o_orderpriorityIndex"
from kept join flags on l_returnflag = flags.value join states on l_linestatus = states.value
  join urgency on o_orderpriority = urgency.value""")
def delay_rows(spark, sf_dir):
    rows = delay_features(spark, sf_dir)
    return rows.withColumns({c: F.col(c).cast("int") for c in ("price", "quantity")})


@query("string_index", """
with counted as (
  select 'p_brand' as "column", p_brand as value, count(*) as n from part group by 2
  union all select 'p_type', p_type, count(*) from part group by 2)
select "column", value, cast(row_number() over (partition by "column" order by n desc, value) - 1 as int) as "index"
from counted""")
def string_index(spark, sf_dir):
    return learn.fit_categories(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query("assemble", "select p_partkey, p_size::double as size, p_retailprice as price from part")
def assemble(spark, sf_dir):
    rows = learn.assemble(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"),
                          ["p_size", "p_retailprice"])
    numbers = vector_to_array("features")
    return rows.select("p_partkey", numbers[0].alias("size"), numbers[1].alias("price"))


@query("accuracy", """
select avg(case when (l_quantity > 25) = (l_extendedprice > 50000) then 1 else 0 end) as accuracy from lineitem""")
def accuracy(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
        (F.col("l_extendedprice") > 50000).cast("double").alias("label"))
    return learn.accuracy(rows)


def delay_predictions(spark, sf_dir, algo: str, **params):
    rows = learn.assemble(cut(delay_features(spark, sf_dir)), DELAYS.features, "skip")
    train, test = splits.random_split(rows, [0.9, 0.1], seed=42, keys=ROW)
    model = learn.train_classifier(train, algo, DELAYS.delay, **params)
    return model.transform(test).select(*ROW, DELAYS.delay, "prediction")


@query("delay_rf")
def delay_rf(spark, sf_dir):
    return delay_predictions(spark, sf_dir, "rf")


@query("delay_lr")
def delay_lr(spark, sf_dir):
    return delay_predictions(spark, sf_dir, "lr")


@query("delay_accuracy")
def delay_accuracy(spark, sf_dir):
    return learn.accuracy(delay_predictions(spark, sf_dir, "rf"), DELAYS.delay)


# The forest must beat the larger class; the share of that class is also given, so the row can be checked by SQL.
@query("delay_beats_majority", """
with kept as (
  select l_orderkey, case when date_diff('day', o_orderdate, l_shipdate) > 0 then 1 else 0 end as late
  from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus <> 'P')
select round(greatest(avg(late), 1 - avg(late)), 9) as majority, true as at_least from kept""")
def delay_beats_majority(spark, sf_dir):
    rows = cut(delay_features(spark, sf_dir).select(*ROW, *DELAYS.features, DELAYS.delay))
    train, test = splits.random_split(learn.assemble(rows, DELAYS.features, "skip"), [0.9, 0.1], seed=42, keys=ROW)
    predicted = learn.train_classifier(train, "rf", DELAYS.delay).transform(test)
    late = F.avg(F.col(DELAYS.delay))
    found = learn.accuracy(predicted, DELAYS.delay).crossJoin(predicted.agg(late.alias("test_late")))
    share = F.greatest("late", 1 - F.col("late"))
    return rows.agg(late.alias("late")).crossJoin(found).select(
        F.round(share, 9).alias("majority"),
        (F.col("accuracy") >= F.greatest("test_late", 1 - F.col("test_late"))).alias("at_least"))


@query("price_tree")
def price_tree(spark, sf_dir):
    parts = learn.index_categories(table(spark, sf_dir, "part"), ["p_brand", "p_type"])
    rows = learn.assemble(parts, ["p_size", "p_brandIndex", "p_typeIndex"])
    train, test = splits.random_split(rows, [0.9, 0.1], seed=42, keys=["p_partkey"])
    model = learn.train_regressor(train, "p_retailprice")
    return model.transform(test).select("p_partkey", "p_retailprice", "prediction")

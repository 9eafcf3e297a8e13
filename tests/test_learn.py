from pyspark.sql import Observation
from pyspark.sql import functions as F

from skein import session
from skein.operators import learn, shape, splits
from skein.operators.aggregates import (category_share, count_by_time_part, extreme_months, group_count,
                                        value_counts)


def delays(spark):
    rows = [(2008, i, "AB"[i % 2], str(i % 7), "NA" if i % 9 == 0 else str(60 if i % 2 else -5), int(i % 20 == 0))
            for i in range(400)]
    return spark.createDataFrame(rows, "Year int, id int, Carrier string, Distance string, ArrDelay string, Cancelled int")


def test_features_and_classifiers(spark):
    rows = delays(spark)
    spec = learn.DelaySpec(delay="ArrDelay", keep=rows["Cancelled"] == 0, numeric=["Distance"], plain=["Year"], categories=["Carrier"])
    features = learn.prepare_delay_features([rows.filter("id < 100"), rows.filter("id >= 100")], spec, ["id"])
    assert features.columns == ["id", "Year", "Distance", "ArrDelay", "CarrierIndex"]
    kept = [i for i in range(400) if i % 20 and i % 9]
    assert sorted(r.id for r in features.collect()) == kept
    train, test = splits.random_split(learn.assemble(features, spec.features, "skip"), [0.8, 0.2], 42, ["id"])
    for algo in ("rf", "lr"):
        predicted = learn.train_classifier(train, algo, "ArrDelay").transform(test)
        assert learn.accuracy(predicted, "ArrDelay").first().accuracy == 1.0


def test_models_predict_in_a_session_that_observed_a_frame(spark):
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 5}
    rows = learn.assemble(spark.range(40).selectExpr("id % 2 + 0.5 as x", "cast(id % 2 as double) as y"), ["x"])
    for algo in ("rf", "lr"):
        predicted = learn.train_classifier(rows, algo, "y").transform(rows)
        assert learn.accuracy(predicted, "y").first().accuracy == 1.0


class Sizes:
    """Stands for an estimator; returns how many rows each task got."""

    def fit(self, train):
        return train.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()


def test_training_tasks_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(learn, "TRAIN_ROWS", 100, raising=False)
    largest, total = learn._fit(Sizes(), spark.range(5000).coalesce(1))
    assert total == 5000 and largest <= 110


def test_pieces_of_large_files_grow_in_number(spark, monkeypatch, tmp_path):
    folder = f"{tmp_path}/a b"
    spark.range(50_000).coalesce(1).write.parquet(folder)
    monkeypatch.setattr(session, "SPREAD_BYTES", 4_000, raising=False)
    spread = session.spread(spark.read.parquet(folder))
    largest, total = spread.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert total == 50_000 and largest <= 2_000


def test_category_order(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    index = learn.fit_categories(rows, ["v"])
    assert {r.value: r["index"] for r in index.collect()} == {"c": 0, "a": 1, "b": 2}
    indexed = learn.index_categories(rows.union(spark.createDataFrame([("new",)], "v string")), ["v"], index)
    assert sorted((r.v or "", r.vIndex) for r in indexed.filter("vIndex is not null").collect()) == [
        ("a", 1), ("b", 2), ("c", 0), ("c", 0)]
    assert indexed.filter("vIndex is null").count() == 2


def test_regression(spark):
    rows = learn.assemble(spark.range(200).selectExpr("id", "id % 10 as x", "(id % 10) * 3.0 as y"), ["x"])
    predicted = learn.train_regressor(rows, "y", maxDepth=5).transform(rows)
    assert predicted.filter("abs(prediction - y) > 0.001").count() == 0


def test_casts_and_labels(spark):
    rows = spark.createDataFrame([("1",), ("2.9",), ("NA",), ("-3",), (None,)], "v string")
    assert [r.v for r in shape.try_numeric(rows, ["v"], "int").collect()] == [1, 2, None, -3, None]
    assert [r.v for r in shape.try_numeric(rows, ["v"], "bigint").collect()] == [1, 2, None, -3, None]
    numbers = shape.try_numeric(rows, ["v"])
    assert [r.v for r in shape.binarise(numbers, "v").collect()] == [1.0, 1.0, 0.0]
    assert [r.v for r in shape.binarise(numbers, "v", null_label="zero").collect()] == [1.0, 1.0, 0.0, 0.0, 0.0]


def test_null_rules_and_first_seen_months(spark):
    rows = spark.createDataFrame(
        [(0, "2020-03-01T23:30:00+01:00", "x"), (1, "2020-01-05T00:30:00+01:00", None), (2, None, "x"), (3, "", "y")],
        "pos int, time string, category string")
    assert {r.year: r.n for r in count_by_time_part(rows, "year", keep_null=True).collect()} == {"2020": 2, None: 2}
    assert [r.day for r in count_by_time_part(rows, "day").collect()] == ["2020-01-05", "2020-03-01"]
    assert [r.weekday for r in count_by_time_part(rows, "weekday").collect()] == [6]
    assert tuple(extreme_months(rows).first()) == (None, 2, "03", 1)
    assert {r.value: r.n for r in value_counts(rows, "category", keep_null=False).collect()} == {"x": 2, "y": 1}
    assert group_count(rows, "category").first()[0] == 3
    assert sum(r.share for r in category_share(rows, "category").collect()) == 1.0

from pyspark.sql import functions as F

from skein.operators import graph as g
from skein.sources.files import from_lines


def graph(spark):
    nodes = spark.createDataFrame(
        [(1, ["Person"], "Ann", 1950), (2, ["Person"], "Bob", 1970), (3, ["Movie"], "M", None),
         (4, ["Movie"], "N", None)], "id int, labels array<string>, name string, birth_year int")
    edges = spark.createDataFrame(
        [(1, 3, "ACTED_IN", 10.0), (2, 3, "ACTED_IN", 20.0), (2, 3, "ACTED_IN", 5.0), (2, 4, "ACTED_IN", 1.0),
         (1, 2, "CONTACT", None)], "src int, dst int, type string, earnings double")
    return nodes, edges


def named(name):
    return F.col("name") == name


def test_degree(spark):
    lines = from_lines(spark, ["1 2 3 ", "1  4", "5", "", "6 1"])
    names = spark.createDataFrame([(1, "one"), (5, "five"), (6, "six")], "id bigint, name string")
    degrees = g.degree(lines)
    assert {r.id: r.connections for r in degrees.collect()} == {1: 3, 5: 0, 6: 1}
    assert g.most_connected(degrees, names).first().name == "one"
    assert [r.name for r in g.least_connected(degrees, names).collect()] == ["five"]
    assert [r.name for r in g.isolated(degrees, names).collect()] == ["five"]
    assert g.degree(lines, sum_lines=False).count() == 4


def test_matching(spark):
    nodes, edges = graph(spark)
    for sizes in ({}, {"max_rows": 0}):
        people = g.match_in(nodes, edges, "ACTED_IN", named("M"), ["name"], "Person", "Movie", **sizes)
        assert [r.name for r in people.collect()] == ["Ann", "Bob", "Bob"]
        films = g.match_out(nodes, edges, "ACTED_IN", named("Bob"), ["name"], "Movie", "Person", **sizes)
        assert sorted(r.name for r in films.collect()) == ["M", "M", "N"]
        assert g.target_count(nodes, edges, "ACTED_IN", named("Bob"), "Movie", **sizes).first().n == 3
        common = g.common_targets(nodes, edges, "ACTED_IN", named("Ann"), named("Bob"), ["name"], "Movie", **sizes)
        assert [tuple(r) for r in common.collect()] == [(3, "M", 2)]
        same = g.common_targets(nodes, edges, "ACTED_IN", named("Bob"), named("Bob"), ["name"], "Movie", **sizes)
        assert [tuple(r) for r in same.collect()] == [(3, "M", 2)]
        hops = g.match_two_hop(nodes, edges, "CONTACT", "ACTED_IN", named("Ann"), F.col("birth_year") >= 1960,
                               F.col("earnings") >= 5, ["name", "birth_year"], "earnings", **sizes)
        assert [tuple(r) for r in hops.collect()] == [("Bob", 1970, 20.0, 1), ("Bob", 1970, 5.0, 1)]
    assert g.target_count(nodes, edges, "ACTED_IN", named("nobody")).first().n == 0


def test_updates(spark):
    nodes, edges = graph(spark)
    rich = lambda **kw: {r.name for r in g.label_where_sum(
        nodes, edges, "ACTED_IN", "earnings", 26, "Rich", **kw).filter("array_contains(labels, 'Rich')").collect()}
    assert rich() == set() and rich(inclusive=True) == {"Bob"}
    new = spark.createDataFrame([(9, ["Person"], "Ann"), (8, ["Movie"], "Ann")],
                                "id int, labels array<string>, name string")
    assert g.add_nodes(nodes, new, ["name"]).count() == 5
    assert g.add_nodes(nodes, new, ["name"], always_new=True).count() == 6
    hobby = g.set_property(nodes, named("Ann"), "hobby", "chess")
    assert {r.name: r.hobby for r in hobby.collect()}["Ann"] == "chess"
    renamed = g.set_property(nodes, named("Ann"), "birth_year", 1951)
    assert sorted(r.birth_year or 0 for r in renamed.collect()) == [0, 0, 1951, 1970]


def test_merge_counter(spark):
    views = spark.createDataFrame(
        [(1, 3, "VIEWED", 4), (2, 3, "VIEWED", None), (1, 2, "CONTACT", None)],
        "src int, dst int, type string, views bigint")
    pairs = spark.createDataFrame([(1, 3), (1, 3), (2, 3), (2, 4), (1, 2)], "src int, dst int")
    merged = g.merge_edge_counter(views, pairs, "VIEWED", "views")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert sorted((r.src, r.dst, r.type, r.views or 0) for r in merged.collect()) == [
        (1, 2, "CONTACT", 0), (1, 2, "VIEWED", 1), (1, 3, "VIEWED", 6), (2, 3, "VIEWED", 1), (2, 4, "VIEWED", 1)]


def test_labels_on_both_ends(spark):
    nodes, edges = graph(spark)
    nodes = nodes.union(spark.createDataFrame([(5, ["Prize"], "Gold", None)], nodes.schema))
    edges = edges.union(spark.createDataFrame([(2, 5, "ACTED_IN", 99.0)], edges.schema))
    hops = g.match_two_hop(nodes, edges, "CONTACT", "ACTED_IN", named("Ann"), F.col("birth_year") >= 1960,
                           F.col("earnings") >= 5, ["name"], "earnings", "Person", "Person", "Movie")
    assert [r.earnings for r in hops.collect()] == [20.0, 5.0]
    assert g.average_edge(nodes, edges, "ACTED_IN", "earnings", "a", "Person", "Movie").first().a == 9.0
    rich = g.label_where_sum(nodes, edges, "ACTED_IN", "earnings", 26, "Rich", target_label="Movie")
    assert rich.filter("array_contains(labels, 'Rich')").count() == 0


def test_a_node_with_more_labels_is_reused(spark):
    nodes, _ = graph(spark)
    known = g.label_where_sum(*graph(spark), "ACTED_IN", "earnings", 5, "Rich")
    new = spark.createDataFrame([(9, ["Person"], "Ann")], "id int, labels array<string>, name string")
    assert g.add_nodes(known, new, ["name"]).count() == nodes.count()
    more = spark.createDataFrame([(9, ["Person", "Poor"], "Ann")], "id int, labels array<string>, name string")
    assert g.add_nodes(known, more, ["name"]).count() == nodes.count() + 1

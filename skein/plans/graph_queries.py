"""Queries over adjacency lines and the property graph."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.operators import aggregates as agg
from skein.operators import graph as g
from skein.operators.shape import take_n
from skein.plans.registry import query
from skein.plans.sql import EDGES, LINES, NODES, PRIZED
from skein.plans.tables import adjacency_lines, edges, movie_id, nodes, order_names, prized, table, viewer_id

PERSON, OTHER, MOVIE, VIEWER = "Supplier#000000007", "Supplier#000000003", "small ring", "Customer#000000007"


def named(name: str) -> Column:
    return F.col("name") == name


@query("degree", f"with {LINES} select * from degree")
def degree(spark, sf_dir):
    return g.degree(adjacency_lines(spark, sf_dir))


@query("line_degrees", f"with {LINES} select id, connections, count(*) as n from lines group by 1, 2")
def line_degrees(spark, sf_dir):
    per_line = g.degree(adjacency_lines(spark, sf_dir), sum_lines=False)
    return agg.counts_by(per_line, ["id", "connections"])


@query("most_connected", f"""with {LINES}
select id, name, connections from degree join names using (id) order by connections desc, id limit 1""")
def most_connected(spark, sf_dir):
    return g.most_connected(g.degree(adjacency_lines(spark, sf_dir)), order_names(spark, sf_dir))


@query("least_connected", f"""with {LINES}
select id, name, connections from degree join names using (id)
where connections = (select min(connections) from degree)""")
def least_connected(spark, sf_dir):
    return g.least_connected(g.degree(adjacency_lines(spark, sf_dir)), order_names(spark, sf_dir))


@query("isolated_nodes", f"""with {LINES}
select id, name, connections from degree join names using (id) where connections = 0""")
def isolated_nodes(spark, sf_dir):
    return g.isolated(g.degree(adjacency_lines(spark, sf_dir)), order_names(spark, sf_dir))


@query("take_n")
def take_any(spark, sf_dir):
    return take_n(nodes(spark, sf_dir), 10, "Movie")


@query("take_n_holds", f"""with {NODES}
select least(10, count(*))::int as n, true as known from nodes where label = 'Movie'""")
def take_holds(spark, sf_dir):
    everything = nodes(spark, sf_dir).filter(F.array_contains("labels", "Movie")).select("id", "name")
    taken = take_n(nodes(spark, sf_dir), 10, "Movie").join(everything, ["id", "name"], "left_semi")
    return taken.agg(F.count(F.lit(1)).cast("int").alias("n"), F.lit(True).alias("known"))


@query("graph_actors_of", f"""with {NODES}, {EDGES}
select p.name from edges join nodes m on dst = m.id join nodes p on src = p.id
where type = 'ACTED_IN' and m.label = 'Movie' and p.label = 'Person' and m.name = '{MOVIE}' order by 1""")
def graph_actors_of(spark, sf_dir):
    return g.match_in(nodes(spark, sf_dir), edges(spark, sf_dir), "ACTED_IN", named(MOVIE), ["name"],
                      "Person", "Movie")


@query("graph_targets_of", f"""with {NODES}, {EDGES}
select m.name from edges join nodes m on dst = m.id join nodes p on src = p.id
where type = 'ACTED_IN' and m.label = 'Movie' and p.label = 'Person' and p.name = '{PERSON}'""")
def graph_targets_of(spark, sf_dir):
    return g.match_out(nodes(spark, sf_dir), edges(spark, sf_dir), "ACTED_IN", named(PERSON), ["name"],
                       "Movie", "Person")


@query("graph_target_count", f"""with {NODES}, {EDGES}
select count(m.name) as n from edges join nodes m on dst = m.id join nodes p on src = p.id
where type = 'ACTED_IN' and m.label = 'Movie' and p.label = 'Person' and p.name = '{PERSON}'""")
def graph_target_count(spark, sf_dir):
    return g.target_count(nodes(spark, sf_dir), edges(spark, sf_dir), "ACTED_IN", named(PERSON),
                          "Movie", "Person")


@query("graph_common_targets", f"""with {NODES}, {EDGES}
select m.id, m.name, count(*) as matches
from edges a join edges b on a.dst = b.dst join nodes m on a.dst = m.id
  join nodes p on a.src = p.id join nodes q on b.src = q.id
where a.type = 'ACTED_IN' and b.type = 'ACTED_IN' and p.name = '{PERSON}' and q.name = '{OTHER}'
group by 1, 2""")
def graph_common_targets(spark, sf_dir):
    return g.common_targets(nodes(spark, sf_dir), edges(spark, sf_dir), "ACTED_IN", named(PERSON),
                            named(OTHER), ["name"], "Movie", "Person")


# Some deliveries stand for prizes: edges of the same type into nodes that are no movies, and from ones that are no persons.
@query("graph_avg_edge", f"""with {NODES}, {PRIZED}
select round(avg(earnings), 6) as avg_earnings from prized join nodes p on src = p.id join nodes m on dst = m.id
where type = 'ACTED_IN' and p.label = 'Person' and m.label = 'Movie'""")
def graph_avg_edge(spark, sf_dir):
    found = g.average_edge(nodes(spark, sf_dir), prized(spark, sf_dir), "ACTED_IN", "earnings", "avg_earnings", "Person", "Movie")
    return found.select(F.round("avg_earnings", 6).alias("avg_earnings"))


@query("graph_two_hop", f"""with {NODES}, {PRIZED}
select c.name, c.birth_year, b.earnings, count(*) as paths
from prized a join (select *, row_number() over () as edge_id from prized) b on a.dst = b.src
  join nodes p on a.src = p.id join nodes c on a.dst = c.id join nodes m on b.dst = m.id
where p.label = 'Person' and c.label = 'Person' and m.label = 'Movie' and a.type = 'CONTACT' and b.type = 'ACTED_IN' and p.name = '{VIEWER}' and c.birth_year >= 1960
  and b.earnings >= 50000
group by b.edge_id, 1, 2, 3""")
def graph_two_hop(spark, sf_dir):
    return g.match_two_hop(
        nodes(spark, sf_dir), prized(spark, sf_dir), "CONTACT", "ACTED_IN", named(VIEWER),
        F.col("birth_year") >= 1960, F.col("earnings") >= 50000, ["name", "birth_year"], "earnings",
        "Person", "Person", "Movie")


RICH = 30_000_000


@query("graph_label_rich", f"""with {NODES}, {PRIZED},
rich as (select src as id from prized join nodes p on src = p.id join nodes m on dst = m.id
  where type = 'ACTED_IN' and p.label = 'Person' and m.label = 'Movie' group by 1 having sum(earnings) > {RICH})
select id, name, label || case when id in (select id from rich) then ',Rich' else '' end as labels
from nodes""")
def graph_label_rich(spark, sf_dir):
    labelled = g.label_where_sum(nodes(spark, sf_dir), prized(spark, sf_dir), "ACTED_IN", "earnings", RICH, "Rich",
                                 source_label="Person", target_label="Movie")
    return labelled.select("id", "name", F.array_join("labels", ",").alias("labels"))


# A new movie, with a known person acting in it; the person is reused.
@query("graph_add", f"""with {NODES}, {EDGES}
select 'node' as kind, label as what, null::bigint as src, null::bigint as dst, count(*) as n from nodes group by 2
union all select 'node', 'Movie of {PERSON}', null, null, 1
union all select 'edge', 'ACTED_IN', (select id from nodes where name = '{PERSON}'), -1, 1
union all select 'edge', type, null, null, count(*) from edges group by 2""")
def graph_add(spark, sf_dir):
    known, links = nodes(spark, sf_dir), edges(spark, sf_dir)
    # The person has gained a label since; it is the same person all the same.
    known = known.withColumn("labels", F.when(named(PERSON), F.array_append("labels", F.lit("Rich"))).otherwise(F.col("labels")))
    title = f"Movie of {PERSON}"
    new = spark.createDataFrame(
        [(-1, ["Movie"], title), (-2, ["Person"], PERSON)], "id bigint, labels array<string>, name string")
    grown = g.add_nodes(known, new, ["name"])
    pair = spark.createDataFrame([(PERSON, title)], "src_name string, dst_name string")
    added = g.edges_between(grown, named(PERSON), named(title), "ACTED_IN", pair)
    what = F.when(F.col("name") == title, F.col("name")).otherwise(F.col("labels")[0])
    node_counts = grown.select(F.lit("node").alias("kind"), what.alias("what"))
    fresh = F.col("dst") == -1
    nothing = F.lit(None).cast("bigint")
    edge_counts = g.add_edges(links, added).select(
        F.lit("edge").alias("kind"), F.col("type").alias("what"), F.when(fresh, F.col("src").cast("bigint")).alias("src"),
        F.when(fresh, F.col("dst").cast("bigint")).alias("dst"))
    node_counts = node_counts.withColumns({"src": nothing, "dst": nothing})
    return agg.counts_by(node_counts.unionAll(edge_counts), ["kind", "what", "src", "dst"])


@query("graph_set_property", f"""with {NODES}
select id, name, case when name = '{PERSON}' then 'ballroom dancing' end as hobby from nodes""")
def graph_set_property(spark, sf_dir):
    return g.set_property(nodes(spark, sf_dir), named(PERSON), "hobby", "ballroom dancing").select(
        "id", "name", "hobby")


# Views: customers look at parts. Lines shipped before 1998 are counted already, later ones come in.
SEEN = "select o_custkey * 3 + 2 as src, l_partkey * 3 + 1 as dst from lineitem join orders on l_orderkey = o_orderkey"


@query("graph_merge_counter", f"""
select src, dst, 'VIEWED' as type, count(*) as views from ({SEEN}) group by 1, 2""")
def graph_merge_counter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    seen = lines.join(orders, "l_orderkey").select(
        viewer_id("o_custkey").alias("src"), movie_id("l_partkey").alias("dst"), "l_shipdate")
    early = F.col("l_shipdate") < "1998-01-01"
    known = seen.filter(early).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("views")).select(
        "src", "dst", F.lit("VIEWED").alias("type"), "views")
    return g.merge_edge_counter(known, seen.filter(~early), "VIEWED", "views")

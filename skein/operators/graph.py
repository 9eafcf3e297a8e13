"""Degrees of adjacency lines, and matching and updating of property graphs.

A property graph is two tables: ``nodes(id, labels array<string>, typed properties…)`` and
``edges(src, dst, type, typed properties…)``. Filters run on the node table first; edges then meet a
side that is broadcast only when measured small, and hot nodes are salted otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.skew import lookup
from skein.operators.joins import name_of_top
from skein.session import cut


def degree(lines: DataFrame, col: str = "value", sum_lines: bool = True) -> DataFrame:
    """Connections per node of adjacency lines ``id n1 n2 …``, as ``(id, connections)``.

    A node may own several lines; with ``sum_lines=False`` every line stays a row.
    """
    parts = F.split(F.trim(F.col(col)), r"\s+")
    per_line = lines.filter(F.trim(F.col(col)) != "").select(
        F.get(parts, F.lit(0)).try_cast("bigint").alias("id"), (F.size(parts) - 1).alias("connections"))
    return per_line.groupBy("id").agg(F.sum("connections").alias("connections")) if sum_lines else per_line


def most_connected(degrees: DataFrame, names: DataFrame) -> DataFrame:
    """The node with most connections and its name; the smaller id wins ties."""
    return name_of_top(degrees, names, "connections")


def least_connected(degrees: DataFrame, names: DataFrame) -> DataFrame:
    """Named nodes with the fewest connections, sorted by name.

    The degrees are needed twice, so they are written once: one row per node instead of all lines.
    """
    degrees = cut(degrees)
    fewest = degrees.agg(F.min("connections"))
    return degrees.filter(F.col("connections") == fewest.scalar()).join(names, "id").orderBy("name", "id")


def isolated(degrees: DataFrame, names: DataFrame) -> DataFrame:
    """Named nodes without any connection, sorted by name."""
    return degrees.filter(F.col("connections") == 0).join(names, "id").orderBy("name", "id")


def with_label(nodes: DataFrame, label: str | None) -> DataFrame:
    return nodes if label is None else nodes.filter(F.array_contains("labels", label))


def edges_from(nodes: DataFrame, edges: DataFrame, kind: str, where: Column,
               label: str | None = None, **sizes: int) -> DataFrame:
    """Edges of a type that start at a node meeting the condition."""
    ids = with_label(nodes, label).filter(where).select(F.col("id").alias("src"))
    return lookup(edges.filter(F.col("type") == kind), ids, "src", "left_semi", **sizes)


def edges_into(nodes: DataFrame, edges: DataFrame, kind: str, where: Column,
               label: str | None = None, **sizes: int) -> DataFrame:
    """Edges of a type that end at a node meeting the condition."""
    ids = with_label(nodes, label).filter(where).select(F.col("id").alias("dst"))
    return lookup(edges.filter(F.col("type") == kind), ids, "dst", "left_semi", **sizes)


def match_in(nodes: DataFrame, edges: DataFrame, kind: str, target: Column, columns: list[str],
             label: str | None = None, target_label: str | None = None, **sizes: int) -> DataFrame:
    """Nodes with an edge of a type into a target, one row per edge, sorted by the columns."""
    hits = edges_into(nodes, edges, kind, target, target_label, **sizes).select(F.col("src").alias("id"))
    named = with_label(nodes, label).select("id", *columns)
    return lookup(hits, named, "id", **sizes).select(*columns).orderBy(*columns)


def match_out(nodes: DataFrame, edges: DataFrame, kind: str, source: Column, columns: list[str],
              label: str | None = None, source_label: str | None = None, **sizes: int) -> DataFrame:
    """Nodes an edge of a type leads to from a source, one row per edge."""
    hits = edges_from(nodes, edges, kind, source, source_label, **sizes).select(F.col("dst").alias("id"))
    return lookup(hits, with_label(nodes, label).select("id", *columns), "id", **sizes).select(*columns)


def target_count(nodes: DataFrame, edges: DataFrame, kind: str, source: Column,
                 label: str | None = None, source_label: str | None = None, name: str = "n",
                 **sizes: int) -> DataFrame:
    """Number of edges of a type that lead from a source to a node with the label."""
    hits = edges_from(nodes, edges, kind, source, source_label, **sizes).groupBy(
        F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("_edges"))
    return hits.join(with_label(nodes, label).select("id"), "id", "left_semi").agg(
        F.coalesce(F.sum("_edges"), F.lit(0)).alias(name))


def common_targets(nodes: DataFrame, edges: DataFrame, kind: str, one: Column, other: Column,
                   columns: list[str], label: str | None = None, source_label: str | None = None,
                   **sizes: int) -> DataFrame:
    """Nodes reached from both sources, with the number of edge pairs that show it.

    An edge is used once per match, so an edge that fits both sources does not pair with itself.
    Pairs are counted per target, never produced.
    """
    sources = with_label(nodes, source_label)
    both = sources.filter(one | other).select(
        F.col("id").alias("src"), F.coalesce(one, F.lit(False)).alias("_one"),
        F.coalesce(other, F.lit(False)).alias("_other"))
    hits = lookup(edges.filter(F.col("type") == kind).select("src", "dst"), both, "src", **sizes)
    pairs = hits.groupBy(F.col("dst").alias("id")).agg(
        (F.count_if(F.col("_one")) * F.count_if(F.col("_other"))
         - F.count_if(F.col("_one") & F.col("_other"))).alias("matches"))
    return pairs.filter(F.col("matches") > 0).join(
        with_label(nodes, label).select("id", *columns), "id").select("id", *columns, "matches")


def match_two_hop(nodes: DataFrame, edges: DataFrame, first: str, second: str, source: Column,
                  middle: Column, second_edge: Column, columns: list[str], measure: str,
                  source_label: str | None = None, middle_label: str | None = None, target_label: str | None = None,
                  **sizes: int) -> DataFrame:
    """Middle nodes reached over ``first`` that have a fitting ``second`` edge into a node, best edge first.

    One row per second edge; ``paths`` counts the first edges that lead to its node.
    """
    reached = edges_from(nodes, edges, first, source, source_label, **sizes).groupBy(F.col("dst").alias("id")).agg(
        F.count(F.lit(1)).alias("paths"))
    through = with_label(nodes, middle_label).filter(middle).join(reached, "id").select(F.col("id").alias("src"), *columns, "paths")
    onward = edges.filter(F.col("type") == second).filter(second_edge).select("src", "dst", measure)
    found = lookup(onward, cut(through), "src", **sizes)
    if target_label is not None:
        found = lookup(found, with_label(nodes, target_label).select(F.col("id").alias("dst")), "dst", "left_semi", **sizes)
    return found.select(*columns, measure, "paths").orderBy(
        F.col(measure).desc(), *columns)


def label_where_sum(nodes: DataFrame, edges: DataFrame, kind: str, measure: str, threshold: float,
                    label: str, inclusive: bool = False, source_label: str | None = None,
                    target_label: str | None = None, **sizes: int) -> DataFrame:
    """Add a label to nodes (of ``source_label``) whose edges of a type (into ``target_label``) sum up past the threshold."""
    ends = with_label(nodes, target_label).select(F.col("id").alias("dst"))
    of_kind = edges.filter(F.col("type") == kind).select("src", "dst", measure)
    if target_label is not None:
        of_kind = lookup(of_kind, ends, "dst", "left_semi", **sizes)
    summed = of_kind.groupBy(F.col("src").alias("id")).agg(F.sum(measure).alias("_sum"))
    passed = F.col("_sum") >= threshold if inclusive else F.col("_sum") > threshold
    chosen = summed.filter(passed).select("id", F.lit(True).alias("_chosen"))
    fits = F.lit(True) if source_label is None else F.array_contains("labels", source_label)
    labelled = F.when(F.col("_chosen") & fits, F.array_union("labels", F.array(F.lit(label)))).otherwise(
        F.col("labels"))
    return nodes.join(chosen, "id", "left").withColumn("labels", labelled).drop("_chosen")


def add_nodes(nodes: DataFrame, new: DataFrame, same: list[str], always_new: bool = False) -> DataFrame:
    """Append nodes; unless ``always_new``, one that equals an existing node on ``same`` is reused.

    The existing node must have all labels of the new one, and may have more. Null-safe on ``same``, so a missing
    property is a value.
    """
    if not always_new:
        known = nodes.select(F.col("labels").alias("_labels"), *[F.col(c).alias(f"_{c}") for c in same])
        fits = F.size(F.array_except(F.coalesce("labels", F.array()), F.coalesce("_labels", F.array()))) == 0
        for c in same:
            fits = fits & F.col(c).eqNullSafe(F.col(f"_{c}"))
        new = new.join(known, fits, "left_anti")
    return nodes.unionByName(new, allowMissingColumns=True)


def add_edges(edges: DataFrame, new: DataFrame) -> DataFrame:
    """Append edges."""
    return edges.unionByName(new, allowMissingColumns=True)


def edges_between(nodes: DataFrame, source: Column, target: Column, kind: str, pairs: DataFrame) -> DataFrame:
    """Edges for named pairs ``(src_name, dst_name)`` between nodes that meet the conditions."""
    start = nodes.filter(source).select(F.col("id").alias("src"), F.col("name").alias("src_name"))
    end = nodes.filter(target).select(F.col("id").alias("dst"), F.col("name").alias("dst_name"))
    return pairs.join(start, "src_name").join(end, "dst_name").select("src", "dst", F.lit(kind).alias("type"))


def set_property(nodes: DataFrame, where: Column, key: str, value) -> DataFrame:
    """Set a property on the nodes that meet the condition; the column appears when it is new."""
    old = F.col(key) if key in nodes.columns else F.lit(None)
    return nodes.withColumn(key, F.when(where, F.lit(value)).otherwise(old))


def average_edge(nodes: DataFrame, edges: DataFrame, kind: str, measure: str, name: str, source_label: str | None = None,
                 target_label: str | None = None, **sizes: int) -> DataFrame:
    """Average of a measure over the edges of a type between nodes with the labels."""
    hits = edges.filter(F.col("type") == kind).select("src", "dst", measure)
    for end, label in (("src", source_label), ("dst", target_label)):
        if label is not None:
            hits = lookup(hits, with_label(nodes, label).select(F.col("id").alias(end)), end, "left_semi", **sizes)
    return hits.agg(F.avg(measure).alias(name))


def merge_edge_counter(edges: DataFrame, pairs: DataFrame, kind: str, counter: str) -> DataFrame:
    """Upsert one edge per pair ``(src, dst)``: the counter grows by the number of times it occurs.

    An existing edge starts from its counter (0 if missing), a created one from 0. Edges of a pair are one edge with
    the sum of their counters. Edges of other types pass through untouched. Old counters and new occurrences meet in
    one grouped sum, combined on the map side, so a pair with very many views is a row per task.
    """
    of_kind = F.col("type").eqNullSafe(F.lit(kind))
    known = edges.filter(of_kind)
    rest = [c for c in edges.columns if c not in ("src", "dst", "type", counter)]
    old = known.select("src", "dst", F.coalesce(counter, F.lit(0)).cast("long").alias(counter), *rest)
    new = pairs.select("src", "dst", F.lit(1).cast("long").alias(counter))
    merged = old.unionByName(new, allowMissingColumns=True).groupBy("src", "dst").agg(
        F.sum(counter).cast(edges.schema[counter].dataType).alias(counter), *[F.first(c, ignorenulls=True).alias(c) for c in rest])
    return edges.filter(~of_kind).unionByName(merged.withColumn("type", F.lit(kind)))

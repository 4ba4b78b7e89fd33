"""Frontier expansion over landed documents, and what it proves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.shared import cut
from .ranking import numbered


def expand_frontier(seeds: DataFrame, edges: DataFrame, max_depth: int = 5, max_nodes: int | None = None, kind: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is reached from seeds (node, priority, entity) along edges (parent, child, priority): nodes, bindings, edges met.

    A node is any comparable value, such as a struct of kind and key. Nodes (node, depth, priority) keep their least depth
    and priority; bindings (node, segment, entities) are inherited from every parent and come in segments of at most 64.
    Edges have the depth of their parent and why their child was refused: ``max_depth`` is observed but not expanded, and
    once ``max_nodes`` nodes are admitted all further edges are ``max_nodes``. Admission is that of a sequential run: levels
    one after the other, a level's parents by priority and node, and a parent's edges by ``seq``, if they have such a
    column, and child. A level's edges are written once where the budget may bind, and numbered over range partitions; a
    level refused as a whole is neither, and costs only who reads the edges met.

    ``kind`` names a field of the nodes with few values: a level then reads only the edges of the kinds it has come to.
    """
    edges = edges if "seq" in edges.columns else edges.withColumn("seq", F.lit(0))
    # nodes meet by their hashes, which are those of one type
    one = seeds.select("node").union(edges.select("parent")).union(edges.select("child")).schema["node"].dataType
    seeds, edges = _cast(seeds, ["node"], one), _cast(edges, ["parent", "child"], one)
    if max_nodes is None:
        found, names = _spread(seeds, edges, max_depth, kind)
        nodes = found.groupBy("node").agg(F.min("depth").alias("depth"), F.min("priority").alias("priority"))
        met = _leaving(nodes.select("node", "depth"), edges).select("parent", "child", "priority", "seq", "depth", F.when(F.col("depth") == max_depth, "max_depth").alias("refused"))
    else:
        nodes, met = _admitted(seeds, edges, max_depth, max_nodes)
        known = seeds.filter("entity is not null").join(nodes, "node", "left_semi")
        found, names = _spread(known, met.filter("refused is null"), max_depth, kind)
    entities = F.filter("names", lambda _, i: F.getbit("bits", i) == 1)
    bound = found.filter("segment is not null").join(names, "segment").select("node", "segment", entities.alias("entities"))
    return nodes, bound, met


def _spread(seeds: DataFrame, edges: DataFrame, max_depth: int, kind: str | None) -> tuple[DataFrame, DataFrame]:
    """Nodes reached with what is bound to them (node, segment, depth, priority, bits, ...), and the segments' names.

    Entities are numbered, and those bound to a node are bits, 64 a row: an edge carries a segment at a time and not an
    entity. A row without a segment stands for a node to which nothing is bound. A round sends what the one before added
    along all edges of its nodes; that it sends depth and priority along as well, also of nodes known before, changes no least.
    """
    ids = numbered(seeds.select("entity").filter("entity is not null").distinct(), ["entity"], "id")
    ids = cut(ids.select("entity", F.expr("(id - 1) div 64").alias("segment"), F.expr("cast((id - 1) % 64 as int)").alias("bit")), "ids")
    rows = seeds.filter("entity is not null").join(ids.hint("merge"), "entity").select("node", "priority", "segment", F.expr("shiftleft(1L, bit)").alias("bits"))
    rows = rows.unionByName(seeds.filter("entity is null").select("node", "priority", F.lit(None).cast("long").alias("segment"), F.lit(0).cast("long").alias("bits")))
    found = rows.groupBy("node", "segment").agg(F.lit(0).alias("depth"), F.min("priority").alias("priority"), F.bit_or("bits").alias("bits"))
    found = cut(found.withColumn("fresh", F.col("bits")).withColumn("since", F.lit(0)), "found")
    for depth in range(max_depth):
        sent = found.filter(F.col("since") == depth)
        if kind is None:
            if sent.isEmpty():
                break
            step = edges
        else:
            kinds = [k for (k,) in sent.select(F.col("node")[kind]).distinct().collect()]
            if not kinds:
                break
            at = F.col("parent")[kind]
            step = edges.filter(at.isin([k for k in kinds if k is not None]) | (at.isNull() if None in kinds else F.lit(False)))
        step = _leaving(sent.select("node", "segment", "fresh"), step).select(F.col("child").alias("node"), "segment", F.lit(depth + 1).alias("depth"), "priority", F.lit(0).cast("long").alias("bits"), "fresh")
        both = found.select("node", "segment", "depth", "priority", "bits", F.lit(0).cast("long").alias("fresh")).unionByName(step)
        both = both.groupBy("node", "segment").agg(F.min("depth").alias("depth"), F.min("priority").alias("priority"), F.bit_or("bits").alias("bits"), F.bit_or("fresh").alias("fresh"))
        fresh = F.col("fresh").bitwiseAND(F.bitwise_not("bits"))
        both = both.select("node", "segment", "depth", "priority", F.col("bits").bitwiseOR(F.col("fresh")).alias("bits"), fresh.alias("fresh"))
        found = cut(both.withColumn("since", F.when((F.col("depth") == depth + 1) | (F.col("fresh") != 0), depth + 1)), "found")
    names = F.array_sort(F.collect_list(F.struct("bit", "entity")))
    return found, ids.groupBy("segment").agg(F.transform(names, lambda x: x["entity"]).alias("names"))


def _cast(df: DataFrame, names: Sequence[str], to: DataType) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(to) for c in names if df.schema[c].dataType.simpleString() != to.simpleString()})


def _leaving(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with the edges whose parents they are.

    They are joined on a hash, as Spark sorts numbers several times as fast as structs, and compared in full as they meet;
    an equality would become a key to sort by. The join is merged: these tables are far larger than their files, by whose
    size Spark would broadcast them.
    """
    same = F.col("parent").between(F.col("node"), F.col("node"))
    return edges.join(nodes.hint("merge"), (F.xxhash64("parent") == F.xxhash64("node")) & same)


def _admitted(seeds: DataFrame, edges: DataFrame, max_depth: int, max_nodes: int) -> tuple[DataFrame, DataFrame]:
    """The nodes within a budget and all edges met."""
    first = numbered(seeds.groupBy("node").agg(F.min("priority").alias("priority")), ["priority", "node"]).filter(F.col("place") <= max_nodes)
    # nodes know the level they came at, so that one aggregation a level both adds to them and tells what is new
    nodes = cut(first.select("node", F.lit(0).alias("depth"), "priority"), "nodes")
    met, count = None, nodes.count()
    for depth in range(max_depth + 1):
        frontier = nodes.filter(F.col("depth") == depth)
        if depth and frontier.isEmpty():
            break
        step = edges.join(frontier.select(F.col("node").alias("parent"), F.col("priority").alias("_by")), "parent")
        step = step.select("parent", "child", "priority", "seq", "_by", F.lit(depth).alias("depth"))
        if depth == max_depth:
            step = step.withColumn("refused", F.lit("max_depth")).drop("_by")
        elif count >= max_nodes:
            step = step.withColumn("refused", F.lit("max_nodes")).drop("_by")
        else:
            step = numbered(step, ["_by", "parent", "seq", "child", "priority"]).drop("_by")
            new = cut(step.groupBy(F.col("child").alias("node")).agg(F.min("place").alias("place")).join(nodes.select("node"), "node", "left_anti"), "new")
            over = _nth(new, max_nodes - count)
            step = step.withColumn("refused", F.when(F.col("place") > (F.lit(over) if over is not None else F.col("place")), "max_nodes")).drop("place")
            count = min(max_nodes, count + new.count())
        met = step if met is None else met.unionByName(step)
        if depth == max_depth:
            break
        nodes = nodes.unionByName(step.filter("refused is null").select(F.col("child").alias("node"), F.lit(depth + 1).alias("depth"), "priority"))
        nodes = cut(nodes.groupBy("node").agg(F.min("depth").alias("depth"), F.min("priority").alias("priority")), "nodes")
    return nodes, met


def _nth(new: DataFrame, n: int) -> int | None:
    """The n-th smallest place, or None if there are fewer."""
    row = numbered(new, ["place"], "nth").filter(F.col("nth") == n).select("place").first()
    return row[0] if row else None


def explain_entity(bindings: DataFrame, nodes: DataFrame, observations: DataFrame, entity: object) -> DataFrame:
    """All nodes bound to an entity with what was observed there, in order."""
    own = bindings.filter(F.col("entity") == entity).join(nodes, "node")
    return own.join(observations, "node", "left").orderBy("depth", "node")


def materialize_valid(catalog: DataFrame, key: str, current: str, confirmed: Column, hits: DataFrame, url: str, order: Sequence[str], fields: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The first valid asset of each known entity, never over a different confirmed one; and the ledger of old and new."""
    first = hits.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order, url))).filter("_n = 1").select(key, F.col(url).alias("_new"))
    rows = catalog.join(first, key, "left").withColumn("_keep", F.coalesce(confirmed, F.lit(False)) & (F.col(current) != F.col("_new")))
    value = F.when(F.col("_new").isNull() | F.col("_keep"), F.col(current)).otherwise(F.col("_new"))
    ledger = rows.filter(F.col("_new").isNotNull() & ~F.col("_keep") & ~F.col(current).eqNullSafe(F.col("_new"))).select(key, F.lit(current).alias("field"), F.col(current).alias("old"), F.col("_new").alias("new"))
    return rows.withColumn(current, value).drop("_new", "_keep"), ledger

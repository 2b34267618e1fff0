"""Links inside buckets without emitting all their pairs, and connected components; DataFrame operations only.

Every member of a bucket is first compared with one hub, so a large group soon hangs together. Then only members outside
their bucket's largest component are compared with members of other components. No pair of one bucket is left out
unless its two ends are connected already, or the caller compares it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithlink.llm.common import drop_scratch, materialize

#: Rows of a round's graph tables that one task writes; small graphs take few tasks, whatever the number of shuffle partitions.
ROWS_A_TASK = 100_000
#: Members of a bucket that a stray meets in one row, and the weight of a tile.
TILE, TILE_WEIGHT = 128, 1 << 17


def shared_keys(rows: DataFrame, key: str = "key", node: str = "node") -> DataFrame:
    """Rows of buckets with at least two distinct nodes. One shuffle by key."""
    whole = Window.partitionBy(key)
    return rows.withColumn("least_", F.min(node).over(whole)).withColumn("most_", F.max(node).over(whole)).filter("least_ <> most_").drop("least_", "most_")


def stray_pairs(hubbed: DataFrame, components: DataFrame, extra: list[str], condition, key: str = "key", node: str = "node", enough=None, pivots: DataFrame | None = None) -> DataFrame:
    """(a, b, shared), a < b, within a bucket and in different components, for which the condition holds; shared: in how many buckets.

    extra: columns of hubbed that the condition needs, under aliases l and r. enough: a column of theirs to return besides, the same for a pair in every bucket.
    pivots: (node, pivot); pairs with the same pivot are left out. A node without a row in components is its own component.
    """
    named = components.select(F.col("node").alias("of"), "component")
    if pivots is not None:
        named = named.join(pivots.select(F.col("node").alias("of"), "pivot"), "of", "full")
        extra, condition = [*extra, "pivot"], condition & F.coalesce(F.col("l.pivot") != F.col("r.pivot"), F.lit(True))
    own = hubbed.join(named, F.col(node) == F.col("of"), "left").withColumn("own", F.coalesce("component", F.col(node))).drop("of", "component")
    whole = Window.partitionBy(key)
    mixed = own.withColumn("least", F.min("own").over(whole)).withColumn("most", F.max("own").over(whole)).filter("least <> most")
    mixed = mixed.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy(key, "own"))).withColumn("main", F.max(F.struct("held", "own")).over(whole)["own"]).select(key, node, "own", "main", *extra)
    mixed = materialize(mixed, "mixed")
    left, right = mixed.filter("own <> main").alias("l"), mixed.alias("r")
    once = (F.col("r.own") == F.col("r.main")) | (F.col(f"l.{node}") < F.col(f"r.{node}"))  # two strays meet from either side
    on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l.own") != F.col("r.own")) & once & condition
    a, b = F.col(f"l.{node}"), F.col(f"r.{node}")
    met = left.join(right, on).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), (F.lit(1) if enough is None else enough).alias("enough"))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("enough").alias("enough"))


def stray_lists(hubbed: DataFrame, components: DataFrame, extra: list[str], weight: str, condition, may_meet, sort_by: str, edges: DataFrame, key: str = "key", node: str = "node") -> tuple[DataFrame, DataFrame]:
    """(node, tile, others), for each stray the nodes of other components that it shares a bucket with and the condition holds for; and (tile, member), the nodes of the tiles.

    The pairs are those of stray_pairs but never become rows: a stray meets its bucket's members TILE at a time, and `others` lie in one tile: nodes of
    some TILE_WEIGHT that have their hub's component in common. condition: of two structs of `extra`. may_meet: of a struct of `extra` and those of the least and
    greatest values of some members, false only if the condition fails for all of these; members go by sort_by. weight: a column of extra. edges: (x, y) from hub_edges, which are left out as seen from x.
    """
    named = components.select(F.col("node").alias("of"), "component")
    own = hubbed.join(named, F.col(node) == F.col("of"), "left").withColumn("own", F.coalesce("component", F.col(node))).drop("of", "component")
    whole = Window.partitionBy(key)
    mixed = own.withColumn("least", F.min("own").over(whole)).withColumn("most", F.max("own").over(whole)).filter("least <> most")
    mixed = mixed.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy(key, "own"))).withColumn("main", F.max(F.struct("held", "own")).over(whole)["own"])
    part = F.floor((F.row_number().over(whole.orderBy(sort_by, node)) - 1) / TILE)
    hubs = edges.select(F.col("x").alias("x"), F.col("y").alias("hub"))
    mixed = mixed.withColumn("part", part).select(key, node, "own", "main", "part", *extra).join(hubs, F.col(node) == F.col("x"), "left").join(named, F.col("hub") == F.col("of"), "left")
    mixed = materialize(mixed.select(key, node, "own", "main", "part", "hub", F.coalesce("component", "hub", "own").alias("home"), *extra), "mixed")
    cuts = mixed.groupBy("home", node).agg(F.first(weight).alias("w")).groupBy("home").agg(F.ceil(F.sum("w") / TILE_WEIGHT).alias("cuts")).filter("cuts > 1")
    placed = mixed.join(cuts, "home", "left").withColumn("tile", F.xxhash64("home", F.pmod(F.xxhash64(node), F.coalesce("cuts", F.lit(1)))))
    ends = [F.struct(*(f(c).alias(c) for c in extra)).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
    members = placed.groupBy(key, "part").agg(F.collect_list(F.struct(F.col(node).alias("node"), "own", "tile", *extra)).alias("members"), *ends)
    stray = mixed.filter("own <> main").select(F.col(key).alias("k"), F.col(node).alias("node"), "own", "main", "hub", F.struct(*extra).alias("s"))
    met = stray.join(members, (F.col("k") == F.col(key)) & may_meet(F.col("s"), F.col("low"), F.col("high")))
    first = lambda m: ((F.col("node") < m["node"]) | (m["own"] == F.col("main"))) & (m["own"] != F.col("own")) & ~m["node"].eqNullSafe(F.col("hub"))
    found = F.transform(F.filter("members", lambda m: first(m) & condition(F.col("s"), m)), lambda m: F.struct(m["tile"].alias("tile"), m["node"].alias("node")))
    # generated, so that the filter isn't moved below and finds them twice
    met = met.select("node", F.explode(F.array(found)).alias("met")).filter("size(met) > 0").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("met"))).alias("met"))
    met = met.select("node", "met", F.explode(F.array_distinct(F.transform("met", lambda m: m["tile"]))).alias("tile"))
    others = F.transform(F.filter("met", lambda m: m["tile"] == F.col("tile")), lambda m: m["node"])
    lists = materialize(met.select("node", "tile", others.alias("others")), "strays")
    drop_scratch(mixed)
    some = lists.groupBy("tile", F.pmod(F.xxhash64("node"), F.lit(64)).alias("fan")).agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("held"))
    tiles = some.groupBy("tile").agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held")).select("tile", F.explode("held").alias("member"))
    return lists, materialize(tiles, "tiles")


def hub_edges(buckets: DataFrame, often: str, extra: list[str], condition, enough=None, key: str = "key", node: str = "node") -> DataFrame:
    """(x, y): each node x with one hub y, of those that meet the condition the one with most buckets in common.

    A bucket's hub is the member with the highest `often`, and of those the one of least hash: what near copies were made from
    is there more often than any of them. extra: columns that the condition reads, the hub's as hub_{column}.
    enough: of the same columns; a hub that shares less than half of it is left to the strays.
    """
    parts = [(-F.col(often)).alias("rank"), F.xxhash64(node).alias("o"), F.col(node).alias("hub"), *(F.col(c).alias(f"hub_{c}") for c in extra)]
    met = buckets.withColumn("h", F.min(F.struct(*parts)).over(Window.partitionBy(key))).select(node, *extra, "h.hub", *(f"h.hub_{c}" for c in extra)).filter(f"{node} <> hub").filter(condition)
    shared = met.groupBy(node, "hub").agg(F.count(F.lit(1)).alias("shared"), F.max(F.lit(1) if enough is None else enough).alias("enough")).filter("2 * shared >= enough")
    return shared.groupBy(node).agg(F.max(F.struct("shared", F.xxhash64("hub").alias("o"), "hub")).alias("m")).select(F.col(node).alias("x"), F.col("m.hub").alias("y"))


def undirected(edges: DataFrame) -> DataFrame:
    """(x, y) as (a, b), a < b, each once."""
    return edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the least node that it reaches), for every node of an edge.

    Each round every node hooks onto its least neighbour, chains are shortened to their roots by doubling, and edges are
    renamed to roots; edges inside a component vanish. A hub with any share of the edges is pre-aggregated where it
    is read. Every round's tables are written, so a lost executor costs one round at most.
    """
    spark = edges.sparkSession
    live = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    kind = live.schema["u"].dataType.simpleString()
    label = None
    while n := live.count():
        width = 4 + n // ROWS_A_TASK
        parent = materialize(live.groupBy("u").agg(F.min("v").alias("p")).coalesce(width), "parents")
        while True:
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("q"))
            moved = materialize(parent.join(up, "p", "left").select("u", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")).coalesce(width), "jumps")
            parent = moved.select("u", "p")
            if moved.filter("moved").isEmpty():
                break
        label = parent if label is None else materialize(_renamed(label, parent, "p").unionByName(parent.join(label.select("u"), "u", "left_anti")).coalesce(2 * width), "labels")
        live = _renamed(_renamed(live, parent, "u"), parent, "v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
        live = materialize(live.coalesce(width), "edges")
    if label is None:
        return spark.createDataFrame([], f"node {kind}, component {kind}")
    named = label.select(F.col("u").alias("node"), F.col("p").alias("component"))
    return named.unionByName(named.select(F.col("component").alias("node"), "component").distinct())


def _renamed(rows: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """rows with `column` replaced by its root where it has one."""
    up = parent.select(F.col("u").alias("_u"), F.col("p").alias("_p"))
    return rows.join(up, F.col(column) == F.col("_u"), "left").withColumn(column, F.coalesce("_p", column)).drop("_u", "_p")

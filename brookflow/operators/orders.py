"""Stream order numbers and hierarchical order codes.

Order 2 belongs to the given outflow edges. From an outflow edge a chain is
followed upstream along each node's selected edge; every other edge into the
chain's nodes is an outflow edge of the next order. Seen from an edge, its order
is the least number of chains on a way down to an outflow, so all orders are
found together by doubled pointers (chain_places), and codes are joined along
the tree of chains in the same way: neither takes a step per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import windows
from brookflow.runtime import release, staged


def _composed(a: str, b: str) -> dict[str, Column]:
    """The step a after the step b, each (more, head, rank): orders added; if any was, the edge that begins the chain and the place in it, else the places added."""
    fresh = F.col(f"{a}.head").isNotNull()
    return {
        "more": F.col(f"{a}.more") + F.col(f"{b}.more"), "head": F.coalesce(f"{a}.head", f"{b}.head"),
        "rank": F.when(fresh, F.col(f"{a}.rank")).otherwise(F.col(f"{a}.rank") + F.col(f"{b}.rank")),
    }


def _stepped(step: str, value: str) -> Column:
    """The struct (order, head, rank, root) behind a step."""
    fresh = F.col(f"{step}.head").isNotNull()
    return F.struct(
        (F.col(f"{value}.order") + F.col(f"{step}.more")).alias("order"), F.coalesce(f"{step}.head", f"{value}.head").alias("head"),
        F.when(fresh, F.col(f"{step}.rank")).otherwise(F.col(f"{value}.rank") + F.col(f"{step}.rank")).alias("rank"), F.col(f"{value}.root").alias("root"),
    )


def chain_places(edges: DataFrame, heads: DataFrame, rounds: list | None = None) -> DataFrame:
    """(code, order, head, rank, root) of edges(code, edge_id, node_start, node_end, follows) above heads(code, root).

    `follows`: the edge is the one selected at its end, so it carries on the chain of an edge that leaves there; else it
    begins a chain of the next order. Of all ways down to a head the least (order, chain's edge_id, place in the chain)
    counts, `root` being the head's. A step up adds an order or a place and keeps that order, so ways can be put together:
    nodes that a single edge leaves, none of them a head, point down that way and pointers are doubled until they stand
    on other nodes; only between those is the least way sought, a round for each on the way. Edges without a way have no row.
    """
    step = F.struct(F.when(F.col("follows"), 0).otherwise(1).alias("more"), F.when(~F.col("follows"), F.col("edge_id")).alias("head"), F.when(F.col("follows"), 1).otherwise(0).cast("long").alias("rank"))
    ways = staged(edges.select("code", "edge_id", "node_start", "node_end", step.alias("step")), "ways")
    given = heads.join(ways, "code").select("node_start", F.struct(F.lit(2).alias("order"), F.col("edge_id").alias("head"), F.lit(0).cast("long").alias("rank"), "root").alias("value"))
    leaving = ways.groupBy(F.col("node_start").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("node_end").alias("to"), F.min("step").alias("step"))
    own = given.groupBy(F.col("node_start").alias("node")).agg(F.min("value").alias("value"))
    flagged = leaving.join(own, "node", "left").withColumn("stands", (F.col("n") > 1) | F.col("value").isNotNull())
    nothing = F.struct(F.lit(0).alias("more"), F.lit(None).cast("long").alias("head"), F.lit(0).cast("long").alias("rank"))
    now = staged(flagged.select("node", F.when(F.col("stands"), F.col("node")).otherwise(F.col("to")).alias("to"), F.when(F.col("stands"), nothing).otherwise(F.col("step")).alias("step"), "stands"), "down")
    keys = staged(flagged.where("stands").select("node", "value"), "keys")
    left = None
    while (open_now := now.where("not stands").count()) and open_now != left:
        ahead = now.select(F.col("node").alias("to"), F.col("to").alias("further"), F.col("step").alias("next"), F.col("stands").alias("there"))
        moved = now.where("not stands").join(ahead, "to").select("node", F.col("further").alias("to"), F.struct(*(c.alias(k) for k, c in _composed("step", "next").items())).alias("step"), F.col("there").alias("stands"))
        new = staged(now.where("stands").unionByName(moved), "down")
        release(now)
        now, left = new, open_now
        if rounds is not None:
            rounds.append(open_now)
    down = now.where("stands")
    # from key to key: an edge that leaves a key, then the way down from its end
    onward = ways.join(keys.select(F.col("node").alias("node_start")), "node_start", "left_semi").join(down.select(F.col("node").alias("node_end"), F.col("to"), F.col("step").alias("next")), "node_end")
    hops = staged(onward.select(F.col("node_start").alias("node"), "to", F.struct(*(c.alias(k) for k, c in _composed("step", "next").items())).alias("step")), "hops")
    best = staged(keys.select("node", "value", F.col("value").isNotNull().alias("new")), "best")
    while not best.where("new").isEmpty():
        tried = best.where("new").select(F.col("node").alias("to"), "value").join(hops, "to").select("node", _stepped("step", "value").alias("t")).groupBy("node").agg(F.min("t").alias("t"))
        better = F.col("t").isNotNull() & (F.col("value").isNull() | (F.col("t") < F.col("value")))
        new = staged(best.drop("new").join(tried, "node", "left").select("node", F.when(better, F.col("t")).otherwise(F.col("value")).alias("value"), better.alias("new")), "best")
        release(best)
        best = new
        if rounds is not None:
            rounds.append("step")
    at = down.join(best.where("value is not null").select(F.col("node").alias("to"), "value"), "to").select(F.col("node").alias("node_end"), _stepped("step", "value").alias("v"))
    carried = ways.join(at, "node_end").select("code", _stepped("step", "v").alias("t"))
    begun = heads.join(ways, "code").select("code", F.struct(F.lit(2).alias("order"), F.col("edge_id").alias("head"), F.lit(0).cast("long").alias("rank"), "root").alias("t"))
    return carried.unionByName(begun).groupBy("code").agg(F.min("t").alias("t")).select("code", "t.order", "t.head", "t.rank", "t.root")


def order_numbers(nodes: DataFrame, edges: DataFrame, outflows: DataFrame, max_order_no: int = 1000, rounds: list | None = None) -> DataFrame:
    """edges with order_no, outflow_edge, order_edge_no and rws_code/rws_order_code; -999 and "" for edges that no chain reaches.

    nodes(node_id, selected_upstream_edge), edges(code, edge_id, node_start,
    node_end), outflows(code, order_code, rws_code). Where chains meet, the
    lowest (order, outflow's edge_id, rank) wins, and its receiving water with it.
    """
    chosen = nodes.select(F.col("node_id").alias("node_end"), F.col("selected_upstream_edge").alias("_selected"))
    ways = staged(edges.select("code", "edge_id", "node_start", "node_end").join(chosen, "node_end", "left").withColumn("follows", F.coalesce(F.col("_selected") == F.col("code"), F.lit(False))).drop("_selected"), "selected")
    places = chain_places(ways, outflows.select("code", F.col("code").alias("root")), rounds).where(F.col("order") <= max_order_no)
    waters = outflows.select(F.col("code").alias("root"), F.col("order_code").alias("rws_order_code"), "rws_code")
    named = places.join(ways.select(F.col("edge_id").alias("head"), F.col("code").alias("outflow_edge")), "head").join(waters, "root")
    done = named.select("code", F.col("order").alias("order_no"), "outflow_edge", F.col("rank").alias("order_edge_no"), "rws_code", "rws_order_code")
    out = edges.join(done, "code", "left")
    return out.na.fill(-999, ["order_no", "order_edge_no"]).na.fill("", ["outflow_edge", "rws_code", "rws_order_code"])


def chain_prefixes(heads: DataFrame, links: DataFrame, rounds: list | None = None) -> DataFrame:
    """(outflow_edge, prefix): what the codes of each chain begin with. heads(outflow_edge, prefix) have it; links(outflow_edge, parent, part) hang behind their parent chain's.

    Parts are joined along the tree of chains by doubling: each round a chain takes over what its ancestor has gathered.
    """
    start = heads.select("outflow_edge", F.lit(None).cast("string").alias("parent"), F.col("prefix").alias("part"))
    now = staged(start.unionByName(links.join(heads.select("outflow_edge"), "outflow_edge", "left_anti").select(start.columns)), "prefixes")
    left = None
    while (open_now := now.where("parent is not null").count()) and open_now != left:
        above = now.select(F.col("outflow_edge").alias("parent"), F.col("parent").alias("_further"), F.col("part").alias("_part"))
        moved = now.where("parent is not null").join(above, "parent").select("outflow_edge", F.col("_further").alias("parent"), F.concat("_part", "part").alias("part"))
        new = staged(now.where("parent is null").unionByName(moved), "prefixes")
        release(now)
        now, left = new, open_now
        if rounds is not None:
            rounds.append(open_now)
    return now.where("parent is null").select("outflow_edge", F.col("part").alias("prefix"))


def order_codes(ordered: DataFrame, outflows: DataFrame, order_for_each_edge: bool = False, rounds: list | None = None) -> DataFrame:
    """Adds no_edge_codes, order_code_no and order_code.

    n(e) counts the next order's edges into e's start; an edge takes n + 1
    numbers of its chain (none if n is 0, unless order_for_each_edge). The j-th
    of them hangs below its parent as the parent's code without its last four
    characters, a dot and the parent's number plus j.
    """
    rows = staged(ordered.where("order_no > 0"), "ordered")
    tributary = rows.where("order_edge_no = 0").select(F.col("code").alias("t_code"), F.col("node_end").alias("node"), F.col("order_no").alias("t_order"), F.col("edge_id").alias("t_id"))
    parent = rows.select(F.col("code").alias("p_code"), F.col("node_start").alias("node"), F.col("order_no").alias("p_order"))
    below = staged(tributary.join(parent, (tributary["node"] == parent["node"]) & (F.col("t_order") == F.col("p_order") + 1)).select("t_code", "t_id", "t_order", "p_code"), "tributaries")
    n = below.groupBy(F.col("p_code").alias("code")).agg(F.count(F.lit(1)).alias("no_edge_codes"))
    base = F.col("no_edge_codes") + 1 if order_for_each_edge else F.when(F.col("no_edge_codes") > 0, F.col("no_edge_codes") + 1).otherwise(F.lit(0))
    numbered = windows.shifted_sum(rows.join(n, "code", "left").na.fill(0, ["no_edge_codes"]).withColumn("_base", base), "outflow_edge", "order_edge_no", "_base", "order_code_no").drop("_base")
    numbered = staged(numbered, "numbered")
    # where several edges of the parent's order leave one node, a tributary hangs below the first of them
    place = windows.keep_first(below.withColumn("j", F.row_number().over(W.partitionBy("p_code").orderBy("t_id"))), ["t_code"], ["p_code"])
    at = place.join(numbered.select(F.col("code").alias("p_code"), F.col("outflow_edge").alias("parent"), F.col("order_code_no").alias("p_no")), "p_code")
    own = F.concat(F.lit("."), g.zfill(F.col("p_no")))
    part = F.concat(F.substring(own, F.lit(1), F.length(own) - 4), F.lit("."), g.zfill(F.col("p_no") + F.col("j")))
    prefixes = chain_prefixes(outflows.select(F.col("code").alias("outflow_edge"), F.col("order_code").alias("prefix")), at.select(F.col("t_code").alias("outflow_edge"), "parent", part.alias("part")), rounds)
    coded = numbered.join(prefixes, "outflow_edge").withColumn("order_code", F.concat("prefix", F.lit("."), g.zfill(F.col("order_code_no")))).drop("prefix")
    rest = ordered.where("order_no <= 0").withColumns({"no_edge_codes": F.lit(0).cast("long"), "order_code_no": F.lit(-999).cast("long"), "order_code": F.lit("")})
    return coded.unionByName(rest.select(coded.columns))


def other_waterlines(points: DataFrame, edges: DataFrame, others: DataFrame) -> DataFrame:
    """Ditches below their outflow: others(code, outflow_node) with order_no one above and order_code "...-X0001" below the lowest (order_no, order_code) that leaves the point.

    points(point_id, x, y, node_id). Edges without an order don't count.
    """
    low = edges.where("order_no > 0").groupBy(F.col("node_start").alias("node_id")).agg(F.min(F.struct("order_no", "order_code", "code")).alias("m"))
    at = points.join(low, "node_id").select(F.col("point_id").alias("outflow_node"), F.col("m.order_no").alias("downstream_order_no"), F.col("m.order_code").alias("downstream_order_code"), F.col("m.code").alias("downstream_edges"))
    out = others.join(at, "outflow_node").withColumn("order_no", F.col("downstream_order_no") + 1)
    out = windows.numbered(out, "downstream_order_code", "code", "order_code_no")
    return out.withColumn("order_code", F.concat("downstream_order_code", F.lit("-X"), g.zfill(F.col("order_code_no"), 4)))


def outflows_near_dead_ends(dead: DataFrame, given: DataFrame, reach: float = 50.0) -> DataFrame:
    """Each given outflow point (id, x, y, order_code) with its nearest dead end (id, x, y) within reach."""
    from brookflow.operators.spatial import nearest

    return given.join(nearest(given, dead, reach).select(F.col("l_id").alias("id"), F.col("r_id").alias("node_end"), F.col("dist").alias("distance")), "id")


def outflow_numbers(points: DataFrame, ranges: DataFrame, order: str = "id") -> DataFrame:
    """points(id, rws_code, authority) numbered per receiving water from the authority's order_code_min, with the code and whether it overflows the range."""
    out = points.join(ranges, "authority")
    out = out.withColumn("rws_code_no", (F.col("order_code_min") + F.row_number().over(W.partitionBy("rws_code").orderBy(order)) - 1).cast("long"))
    return out.withColumns({"order_code": F.concat("rws_code", F.lit("."), g.zfill(F.col("rws_code_no"))), "overflows": F.col("rws_code_no") > F.col("order_code_max")})

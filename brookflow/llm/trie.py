"""Conversation prefix trie from mergeable partial tries.

A conversation is a sequence of turns (role, text), every distinct beginning is
a node, and a node is keyed by a polynomial of its turns' digests modulo the
prime 2**127 - 1. The polynomial of a run of turns turns any state into the next
one, so a long conversation is hashed in blocks, and a scan over the blocks'
polynomials gives each block the state it starts from.

Conversations lie in range partitions by id. Each partition's nodes are combined
where they are made (members summed, smallest member, list of the conversations
that end there); the partial tries of FAN neighbouring partitions are merged by
node key, then those of FAN neighbouring groups, and so on to one. Neighbours'
ids don't overlap, so sorted lists stay sorted when joined. A list of more than
`most` ids isn't joined further: its parts stand as closed blocks, whose ids are
hashed in order as one stream, since SHA-256 can't be taken in parts.

The roll-up to subtrees doubles distances: with the sums over descendants nearer
than 2**k, each node adds them to its ancestor at that distance, so a
conversation of a million turns takes twenty rounds and each round has only the
nodes deep enough for it.

Defined results: null role or text is empty; turns of one number (null first)
are ordered by role and text digest, repeated rows are turns of their own; rows
without a conversation id belong to none and are left out; without conversations
there is no node, the root included; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.llm.common import release, staged
from brookflow.llm.ordered import BITS, block, in_order

#: Partial tries that one merge takes.
FAN = 8
#: Ids of a list that is joined further.
MOST = 4096
#: Conversations whose ids differ by less share their first turns, at most MOST_SHARED.
GROUP, MOST_SHARED = 100, 5

_PRIME = (1 << 127) - 1
#: Any number below the prime that isn't small.
_BASE = int.from_bytes(hashlib.sha256(b"turns of a conversation").digest()[:15], "big")
_ROOT = b"\0" * 16


def turns(conversations: DataFrame) -> DataFrame:
    """(c, turn, role, digest, print, points): `print` is what tells turns apart, `points` the code points of the text."""
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.coalesce("role", F.lit("")).alias("role"), digest.alias("digest"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
    ).withColumn("print", F.substring(F.sha2(F.concat("role", "digest").cast("binary"), 256), 1, 32))


def shared_turns(c: str = "c") -> Column:
    """How many first turns a conversation takes from the first one of its group of ids."""
    return (F.crc32(F.col(c).cast("string")) % (MOST_SHARED + 1)).cast("int")


def rebuilt(conversations: DataFrame, bits: int = BITS) -> DataFrame:
    """(c, block, part, start, lead, own, last): blocks of conversations whose first h turns are those of conversation c - c % GROUP.

    own: turns of the block that stay; start: how many of the conversation's stay before; lead: in the first block, the turns taken over.
    """
    line = in_order(turns(conversations), "c", "turn", "role", "digest")
    made = line.groupBy("c", block(bits).alias("block")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "print", "points"))), lambda x: F.struct(x["print"], x["points"])).alias("rows"))
    whole = W.partitionBy("c")
    ahead = whole.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    n = F.size("rows").cast("long")
    blocks = staged(made.select("*", F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias("begin"), F.min("block").over(whole).alias("first"), F.max("block").over(whole).alias("final")), "turn-blocks")
    firsts = blocks.where((F.col("begin") < MOST_SHARED) & (F.col("c") % GROUP == 0)).select("c", "begin", F.slice("rows", 1, MOST_SHARED).alias("rows"))
    heads = firsts.groupBy(F.col("c").alias("head")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("begin", "rows"))), lambda x: x["rows"])).alias("taken"))
    h = shared_turns()
    drop = F.greatest(F.lit(0).cast("long"), h - F.col("begin"))
    lead = F.when(F.col("block") == F.col("first"), F.slice(F.coalesce("taken", F.array().cast(heads.schema["taken"].dataType)), F.lit(1), h))
    joined = blocks.join(heads, F.col("c") - F.col("c") % GROUP == F.col("head"), "left")
    return joined.select(
        "c", "block", F.shiftright("first", 33 - bits).alias("part"), F.least(F.size(F.coalesce("taken", F.array().cast(heads.schema["taken"].dataType))), h).cast("long").alias("leads"),
        F.greatest(F.lit(0).cast("long"), F.col("begin") - h).alias("start"), lead.alias("lead"), F.slice("rows", (drop + 1).cast("int"), F.size("rows")).alias("own"),
        (F.col("block") == F.col("final")).alias("last"), (F.col("first") < F.col("final")).alias("several"),
    )


def _on(state: int, rows: list[dict]) -> int:
    for r in rows:
        state = (state * _BASE + int(r["print"], 16) + 1) % _PRIME
    return state


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _each(df: DataFrame, of, schema: str) -> DataFrame:
    """The rows (tuples) that `of` yields for each row of df."""
    kinds = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                made = [x for row in batch.slice(at, 256).to_pylist() for x in of(row)]
                for i in range(0, len(made), 8192):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made[i : i + 8192]), kinds.types, strict=True)], schema=kinds)

    return df.mapInArrow(run, schema)


def _summary(row: dict) -> Iterator[tuple]:
    yield row["c"], row["block"], len(row["own"]), f"{_on(0, row['own']):032x}", f"{_on(0, row['lead']):032x}" if row["lead"] is not None else None


def _states(row: dict) -> Iterator[tuple]:
    """The state that each block starts from."""
    state = int(row["parts"][0]["led"], 16)
    for x in row["parts"]:
        yield row["c"], x["block"], f"{state:032x}"
        state = (state * pow(_BASE, x["n"], _PRIME) + int(x["poly"], 16)) % _PRIME


def _nodes(row: dict) -> Iterator[tuple]:
    """(node, parent, depth, points, members, conv, ends, part) of a block's turns; the root and the turns taken over come with the first block."""
    c, part = row["c"], row["part"]
    state, key, depth = 0, _ROOT, 0
    runs = [row["own"]]
    if row["lead"] is not None:
        yield _ROOT, None, 0, 0, 1, c, [], part
        runs = [row["lead"], row["own"]]
    else:
        state, depth = int(row["state"], 16), row["leads"] + row["start"]
        key = state.to_bytes(16, "big")
    for run in runs:
        for r in run:
            state = (state * _BASE + int(r["print"], 16) + 1) % _PRIME
            above, key, depth = key, state.to_bytes(16, "big"), depth + 1
            yield key, above, depth, r["points"], 1, c, [], part
    if row["last"]:
        yield key, None, depth, 0, 0, c, [c], part


_NODE = "node binary, parent binary, depth long, points long, members long, conv long, ends array<long>, part long"


def nodes(blocks: DataFrame) -> DataFrame:
    """A row per turn of rebuilt conversations, per conversation for the root, and per conversation's end."""
    parts = _each(blocks.where("several"), _summary, "c long, block long, n long, poly string, led string")
    chains = parts.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("block", "n", "poly", "led"))).alias("parts"))
    states = _each(chains, _states, "c long, block long, state string")
    return _each(blocks.join(states, ["c", "block"], "left"), _nodes, _NODE)


def merged(made: DataFrame, parts: int, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(nodes, blocks) of partial tries of `parts` partitions: one row per node, with its list of ends unless that is closed, and the closed blocks (node, first, ends)."""
    def combined(rows: DataFrame, group: Column) -> DataFrame:
        own = F.col("ends")
        lists = F.array_sort(F.filter(F.collect_list(F.struct(F.when(F.size(own) > 0, own[0]).alias("first"), own.alias("ends"))), lambda x: x["first"].isNotNull()))
        return rows.groupBy("node", group.alias("part")).agg(
            F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("points").alias("points"), F.sum("members").alias("members"),
            F.min("conv").alias("conv"), lists.alias("lists"), F.bool_or("closed").alias("closed"),
        ).withColumn("closed", F.col("closed") | (F.aggregate("lists", F.lit(0), lambda n, x: n + F.size(x["ends"])) > most))

    def joined(rows: DataFrame) -> DataFrame:
        ends = F.when(F.col("closed"), F.array().cast("array<long>")).otherwise(F.flatten(F.transform("lists", lambda x: x["ends"])))
        return rows.withColumn("ends", ends).drop("lists")

    closed, now, left = [], made.withColumn("closed", F.lit(False)), parts
    group = F.col("part")
    while True:
        rows = staged(combined(now, group), "tries")
        closed.append(rows.where("closed").select("node", F.explode("lists").alias("x")).select("node", "x.first", "x.ends"))
        now = joined(rows)
        if left <= 1:
            break
        left, group = -(-left // FAN), F.floor(F.col("part") / FAN).cast("long")
    blocks = closed[0]
    for more in closed[1:]:
        blocks = blocks.unionByName(more)
    return now.drop("part"), blocks


def _stream_digests(blocks: DataFrame) -> DataFrame:
    """(node, ends_sha256) of closed blocks, each node's as one stream."""
    kinds = _arrow("node binary, ends_sha256 string")
    texts = blocks.select("node", "first", F.array_join(F.col("ends").cast("array<string>"), ",").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            for at in range(0, len(batch), 64):
                for r in batch.slice(at, 64).to_pylist():
                    if r["node"] != node:
                        if node is not None:
                            done.append((node, digest.hexdigest()))
                        node, digest = r["node"], hashlib.sha256(r["text"].encode())
                    else:
                        digest.update(b"," + r["text"].encode())
        if node is not None:
            done.append((node, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds.types, strict=True)], schema=kinds)

    return texts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(run, "node binary, ends_sha256 string")


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """(node, values): sums over each node and all below it of tree(node, parent, depth, values), as rows to be added up by node.

    Round k has the nodes of depth 2**k and more, with the sums of those nearer than 2**k below them and the ancestor at that distance.
    """
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    pieces, step = tree.select("node", *values), 1
    active = tree.where("depth >= 1").select("node", F.col("parent").alias("above"), "depth", *values)
    while step <= deepest:
        given = staged(active.groupBy(F.col("above").alias("node")).agg(*(F.sum(v).alias(v) for v in values)), "sums")
        pieces = pieces.unionByName(given)
        step *= 2
        if step <= deepest:
            ahead = active.select(F.col("node").alias("above"), F.col("above").alias("further"))
            got = given.select("node", *(F.col(v).alias(f"_{v}") for v in values))
            nearer = active.where(F.col("depth") >= step).join(ahead, "above").join(got, "node", "left")
            new = staged(nearer.select("node", F.col("further").alias("above"), "depth", *((F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values)), "deep")
            if step > 2:
                release(active)
            active = new
    return pieces


def prefix_trie(conversations: DataFrame, bits: int = BITS, most: int = MOST) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node, parent.

    saved_tokens: over the node's subtree, (members - 1) times the code points of the node's text.
    """
    parts = max(1, int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tries, blocks = merged(nodes(rebuilt(conversations, bits)), parts, most)
    below = tries.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")).where("node is not null")
    none = F.lit(0).cast("long")
    tree = tries.join(below, "node", "left").select(
        "node", "parent", "depth", F.col("conv").alias("conv_id"), F.col("members").alias("n_convs"), F.coalesce("n_children", none).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("members") - 1) * F.col("points")).alias("saved_tokens"),
        F.when(~F.col("closed"), F.sha2(F.array_join(F.col("ends").cast("array<string>"), ",").cast("binary"), 256)).alias("ends_sha256"),
    )
    tree = staged(tree, "tree")
    sums = subtree_sums(tree, ["n_leaves", "saved_tokens"])
    rows = tree.drop("n_leaves", "saved_tokens")
    all_of = rows.unionByName(sums, allowMissingColumns=True).unionByName(_stream_digests(blocks), allowMissingColumns=True).groupBy("node").agg(
        *(F.max(c).alias(c) for c in rows.columns if c != "node"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
    )
    above = tree.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return all_of.join(above, "parent", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "node", "parent")

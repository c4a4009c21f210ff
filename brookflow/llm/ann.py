"""Nearest neighbours by a forest of random-projection trees.

The forest is grown on the driver from a sample (about SAMPLE vectors, those with
the least hashes of their ids, and at most SAMPLE_BYTES): a node splits its part
of the sample at the median along a random direction (a tree's nodes of one depth
share it), until a leaf stands for about LEAF vectors of the whole table or holds
LEAST of the sample. So trees deepen with the table. Every vector is then indexed:
it gets one leaf per tree. A query walks all trees with one shared priority queue,
always opening the node whose cell is nearest (the sum of squared margins on the
way to it), until it has visited `visits` leaves; its candidates are the members of
those leaves, reranked by exact Euclidean distance in double precision on the
original vectors.

How many leaves that takes depends on the data: a few where vectors lie in
clusters or near a surface, a large part of them where neighbours are hardly nearer
than others. So it is measured: PROBES queries are held against all rows by brute
force (one pass), and `visits` is the least number that finds RECALL of their true
neighbours. plan() returns it with the measured recall.

Candidates aren't written as pairs: members and queries meet per subtree of about
BUCKET members, a query's vector once for all its leaves there, and each meeting
returns a query's k best alone. A subtree of more than CHUNK members (say, of one
very common vector) is dealt in chunks, and its queries in blocks of as many, by hash.

Vectors that are null, of another length than most, all zero, or that hold null
or non-finite components take no part, nor do rows without an id. Repeated rows
of an id are one candidate (the nearer, if they differ). With k candidates or
fewer all are returned, as a query visits leaves of some tree that hold more than
k of the sample, or all. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.llm.common import staged

TREES, SAMPLE, SAMPLE_BYTES, LEAF, LEAST, DEPTH = 8, 65536, 32 << 20, 64, 8, 40
BUCKET, CHUNK = 4096, 8192
PROBES, RECALL = 96, 0.95


@dataclass
class Forest:
    """Nodes of all trees: node n splits along direction kinds[n] at offsets[n]; with children[n][0] < 0 it is the leaf -1 - children[n][0]."""

    directions: np.ndarray
    kinds: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: list[int]
    #: Per leaf: its tree, its sample vectors, and the subtree (bucket) at which its members and queries meet.
    trees: np.ndarray
    sizes: np.ndarray
    buckets: np.ndarray

    def assign(self, x: np.ndarray) -> np.ndarray:
        """(vectors, trees): the leaf of each vector in each tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        along = x @ self.directions.T
        for t, root in enumerate(self.roots):
            node = np.full(len(x), root)
            going = np.arange(len(x))
            while len(going):
                at = node[going]
                inner = self.children[at, 0] >= 0
                out[going[~inner], t] = -1 - self.children[at[~inner], 0]
                going, at = going[inner], at[inner]
                side = (along[going, self.kinds[at]] > self.offsets[at]).astype(np.int64)
                node[going] = self.children[at, side]
        return out

    def search(self, q: np.ndarray, visits: int, more_than: int) -> list[int]:
        """Leaves of all trees, nearest cell first, from one shared priority queue: `visits` of them, and more_than sample vectors in some tree."""
        along = self.directions @ q
        queue = [(0.0, r) for r in self.roots]
        found: list[int] = []
        seen = [0] * len(self.roots)
        enough = False
        while queue and not (enough and len(found) >= visits):
            gap, node = heapq.heappop(queue)
            left, right = self.children[node]
            if left < 0:
                leaf = -1 - int(left)
                found.append(leaf)
                seen[self.trees[leaf]] += int(self.sizes[leaf])
                enough = enough or seen[self.trees[leaf]] > more_than
                continue
            m = along[self.kinds[node]] - self.offsets[node]
            far = gap + m * m
            heapq.heappush(queue, (far if m > 0 else gap, int(left)))
            heapq.heappush(queue, (gap if m > 0 else far, int(right)))
        return found


def grow(x: np.ndarray, trees: int = TREES, leaf: int = LEAF, bucket: int = BUCKET, seed: int = 11) -> Forest:
    """A forest over the rows of x: leaves of at most `leaf` of them, buckets of at most `bucket`; equal rows stay in one leaf."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(trees * DEPTH, x.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    kinds, offsets, children, roots, tree, sizes, buckets, count = [], [], [], [], [], [], [], 0

    def node() -> int:
        kinds.append(0)
        offsets.append(0.0)
        children.append([0, 0])
        return len(children) - 1

    for t in range(trees):
        along = x @ directions[t * DEPTH : (t + 1) * DEPTH].T
        roots.append(node())
        stack = [(roots[-1], np.arange(len(x)), 0, -1)]
        while stack:
            at, rows, depth, held = stack.pop()
            if held < 0 and len(rows) <= bucket:
                held, count = count, count + 1
            here, cut = None, 0.0
            while len(rows) > leaf and depth < DEPTH and here is None:  # a direction that doesn't separate the rows is passed over
                values = along[rows, depth]
                low, cut, high = values.min(), np.median(values), values.max()
                if low < high:
                    cut = cut if cut < high else (low + high) / 2
                    here = values > cut
                else:
                    depth += 1
            if here is None:
                if held < 0:
                    held, count = count, count + 1
                children[at] = [-1 - len(tree), -1 - len(tree)]
                tree.append(t)
                sizes.append(len(rows))
                buckets.append(held)
                continue
            kinds[at], offsets[at] = t * DEPTH + depth, float(cut)
            for side, part in ((0, rows[~here]), (1, rows[here])):
                children[at][side] = node()
                stack.append((children[at][side], part, depth + 1, held))
    as_ints = [np.array(v, np.int64) for v in (kinds, tree, sizes, buckets)]
    return Forest(directions, as_ints[0], np.array(offsets), np.array(children, np.int64), roots, *as_ints[1:])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the rows that take part, staged, and their number; v holds the components' bytes, float32 where the column does."""
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull()).where(finite)
    lengths = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    size, count = (lengths[0]["size"], lengths[0]["count"]) if lengths else (0, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = size * (4 if kind == "float" else 8)
        for batch in batches:
            flat = np.ascontiguousarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), f"<f{width // max(size, 1)}")
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), batch.num_rows, [None, pa.py_buffer(flat)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), raw], ["vec_id", "v"])

    packed = staged(rows.where(F.size("v") == size).mapInArrow(run, "vec_id long, v binary"), "vectors")
    return packed, count


def _matrix(raws, single: bool) -> np.ndarray:
    """Vectors of a column of bytes, in double precision."""
    raws = raws if isinstance(raws, list) else raws.to_pylist()
    return np.frombuffer(b"".join(raws), "<f4" if single else "<f8").reshape(len(raws), -1).astype(np.float64)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k least (score, id), each id once."""
    keep = np.arange(len(ids))
    if len(ids) > 4 * k:  # whatever may be among the k least ids: all within the score of the k-th, widened while ids repeat
        take = 2 * k
        while take < len(ids):
            near = np.flatnonzero(score <= np.partition(score, take - 1)[take - 1])
            if len(np.unique(ids[near])) >= k:
                keep = near
                break
            take *= 4
    order = keep[np.lexsort((ids[keep], score[keep]))]
    _, firsts = np.unique(ids[order], return_index=True)
    return order[np.sort(firsts)[:k]]


_FOUND = "query_id long, vec_id long, score double"


def _top(found: DataFrame, k: int) -> DataFrame:
    each = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(rows: DataFrame, queries: dict[int, np.ndarray], k: int, single: bool) -> DataFrame:
    """(query_id, rank, vec_id, score): the true k nearest of a bounded set of queries among all of rows (vec_id, v), in one pass."""
    ids, q = np.array(list(queries), np.int64), np.array(list(queries.values()), np.float64).reshape(len(queries), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                mine, x = part.column(0).to_numpy(), _matrix(part.column(1), single)
                for one, v in zip(ids, q, strict=True):
                    others = np.flatnonzero(mine != one)
                    score = np.sqrt(((x[others] - v) ** 2).sum(axis=1))
                    best = _best(mine[others], score, k)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), one)), pa.array(mine[others][best]), pa.array(score[best])], ["query_id", "vec_id", "score"])

    return _top(rows.select("vec_id", "v").mapInArrow(run, _FOUND), k)


@dataclass
class Plan:
    """A forest, the leaves that a query visits, and what was measured: the probes' recall and their share of distinct candidates (of the sample)."""

    forest: Forest
    visits: int
    recall: float
    share: float


def _drawn(rows: DataFrame, count: int, most: int) -> tuple[np.ndarray, list[bytes]]:
    """About `most` rows of different ids, by hash of their ids; all, if there are fewer."""
    part = min(1.0, most / max(count, 1))
    chosen = rows if part == 1 else rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    got = chosen.groupBy("vec_id").agg(F.min("v").alias("v")).toArrow()
    order = np.argsort(got["vec_id"].to_numpy())
    return got["vec_id"].to_numpy()[order], got["v"].take(pa.array(order)).to_pylist()


def plan(rows: DataFrame, count: int, single: bool, *, every: int, k: int, trees: int, sample: int, leaf: int, recall: float) -> Plan:
    """Grow the forest and measure how many leaves reach the recall."""
    width = len(rows.select("v").head(1)[0]["v"]) if count else 8
    most = max(1, min(sample, SAMPLE_BYTES // width))
    ids, raws = _drawn(rows, count, most)
    x = _matrix(raws, single) if len(ids) else np.zeros((0, 1))
    scale = len(ids) / max(count, 1)
    forest = grow(x, trees, max(LEAST, round(leaf * scale)), max(LEAST, round(BUCKET * scale)))
    asked = rows.where(F.col("vec_id") % every == 0)
    probes = dict(zip(*_drawn(asked, max(1, count // every), PROBES), strict=True)) if count else {}
    probes = dict(list(probes.items())[: 2 * PROBES])
    if not probes:
        return Plan(forest, 1, 1.0, 1.0)
    queries = {i: _matrix([v], single)[0] for i, v in probes.items()}
    true = brute_force(rows, queries, k, single).collect()  # at most k rows a probe
    if not true:
        return Plan(forest, 1, 1.0, 1.0)
    near = {r["vec_id"]: r["v"] for r in rows.where(F.col("vec_id").isin([r["vec_id"] for r in true])).groupBy("vec_id").agg(F.min("v").alias("v")).collect()}
    leaves = forest.assign(_matrix([near[r["vec_id"]] for r in true], single))
    turns = {}  # per probe, when each leaf's turn comes
    for i, q in queries.items():
        order = forest.search(q, len(forest.sizes), len(ids))
        turns[i] = np.empty(len(order), np.int32)
        turns[i][order] = np.arange(len(order))
    needed = np.sort([turns[r["query_id"]][mine].min() + 1 for r, mine in zip(true, leaves, strict=True)])
    visits = int(needed[max(0, int(np.ceil(recall * len(needed))) - 1)])
    met = 0
    for at in range(0, len(x), 4096):
        where = forest.assign(x[at : at + 4096])
        met += sum(int((turn[where] < visits).any(axis=1).sum()) for turn in turns.values())
    share = met / (len(x) * len(turns))
    return Plan(forest, visits, float((needed <= visits).mean()), float(share))


def _blocks(size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col("n") / size)).cast("int")


def nearest(vectors: DataFrame, *, every: int = 100, k: int = 10, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose id is divisible by `every`, among all other rows."""
    rows, count = usable(vectors, id_col, vector_col)
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"

    made = plan(rows, count, single, every=every, k=k, trees=trees, sample=sample, leaf=leaf, recall=recall)
    return search(rows, made, single, every=every, k=k)


def search(rows: DataFrame, made: Plan, single: bool, *, every: int, k: int) -> DataFrame:
    """The k nearest that a plan finds; rows: (vec_id, v) as usable gives them."""
    shared = rows.sparkSession.sparkContext.broadcast(made.forest)  # bounded by the sample: trees * sample / LEAST leaves
    visits = made.visits

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        total = np.zeros(int(forest.buckets.max(initial=0)) + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                leaves = forest.assign(_matrix(batch.column(1).slice(at, 4096), single))
                total += np.bincount(forest.buckets[leaves.reshape(-1)], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                leaves = forest.assign(_matrix(part.column(1), single))
                take = pa.array(np.repeat(np.arange(part.num_rows), leaves.shape[1]))
                flat = leaves.reshape(-1)
                yield pa.RecordBatch.from_arrays([pa.array(forest.buckets[flat]), pa.array(flat), part.column(0).take(take), part.column(1).take(take)], ["bucket", "leaf", "vec_id", "v"])

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                leaves = np.array(forest.search(_matrix([raw], single)[0], visits, k), np.int64)
                where = forest.buckets[leaves]
                order = np.argsort(where, kind="stable")
                buckets, firsts = np.unique(where[order], return_index=True)
                parts = [np.sort(p) for p in np.split(leaves[order], firsts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(np.full(len(buckets), i)), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([raw] * len(parts), pa.binary())], ["bucket", "query_id", "leaves", "v"])

    asked = staged(rows.where(F.col("vec_id") % every == 0).dropDuplicates().mapInArrow(queries, "bucket long, query_id long, leaves binary, v binary"), "queries")
    held = rows.mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).select("bucket", _blocks(CHUNK).alias("chunks"))
    split = staged(held.join(asked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select("bucket", _blocks(CHUNK).alias("blocks")), "bucket"), "buckets")
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    every_chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    left = rows.mapInArrow(members, "bucket long, leaf long, vec_id long, v binary").join(split, "bucket")
    left = left.select("bucket", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int").alias("chunk"), every_block.alias("block"), "leaf", "vec_id", "v")
    right = asked.join(split, "bucket").select("bucket", every_chunk.alias("chunk"), F.pmod(F.xxhash64("query_id"), "blocks").cast("int").alias("block"), "query_id", "leaves", "v")

    def meet(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(mine) and len(theirs):
            mine = mine.sort_values("leaf", kind="stable")
            x, ids, leaf = _matrix(list(mine["v"]), single), mine["vec_id"].to_numpy(), mine["leaf"].to_numpy()
            for query, leaves, raw in zip(theirs["query_id"], theirs["leaves"], theirs["v"], strict=True):
                wanted = np.frombuffer(leaves, np.int64)
                begin, end = np.searchsorted(leaf, wanted), np.searchsorted(leaf, wanted, side="right")
                near = np.repeat(begin - np.cumsum(end - begin) + (end - begin), end - begin) + np.arange((end - begin).sum())
                near = near[ids[near] != query]
                score = np.sqrt(((x[near] - _matrix([raw], single)) ** 2).sum(axis=1))
                best = _best(ids[near], score, k)
                out["query_id"].append(np.full(len(best), query))
                out["vec_id"].append(ids[near][best])
                out["score"].append(score[best])
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in out.items()})

    met = left.groupBy("bucket", "chunk", "block").cogroup(right.groupBy("bucket", "chunk", "block")).applyInPandas(meet, _FOUND)
    return _top(met, k)

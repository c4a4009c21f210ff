"""Packing token sequences: exact-complement hashing, then best fit.

Texts are tokenized, closed by an end id and cut into pieces of at most
`capacity` ids. Only the histogram of piece lengths - at most `capacity` rows,
whatever the input - is planned on the driver: sums of one, two and three
available lengths are indexed; a sequence opened by the longest length left
takes the combination that fills its gap exactly, as often as the counts allow;
where no combination fits exactly, the longest length that fits goes in and the
smaller gap is looked up again. The plan is a list of runs (lengths, times).

A piece finds its place without a sort of all pieces: its rank among those of
its length is the count in earlier tasks (a prefix sum over task x length
counts) plus its number within its task, and a run covers an interval of ranks
of each of its lengths. So a length that a third of all pieces share is no
heavier than any other.

Defined results: a null or empty text is the end id alone; repeated rows and
null ids are pieces like any other; an empty table packs into nothing; columns
other than the id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.llm.common import staged
from brookflow.llm.tokens import encoded_blocks

CAPACITY = 2048


class _Sums:
    """Which sums of one, two and three available lengths occur: ordered tuples are counted per sum, and kept right as lengths run out."""

    def __init__(self, counts: np.ndarray) -> None:
        self.n = len(counts)
        self.one = (counts > 0).astype(np.int64)
        self.one[0] = 0
        self.two = np.convolve(self.one, self.one)[: self.n]
        self.three = np.convolve(self.one, self.two)[: self.n]

    def exhaust(self, x: int) -> None:
        """(f - d)^2 = f^2 - 2 d f + d^2 and (f - d)^3 = f^3 - 3 d f^2 + 3 d^2 f - d^3, with d the length's own indicator."""
        n, one, two = self.n, self.one.copy(), self.two.copy()
        self.three[x:] -= 3 * two[: n - x]
        self.two[x:] -= 2 * one[: n - x]
        if 2 * x < n:
            self.three[2 * x :] += 3 * one[: n - 2 * x]
            self.two[2 * x] += 1
        if 3 * x < n:
            self.three[3 * x] -= 1
        self.one[x] = 0

    def pairs(self, gap: int) -> np.ndarray:
        """Larger halves of the available pairs that fill the gap, largest first."""
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        return a[(self.one[a] > 0) & (self.one[gap - a] > 0)]

    def heads(self, gap: int) -> np.ndarray:
        a = np.arange(gap - 2, 0, -1)
        return a[(self.one[a] > 0) & (self.two[gap - a] > 0)]


def plan_runs(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence, number of such sequences)] that use up counts[length] pieces of every length."""
    left = np.zeros(capacity + 1, np.int64)
    left[: len(counts)] = counts
    sums = _Sums(left)
    runs: list[tuple[tuple[int, ...], int]] = []

    def fits(used: Counter, more: tuple[int, ...]) -> bool:
        need = used + Counter(more)
        return all(left[x] >= k for x, k in need.items())

    def exact(used: Counter, gap: int) -> tuple[int, ...]:
        if sums.one[gap] and fits(used, (gap,)):
            return (gap,)
        if gap > 1 and sums.two[gap]:
            for a in map(int, sums.pairs(gap)):
                if fits(used, (a, gap - a)):
                    return a, gap - a
        if gap > 2 and sums.three[gap]:
            for a in map(int, sums.heads(gap)):
                for b in map(int, sums.pairs(gap - a)):
                    if b <= a and fits(used, (a, b, gap - a - b)):
                        return a, b, gap - a - b
        return ()

    for longest in range(capacity, 0, -1):
        while left[longest]:
            used, gap = Counter([longest]), capacity - longest
            while gap:
                if more := exact(used, gap):
                    used.update(more)
                    break
                below = np.flatnonzero(left[1 : gap + 1] > [used[x] for x in range(1, gap + 1)]) + 1
                if not len(below):
                    break
                used[int(below[-1])] += 1
                gap -= int(below[-1])
            times = min(int(left[x]) // k for x, k in used.items())
            runs.append((tuple(sorted(used.elements(), reverse=True)), times))
            for x, k in used.items():
                left[x] -= k * times
                if not left[x]:
                    sums.exhaust(x)
    return runs


def slots(runs: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first rank, offset) for each place of each run."""
    used: Counter = Counter()
    out, sequence = [], 0
    for lengths, times in runs:
        offset = 0
        for x in lengths:
            out.append((x, used[x], used[x] + times, sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return out


def cut_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32, ids) of all texts, staged, with the task (part) that cut them and their number among its pieces of that length (local).

    Without ids, only their crc32 is kept, taken where they are made.
    """
    kinds = {"part": pa.int32(), "local": pa.int64(), "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    if with_ids:
        kinds["ids"] = pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for at, to, ids, first in encoded_blocks(tokenizer_path, batch.column(1), end_id):
                pieces = -(-np.diff(first) // capacity)
                text = np.repeat(np.arange(to - at), pieces)
                piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(np.diff(first)[text] - start, capacity)
                order = np.argsort(length, kind="stable")
                local = np.empty(len(order), np.int64)
                counts = np.bincount(length, minlength=capacity + 1)
                local[order] = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
                seen += counts
                begin = first[text] + start
                spans = [ids[i:j] for i, j in zip(begin, begin + length, strict=True)]
                made = [np.full(len(text), part), local, batch.column(0).slice(at, to - at).take(pa.array(text)), piece, start, length, [zlib.crc32(x) for x in spans]]
                if with_ids:
                    made.append([x.tobytes() for x in spans])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(made, kinds.values(), strict=True)], list(kinds))

    schema = "part int, local long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return staged(made, "pieces")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (which keep their other columns) of cut_pieces."""
    spark = pieces.sparkSession
    held = staged(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    places = spark.createDataFrame(slots(plan_runs(counts, capacity)), "length long, first long, end long, sequence long, offset long")
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = held.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    # the plan has a few rows per length: its size is bounded by the capacity
    placed = ranked.join(F.broadcast(places), (ranked["length"] == places["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    keep = [pieces[c] for c in pieces.columns if c not in ("part", "local", "length")]
    return placed.select(*keep, ranked["length"], (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the pieces of each sequence joined in order; a sequence has at most `capacity` ids."""
    members = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(members, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def packed_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces with their ids' crc32 and their place. The crc is taken where the ids are made: they are neither written nor shuffled."""
    pieces = cut_pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id, with_ids=False)
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

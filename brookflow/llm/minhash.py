"""Near-duplicates by circulant MinHash, confirmed by exact Jaccard similarity.

A document's set holds its distinct runs of five words (words: longest runs
without blanks and \\t\\n\\v\\f\\r, A-Z folded; with fewer words the whole
sequence; without words, nothing). Two permutations make all signature
coordinates: the first spreads the shingle hashes over 2**32 places, the second,
shifted by k places round the circle, orders them for coordinate k, whose
value is the least of the set.

1. One pass over the texts makes, per document, its set's size and 128-bit
   hash, a signature of one byte per coordinate and the band keys (some
   coordinates each).
2. Documents with equal sets are one class, so a thousand exact copies cost one.
   Its text is that of its least document (doc_id, text's hash).
3. Classes that share a band key form a bucket; buckets with the same members
   are the same bucket. In a bucket (in portions of PORTION members), the member
   whose signature agrees most with the bucket's commonest bytes is compared
   with the others (a bucket of two is one pair); those whose signatures disagree are compared with the next
   such member, and so on. That yields at most one pair per member. The leaders
   of a bucket's portions meet in further rounds, dealt anew, as long as that makes them fewer.
4. Pairs are confirmed on the full sets, and confirmed links joined to
   components. Buckets that still hold several components then yield every pair
   of members of different components whose signatures may agree; those pairs
   are confirmed too, and the components joined again. So no link between
   different texts is left out because its bucket was large.

Everything follows from the threshold (Bounds). A link at the threshold shares no
band with a probability of MISSED at most: 22 bands of five coordinates at 85 %, 25
of four at 80 %. Its signature's agreement falls short of the cut-off as rarely.

Defined results: a null or empty text, or one of blanks, has the set size 0 and
is linked with nothing; repeated rows are copies; rows with a null doc_id are
linked with nothing and kept; rows of one doc_id with different texts are compared
each by its own text (and aren't linked by their id); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookflow.llm import common
from brookflow.llm.common import staged
from brookflow.llm.graph import components

SHINGLE = 5
COORDINATES, WIDE_COORDINATES = 128, 512
PORTION = 2048
#: A link at the threshold shares no band with this probability at most.
MISSED = 3e-6
#: Signatures whose agreement is more than so many standard deviations below the threshold are no link.
DEVIATIONS = 4.75


@dataclass(frozen=True)
class Bounds:
    """What may be a link of least_percent similarity: `bands` keys of `rows` coordinates, and the least agreement of signatures (open buckets are searched with wide ones)."""

    least_percent: int
    coordinates: int
    rows: int
    bands: int
    estimate: float
    wide_estimate: float


def bounds_of(least_percent: int) -> Bounds:
    """The bands have as many rows as COORDINATES allows at MISSED; where even one row needs more of them, the signature grows."""
    if not 0 < least_percent <= 100:
        raise ValueError("least_percent is above 0 and at most 100")
    t = least_percent / 100

    def bands(rows: int) -> int:
        return 1 if t == 1 else int(np.ceil(np.log(MISSED) / np.log1p(-(t**rows))))

    rows = max((r for r in range(1, COORDINATES + 1) if r * bands(r) <= COORDINATES), default=1)
    coordinates = max(COORDINATES, rows * bands(rows))
    estimate, wide = (t - DEVIATIONS * np.sqrt(t * (1 - t) / n) for n in (coordinates, max(coordinates, WIDE_COORDINATES)))
    return Bounds(least_percent, coordinates, rows, bands(rows), float(estimate), float(wide))


def sets_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, sorted distinct shingle hashes, firsts) of a string column, in blocks."""
    for at, to, data, starts, ends in common.text_blocks(column):
        words, first = common.word_hashes(data, starts, ends)
        hashes, begin = common.shingle_hashes(words, first, SHINGLE)
        parts = [np.unique(hashes[i:j]) for i, j in zip(begin[:-1], begin[1:], strict=True)]
        sizes = np.array([len(p) for p in parts], np.int64)
        yield at, to, np.concatenate(parts) if parts else hashes, np.concatenate([[0], np.cumsum(sizes)])


def circulant_signatures(hashes: np.ndarray, first: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """(texts, coordinates) uint32; rows of empty sets are all ones."""
    sizes = np.diff(first)
    out = np.full((len(sizes), coordinates), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(sizes)
    if len(some):
        place = (common.mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)  # first permutation
        shifted, order, tmp = np.empty_like(place), np.empty_like(place), np.empty_like(place)
        for k in range(coordinates):
            np.add(place, np.uint32(k), out=shifted)  # the second, shifted round the circle of 2**32 places
            out[some, k] = np.minimum.reduceat(common.mix32(shifted, order, tmp), first[some])
    return out


def signatures(docs: DataFrame, bounds: Bounds, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n, h1, h2, bands array<long>, sig binary) per row; h1 and h2 are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, hashes, first in sets_of(batch.column(1)):
                sizes = np.diff(first)
                full = circulant_signatures(hashes, first, bounds.coordinates)
                h = [np.array([x[i:j].sum(dtype=np.uint64) if j > i else 0 for i, j in zip(first[:-1], first[1:], strict=True)], np.uint64) for x in (hashes, common.mix64(hashes ^ np.uint64(0xABCDEF)))]
                bands = np.empty((to - at, bounds.bands), np.uint64)
                with np.errstate(over="ignore"):
                    for b in range(bounds.bands):
                        key = np.full(to - at, b + 1, np.uint64)
                        for r in range(bounds.rows):
                            key = common.mix64(key * np.uint64(0x9E3779B97F4A7C15) + full[:, b * bounds.rows + r])
                        bands[:, b] = key
                low = (full & 0xFF).astype(np.uint8)
                empty = sizes == 0
                offsets = np.arange(0, (to - at + 1) * bounds.bands, bounds.bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, to - at), batch.column(2).slice(at, to - at), pa.array(sizes), pa.array(h[0].view(np.int64), mask=empty), pa.array(h[1].view(np.int64), mask=empty),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.reshape(-1).view(np.int64))), pa.array([x.tobytes() for x in low], pa.binary()),
                ], ["doc_id", "text_hash", "n", "h1", "h2", "bands", "sig"])

    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return made.mapInArrow(run, "doc_id long, text_hash long, n long, h1 long, h2 long, bands array<long>, sig binary")


def wide_signatures(texts: DataFrame, bounds: Bounds) -> DataFrame:
    """(cls, sig) with WIDE_COORDINATES bytes, or more if bounds has more, for each of texts (cls, text)."""
    coordinates = max(bounds.coordinates, WIDE_COORDINATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, hashes, first in sets_of(batch.column(1)):
                low = (circulant_signatures(hashes, first, coordinates) & 0xFF).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array([x.tobytes() for x in low], pa.binary())], ["cls", "sig"])

    return texts.select("cls", "text").mapInArrow(run, "cls long, sig binary")


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)


def _may_link(sig: np.ndarray, n: np.ndarray, one: int, estimate: float, least_percent: int) -> np.ndarray:
    """Whether each row may be linked with row `one`: by its signature and set size."""
    agree = (sig == sig[one]).mean(axis=1)
    return (agree >= estimate) & (100 * np.minimum(n, n[one]) >= least_percent * np.maximum(n, n[one]))


def _leaders(pdf: pd.DataFrame, bounds: Bounds) -> tuple[list[int], list[tuple[int, int]]]:
    """Leaders' positions, and (leader, member) positions, of one portion of a bucket."""
    sig, n = _matrix(pdf), pdf["n"].to_numpy()
    left, leaders, pairs = np.arange(len(pdf)), [], []
    while len(left):
        here = sig[left]
        commonest = np.array([np.bincount(c).argmax() for c in here.T], np.uint8)
        one = int(left[(here == commonest).sum(axis=1).argmax()])
        linked = _may_link(sig[left], n[left], int(np.flatnonzero(left == one)[0]), bounds.estimate, bounds.least_percent)
        leaders.append(one)
        pairs += [(one, int(x)) for x in left[linked] if x != one]
        left = left[~linked & (left != one)]
    return leaders, pairs


_PAIRS = "a long, b long"


def _leader_pairs(pdf: pd.DataFrame, bounds: Bounds) -> pd.DataFrame:
    ids = pdf["cls"].to_numpy()
    leaders, pairs = _leaders(pdf, bounds)
    made = [(ids[x], ids[x], True) for x in leaders] + [(ids[x], ids[y], False) for x, y in pairs]
    return pd.DataFrame(made, columns=["a", "b", "leads"]).assign(bucket=pdf["bucket"].iloc[0])


def _open_pairs(pdf: pd.DataFrame, bounds: Bounds) -> pd.DataFrame:
    """Pairs of different components that may be linked, each between the blocks that this group pairs.

    A pair that shares several open buckets (own: a class's) comes from the least of them alone.
    """
    pdf = pdf.sort_values("component", kind="stable").reset_index(drop=True)
    sig, n, comp, block, ids = _matrix(pdf), pdf["n"].to_numpy(), pdf["component"].to_numpy(), pdf["block"].to_numpy(), pdf["cls"].to_numpy()
    across = pdf["block_a"].iloc[0] != pdf["block_b"].iloc[0]
    own, bucket = [set(map(int, b)) for b in pdf["own"]], int(pdf["bucket"].iloc[0])
    sizes = pd.Series(comp).map(pd.Series(comp).value_counts()).to_numpy()
    largest = sizes == sizes.max()
    largest &= comp == comp[largest.argmax()]
    out = []
    for x in np.flatnonzero(~largest):  # each pair of components has a member outside the largest
        ok = _may_link(sig, n, int(x), bounds.wide_estimate, bounds.least_percent) & (comp != comp[x]) & (largest | (ids > ids[x]))
        if across:
            ok &= block != block[x]
        out += [(min(ids[x], ids[y]), max(ids[x], ids[y])) for y in np.flatnonzero(ok) if min(own[x] & own[y]) == bucket]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def confirmed(pairs: DataFrame, texts: DataFrame, least_percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * |A and B| >= least_percent * |A or B| on the full sets; texts: (cls, text).

    The member's text travels with the pair; the leader's joins it, once per
    pair at the reducer and without another shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = []
                for c in (2, 3):
                    mine: list[np.ndarray] = []
                    for _, _, hashes, first in sets_of(part.column(c)):
                        mine += [hashes[i:j] for i, j in zip(first[:-1], first[1:], strict=True)]
                    sets.append(mine)
                keep = []
                for x, y in zip(*sets, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= least_percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    member = pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    return member.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, _PAIRS)


def _leader_rounds(members: DataFrame, bounds: Bounds, portion: int) -> list[DataFrame]:
    """Staged tables (a, b, leads, bucket) of the first round over portions of all buckets, and of further ones over the leaders of several portions."""
    made = "a long, b long, leads boolean, bucket long"
    rounds: list[DataFrame] = []
    mine, size = members, F.col("size")
    while True:
        seed = F.lit(len(rounds))
        dealt = mine.withColumn("portion", F.pmod(F.xxhash64(seed, "cls"), F.ceil(size / portion)))
        rounds.append(staged(dealt.groupBy("bucket", "portion").applyInPandas(lambda pdf: _leader_pairs(pdf, bounds), made), "leader-pairs"))
        before = mine.where(size > portion).select("bucket", "cls")
        leads = rounds[-1].where("leads").select("bucket", F.col("a").alias("cls"))
        left = before.join(leads, ["bucket", "cls"], "left_semi")
        counted = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("now"))
        held = staged(before.groupBy("bucket").agg(F.count(F.lit(1)).alias("was")).join(counted, "bucket").where("10 * now <= 9 * was"), "leader-counts")
        if held.isEmpty():
            return rounds
        mine = staged(members.join(left, ["bucket", "cls"], "left_semi").join(held.select("bucket", F.col("now").alias("size_now")), "bucket"), "leaders")
        size = F.col("size_now")


def near_duplicates(docs: DataFrame, *, least_percent: int = 85, id_col: str = "doc_id", text_col: str = "text", portion: int = PORTION) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash, stands) per row of docs.

    kept: doc_id is component_id. stands: the row is that document of its component that stands for all, by (doc_id,
    text_hash), the xxhash64 of the text; only its exact repetitions stand with it.
    """
    bounds = bounds_of(least_percent)
    rows = staged(signatures(docs, bounds, id_col, text_col), "signatures")
    known = rows.where("h1 is not null and doc_id is not null")
    classes = known.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    chosen = staged(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    keyed = chosen.select("cls", F.explode("bands").alias("bucket"))
    sums = (F.sum(F.xxhash64("cls").cast("decimal(20,0)")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("s2"))
    grouped = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), *sums).where("size > 1")
    buckets = staged(grouped.groupBy("size", "s1", "s2").agg(F.min("bucket").alias("bucket")).select("bucket", "size"), "buckets")
    inside = staged(keyed.join(buckets, "bucket"), "bucket-members")
    wanted = chosen.join(inside.select("cls").distinct(), "cls", "left_semi").select("cls", F.col("least.doc_id").alias("__id"), F.col("least.text_hash").alias("__hash"))
    twos = inside.where("size = 2").groupBy("bucket").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).select("a", "b")
    members = staged(inside.where("size > 2").join(chosen.select("cls", "n", "sig"), "cls"), "members")
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("__hash"))
    texts = texts.join(wanted.hint("merge"), ["__id", "__hash"]).select("cls", "text")  # at every size the way that large ones take
    texts = staged(texts.dropDuplicates(["cls"]), "texts")

    led = _leader_rounds(members, bounds, portion)
    pairs = reduce(DataFrame.unionByName, led).where("not leads").select("a", "b").union(twos).distinct()
    links = staged(confirmed(pairs, texts, least_percent), "links")
    found = components(links)

    labelled = members.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("bucket")
    blocks = F.ceil(F.col("size") / portion).cast("int")
    held = staged(labelled.drop("sig").join(mixed, "bucket"), "open-members")
    wide = wide_signatures(texts.join(held.select("cls").distinct(), "cls", "left_semi"), bounds)
    own = held.groupBy("cls").agg(F.collect_set("bucket").alias("own"))  # at most a class's bands each
    opened = held.join(wide.join(own, "cls"), "cls").withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
    paired = opened.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("block_a", F.least("block", "other")).withColumn("block_b", F.greatest("block", "other"))
    compared = pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a")))
    rest = paired.groupBy("bucket", "block_a", "block_b").applyInPandas(lambda pdf: _open_pairs(pdf, bounds), _PAIRS).distinct().join(compared, ["a", "b"], "left_anti")
    more = staged(confirmed(rest, texts, least_percent), "more-links")
    found = staged(components(links.union(more)), "components")

    linked = chosen.select("cls", "least").join(found.withColumnRenamed("node", "cls"), "cls")
    leasts = linked.groupBy("component").agg(F.min("least").alias("of_all"))
    of_all = found.withColumnRenamed("node", "cls").join(leasts, "component").select("cls", "of_all")
    of_class = staged(chosen.join(of_all, "cls", "left").select("h1", "h2", "n", F.coalesce("of_all", "least").alias("stands_for")), "class-components")
    out = rows.select("doc_id", "text_hash", "n", "h1", "h2").join(of_class, ["h1", "h2", "n"], "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("stands_for.doc_id", "doc_id"))
    alone = F.col("doc_id").isNull() | F.col("stands_for").isNull()
    stands = alone | (F.struct("doc_id", "text_hash") == F.col("stands_for"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash", stands.alias("stands"))

"""Token-id files: frequency-ranked ids, byte-aligned variable length, control bytes apart.

Ids are replaced by their rank of frequency over the whole corpus, so that the
most frequent take one byte. Four ids share a control byte (two bits each: data
bytes less one), and a text's control bytes precede its data bytes. Decoding
looks the control bytes up in a table of 256 rows and scatters all data bytes
at once.

A file is a run of blocks, each closed by a zero byte. A block has five lines of
ASCII: "RVB2 texts ids start", where start counts the ids of all blocks before
it in all files; the texts' ids ("-" for null); their counts of ids; their
bytes' lengths; and the places of zero bytes, each less the one before. The
texts' bytes follow, ones in the places of zeros, so that the only zero byte of
a block is its end. (Ranks begin at 1 and control bytes are complemented, so
zeros are rare.) Files can thus be cut between blocks: Spark's own text reader
deals them by block on any store, and no task takes a file as a whole. Files in
order of their part number, and texts in a file, ascend by doc_id (null first;
repeated ids by a hash of their ids). `ranks/` holds the table from rank to id,
of at most as many rows as the vocabulary.

Steps: tokenize once into a staged table (no shuffle) -> counts per id (partial
counts per task) -> ranges of (doc_id, hash) of about FILE_BYTES, found on those
two columns alone -> encode each text and shuffle it once, to its range -> blocks,
written by Spark's own writer, so that a lost executor's tasks are simply run
again. A range has a row on the driver: the input's size over FILE_BYTES.

Defined results: a null or empty text has only the end id; repeated rows are
kept, each in its place; an empty table gives files without blocks; columns
other than the id and text are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookflow.llm.common import new_dir, staged
from brookflow.llm.tokens import encoded_blocks, encoder

MAGIC = "RVB2"
#: Encoded bytes of a file, about; and ids of a block, at least.
FILE_BYTES = 32 << 20
BLOCK_IDS = 1 << 18

_BYTES = np.arange(4, dtype=np.uint8)
#: Row c: the lengths, less one, of the four ids whose control byte is c.
CONTROL = (~np.arange(256, dtype=np.uint8)[:, None] >> (2 * _BYTES)) & 3


def encode_ids(values: np.ndarray) -> bytes:
    """Control bytes (complemented), then data bytes, of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    n = len(values)
    codes = np.zeros(-(-n // 4) * 4, np.uint8)
    top = int(values.max(initial=0))
    for bound in (0xFF, 0xFFFF, 0xFFFFFF):
        if top > bound:
            codes[:n] += values > bound
    width = 2 if top <= 0xFFFF else 4
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)[_BYTES[:width] <= codes[:n, None]]
    return (~control.astype(np.uint8)).tobytes() + data.tobytes()


def decode_ids(payload: np.ndarray | bytes, n: int) -> np.ndarray:
    """The n values that encode_ids was given."""
    payload = np.frombuffer(payload, np.uint8) if isinstance(payload, bytes) else payload
    split = -(-n // 4)
    codes = CONTROL[payload[:split]].reshape(-1)[:n]
    width = 2 if codes.max(initial=0) < 2 else 4
    out = np.zeros((n, width), np.uint8)
    out[_BYTES[:width] <= codes[:, None]] = payload[split:]
    return out.view(f"<u{width}").reshape(-1).astype("<u4")


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """(doc_id, n, ids): ids as little-endian bytes of 16 bits where all ids fit, else 32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u2" if max(encoder(tokenizer_path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            for at, to, ids, first in encoded_blocks(tokenizer_path, batch.column(1), end_id):
                raw = ids.astype(kind)
                out = [raw[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(np.diff(first)), pa.array(out, pa.binary())], ["doc_id", "n", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n long, ids binary")


def _array(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def id_counts(tokens: DataFrame) -> DataFrame:
    """(id, count) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):  # all rows have ids of one width
                part = batch.slice(at, 1024)
                here = np.bincount(_array(b"".join(part.column(1).to_pylist()), sum(part.column(0).to_pylist())))
                if len(here) > len(total):
                    total = np.concatenate([total, np.zeros(len(here) - len(total), np.int64)])
                total[: len(here)] += here
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "count"])

    return tokens.select("n", "ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def _ranges(tokens: DataFrame, files: int) -> list[tuple[tuple, int]]:
    """(first key, ids before) of each file's range of keys (not null, doc_id, hash); only keys are shuffled for it."""
    keys = tokens.select("n", F.struct(F.col("doc_id").isNotNull().alias("told"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "hash").alias("key"))
    dealt = keys.repartitionByRange(files, "key") if files > 1 else keys.coalesce(1)
    held = dealt.withColumn("file", F.spark_partition_id()).groupBy("file").agg(F.min("key").alias("key"), F.sum("n").alias("n"))
    out, before = [], 0
    for key, n in sorted((tuple(r["key"]), r["n"]) for r in held.collect()):  # a row per file
        out.append((key, before))
        before += n
    return out


def pack_block(docs: list[tuple], start: int) -> bytes:
    """A block, without the zero byte that closes it, of (doc_id, ids, payload) rows; start: the ids of all blocks before it."""
    ids, counts, payloads = zip(*docs, strict=True)
    body = np.frombuffer(b"".join(payloads), np.uint8).copy()
    zeros = np.flatnonzero(body == 0)
    body[zeros] = 1
    lines = [
        (MAGIC, len(ids), sum(counts), start), ("-" if i is None else i for i in ids), counts, map(len, payloads), np.diff(zeros, prepend=0).tolist(),
    ]
    return b"".join((" ".join(map(str, line)) + "\n").encode() for line in lines) + body.tobytes()


def parse_block(block: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, starts, counts, bytes, where each text's bytes begin) of a block without its closing zero byte."""
    at, lines = 0, []
    raw = memoryview(block)
    while len(lines) < 5:
        size = 1 << 12
        while True:
            found = bytes(raw[at : at + size]).find(b"\n")
            if found >= 0:
                break
            if at + size > len(raw):
                raise ValueError("a token block is cut off")
            size *= 8
        lines.append(bytes(raw[at : at + found]).decode("ascii").split(" "))
        at += found + 1
    magic, texts, total, start = lines[0]
    if magic != MAGIC:
        raise ValueError("not a token block")
    ids = [None if x == "-" else int(x) for x in lines[1]]
    counts, lengths = np.array(lines[2], np.int64), np.array(lines[3], np.int64)
    body = block[at:].copy()
    if lines[4] != [""]:
        body[np.cumsum(np.array(lines[4], np.int64))] = 0
    if not len(ids) == len(counts) == len(lengths) == int(texts) or counts.sum() != int(total) or lengths.sum() != len(body):
        raise ValueError("a token block has another size than it says")
    return ids, int(start) + np.cumsum(counts) - counts, counts, body, np.concatenate([[0], np.cumsum(lengths)])


def write_token_files(docs: DataFrame, out_dir: str, tokenizer_path: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write `out_dir/ranks` and `out_dir/files`."""
    spark = docs.sparkSession
    tokens = staged(tokenized(docs, tokenizer_path, id_col, text_col, end_id), "token-ids").withColumn("hash", F.xxhash64("ids"))
    order = id_counts(tokens).orderBy(F.desc("count"), "id").collect()  # at most one row per id of the vocabulary
    ranked = np.array([r["id"] for r in order], np.int64)
    rank_of = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32)
    rank_of[ranked] = np.arange(1, len(ranked) + 1, dtype=np.uint32)
    spark.createDataFrame([(i + 1, int(x)) for i, x in enumerate(ranked)], "rank long, id long").coalesce(1).write.parquet(f"{out_dir}/ranks")
    size = sum(r["count"] * (1 if i < 255 else 2 if i < (1 << 16) - 1 else 3) for i, r in enumerate(order))
    ranges = _ranges(tokens, max(1, -(-size // file_bytes)))
    firsts, before = [x[0] for x in ranges], [x[1] for x in ranges]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, counts, raws, hashes = (c.to_pylist() for c in part.columns)
                made = [encode_ids(rank_of[_array(raw, n)]) for n, raw in zip(counts, raws, strict=True)]
                files = [bisect.bisect_right(firsts, (i is not None, i or 0, h)) - 1 for i, h in zip(ids, hashes, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.int32()), part.column(0), part.column(3), part.column(1), pa.array(made, pa.binary())], ["file", "doc_id", "hash", "n", "payload"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, at, file = [], 0, 0, None
        for batch in batches:
            for here, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (n >= block_ids or here != file):
                    yield pa.RecordBatch.from_arrays([pa.array([pack_block(held, at)], pa.binary())], ["block"])
                    held, n, at = [], 0, at + n
                if here != file:
                    file, at = here, before[here]
                held.append(tuple(row))
                n += row[1]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([pack_block(held, at)], pa.binary())], ["block"])

    encoded = tokens.select("doc_id", "n", "ids", "hash").mapInArrow(encode, "file int, doc_id long, hash long, n long, payload binary")
    ordered = encoded.repartitionById(max(1, len(ranges)), "file").sortWithinPartitions("file", F.asc_nulls_first("doc_id"), "hash")
    made = ordered.select("file", "doc_id", "n", "payload").mapInArrow(blocks, "block binary")
    made.select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\0").text(f"{out_dir}/files")


def read_token_files(spark: SparkSession, out_dir: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids): per text the count of ids in all texts before it, its ids' count, and its ids as little-endian unsigned 32-bit bytes.

    Without ids, their crc32 (ids_crc32) is taken where they are decoded.
    """
    ranks = spark.read.parquet(f"{out_dir}/ranks").orderBy("rank").collect()  # at most one row per id of the vocabulary
    unrank = np.array([0] + [r["id"] for r in ranks], "<u4")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                ids, starts, counts, body, begin = parse_block(np.frombuffer(value.as_buffer(), np.uint8))
                each = (unrank[decode_ids(body[i:j], k)] for i, j, k in zip(begin[:-1], begin[1:], counts.tolist(), strict=True))
                last = pa.array([x.tobytes() for x in each], pa.binary()) if with_ids else pa.array([zlib.crc32(x) for x in each], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts), pa.array(counts), last], ["doc_id", "start", "n_tokens", "ids" if with_ids else "ids_crc32"])

    lines = spark.read.option("lineSep", "\0").text(f"{out_dir}/files").select(F.col("value").cast("binary"))
    return lines.mapInArrow(texts, "doc_id long, start long, n_tokens long, " + ("ids binary" if with_ids else "ids_crc32 long"))


def token_ids(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the files into the shared folder and return (doc_id, start, n_tokens, ids_crc32) read back from them."""
    out = new_dir(spark, "token-files")
    write_token_files(docs, out, tokenizer_path, end_id=end_id)
    return read_token_files(spark, out, with_ids=False)

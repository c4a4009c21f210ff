"""Byte-pair encoding with an index from each pair to all its positions, and decoding.

Texts are taken in windows of about WINDOW bytes. The pre-tokens of a window
that differ become one array of symbols in which every symbol knows its left and
right neighbour. The index maps the rank of each mergeable pair to all positions
where the pair stands, in all pre-tokens of the window. Active ranks are applied
in ascending order, each to all its positions at once; a merge takes the pairs
beside it out of their neighbours and enters the new ones under their ranks.
That is what merging pre-token by pre-token gives, because a symbol is made by
one rank alone and takes part in later ranks only; a file for which that doesn't
hold is refused, and so is one that joins text across blanks, has a decoder, or
doesn't spell every byte.

Normalization and the cut into pre-tokens are the tokenizer file's own: plain
words and punctuation are cut by Arrow, everything else by the library. The merges
and the decoding are this module's.

Defined results: a null or empty text has no ids and decodes to the empty text;
an added token that a text spells is its id; a very long text spans several
windows and is never cut; repeated rows are rows of their own; an empty table
gives an empty table; `round_trip` keeps the id column and takes any other
columns named in `keep`, so a clashing name matters only there (ValueError).
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brookflow.llm import tokens
from brookflow.llm.tokens import gather

#: Bytes of text that share an index. Bounds memory, not results.
WINDOW = 16 << 20


class PairIndex:
    """The merges of a vocabulary, applied to many pre-tokens at once."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        born = np.full(self.size, -1, np.int64)
        born[made] = np.arange(len(made))
        if len(np.unique(made)) < len(made) or (born[left] >= np.arange(len(made))).any() or (born[right] >= np.arange(len(made))).any():
            raise ValueError("merges whose symbols are made by several ranks or used before they are made aren't supported")
        self.left, self.right, self.made = left, right, made
        keys = left * self.size + right
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        inner, last = [vocab.get(c) for c in tokens._BYTE_CHARS], [vocab.get(c + suffix) for c in tokens._BYTE_CHARS]
        if None in inner or None in last:
            raise ValueError("a byte has no symbol")
        self.inner, self.last = np.array(inner, np.int64), np.array(last, np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where the pair isn't merged."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.by_key[at], -1)

    def encode(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first) of pre-tokens, bytes data[first[i]:first[i + 1]], none of them empty."""
        n = len(data)
        if not n:
            return np.empty(0, "<u4"), np.zeros(len(first), np.int64)
        symbol = np.append(self.inner[data], -1)  # place n stands for "no neighbour"
        symbol[first[1:] - 1] = self.last[data[first[1:] - 1]]
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[first[1:] - 1] = n
        before[first[:-1]] = n
        index: dict[int, list[np.ndarray]] = {}

        def enter(places: np.ndarray, fresh: list[int] | None) -> None:
            rank = self.ranks(symbol[places], symbol[after[places]])
            known = np.flatnonzero(rank >= 0)
            if not len(known):
                return
            places, rank = places[known], rank[known]
            if len(rank) > 1:
                order = np.argsort(rank, kind="stable")
                places, rank = places[order], rank[order]
                cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
                begins = [0, *cut.tolist()]
            else:
                begins = [0]
            for r, i, j in zip(rank[begins].tolist(), begins, [*begins[1:], len(rank)], strict=True):
                if r in index:
                    index[r].append(places[i:j])
                else:
                    index[r] = [places[i:j]]
                    if fresh is not None:
                        heapq.heappush(fresh, r)

        inside = np.flatnonzero(after[:n] < n).astype(np.int32)
        enter(inside, None)
        active = sorted(index)  # a sorted list is a heap
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            here = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, m = self.left[r], self.right[r], self.made[r]
            here = here[(symbol[here] == a) & (symbol[after[here]] == b)]  # a pair that a lower rank took apart stands no more
            if a == b and len(here) > 1:
                here = _apart(np.sort(here), after)
            if not len(here):
                continue
            gone = after[here]
            beyond = after[gone]
            symbol[here] = m
            symbol[gone] = -1
            after[here] = beyond
            before[beyond] = here
            behind = before[here]
            # where two merges meet, the pair is entered from its left side only
            enter(np.concatenate([behind[(behind < n) & (symbol[behind] != m)], here[beyond < n]]), active)
        stands = symbol[:n] >= 0
        upto = np.zeros(n + 1, np.int64)
        np.cumsum(stands, out=upto[1:])
        return symbol[:n][stands].astype("<u4"), upto[first]


def _apart(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of ascending places of a pair of equal symbols, those left when each run of overlapping ones is taken from the left."""
    follows = np.zeros(len(places), bool)
    follows[1:] = after[places[:-1]] == places[1:]
    starts = np.flatnonzero(~follows)
    nth = np.arange(len(places)) - np.repeat(starts, np.diff(np.append(starts, len(places))))
    return places[nth % 2 == 0]


class IndexedEncoder(tokens.ChunkEncoder):
    """encode_column by pair indexes; decode_column by a table of the symbols' texts."""

    window = WINDOW

    def __init__(self, path: str) -> None:
        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("not a plain byte-pair encoding")
        if file.get("decoder") is not None or "ByteLevel" not in json.dumps(file["pre_tokenizer"]) or not self.simple:
            raise ValueError("a tokenizer with a decoder, without byte-level pre-tokens, or whose words depend on their neighbours")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.pairs = PairIndex(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.byte_of = {c: b for b, c in enumerate(tokens._BYTE_CHARS)}
        spelled = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        texts = [f"{spelled.get(i, '')} ".encode() for i in range(max(spelled) + 1)]
        self.flat = np.frombuffer(b"".join(texts), np.uint8)
        self.first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])

    def _cut(self, chunks: list[str]) -> tuple[list[bytes], list[int]]:
        """Bytes of the pre-tokens of chunks, and how many each chunk has."""
        normalize, cut = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        found = [[bytes(map(self.byte_of.__getitem__, t)) for t, _ in cut(normalize(x))] for x in chunks]
        return [t for x in found for t in x], [len(x) for x in found]

    def _entries(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first) of distinct chunks, all their distinct pre-tokens in one index."""
        found = pc.extract_regex(words, tokens._SIMPLE)
        simple = found.is_valid()
        found = found.filter(simple)
        core = pc.utf8_lower(found.field("core")).dictionary_encode()
        tail = found.field("tail").dictionary_encode()
        others, counts = self._cut(words.filter(pc.invert(simple)).to_pylist())
        spelled = [core.dictionary.cast(pa.large_binary()), tail.dictionary.cast(pa.large_binary()), pa.array(others, pa.large_binary())]
        every = pa.concat_arrays(spelled)
        first = np.frombuffer(every.buffers()[1], np.int64)[: len(every) + 1] if len(every) else np.zeros(1, np.int64)
        raw = every.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[: first[-1]] if raw is not None else np.empty(0, np.uint8)
        filled = np.flatnonzero(np.diff(first))  # the empty tail has no symbols
        ids, begin = self.pairs.encode(data, np.append(first[:-1][filled], first[-1]))
        upto = begin[np.searchsorted(filled, np.arange(len(every) + 1))]
        nc, nt = len(spelled[0]), len(spelled[1])
        bounds = np.concatenate([upto[: nc + nt], upto[nc + nt + np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])], [len(ids)]])
        pick = np.full((len(words), 2), len(bounds) - 2, np.int64)  # the last run is empty
        plain = simple.to_numpy(zero_copy_only=False)
        pick[plain, 0] = core.indices.to_numpy()
        pick[plain, 1] = nc + tail.indices.to_numpy()
        pick[~plain, 0] = nc + nt + np.arange(len(counts))
        out, at = gather(ids, bounds, pick.reshape(-1))
        return out, at[::2]

    def _spelled(self, texts: list[str]) -> list[bytes]:
        """Added tokens are found in the raw text, the earliest and of those the longest; what lies between is encoded by itself."""
        import regex

        pattern = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        out = []
        for text in texts:
            parts = pattern.split(text)
            ids, first = self._plain(pa.array(parts[::2], pa.large_string()))
            pieces = [ids[a:b].tobytes() for a, b in zip(first, first[1:])]
            for k, token in enumerate(parts[1::2]):
                pieces[k] += np.uint32(self.special[token]).tobytes()
            out.append(b"".join(pieces))
        return out

    def decode_column(self, ids: np.ndarray, first: np.ndarray) -> pa.Array:
        """Texts of runs of ids: their symbols' texts with a blank between them."""
        out, at = [], 0
        while at < len(first) - 1:  # blocks bound the index arrays; a longer text is a block
            to = max(at + 1, int(np.searchsorted(first, first[at] + (1 << 20), side="right")) - 1)
            data, begin = gather(self.flat, self.first, ids[first[at] : first[to]].astype(np.int64))
            bounds = begin[first[at : to + 1] - first[at]]
            keep = np.ones(len(data), bool)
            keep[bounds[1:][np.diff(bounds) > 0] - 1] = False  # the blank behind a text's last symbol
            bounds = bounds - np.concatenate([[0], np.cumsum(np.diff(bounds) > 0)])
            out.append(pa.LargeStringArray.from_buffers(to - at, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[keep])))
            at = to
        return pa.concat_arrays(out) if out else pa.array([], pa.large_string())


_loaded: dict[str, IndexedEncoder] = {}


def encoder(path: str) -> IndexedEncoder:
    """The process's encoder for the file, loaded once."""
    if path not in _loaded:
        _loaded[path] = IndexedEncoder(path)
    return _loaded[path]


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about WINDOW bytes."""
    upto, at = np.concatenate([[0], np.cumsum(sizes)]), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + WINDOW, side="right")) - 1)
        yield at, to
        at = to


def _lists(ids: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), pa.array(ids.astype(np.int32), pa.int32())).cast(pa.list_(pa.int32()))


def round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decode: bool = True) -> DataFrame:
    """(id_col, ids array<int>, decoded) of every whole text, and the columns named in keep; the text is decoded from the ids."""
    taken = [id_col, *keep]
    if len(set(taken)) < len(taken) or {"ids", "decoded"} & set(taken):
        raise ValueError("kept columns must have names of their own, other than ids and decoded")
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = batch.column(0)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, to in _runs(sizes):
                ids, first = own.encode_column(texts.slice(at, to - at))
                step = max(1, -(-(to - at) * (2 << 20) // max(len(ids), 1)))  # hand over some two million ids at a time
                for i in range(0, to - at, step):
                    j = min(i + step, to - at)
                    part, bounds = ids[first[i] : first[j]], first[i : j + 1] - first[i]
                    columns = [c.slice(at + i, j - i) for c in batch.columns[1:]] + [_lists(part, bounds)]
                    if decode:
                        columns.append(own.decode_column(part, bounds).cast(pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, [*taken, "ids", *["decoded"] * decode])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in taken)
    schema = f"{kinds}, ids array<int>" + ", decoded string" * decode
    return docs.select(F.col(text_col).cast("string").alias("__text"), *taken).mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, **columns) -> DataFrame:
    """(id_col, ids) of every whole text; `columns` as for round_trip."""
    return round_trip(docs, path, decode=False, **columns)


def decoded(df: DataFrame, path: str, *, ids_col: str = "ids") -> DataFrame:
    """df with `decoded`, the text of its ids (null as none)."""
    if "decoded" in df.columns:
        raise ValueError("there is a column named decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, own.decode_column(flat, first).cast(pa.string())], [*batch.schema.names, "decoded"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("decoded", StringType())]))


def digests(trip: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of round_trip's rows: SHA-256 of the decimal ids joined by one blank, and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return trip.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

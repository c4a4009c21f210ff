"""Exact tokenization by a public tokenizer file, with each distinct word encoded once.

The tokenizer's pre-tokenization never joins text across a blank, so the ids of
a text are those of its blank-separated chunks, one after another. A column is
taken in windows of about WINDOW bytes (a long text spans several); a window's
chunks become an Arrow dictionary, only its entries are encoded, and their ids
are gathered by numpy offsets. No Python object is made per word of the text.
Texts that spell one of the tokenizer's added tokens are encoded whole.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose chunks are looked up at once.
WINDOW = 8 << 20
#: Bytes that the encoded words kept per process may take, about; beyond, the table starts anew. Bounds memory, not results.
KEPT_BYTES = 64 << 20
#: What a kept word takes beyond its letters and ids: two objects and its place in the table.
KEPT_EACH = 180

#: A word of Latin-1 letters, then a run of ASCII punctuation without apostrophes (a pre-token of its own).
_SIMPLE = "^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[-!\"#$%&()*+,./:;=?@\\\\\\]\\[^_`{|}~]*) ?$"

#: Byte-level vocabularies spell each byte as a printable character: itself where printable, else the next free one from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = [chr(b) if b in _PRINTABLE else chr(256 + [x for x in range(256) if x not in _PRINTABLE].index(b)) for b in range(256)]

#: Tab, line feed and carriage return separate chunks as a blank does.
_BLANKED = np.arange(256, dtype=np.uint8)
_BLANKED[[9, 10, 13]] = 32

_loaded: dict[str, "ChunkEncoder"] = {}


def gather(flat: np.ndarray, first: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[first[i]:first[i + 1]] for i in pick, joined, and where each begins (with the end)."""
    lens = np.diff(first)[pick]
    begin = np.zeros(len(pick) + 1, np.int64)
    np.cumsum(lens, out=begin[1:])
    return flat[np.arange(begin[-1]) + np.repeat(first[pick] - begin[:-1], lens)], begin


class ChunkEncoder:
    """encode_column(texts) -> all ids and where each text's begin."""

    #: Bytes of text whose chunks are looked up at once, if not WINDOW.
    window: int | None = None

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.kept = 0
        self.model = self.tokenizer.model
        probe = ["thorn", "Éñßà", "Zyx."]
        self.simple = self._ids(probe) == [self._word("thorn"), self._word("éñßà"), self._word("zyx") + self._ids(["."])[0]]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spelled(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that spell added tokens."""
        return self._ids(texts)

    def _word(self, core: str) -> bytes:
        """Ids of one lower-case Latin-1 word: a single pre-token that normalization leaves as it is."""
        spelled = core if core.isascii() else "".join(map(_BYTE_CHARS.__getitem__, core.encode()))
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _lookup(self, words: list[str], learn) -> list[bytes]:
        """Ids of distinct words; `learn` (list -> list) encodes those that aren't known yet."""
        got = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(got) if x is None]
        made = learn([words[i] for i in missing])
        for i, ids in zip(missing, made, strict=True):
            got[i] = ids
        self.kept += sum(KEPT_EACH + len(words[i]) + len(got[i]) for i in missing)
        if self.kept > KEPT_BYTES:
            self.known, self.kept = {}, 0
        else:
            self.known.update(zip((words[i] for i in missing), made, strict=True))
        return got

    def _entries(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first) of distinct chunks: a simple one is its lower-case core's ids, then its tail's."""
        if self.simple:
            found = pc.extract_regex(words, _SIMPLE)
            simple = found.is_valid()
            found = found.filter(simple)
        else:
            found, simple = pa.array([], pa.struct([("core", pa.string()), ("tail", pa.string())])), pa.array(np.zeros(len(words), bool))
        core = pc.utf8_lower(found.field("core")).dictionary_encode()
        tail = found.field("tail").dictionary_encode()
        others = words.filter(pc.invert(simple)).to_pylist()
        parts = self._lookup(core.dictionary.to_pylist(), lambda missing: list(map(self._word, missing)))
        parts += self._lookup(tail.dictionary.to_pylist(), self._ids)
        parts += self._lookup(others, self._ids)
        parts.append(b"")
        first = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4, out=first[1:])
        pick = np.full((len(words), 2), len(parts) - 1, np.int64)
        plain = simple.to_numpy(zero_copy_only=False)
        pick[plain, 0] = core.indices.to_numpy()
        pick[plain, 1] = len(core.dictionary) + tail.indices.to_numpy()
        pick[~plain, 0] = len(core.dictionary) + len(tail.dictionary) + np.arange(len(others))
        ids, begin = gather(np.frombuffer(b"".join(parts), "<u4"), first, pick.reshape(-1))
        return ids, begin[::2]

    def _window(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first) of the chunks data[bounds[i]:bounds[i + 1]]."""
        chunks = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        ids, first = self._entries(chunks.dictionary)
        return gather(ids, first, chunks.indices.to_numpy())

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of text i of a string column (null: none) are ids[first[i]:first[i + 1]]."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if column.null_count:
            column = column.fill_null("")
        whole = np.zeros(len(column), bool)
        for token in self.added:
            whole |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        spelled = np.flatnonzero(whole)
        if len(spelled):
            apart = self._spelled(column.take(pa.array(spelled)).to_pylist())
            column = pc.if_else(pa.array(whole), pa.scalar("", column.type), column)
        ids, first = self._plain(column)
        if len(spelled):
            pieces, at = [], 0
            for i, raw in zip(spelled, apart, strict=True):
                pieces += [ids[at : first[i]], np.frombuffer(raw, "<u4")]
                at = first[i]
            lens = np.zeros(len(column), np.int64)
            lens[spelled] = [len(raw) // 4 for raw in apart]
            ids, first = np.concatenate([*pieces, ids[at:]]), first + np.concatenate([[0], np.cumsum(lens)])
        return ids, first

    def _plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(column)
        if not n:
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        starts = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[starts[0] : starts[-1]] if raw is not None else np.empty(0, np.uint8)
        starts -= starts[0]
        out, first, done, at = [], np.zeros(n + 1, np.int64), 0, 0
        while at < len(data):
            size = self.window or WINDOW
            while True:  # a window ends at a chunk's end; a chunk that is longer than a window widens it
                to = min(at + size, len(data))
                here = _BLANKED[data[at:to]]
                mark = np.zeros(to - at + 1, bool)
                mark[1:] = here == 32
                a, b = np.searchsorted(starts, (at, to), side="left")
                mark[starts[a:b] - at] = True
                mark[0] = True
                mark[-1] |= to == len(data) or starts[b] == to
                bounds = np.flatnonzero(mark)
                if len(bounds) > 1:
                    break
                size *= 2
            to = at + int(bounds[-1])
            ids, begin = self._window(here, bounds)
            a, b = np.searchsorted(starts, (at, to), side="left")
            first[a:b] = done + begin[np.searchsorted(bounds, starts[a:b] - at)]
            out.append(ids)
            done += len(ids)
            at = to
        first[np.searchsorted(starts, len(data), side="left") :] = done
        return np.concatenate(out) if out else np.empty(0, "<u4"), first


def closed(ids: np.ndarray, first: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with end_id behind each text's ids."""
    shift = np.arange(len(first))
    out = np.full(len(ids) + len(first) - 1, end_id, "<u4")
    out[np.arange(len(ids)) + np.repeat(shift[:-1], np.diff(first))] = ids
    return out, first + shift


def encoded_blocks(path: str, column: pa.Array, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, first) of runs of rows of about WINDOW bytes, each text closed by end_id."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + WINDOW, side="right")) - 1)
        yield at, to, *closed(*encoder(path).encode_column(column.slice(at, to - at)), end_id)
        at = to


def encoder(path: str) -> ChunkEncoder:
    """The process's encoder for the file, loaded once."""
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

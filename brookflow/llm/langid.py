"""Language identification by compression with per-language zstandard dictionaries.

Every language has a raw-content dictionary of whole training texts,
DICTIONARY_BYTES of UTF-8 at most. A text's letters (lower case; all else is a
blank) are compressed with each, in pieces of PIECE_BYTES so that the dictionary
and not the text's own repetitions decides; the language whose dictionary makes
it smallest (bytes summed over all pieces) is predicted. Where the runner-up comes within `margin` of the winner the
prediction isn't accepted: `accepted` is false, though lang_pred still names
the winner.

The dictionaries come from a bounded sample: per language at most SAMPLE texts,
those with the least hash of doc_id, found by a partial top-n per task (texts too
long for a dictionary last, of which LONG_PIECES pieces from all over the text are learned). Texts to
predict are compressed whole where they are read; nothing is shuffled.

Defined results: a null text, or one without a letter, is `und` with score 0;
ties go to the language first in alphabetical order; repeated rows are
predicted each; without any training language every text is `und`; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.llm import common

SAMPLE, DICTIONARY_BYTES, PIECE_BYTES = 200, 112 << 10, 2048
#: Pieces of so many letters, as far apart as the text is long, that a training text too long for a dictionary gives.
LONG_PIECES, LONG_LETTERS = 14, 1_000
MARGIN = 0.02
UNDETERMINED = "und"
#: Letters: word characters that are neither digits nor the underscore.
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> dict[str, bytes]:
    """{language: raw content of its dictionary} from the rows that aren't held out. What is collected is bounded by languages x sample."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~common.held_out("doc_id"))
    # a text that doesn't fit a dictionary whole is taken where there are too few others, and pieces from its beginning to its end
    long_text = F.octet_length("text") > DICTIONARY_BYTES
    nth = F.row_number().over(W.partitionBy("lang").orderBy("long", F.xxhash64("doc_id"), "doc_id"))
    ids = rows.select("doc_id", "lang", long_text.alias("long")).withColumn("nth", nth).where(F.col("nth") <= sample).select("doc_id", "lang", "long", "nth")
    begins = F.transform(F.sequence(F.lit(0), F.lit(LONG_PIECES - 1)), lambda i: (1 + F.floor(i * (F.length("text") - LONG_LETTERS) / (LONG_PIECES - 1))).cast("int"))
    part = F.when(long_text, F.array_join(F.transform(begins, lambda at: F.substring(F.col("text"), at, F.lit(LONG_LETTERS))), " ")).otherwise(F.col("text"))
    fetched = rows.select("doc_id", "lang", long_text.alias("long"), part.alias("text")).join(F.broadcast(ids), ["doc_id", "lang", "long"])  # languages x sample rows
    chosen = fetched.groupBy("doc_id", "lang").agg(F.min("nth").alias("nth"), F.min("text").alias("text")).collect()
    return dictionaries([(r["lang"], r["text"]) for r in sorted(chosen, key=lambda r: (r["lang"], r["nth"]))])


def dictionaries(texts: list[tuple[str, str]], size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Fill each language's dictionary with whole texts, each text once, until the next doesn't fit."""
    held: dict[str, list[bytes]] = {}
    for lang, text in texts:
        mine, raw = held.setdefault(lang, []), folded(text)
        if raw not in mine and sum(map(len, mine)) + len(raw) <= size:
            mine.append(raw)
    return {lang: b"".join(parts) for lang, parts in held.items()}


def folded(text: str) -> bytes:
    return _OTHER.sub(" ", text.lower()).encode()


def compressors(known: dict[str, bytes]) -> list:
    """One function bytes -> compressed bytes per language, in alphabetical order: a greedy search for matches of four bytes and more."""
    import zstandard as z

    how = z.ZstdCompressionParameters(window_log=18, hash_log=17, chain_log=17, search_log=5, min_match=4, strategy=z.STRATEGY_GREEDY, write_content_size=False)
    out = []
    for lang in sorted(known):
        content = z.ZstdCompressionDict(known[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=how)
        out.append(z.ZstdCompressor(compression_params=how, dict_data=content).compress)
    return out


def identified(docs: DataFrame, known: dict[str, bytes], *, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, accepted): score is the winner's share, from 0.5 to 1, against the runner-up."""
    langs = sorted(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = compressors(known)
        for batch in batches:
            pred, score, sure = [], [], []
            for item in batch.column(1):
                text = item.as_py()
                if text is None or not langs or not _LETTER.search(text):
                    pred.append(UNDETERMINED)
                    score.append(0.0)
                    sure.append(False)
                    continue
                raw = folded(text)
                pieces = [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]
                sizes = [sum(len(c(p)) for p in pieces) for c in compress]
                best = min(range(len(langs)), key=sizes.__getitem__)
                other = min((x for i, x in enumerate(sizes) if i != best), default=2 * sizes[best])
                gap = 1 - sizes[best] / other if other else 0.0
                pred.append(langs[best])
                score.append(1 / (1 + math.exp(-40 * gap)))
                sure.append(gap >= margin)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sure, pa.bool_())], ["doc_id", "lang_pred", "score", "accepted"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) per row of docs."""
    out = identified(docs, learn(docs))
    return out.select("doc_id", common.held_out("doc_id").alias("held_out"), "lang_pred", "score", "accepted")

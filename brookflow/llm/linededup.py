"""Line deduplication over windows of three consecutive lines.

A text's lines are split at "\\n". Each run of three lines is hashed (128 bits)
as a window; windows overlap. Over the whole corpus the first occurrence of a
window - the least (doc_id, text's hash, line) - stays, and every later one covers
its three lines; a text loses the union of its covered lines. So where a later
occurrence overlaps the first one, lines that they share go too: four equal lines
become one.

Only windows (id, line, two longs) are shuffled by hash; a window that is very
common is counted in part before the shuffle, and its join is split by Spark's
skew join. The covered lines of a text are at most its lines.

Defined results: a text of fewer than three lines (null and empty ones too) has
no window and stays as it is; windows of three blank lines don't count; lines
compare exactly, so a "\\r" is part of its line; repeated rows of a doc_id with
one text are one document, and with several texts as many; rows without a doc_id
stay as they are; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.llm.common import staged

LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(id_col: str, text_col: str) -> Column:
    """What tells documents apart: the id, and for ids with several texts a hash of the text."""
    return F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text"))


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = LINES) -> DataFrame:
    """(doc, line, h1, h2) of every window that isn't blank; doc is (doc_id, text's hash), line the window's first, from 0."""
    some = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    lines = some.select(_key(id_col, text_col).alias("doc"), _lines(F.col(text_col)).alias("lines")).where(F.size("lines") >= size)
    each = F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.trim(x) == "").alias("blank")))
    part = lambda i, name: [F.get(F.col("l"), i + k)[name] for k in range(size)]
    runs = F.transform(F.sequence(F.lit(0), F.size("l") - size), lambda i: F.struct(
        i.alias("line"), F.xxhash64(*part(i, "a")).alias("h1"), F.xxhash64(*part(i, "b")).alias("h2"), _all(part(i, "blank")).alias("blank")))
    return lines.select("doc", each.alias("l")).select("doc", F.explode(runs).alias("w")).where(~F.col("w.blank")).select("doc", "w.line", "w.h1", "w.h2")


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = LINES) -> DataFrame:
    """(doc, covered): the sorted lines of each text that later occurrences cover; texts that lose nothing have no row."""
    seen = staged(windows(docs, id_col, text_col, size), "windows")
    place = F.struct("doc", "line")
    repeated = seen.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2", "first")
    later = seen.join(repeated, ["h1", "h2"]).where(place != F.col("first")).select("doc", "line")
    covers = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.col("line") + k)
    return later.groupBy("doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(covers)))).alias("covered"))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = LINES) -> DataFrame:
    """docs with the covered lines taken out of its text; __lines and __removed count its lines before and those taken out (0 for null)."""
    covered = covered_lines(docs.select(id_col, text_col), id_col, text_col, size)
    covered = covered.select(F.col("doc.doc_id").alias("__id"), F.col("doc.text").alias("__hash"), F.col("covered").alias("__covered"))
    joined = docs.join(covered, (docs[id_col] == covered["__id"]) & (F.xxhash64(docs[text_col]) == covered["__hash"]), "left").withColumn("__split", _lines(F.col(text_col)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__split") - 1), F.col("__covered"))
    text = F.when(F.col("__covered").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("__split"), i)), "\n"))
    lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size("__split"))
    removed = F.when(F.col("__covered").isNull(), 0).otherwise(F.size("__covered"))
    return joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns), lines.alias("__lines"), removed.alias("__removed"))

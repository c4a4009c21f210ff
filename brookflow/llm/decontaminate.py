"""Benchmark decontamination by spaced seeds, in DataFrame operations alone.

A mask such as 11101 is laid at every word of every text; the words under its
ones are hashed, those under its zeros ignored. Hashes of benchmark items are
joined with those of the training texts. A hit puts a text and an item on one
diagonal (word position in the text less that in the item); the words around the
hit are then compared where it is found, and the text holds the item where some
window of WINDOW words on the diagonal (of the whole item, if that is shorter)
agrees in at least 80 of 100 words. A chance hit on common words is turned down
there, before anything is shuffled.

The masks miss nothing that the comparison accepts: however the words that 80 %
leave to substitute are placed in a window of 8 to WINDOW words, one of the two
masks, each with ignored positions, fits beside them (a test tries all
placements). So it is for items of eight words and more: shorter ones (of one
word at least) are held where the whole item occurs word by word.

Words are longest runs without blanks and \\t\\n\\v\\f\\r, in lower case.

Texts are taken in blocks of STEP words with those around them, so a text of any
length is many rows and none of them long. The items' seeds stand in the plan
and are broadcast, with the words around them, where there are at most
HELD_SEEDS; else every word's hashes are joined by a shuffle, and the words
around a hit fetched from the text's block. Both give the same hits.

Defined results: null and empty texts hold nothing; repeated rows of a doc_id
give one result per (doc_id, item_id); rows without a doc_id hold nothing; an
empty benchmark or table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.llm.common import staged

MASKS = ("11101", "110011")
#: The masks are complete for these: another window or a lower share needs other masks.
WINDOW, LEAST_PERCENT = 20, 80
#: Items of fewer words are only searched whole.
LEAST_WORDS = 8
#: Seeds that are held in the plan and broadcast (some 350 bytes each), at most.
HELD_SEEDS = 50_000
#: Words of a text that are a row.
STEP = 1024


def words(text: Column) -> Column:
    """Hashes of the words, in order."""
    return F.transform(F.filter(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(mask: str, at: str) -> str:
    """The hash of the words under the mask's ones, null where the mask doesn't fit."""
    ones = ", ".join(f"get(w, {at} + {k})" for k, c in enumerate(mask) if c == "1")
    return f"if({at} + {len(mask)} <= size(w), xxhash64({ones}), null)"


def _around(at: str, window: int) -> str:
    """The words from window - 1 before to window - 1 behind, null beyond the text."""
    return f"transform(sequence({1 - window}, {window - 1}), k -> get(w, {at} + k))"


def item_seeds(items: DataFrame, masks: tuple[str, ...], window: int, least: int) -> DataFrame:
    """(mask, seed, item_id, item_at, n, item_words) of items (item_id, w): every mask at every word, or for short items the whole item."""
    sides = []
    for m in masks:
        fits = F.size("w") >= least if "0" in m else F.size("w") == len(m)
        last = f"size(w) - {len(m)}"
        sides.append(items.where(fits).select(F.lit(m).alias("mask"), "item_id", F.size("w").alias("n"), "w", F.expr(f"explode(sequence(0, greatest({last}, 0)))").alias("item_at")).withColumn("seed", F.expr(_seed(m, "item_at"))))
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return out.where("seed is not null").select("mask", "seed", "item_id", "item_at", "n", F.expr(_around("item_at", window)).alias("item_words"))


def text_blocks(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, row, base, lead, w): the words of texts (doc_id, text) in blocks of STEP, with window - 1 before (lead) and twice as many behind; row tells texts of one id apart."""
    side = window - 1
    block = f"struct(s AS base, least(s, {side}) AS lead, slice(w, greatest(s - {side}, 0) + 1, least(s, {side}) + {STEP + 2 * side}) AS w)"
    made = texts.select("doc_id", F.xxhash64("text").alias("row"), words(F.col("text")).alias("w"))
    return made.select("doc_id", "row", F.expr(f"explode(transform(sequence(0, greatest(size(w) - 1, 0), {STEP}), s -> {block})) AS b")).select("doc_id", "row", "b.*")


def _literals(values: list[int]) -> str:
    return ", ".join(f"{v}L" if v > -(2**63) else "-9223372036854775807L - 1L" for v in values)


def _begins(seeds: DataFrame, masks: tuple[str, ...], window: int) -> str:
    """Whether the words that all spaced masks begin with, hashed together, begin some seed: one short hash per word turns most words down."""
    n = min(len(m) - len(m.lstrip("1")) for m in masks if "0" in m)
    at = [f"get({{}}, {{}} + {k})" for k in range(n)]
    of_item = "xxhash64(" + ", ".join(a.format("item_words", window - 1) for a in at) + ")"
    first = seeds.where(F.contains("mask", F.lit("0"))).select(F.expr(of_item).alias("a")).distinct().collect()  # as many as seeds at most
    return "xxhash64(" + ", ".join(a.format("w", "i") for a in at) + f") IN ({_literals([r['a'] for r in first])})"


def _hits(texts: DataFrame, seeds: DataFrame, masks: tuple[str, ...], window: int) -> DataFrame:
    """(doc_id, at, words, item_id, item_at, n, item_words) of every seed that texts share with items."""
    places = f"sequence(lead, least(lead + {STEP}, greatest(size(w), lead + 1)) - 1)"
    each = ", ".join(f"struct('{m}' AS mask, {_seed(m, 'i')} AS seed)" for m in masks)
    blocks = text_blocks(texts, window)
    held = seeds.select("mask", "seed").distinct().limit(HELD_SEEDS + 1).collect()
    if len(held) <= HELD_SEEDS:
        by = {m: _literals([r["seed"] for r in held if r["mask"] == m]) for m in masks}
        some = {m: f"coalesce({_seed(m, 'i')} IN ({kept}), false)" for m, kept in by.items() if kept}
        spaced = [test for m, test in some.items() if "0" in m]
        known = " OR ".join([*(test for m, test in some.items() if "0" not in m), *([f"({_begins(seeds, masks, window)}) AND ({' OR '.join(spaced)})"] if spaced else [])]) or "false"
        found = blocks.select("doc_id", F.expr(f"explode(transform(filter({places}, i -> {known}), i -> struct(base + i - lead AS at, array({each}) AS seeds, {_around('i', window)} AS words))) AS s"))
        return found.select("doc_id", "s.at", "s.words", F.explode("s.seeds").alias("x")).select("doc_id", "at", "words", "x.*").join(F.broadcast(seeds), ["mask", "seed"])
    laid = blocks.select("doc_id", "row", "base", F.expr(f"explode(transform({places}, i -> struct(i AS i, array({each}) AS seeds))) AS s")).select("doc_id", "row", "base", "s.i", F.explode("s.seeds").alias("x"))
    met = staged(laid.select("doc_id", "row", "base", "i", "x.*").where("seed is not null").join(seeds, ["mask", "seed"]).drop("mask", "seed").distinct(), "seed-hits")
    beside = blocks.dropDuplicates(["doc_id", "row", "base"]).join(met, ["doc_id", "row", "base"])
    return beside.select("doc_id", F.expr("base + i - lead").alias("at"), F.expr(_around("i", window)).alias("words"), "item_id", "item_at", "n", "item_words")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", masks: tuple[str, ...] = MASKS, window: int = WINDOW, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """(doc_id, item_id, at_word, n_words, n_same): per text and item the window that agrees most: its first word in the text, its words, and those that agree."""
    if not all("0" in m and m[0] == m[-1] == "1" for m in masks):
        raise ValueError("masks begin and end with a one and ignore a word between")
    least = max(LEAST_WORDS, *map(len, masks))
    items = staged(benchmark.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w")).where(F.size("w") > 0), "items")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    short = sorted(r["n"] for r in items.where(F.size("w") < least).select(F.size("w").alias("n")).distinct().collect())
    every = (*masks, *("1" * n for n in short))
    seeds = staged(item_seeds(items, every, window, least), "item-seeds")
    hits = _hits(texts, seeds, every, window)
    same = F.zip_with("words", "item_words", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    size = F.least(F.col("n"), F.lit(window))
    percent = F.when(F.col("n") < least, 100).otherwise(least_percent)
    likely = hits.select("doc_id", "item_id", "at", "item_at", "n", size.alias("n_words"), percent.alias("percent"), same.alias("same")).where(100 * F.aggregate("same", F.lit(0), lambda a, x: a + x) >= F.col("percent") * F.col("n_words"))
    # windows of the item that hold the hit's first word; s is their start from there
    starts = f"sequence(greatest({1 - window}, 1 - n_words, -item_at), least(0, n - n_words - item_at))"
    sums = f"transform({starts}, s -> struct(-aggregate(slice(same, s + {window}, n_words), 0, (a, x) -> a + x) AS less, at + s AS at_word, n_words AS n_words))"
    best = likely.select("doc_id", "item_id", "percent", F.expr(f"array_min({sums})").alias("b")).where("-100 * b.less >= percent * b.n_words")
    return best.groupBy("doc_id", "item_id").agg(F.min("b").alias("b")).select("doc_id", "item_id", "b.at_word", "b.n_words", (-F.col("b.less")).alias("n_same"))

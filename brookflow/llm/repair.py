"""Conversation structure repair: cheapest edits by Dial's bucket queue.

A conversation's rows, in order of turn (nulls first), role and SHA-256 of the
text, are to become `(s?(ua)+)?` in the initials of their roles. Edits: keep a
row (0), change its role to user or assistant (3), delete it (4; a must for
blank rows and repeated ones), insert an empty user or assistant row (3); an
unfinished row that isn't deleted adds 3. The edits are arcs between nodes (rows
done, state of the pattern); arcs cost 0 to 6, so shortest ways to the end come
from an array of buckets. The audit is the lexicographically least shortest way:
from the start, the arc that is tight and has the least letter, again and again.

A row that must go needs no node: its deletion is tight wherever the way stands
and D is the least letter, so it is written as soon as the way reaches it.

Long conversations: equal rows are counted before they are shuffled, the order
comes from range partitions, and blocks of at most 2**BITS rows are solved on
their own. Of a conversation in several blocks each gives the costs between its
four entries and exits; a scan over those gives every block the distances at its
end; then each is walked from all four entries and the scan of exits picks the
walk that holds. Texts are shuffled once and streamed past the audit, as the
SHA-256 of a repaired conversation can't be taken in parts; nothing but the audit
is held for that, a byte per row.

Defined results: null roles and texts are one blank (so such a text is blank,
and no pattern keeps such a role); rows without a conversation id are one
conversation, whose id is null; rows of one turn are ordered by role and text
digest, so repeated rows are neighbours; an empty table gives an empty table;
columns other than the four are ignored, clashing names or not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.llm.common import staged
from brookflow.llm.ordered import BITS, BLANKS, block, conversation_key, in_order

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
#: Out of reach.
FAR = 1 << 40
#: States: 0 nothing yet, 1 behind s, 2 behind u, 3 behind a. Initials: 0 s, 1 u, 2 a, 3 any other.
_STEP = (2, 2, 3, 2)
_ON = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_NAMES = {2: "user", 3: "assistant"}
_ENDS = (0, FAR, FAR, 0)
_STEP_FROM = tuple(tuple(p for p in range(4) if _STEP[p] == q) for q in range(4))
_ON_FROM = tuple(tuple(tuple(p for p in range(4) if _ON.get((p, c)) == q) for q in range(4)) for c in range(4))
_FOLLOWS = {(0, 1), (1, 2), (2, 1)}
#: Kinds of rows: sound, truncated, blank, repeated. The last two must go.
SOUND, TRUNCATED, BLANK, REPEATED = range(4)


def distances(codes: list[int], ends: tuple[int, ...] | list[int]) -> list[int]:
    """At 4 * i + q: the least cost from row i in state q to the end, whose states cost `ends`. codes: initial + 4 * (truncated) of rows that may stay.

    Dial's queue: node by node in order of distance, from an array of buckets.
    """
    n = len(codes)
    least = min(ends)
    dist = [FAR] * (4 * n + 4)
    buckets: list[list[int]] = [[] for _ in range(max(x - least for x in ends if x < FAR) + 1)]
    for q, x in enumerate(ends):
        if x < FAR:
            dist[4 * n + q] = x - least
            buckets[x - least].append(4 * n + q)
    d = 0
    while d < len(buckets):
        for node in buckets[d]:  # grows by arcs of no cost
            if dist[node] < d:
                continue
            i, q = node >> 2, node & 3
            arcs = [(4 * i + p, INSERT) for p in _STEP_FROM[q]]
            if i:
                late = UNFINISHED if codes[i - 1] >= 4 else 0
                to = 4 * i - 4
                arcs.append((to + q, DELETE))
                arcs += [(to + p, REROLE + late) for p in _STEP_FROM[q]]
                arcs += [(to + p, KEEP + late) for p in _ON_FROM[codes[i - 1] & 3][q]]
            for other, cost in arcs:
                if d + cost < dist[other]:
                    dist[other] = d + cost
                    while len(buckets) <= d + cost:
                        buckets.append([])
                    buckets[d + cost].append(other)
        buckets[d] = []
        d += 1
    return [x + least if x < FAR else FAR for x in dist]


def walk(codes: list[int], leading: int, forced: list[int], dist: list[int], ends: tuple[int, ...] | list[int], state: int) -> tuple[str, int, int]:
    """(audit, state at the end, cost) of the least tight way from a state; forced[i] deletions follow row i, `leading` go ahead of all.

    At the end it goes on as soon as that costs no more: what comes next may be a deletion, which is less than an insertion.
    """
    audit, cost, i, n = ["D" * leading], DELETE * leading, 0, len(codes)
    while True:
        now = dist[4 * i + state]
        if i == n and now == ends[state]:
            return "".join(audit), state, cost
        if i < n:
            late, on = (UNFINISHED if codes[i] >= 4 else 0), _ON.get((state, codes[i] & 3))
            arcs = [("D", DELETE, i + 1, state), ("I", INSERT, i, _STEP[state])]
            if on is not None:
                arcs.append(("K", KEEP + late, i + 1, on))
            arcs.append(("R", REROLE + late, i + 1, _STEP[state]))
        else:
            arcs = [("I", INSERT, i, _STEP[state])]
        letter, price, to, q = next(x for x in arcs if dist[4 * x[2] + x[3]] + x[1] == now)
        audit.append(letter)
        cost += price
        if to > i and forced[i]:
            audit.append("D" * forced[i])
            cost += DELETE * forced[i]
        i, state = to, q


def _split(rows: list[dict]) -> tuple[list[int], int, list[int]]:
    """codes, leading, forced of a block's rows {code: initial + 4 * kind, n}: of a row that may stay only the first of equal ones does."""
    codes, forced, leading = [], [], 0
    for r in rows:
        kind, n = r["code"] >> 2, r["n"]
        if kind in (SOUND, TRUNCATED):
            codes.append(r["code"])
            forced.append(n - 1)
        elif forced:
            forced[-1] += n
        else:
            leading += n
    return codes, leading, forced


def damaged(conversations: DataFrame) -> DataFrame:
    """(cid, turn, role, text, n) of conversations harmed by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes out `[.!?]`, 3 doubles it (n = 2), 4 makes it the user's."""
    harm = F.crc32(F.concat(conversation_key(), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.where(harm != 0).select(
        conversation_key().alias("cid"), "turn", F.when(harm == 4, "user").otherwise(role).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), F.when(harm == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def plain(conversations: DataFrame) -> DataFrame:
    """(cid, turn, role, text, n) of conversations as they are."""
    return conversations.select(conversation_key().alias("cid"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).cast("long").alias("n"))


def _digest(text: str = "text") -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def _blocks(rows: DataFrame, bits: int) -> DataFrame:
    """(cid, block, rows, turns): the rows of each block in order, without their texts."""
    seen = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(seen == "", BLANK).when(F.substring(seen, -1, 1).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    compact = rows.select("cid", "turn", "role", _digest().alias("digest"), fault.alias("kind"), "n")
    equal = staged(compact.groupBy("cid", "turn", "role", "digest", "kind").agg(F.sum("n").alias("n")), "turns")
    firsts = equal.groupBy("cid", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("given"), "turn")).alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1")
    first = firsts.select(F.col("cid").alias("c"), F.col("role").alias("r"), F.col("digest").alias("g"), F.col("first.turn").alias("t"))
    marked = equal.join(first, (F.col("cid") == F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("g")), "left")
    again = F.col("c").isNotNull() & ~F.col("turn").eqNullSafe(F.col("t"))
    kind = F.when((F.col("kind") != BLANK) & again, REPEATED).otherwise(F.col("kind"))
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    line = in_order(marked.select("cid", "turn", "role", "digest", (initial + 4 * kind).alias("code"), "n"), "cid", "turn", "role", "digest")
    return line.groupBy("cid", block(bits).alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "code", "n"))), lambda x: F.struct(x["code"], x["n"])).alias("rows"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).cast("long").alias("turns"),
    )


def _each(df: DataFrame, of, schema: str) -> DataFrame:
    """The rows (dicts) that `of` yields for each row of df."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                made = [x for row in batch.slice(at, 256).to_pylist() for x in of(row)]
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=kinds)

    kinds = _arrow(df, schema)
    return df.mapInArrow(run, schema)


def _arrow(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _matrix(row: dict) -> Iterator[dict]:
    """Costs from each entry to each exit, without the deletions that are forced anyway."""
    codes, _, _ = _split(row["rows"])
    columns = [distances(codes, [0 if q == k else FAR for q in range(4)])[:4] for k in range(4)]
    yield {"cid": row["cid"], "block": row["block"], "matrix": [columns[k][q] for q in range(4) for k in range(4)]}


def _ends(row: dict) -> Iterator[dict]:
    """The distances at the end of every block, from the last to the first."""
    ends = list(_ENDS)
    for x in reversed(row["parts"]):
        yield {"cid": row["cid"], "block": x["block"], "ends": ends}
        m = x["matrix"]
        ends = [min(FAR, *(m[4 * q + k] + ends[k] for k in range(4))) for q in range(4)]


def _walked(row: dict) -> Iterator[dict]:
    codes, leading, forced = _split(row["rows"])
    ends = row["ends"] or _ENDS
    dist = distances(codes, ends)
    walks = [walk(codes, leading, forced, dist, ends, q) if dist[q] < FAR else ("", q, FAR) for q in (range(4) if row["ends"] else [0])]
    kinds, illegal, before = [0] * 4, 0, None
    for r in row["rows"]:
        initial, kind, n = r["code"] & 3, r["code"] >> 2, r["n"]
        once = kind in (SOUND, TRUNCATED)
        kinds[kind] += 1 if once else n
        kinds[REPEATED] += n - 1 if once else 0
        illegal += n - 1 + (before is not None and (before, initial) not in _FOLLOWS)
        before = initial
    yield {
        "cid": row["cid"], "block": row["block"], "audits": [w[0] for w in walks], "exits": [w[1] for w in walks], "costs": [w[2] for w in walks],
        "blank": kinds[BLANK], "duplicate": kinds[REPEATED], "truncated": kinds[TRUNCATED], "illegal": illegal,
        "first": row["rows"][0]["code"] & 3, "last": before, "low": row["low"], "high": row["high"], "turns": row["turns"],
    }


def _joined(row: dict) -> Iterator[dict]:
    """The blocks of a conversation put together."""
    out = {"cid": row["cid"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
    audit, state, before, low, high, turns = [], 0, None, None, None, 0
    for x in row["parts"]:
        audit.append(x["audits"][state])
        out["cost"] += x["costs"][state]
        state = x["exits"][state]
        for name in ("blank", "duplicate", "truncated", "illegal"):
            out[name] += x[name]
        out["illegal"] += before is not None and (before, x["first"]) not in _FOLLOWS
        before = x["last"]
        if x["turns"]:
            turns += x["turns"] - (high is not None and high == x["low"])
            low, high = x["low"] if low is None else low, x["high"]
    yield out | {"gaps": high - low + 1 - turns if turns else 0, "audit": "".join(audit)}


def audits(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """(cid, gaps, blank, duplicate, truncated, illegal, cost, audit) of conversations with rows (cid, turn, role, text, n)."""
    blocks = staged(_blocks(rows, bits), "blocks")
    several = blocks.groupBy("cid").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("cid")
    matrices = _each(blocks.join(several, "cid").select("cid", "block", "rows"), _matrix, "cid string, block long, matrix array<long>")
    parts = matrices.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("block", "matrix"))).alias("parts"))
    ends = _each(parts, _ends, "cid string, block long, ends array<long>")
    walks = _each(
        blocks.join(ends, ["cid", "block"], "left"), _walked,
        "cid string, block long, audits array<string>, exits array<long>, costs array<long>, blank long, duplicate long, truncated long, illegal long, first long, last long, low long, high long, turns long",
    )
    fields = [c for c in walks.columns if c != "cid"]
    whole = walks.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("parts"))
    return _each(whole, _joined, "cid string, blank long, duplicate long, truncated long, illegal long, cost long, gaps long, audit string")


_STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _line(conversations: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one task's stream."""
    ids = conversations.select(conversation_key().alias("cid"), F.col("conv_id").cast("long").alias("conv_id")).distinct()
    heads = ids.join(found, "cid", "left").select("cid", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.coalesce("audit", F.lit("")).alias("text"), F.lit(1).cast("long").alias("n"), "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _STATS))
    none = [F.lit(None).cast("long").alias(c) for c in ("conv_id", *_STATS)]
    both = heads.unionByName(rows.select("cid", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "text", "n", *none))
    return both.withColumn("digest", F.when(F.col("kind") == 1, _digest())).repartition("cid").sortWithinPartitions("cid", "kind", F.col("turn").asc_nulls_first(), "role", "digest")


class _Mended:
    """Rows of one conversation as its audit says, one after another."""

    def __init__(self, head: dict) -> None:
        self.head, self.audit, self.at, self.state = head, head["text"], 0, 0

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = _STEP[self.state]
            yield "I", _NAMES[self.state], ""

    def row(self, role: str, text: str, n: int) -> Iterator[tuple[str, str, str]]:
        for _ in range(n):
            yield from self.inserted()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = _ON[self.state, "sua".index(role[0])]
                yield "K", role, text
            elif letter == "R":
                self.state = _STEP[self.state]
                yield "R", _NAMES[self.state], text


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str, str]]]]:
    """(head, its rows) of every conversation of a stream of _line; a conversation's rows are to be taken before the next one."""
    stream = (r for b in batches for at in range(0, len(b), 256) for r in b.slice(at, 256).to_pylist())
    waiting = next(stream, None)

    def rows(one: _Mended) -> Iterator[tuple[str, str, str]]:
        nonlocal waiting
        while (waiting := next(stream, None)) is not None and waiting["kind"]:
            yield from one.row(waiting["role"], waiting["text"], waiting["n"])
        yield from one.inserted()

    while waiting is not None:
        yield waiting, rows(_Mended(waiting))


def repaired(conversations: DataFrame, rows: DataFrame | None = None, bits: int = BITS) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of repaired conversations, numbered from 0; edit is K, R or I. rows: what is to be repaired, if not the conversations themselves."""
    rows = plain(conversations) if rows is None else rows
    schema = "conv_id long, place long, edit string, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for head, made in _mended(batches):
            for place, (edit, role, text) in enumerate(made):
                held.append((head["conv_id"], place, edit, role, text))
                if len(held) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds.types, strict=True)], schema=kinds)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds.types, strict=True)], schema=kinds)

    kinds = _arrow(conversations, schema)
    return _line(conversations, rows, audits(rows, bits)).mapInArrow(run, schema)


def repair_report(conversations: DataFrame, rows: DataFrame, bits: int = BITS) -> DataFrame:
    """A row per original conv_id: what is wrong with its rows, the cheapest repair's cost and audit, and the SHA-256 of the repaired `role:text` lines."""
    schema = "conv_id long, " + ", ".join(f"{c} long" for c in _STATS) + ", audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for head, made in _mended(batches):
            digest, join = hashlib.sha256(), b""
            for _, role, text in made:
                digest.update(join + f"{role}:{text}".encode())
                join = b"\n"
            held.append({c: head[c] for c in ("conv_id", *_STATS)} | {"audit": head["text"], "repaired_sha256": digest.hexdigest()})
            if len(held) == 256:
                yield pa.RecordBatch.from_pylist(held, schema=kinds)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=kinds)

    kinds = _arrow(conversations, schema)
    return _line(conversations, rows, audits(rows, bits)).mapInArrow(run, schema)

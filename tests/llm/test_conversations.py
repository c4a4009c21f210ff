"""Structure repair and prefix tries against plain versions, with conversations in many blocks."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from brookflow.llm import queries, repair, trie

SCHEMA = "conv_id long, turn long, role string, text string, block string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def order(r):
    return (r[1] is not None, r[1] or 0, r[2], sha(r[3]))


def blank(text):
    return not text.strip(" \t\n\x0b\f\r")


def plain_damage(rows):
    out = []
    for c, turn, role, text in rows:
        harm = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm == 1:
            text = ""
        if harm == 2:
            text = "".join(x for x in text if x not in ".!?")
        if harm == 4:
            role = "user"
        out += [(c, turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return out


def plain_repair(rows):
    """One conversation's rows: every edit of every row, tried from the last row to the first."""
    rows = sorted(rows, key=order)
    kinds, seen = [], set()
    for r in rows:
        if blank(r[3]):
            kinds.append("blank")
        elif r[2:] in seen:
            kinds.append("duplicate")
        else:
            kinds.append("sound" if r[3].rstrip(" \t\n\x0b\f\r")[-1] in ".!?" else "truncated")
        seen.add(r[2:])
    on = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 3:
            cost, audit, made = best(i, step[state], inserted + 1)
            ways.append((cost + 3, "I" + audit, ((names[step[state]], ""), *made)))
        if i < len(rows):
            _, _, role, text = rows[i]
            late = 3 * (kinds[i] == "truncated")
            cost, audit, made = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit, made))
            if kinds[i] in ("sound", "truncated"):
                if (state, role[:1]) in on:
                    cost, audit, made = best(i + 1, on[state, role[:1]], 0)
                    ways.append((cost + late, "K" + audit, ((role, text), *made)))
                cost, audit, made = best(i + 1, step[state], 0)
                ways.append((cost + 3 + late, "R" + audit, ((names[step[state]], text), *made)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, made = best(0, "", 0)
    given = [r[1] for r in rows if r[1] is not None]
    gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(f"{a}:{b}" for a, b in made))), made


def talks(seed, many):
    r = random.Random(seed)
    texts = ["So it is.", "Why?", "unfinished", " \t", "", None, "No!", "x" * 3000 + "."]
    rows = []
    for c in [*range(many), None, 900]:
        for turn in range(r.choice([0, 1, 2, 5, 9]) if c != 900 else 60):
            rows.append((c, r.choice([turn, turn, turn, None, turn + 3]), r.choice(["user", "assistant", "user", "assistant", "system", None, "", "other"]), r.choice(texts)))
    return rows + rows[:5]


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_repairs_against_every_edit(spark, bits):
    rows = talks(3, 25)
    conversations = frame(spark, rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair_report(conversations, repair.damaged(conversations), bits).collect()}
    after = plain_damage(rows)
    assert set(got) == {r[0] for r in rows}
    for c in got:
        assert got[c] == plain_repair([r for r in after if r[0] == c])[0], c


def test_repaired_rows(spark):
    rows = talks(4, 12)
    conversations = frame(spark, rows)
    got = {}
    for r in sorted(repair.repaired(conversations, bits=1).collect(), key=lambda r: r["place"]):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for c in {r[0] for r in rows}:
        blanked = [(a, b, " " if x is None else x, " " if y is None else y) for a, b, x, y in rows if a == c]
        assert tuple(got.get(c, [])) == plain_repair(blanked)[1]


def test_equal_rows_of_a_long_conversation(spark):
    rows = [(7, 1, "user", "Same.")] * 300 + [(7, 2, "assistant", "End.")] + [(7, t, "user", "Same.") for t in range(3, 40)]
    out = repair.repair_report(frame(spark, rows), repair.plain(frame(spark, rows)), 3).collect()[0]
    assert out["audit"] == "K" + "D" * 299 + "K" + "D" * 37 and out["cost"] == 4 * 336 and out["duplicate"] == 336 and out["illegal"] == 299 + 36


def test_no_rows_after_damage_and_no_rows(spark, tmp_path):
    c = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    conversations = frame(spark, [(c, 0, "user", "Gone.")])
    row = repair.repair_report(conversations, repair.damaged(conversations)).collect()
    assert [tuple(r) for r in row] == [(c, 0, 0, 0, 0, 0, 0, "", sha(""))]
    conversations.where("false").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_structure_repair(spark, str(tmp_path)).count() == 0
    assert queries.op13_prefix_trie(spark, str(tmp_path)).count() == 0


def plain_trie(rows):
    by = {}
    for r in rows:
        if r[0] is not None:
            by.setdefault(r[0], []).append((r[0], r[1], r[2] or "", r[3] or ""))
    talk = {c: [x[2:] for x in sorted(v, key=order)] for c, v in by.items()}
    made = {}
    for c in talk:
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(talk.get(c - c % 100, [])[:h] + talk[c][h:])
    members = {}
    for c, path in made.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], set()).add(c)
    out = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = sum(len(x) == len(node) + 1 for x in below)
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in sorted(own) if made[c] == node)
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children, leaves, saved, sha(ends)))
    return sorted(out, key=repr)


def shared_talks(seed):
    r = random.Random(seed)
    rows = []
    for c in [*range(95, 150), *range(198, 215), 340]:
        words = r.choice([["Hi é 日.", "Yes."], ["Hi é 日.", "No."], [None, "Yes."]])
        rows += [(c, r.choice([t, t, None]), r.choice(["user", None]), words[t % 2]) for t in range(r.choice([1, 2, 3, 7]))]
    return rows + [(100, t, "user", "again") for t in range(40)] + [(100, 3, "user", "again")] * 3 + [(None, 1, "user", "none")]


@pytest.mark.parametrize(("bits", "most"), [(12, 4096), (1, 2), (0, 0), (3, 5)])
def test_tries_against_all_beginnings(spark, bits, most):
    rows = shared_talks(bits)
    got = [tuple(r)[:8] for r in trie.prefix_trie(frame(spark, rows), bits, most).collect()]
    assert sorted(got, key=repr) == plain_trie(rows)


def test_one_talk_of_many_turns(spark):
    rows = [(200, t, "user", f"turn {t}") for t in range(700)] + [(c, t, "user", f"turn {t}") for c in (205, 310) for t in range(20)]
    got = [tuple(r)[:8] for r in trie.prefix_trie(frame(spark, rows), 4, 1).collect()]
    assert sorted(got, key=repr) == plain_trie(rows)

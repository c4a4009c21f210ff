"""The pipeline on a small corpus with nulls, repeats and empties, each stage against a plain version of it."""

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from brookflow.llm import tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode().lower().split()


def line_dedup(rows):
    """Later occurrences of windows of three lines go; documents in order of id, then of the rows given."""
    seen, out = {}, []
    for i, text, *rest in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        lines, gone = text.split("\n"), set()
        for k in range(len(lines) - 2):
            window = tuple(lines[k : k + 3])
            if any(x.strip(" ") for x in window) and seen.setdefault(window, (i, text, k)) != (i, text, k):
                gone |= {k, k + 1, k + 2}
        left = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        if not gone or left.strip(" \t\r\n"):
            out.append((i, left, *rest[:2], len(left) if gone else rest[2]))
    return out + [r for r in rows if r[0] is None or r[1] is None]


def near_dedup(rows):
    told = sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=lambda x: (x[0], x[1] or ""))
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(t)) else set() for _, t in told]
    group = list(range(len(told)))
    for _ in told:
        for a in range(len(told)):
            for b in range(a):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    kept = {told[i] for i in range(len(told)) if group[i] == i}
    out = []
    for r in rows:
        if r[0] is None:
            out.append(r)
        elif (r[0], r[1]) in kept:
            kept.remove((r[0], r[1]))
            out.append(r)
    return out


def decontaminate(rows, items):
    held = set()
    for i, text, *_ in rows:
        w = words(text)
        for item in filter(None, map(words, items)):
            for at in range(1 - len(item), len(w)):
                same = [0 <= at + k < len(w) and w[at + k] == x for k, x in enumerate(item)]
                size = min(20, len(item))
                least = 100 if len(item) < 8 else 80
                if any(100 * sum(same[k : k + size]) >= least * size for k in range(len(same) - size + 1)):
                    held.add(i)
    return [r for r in rows if r[0] is None or r[0] not in held]


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    r = random.Random(12)
    vocab = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    item = " ".join(f"q{i}" for i in range(18))
    swapped = item.split()
    swapped[3] = swapped[9] = swapped[14] = "zz"
    passage = "\n".join(prose(20) for _ in range(4))
    base = prose(200)
    near = base.split()
    near[100:104] = ["n1", "n2", "n3", "n4"]
    texts = [base, " ".join(near), base, prose(30) + "\n" + passage, passage + "\n" + prose(30), passage, prose(10) + " " + item, prose(9) + " " + " ".join(swapped) + " x", "a\nb\nc", "a\nb\nc", None, "", " \n ", "one two", "five q1 q2 q3"]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(0, base, "en", "s", len(base)), (50, base, "en", "s", len(base)), (50, prose(40), "en", "s", 1), (None, base, "en", "s", 5), (None, None, None, None, None)]
    rows += [(100 + i, prose(40) + (" vile brute scoundrel" if i % 3 == 0 else ""), "en", "s", 7) for i in range(150)]
    labels = [(100 + i, 1, int(i % 3 == 0)) for i in range(150)]
    return rows, labels, [(1, item), (2, "five q1 q2 q3"), (3, None), (4, "")]


def written(spark, path, rows, labels, items):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_every_stage_against_a_plain_version(spark, corpus, tmp_path):
    rows, labels, items = corpus
    d = written(spark, tmp_path / "t", rows, labels, items)
    stages = dict(corpus_pipeline.STAGES)
    as_rows = lambda df: sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    clean = as_rows(stages["toxicity"](spark, docs, d))
    toxic = {100 + i for i in range(150) if i % 3 == 0}
    gone = {r[0] for r in rows} - {r[0] for r in clean}
    assert len(gone & toxic) > 0.9 * len(toxic) and len(gone - toxic) <= 2
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    lines = as_rows(stages["line_dedup"](spark, frame(clean), d))
    assert lines == sorted(line_dedup(clean), key=str)
    assert len(lines) == len(clean) - 2  # the second "a b c" and the whole passage
    near = as_rows(stages["minhash"](spark, frame(lines), d))
    assert near == sorted(near_dedup(lines), key=str)
    fit = as_rows(stages["decontaminate"](spark, frame(near), d))
    assert fit == sorted(decontaminate(near, [t for _, t in items]), key=str) and {6, 7, 14}.isdisjoint(r[0] for r in fit)
    enc = tokens.encoder(tokens.default_path()).tokenizer
    want = [(r[0], zlib.crc32(np.array(enc.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4").tobytes())) for r in fit]
    packed = corpus_pipeline.run(spark, d).collect()
    assert sorted(((r["doc_id"], r["ids_crc32"]) for r in packed), key=str) == sorted(want, key=str)
    assert sum(r["length"] for r in packed) <= 2048 * len({r["sequence_id"] for r in packed})


def test_an_empty_corpus(spark, tmp_path):
    d = written(spark, tmp_path / "t", [], [], [])
    assert corpus_pipeline.run(spark, d).count() == 0

"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, against brute force."""

import itertools
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brookflow.llm import common, decontaminate, langid, linededup, minhash, packing, tokenids, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, n_chars long, bucket string, label int, cls int, rank int"


def frame(spark, texts, ids=None):
    rows = [(i, t, "en", None, "b", 1, 2, 3) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    base = " ".join(r.choice(vocab) for _ in range(80))
    near = base.split()
    near[40] = "changed"
    return [base, base, " ".join(near), None, "", " \n\t ", "one two", "One  TWO", "x", " ".join(r.choice(vocab) for _ in range(9000)), "Straße ÉÉ 日本 ‖ a\x1cb <|endoftext|> it's", base + "\n" + base]


def test_word_and_shingle_hashes_match_split(texts):
    col = pa.array(texts)
    got = []
    for _, _, data, starts, ends in common.text_blocks(col):
        words, first = common.word_hashes(data, starts, ends)
        sh, sf = common.shingle_hashes(words, first, 5)
        got += [(list(words[a:b]), list(sh[c:d])) for a, b, c, d in zip(first, first[1:], sf, sf[1:])]
    seen = {}
    for t, (hashes, shingles) in zip(texts, got):
        w = (t or "").encode().lower().split()
        assert len(w) == len(hashes)
        for a, b in zip(w, hashes):
            assert seen.setdefault(a, b) == b
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])
        assert len(runs) == len(shingles)
        for a, b in zip(runs, shingles):
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)


def test_minhash_against_brute_force(spark, texts):
    ids = list(range(len(texts)))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    sets = {}
    for i in ids:
        w = (texts[i] or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids[:a]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    for i in ids:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), root(i), root(i) == i)
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_minhash_null_ids_and_repeated_rows(spark):
    t = "a b c d e f g"
    got = [tuple(r)[:4] for r in minhash.near_duplicates(frame(spark, [t, t, t, t], [None, 4, 4, 9])).collect()]
    assert sorted(got, key=str) == sorted([(None, 3, None, True), (4, 3, 4, True), (4, 3, 4, True), (9, 3, 4, False)], key=str)


def test_minhash_ids_with_several_texts(spark):
    """Rows of one id are judged by their own texts: 1 has texts like 5's and like 0's, which aren't linked with each other."""
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = frame(spark, [one, two, one, two, "x y z", None], [1, 1, 5, 0, 1, 1])
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"], r["stands"]) for r in minhash.near_duplicates(rows).collect())
    assert got == [(0, 36, 0, True, True), (1, 0, 1, True, True), (1, 1, 1, True, True), (1, 36, 0, False, False), (1, 36, 1, True, True), (5, 36, 1, False, False)]


def _changed(seed, count):
    """Copies of a base with different words changed: most are linked with the base alone."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    docs = [" ".join(base)]
    for k in range(count):
        w = list(base)
        for j in r.sample(range(120), r.choice([1, 1, 2, 3, 6])):
            w[j] = f"z{k}_{j}"
        docs.append(" ".join(w))
    return docs


@pytest.mark.parametrize("portion", [3, 16])
def test_minhash_buckets_of_many_portions(spark, portion):
    """Buckets far larger than a portion: leaders meet in further rounds, and what stays open is compared block by block."""
    docs = _changed(7, 90)
    sets = [{tuple(d.split()[i : i + 5]) for i in range(116)} for d in docs]
    want = list(range(len(docs)))
    for _ in range(6):
        for a in range(len(docs)):
            for b in range(len(docs)):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    want[a] = min(want[a], want[b])
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(frame(spark, docs), portion=portion).collect()}
    assert [got[i] for i in range(len(docs))] == want


def test_words_of_long_texts_are_hashed_in_windows(monkeypatch):
    r = random.Random(2)
    col = pa.array(["".join(r.choice("ab \nÉ") for _ in range(r.choice([0, 5, 300]))) for _ in range(60)] + ["x" * 500, "", "a b"])

    def hashed():
        return [(words.tolist(), first.tolist()) for _, _, data, starts, ends in common.text_blocks(col) for words, first in [common.word_hashes(data, starts, ends)]]

    monkeypatch.setattr(common, "_cache", {})
    monkeypatch.setattr(common, "BLOCK_BYTES", 1 << 20)
    whole = hashed()
    original = common.text_blocks
    monkeypatch.setattr(common, "text_blocks", lambda c: original(c) if common.BLOCK_BYTES > 64 else iter(blocks))
    blocks = list(original(col))
    for size in (1, 7, 64):
        monkeypatch.setattr(common, "BLOCK_BYTES", size)
        assert hashed() == whole


def test_minhash_large_mixed_bucket(spark):
    """Copies of a base with different words changed: most are linked with the base alone."""
    r = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    docs = [" ".join(base)]
    for k in range(60):
        w = list(base)
        for j in r.sample(range(120), r.choice([1, 1, 2, 3, 6])):
            w[j] = f"z{k}_{j}"
        docs.append(" ".join(w))
    sets = [{tuple(d.split()[i : i + 5]) for i in range(116)} for d in docs]
    want = list(range(len(docs)))
    for _ in range(10):
        for a in range(len(docs)):
            for b in range(len(docs)):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    want[a] = min(want[a], want[b])
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(frame(spark, docs)).collect()}
    assert [got[i] for i in range(len(docs))] == want


def test_minhash_bounds_follow_the_threshold():
    for percent in (1, 30, 50, 70, 80, 85, 95, 99, 100):
        b, t = minhash.bounds_of(percent), percent / 100
        assert (1 - t**b.rows) ** b.bands <= minhash.MISSED and b.rows * b.bands <= b.coordinates
        for cut, n in ((b.estimate, b.coordinates), (b.wide_estimate, max(b.coordinates, minhash.WIDE_COORDINATES))):
            assert cut <= t - 4.5 * (t * (1 - t) / n) ** 0.5
    assert (minhash.bounds_of(85).rows, minhash.bounds_of(85).bands) == (5, 22)


def _near_pairs():
    """Pairs of texts of 200 words of which one has a changed block or a longer end: similarity 0.80 to 0.85."""
    out = []
    for k in range(12):
        base = [f"p{k}w{i}" for i in range(204)]
        out += [" ".join(base[:164]), " ".join(base[: 164 + 31 + k % 9])]  # 160 of 191 to 199 runs
    return out


def test_minhash_least_percent_80(spark):
    """Links between 80 and 85 %, also by size: all are found at 80, and the pipeline's stage takes them out."""
    import corpus_pipeline

    docs = _near_pairs()
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(frame(spark, docs), least_percent=80).collect()}
    assert [got[i] for i in range(len(docs))] == [i - i % 2 for i in range(len(docs))]
    kept = {x["doc_id"] for x in corpus_pipeline.near_dedup(spark, frame(spark, docs), "").collect()}
    assert kept == set(range(0, len(docs), 2))


def test_minhash_open_bucket_at_80(spark):
    """Large buckets, whose members don't all meet their leader, at 80 %: a bucket of three and more is searched by signatures."""
    r = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    docs = [" ".join(base)]
    for k in range(60):
        w = list(base)
        for j in r.sample(range(150), r.choice([1, 2, 3, 4, 5])):
            w[j] = f"z{k}_{j}"
        docs.append(" ".join(w[: r.choice([150, 140, 130])]))
    sets = [{tuple(d.split()[i : i + 5]) for i in range(len(d.split()) - 4)} for d in docs]
    want = list(range(len(docs)))
    for _ in range(10):
        for a in range(len(docs)):
            for b in range(len(docs)):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    want[a] = min(want[a], want[b])
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(frame(spark, docs), least_percent=80).collect()}
    assert [got[i] for i in range(len(docs))] == want


@pytest.mark.parametrize("sizes", [(tokenids.FILE_BYTES, tokenids.BLOCK_IDS), (600, 100), (100, 1)])
def test_token_files_round_trip(spark, texts, sizes):
    """One file and block, and several of both."""
    ids = [5, 3, None, 1, 9, 2, 7, 7, 8, 4, 6, 0] + [7] * 20
    texts = texts + ["seven times " + "x" * i for i in range(20)]
    enc = tokens.encoder(tokens.default_path()).tokenizer
    want = []
    for i, t in zip(ids, texts, strict=True):
        a = np.array(enc.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, len(a), zlib.crc32(a.tobytes())))
    out = common.new_dir(spark, "token-files")
    tokenids.write_token_files(frame(spark, texts, ids), out, tokens.default_path(), end_id=2, file_bytes=sizes[0], block_ids=sizes[1])
    got = [tuple(r) for r in tokenids.read_token_files(spark, out, with_ids=False).collect()]
    assert sorted(((i, n, c) for i, _, n, c in got), key=str) == sorted(want, key=str)
    at, got = 0, sorted(got, key=lambda r: r[1])
    for _, start, n, _ in got:
        assert start == at
        at += n
    assert [r[0] for r in got] == sorted(ids, key=lambda x: (x is not None, x))
    files = sorted(Path(out.removeprefix("file:") + "/files").glob("part-*"))
    heads = [line.split(b"\n")[0].split(b" ") for f in files for line in f.read_bytes().split(b"\0")[:-1]]
    assert [int(h[3]) for h in heads] == sorted(int(h[3]) for h in heads) and sum(int(h[1]) for h in heads) == len(ids)
    assert (len(files) > 3 and len(heads) > 5) if sizes[0] < 1000 else len(heads) == 1
    whole = {(r["doc_id"], r["n_tokens"], zlib.crc32(r["ids"])) for r in tokenids.read_token_files(spark, out).collect()}
    assert whole == set(want)


def test_token_files_of_an_empty_table(spark):
    assert tokenids.token_ids(spark, frame(spark, []), tokens.default_path()).count() == 0


@pytest.mark.parametrize("window", [1, 16, 300, 1 << 20])
def test_column_encoding_equals_the_tokenizer(monkeypatch, window):
    """Texts of all sizes against windows of all sizes: nulls, added tokens, long chunks, other scripts, slices."""
    r = random.Random(window)
    alphabet = [*"aZéÉß .,-'\n\t\r_9  日Å ſ", "e\u0301", "<|endoftext|>", "'s", "İ", "don't"]
    rows = [None if r.random() < 0.05 else "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 3, 20, 400]))) for _ in range(800)]
    rows += ["x" * 1000, "", None]
    monkeypatch.setattr(tokens, "WINDOW", window)
    enc = tokens.ChunkEncoder(tokens.default_path())
    for column in (pa.array(rows).slice(3), pa.array(rows, pa.large_string()), pa.array([], pa.string()), pa.array([None, ""])):
        ids, first = enc.encode_column(column)
        want = [e.ids for e in enc.tokenizer.encode_batch_fast([x or "" for x in column.to_pylist()], add_special_tokens=False)]
        assert [list(ids[a:b]) for a, b in zip(first, first[1:])] == want
        ids, first = tokens.closed(ids, first, 7)
        assert [list(ids[a:b]) for a, b in zip(first, first[1:])] == [x + [7] for x in want]


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 2000)
    enc = tokens.ChunkEncoder(tokens.default_path())
    for k in range(30):
        enc.encode_column(pa.array([" ".join(f"word{chr(97 + k % 26)}{chr(97 + j)}" for j in range(20))]))
        assert enc.kept <= 2000 and len(enc.known) <= 12


@pytest.mark.parametrize("top", [1, 250, 60_000, 1 << 20, 1 << 32])
def test_variable_length_coding(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 2, 3, 4, 5, 1001):
        v = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
        assert (tokenids.decode_ids(tokenids.encode_ids(v), n) == v).all()


def test_packing_plan_uses_every_piece():
    rng = np.random.default_rng(0)
    for _ in range(40):
        cap = int(rng.integers(1, 50))
        counts = np.zeros(cap + 1, int)
        counts[1:] = rng.integers(0, 7, cap) * (rng.random(cap) < 0.6)
        used = np.zeros(cap + 1, int)
        for lengths, times in packing.plan_runs(counts, cap):
            assert sum(lengths) <= cap and times > 0
            for x in lengths:
                used[x] += times
        assert (used == counts).all()


def test_packing_fills_exactly():
    counts = np.zeros(11, int)
    counts[[7, 2, 1]] = 4
    assert sum(t for _, t in packing.plan_runs(counts, 10)) == 4


def test_packing_rows(spark, texts):
    """Against the tokenizer: every piece's ids, start and length, gapless sequences, and as few as a lower bound allows or one in ten more."""
    texts = texts + ["word " * 5000, "a b c", "a b c"]
    ids = [*range(len(texts) - 2), None, 3]
    docs = frame(spark, texts, ids)
    enc = tokens.encoder(tokens.default_path()).tokenizer
    want = []
    for i, t in zip(ids, texts, strict=True):
        a = np.array(enc.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, k, at, len(a[at : at + 64]), zlib.crc32(a[at : at + 64].tobytes())) for k, at in enumerate(range(0, len(a), 64))]
    rows = packing.packed_documents(spark, docs, tokens.default_path(), capacity=64).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    least = -(-sum(x[3] for x in want) // 64)
    assert least <= len(sequences) <= 1.1 * least + 1
    pieces = packing.cut_pieces(docs, tokens.default_path(), capacity=64)
    joined = packing.sequences(packing.pack(pieces, 64)).toPandas()
    assert (joined.ids.map(len) == 4 * joined.length).all() and joined.length.sum() == sum(x[3] for x in want)
    assert packing.packed_documents(spark, frame(spark, []), tokens.default_path()).count() == 0


def test_line_dedup_against_brute_force(spark):
    texts = ["a\nb\nc\nd", "x\na\nb\nc", None, "", "a\nb", "b\nc\nd", "\n\n\n\n", "q\nq\nq\nq", "a\nb\nc\nd"]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if all(x.strip(" ") == "" for x in w):
                continue
            if w in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        want[i] = t if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    got = {r["doc_id"]: r for r in linededup.deduplicated(frame(spark, texts)).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert got[0]["lang"] == "en" and got[2]["__lines"] == 0
    twice = linededup.deduplicated(frame(spark, ["a\nb\nc", "a\nb\nc"], [1, 1])).collect()
    assert [r["text"] for r in twice] == ["a\nb\nc"] * 2
    differ = linededup.deduplicated(frame(spark, ["a\nb\nc", "p\nq\nr\ns", "a\nb\nc\nd"], [1, 1, 2])).collect()
    assert sorted(r["text"] for r in differ) == ["a\nb\nc", "d", "p\nq\nr\ns"]  # an id with two texts loses nothing of either
    long_text = "\n".join(f"line {i}" for i in range(5000))
    odd = linededup.deduplicated(frame(spark, [long_text, "x\n" + long_text, long_text], [None, 7, 8])).collect()
    assert {(r["doc_id"], len(r["text"])) for r in odd} == {(None, len(long_text)), (7, len(long_text) + 2), (8, 0)}
    assert linededup.deduplicated(frame(spark, [])).count() == 0


def test_decontaminate_substitutions(spark):
    item = " ".join(f"t{i}" for i in range(30))
    sub = item.split()
    sub[4] = sub[13] = sub[22] = "zz"
    half = " ".join(item.split()[:6])
    docs = frame(spark, ["pre " + item + " post", "x " + " ".join(sub), half + " other words follow here now", None, "", "T0 " + item.upper()])
    bench = spark.createDataFrame([(7, item, 1), (8, "too short", 1), (9, None, 1)], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]): (r["at_word"], r["n_same"], r["n_words"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(0, 7), (1, 7), (5, 7)}
    assert got[0, 7] == (1, 20, 20) and got[1, 7][1] >= 16
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def plain_contaminated(docs, items):
    """The best window of every text and item, on every diagonal."""
    best = {}
    for i, text in docs:
        w = (text or "").lower().split()
        for item_id, item in items:
            x = (item or "").lower().split()
            size, percent = min(20, len(x)), 100 if len(x) < 8 else 80
            for d in range(1 - len(x), len(w)) if x else ():
                same = [0 <= d + k < len(w) and w[d + k] == v for k, v in enumerate(x)]
                if 100 * sum(same) < percent * size:
                    continue
                for s in range(len(x) - size + 1):
                    n = sum(same[s : s + size])
                    if 100 * n >= percent * size:
                        best[i, item_id] = min(best.get((i, item_id), (0, 0, 0)), (-n, s + d, size))
    return {k: (at, size, -n) for k, (n, at, size) in best.items()}


@pytest.mark.parametrize("held", [decontaminate.HELD_SEEDS, 3])
def test_decontaminate_against_brute_force(spark, monkeypatch, held):
    """Items of 1 to 60 words out of few, texts made of altered stretches of them, in blocks of 16 words; both ways of joining."""
    monkeypatch.setattr(decontaminate, "HELD_SEEDS", held)
    monkeypatch.setattr(decontaminate, "STEP", 16)
    r = random.Random(held)
    vocab = [f"v{k}" for k in range(25)]
    items = [(n, " ".join(r.choice(vocab) for _ in range(n))) for n in (1, 3, 7, 8, 9, 10, 11, 14, 15, 19, 20, 21, 35, 60)] + [(200, None), (201, " \n")]
    docs = [(i, None if i == 5 else "") for i in (5, 6)]
    for i in range(10, 60):
        out = []
        for _ in range(r.randrange(1, 4)):
            part = r.choice(items[:14])[1].split()
            part = part[r.randrange(0, 4) :] if r.random() < 0.3 else part
            out += [r.choice(vocab).upper() if r.random() < 0.17 else w for w in part] + [r.choice(vocab) for _ in range(r.randrange(0, 9))]
        docs.append((i, " ".join(out)))
    docs += [docs[-1], (docs[-1][0], docs[-2][1])]  # a repeated row, and an id with two texts
    table = frame(spark, [t for _, t in docs], [i for i, _ in docs]).withColumn("item_id", F.lit("clash")).withColumn("w", F.lit("clash"))
    bench = spark.createDataFrame([(n, t, 1, "w") for n, t in items], "item_id long, text string, doc_id int, w string")
    got = [(r["doc_id"], r["item_id"], r["at_word"], r["n_words"], r["n_same"]) for r in decontaminate.contaminated(table, bench).collect()]
    assert sorted(got) == sorted((*k, *v) for k, v in plain_contaminated(docs, items).items())


def test_decontaminate_a_text_of_a_million_words(spark):
    r = random.Random(9)
    item = [f"i{k}" for k in range(40)]
    long = [f"w{r.randrange(500)}" for _ in range(1_000_000)]
    long[1_020:1_060] = item[:20] + ["x", "y", "z", "q"] + item[24:]
    long[999_980:] = item[20:]
    docs = frame(spark, [" ".join(long), "w1 w2 w3 w4 w5"], [None, 3]).withColumn("doc_id", F.coalesce("doc_id", F.lit(8)))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[20:])), (3, " ".join(f"w{k}" for k in range(30)))], "item_id long, text string")
    assert {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()} == {(8, 1, 1_020, 20, 20), (8, 2, 999_980, 20, 20)}


def test_decontaminate_refuses_masks_that_ignore_nothing(spark):
    with pytest.raises(ValueError):
        decontaminate.contaminated(frame(spark, []), frame(spark, []), item_col="doc_id", masks=("1111", "11101"))


def test_decontaminate_masks_miss_no_placement():
    """Every placement of the substitutions that LEAST_PERCENT allows leaves a hit, for every window."""
    for n in range(decontaminate.LEAST_WORDS, decontaminate.WINDOW + 1):
        laid = [sum(1 << (at + k) for k, c in enumerate(m) if c == "1") for m in decontaminate.MASKS for at in range(n - len(m) + 1)]
        most = n - -(-decontaminate.LEAST_PERCENT * n // 100)
        for gone in itertools.combinations(range(n), most):
            bits = sum(1 << k for k in gone)
            assert any(not m & bits for m in laid), (n, gone)


def test_decontaminate_hard_placements_and_short_items(spark):
    places = {8: [2], 9: [4], 10: [3, 6], 11: [3, 7], 12: [3, 8], 15: [3, 7, 11], 20: [2, 5, 11, 14]}
    docs, bench = [], []
    for n, gone in places.items():
        bench.append((n, " ".join(f"i{n}w{k}" for k in range(n))))
        docs.append("a b " + " ".join("zz" if k in gone else f"i{n}w{k}" for k in range(n)) + " c")
    want = {(at, n): (2, n, n - len(places[n])) for at, n in enumerate(places)}
    at = len(docs)
    bench += [(107, "one two three four five six seven"), (103, "Five six SEVEN"), (101, "seven"), (100, " "), (99, None)]
    docs += ["x one two three four five six seven seven", "one two three four five zz seven", "five six seven five six seven", "six"]
    want |= {(at, 107): (1, 7, 7), (at, 103): (5, 3, 3), (at, 101): (7, 1, 1), (at + 1, 101): (6, 1, 1), (at + 2, 103): (0, 3, 3), (at + 2, 101): (2, 1, 1)}
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["at_word"], r["n_words"], r["n_same"]) for r in decontaminate.contaminated(frame(spark, docs), items).collect()}
    assert got == want


def test_languages(spark):
    r = random.Random(3)
    words = {"aa": [f"kor{i}pel" for i in range(40)], "bb": [f"žub{i}ani" for i in range(40)]}
    rows = [(i, " ".join(r.choice(words[lang]) for _ in range(60)), lang) for i in range(60) for lang in [("aa", "bb")[i % 2]]]
    extra = [(100, None, "aa"), (101, "123 --", "aa"), (102, "", None), (103, rows[0][1], None)]
    got = {x["doc_id"]: x for x in langid.languages(spark.createDataFrame(rows + extra, "doc_id long, text string, lang string")).collect()}
    held = [i for i in range(60) if got[i]["held_out"]]
    assert held and all(got[i]["lang_pred"] == rows[i][2] for i in held)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (100, 101, 102))
    assert got[103]["lang_pred"] == "aa" and 0.5 <= got[103]["score"] <= 1
    none = langid.languages(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).collect()
    assert none[0]["lang_pred"] == "und"


def test_languages_of_long_texts_are_learned(spark):
    """A language whose texts all exceed a dictionary, ties, repeated rows and an empty table."""
    r = random.Random(6)
    words = {"aa": [f"kor{i}pel" for i in range(40)], "bb": [f"žub{i}ani" for i in range(40)]}
    make = lambda lang, n: " ".join(r.choice(words[lang]) for _ in range(n))
    rows = [(i, make("aa", 60), "aa") for i in range(20)] + [(i, make("bb", 20_000), "bb") for i in range(20, 26)] + [(40, make("bb", 30), None)] * 2
    got = langid.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert [r["lang_pred"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["aa"] * 20 + ["bb"] * 8
    one, two, asked = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1][:3]
    same = spark.createDataFrame([(one, "kor pel kor", "xx"), (two, "kor pel kor", "ww"), (asked, "kor pel", None)], "doc_id long, text string, lang string")
    tied = [r for r in langid.languages(same).collect() if r["doc_id"] == asked][0]
    assert (tied["lang_pred"], tied["accepted"]) == ("ww", False) and abs(tied["score"] - 0.5) < 1e-9
    assert langid.languages(same.limit(0)).count() == 0


def test_long_texts_are_learned_from_all_over(spark):
    """What only the end of the long texts has is in the dictionary."""
    text = "kor pel " * 30_000 + " zarquon" * 500
    rows = [(i, text, "aa") for i in range(6)]
    known = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert b"zarquon" in known["aa"] and b"kor pel" in known["aa"] and len(known["aa"]) <= langid.DICTIONARY_BYTES


def test_languages_against_plain_recompression(spark):
    """Scores and predictions from compressing every text anew, piece by piece, with each language's dictionary."""
    r = random.Random(16)
    words = {"aa": [f"kor{i}pel" for i in range(60)], "bb": [f"žub{i}ani" for i in range(60)]}
    rows = [(i, " ".join(r.choice(words[lang]) for _ in range(r.randrange(1, 700))), lang) for i, lang in enumerate(["aa", "bb"] * 20)]
    rows += [(100, None, None), (101, "12 !", None), (102, "", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    compress = dict(zip(("aa", "bb"), langid.compressors(langid.learn(docs)), strict=True))
    for row in langid.languages(docs).collect():
        text = dict((i, t) for i, t, _ in rows)[row["doc_id"]]
        raw = langid.folded(text or "")
        if not raw.strip():
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        sizes = {lang: sum(len(f(raw[k : k + langid.PIECE_BYTES])) for k in range(0, len(raw), langid.PIECE_BYTES)) for lang, f in compress.items()}
        assert sizes[row["lang_pred"]] == min(sizes.values()) and 0 < row["score"] <= 1


def test_toxicity(spark):
    r = random.Random(3)
    vocab = [f"n{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(vocab) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            w[r.randrange(40)] = r.choice(["vile", "brute", "scoundrel"])
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(toxic)))
    rows += [(900, None, "en"), (901, "", None), (902, "vile", None), (902, "vile", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x for x in toxicity.toxicity_scores(docs, spark.createDataFrame(labels + [(5000, 1), (1, None)], "doc_id long, toxic int")).collect()}
    held = [i for i in range(400) if got[i]["held_out"]]
    right = [got[i]["predicted"] == labels[i][1] for i in held]
    assert sum(right) / len(right) > 0.95
    assert got[900]["score"] == got[901]["score"] and got[900]["predicted"] == 0 and got[902]["predicted"] == 1
    assert all((x["score"] >= 0.7) == (x["predicted"] == 1) for x in got.values())
    one_kind = toxicity.toxicity_scores(docs, spark.createDataFrame([(0, 0)], "doc_id long, toxic int")).collect()
    assert all(x["predicted"] == 0 for x in one_kind)


def test_toxicity_thresholds_cover_all_labelled_rows(spark, monkeypatch):
    """A language with 1 in 20 labelled rows has too few in a small sample, but its own threshold from all rows."""
    r = random.Random(9)
    rows, labels = [], []
    for i in range(3000):
        lang = "bb" if i % 20 == 0 else "aa"
        toxic = r.random() < 0.4
        w = [f"{lang}{r.randrange(30)}" for _ in range(20)] + (["vile"] if toxic or (lang == "bb" and r.random() < 0.1) else [])
        rows.append((i, " ".join(w), lang))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    seen, real = [], toxicity.thresholds_of

    def watched(language, label, logit, count, totals, languages):
        seen.append((language, label, count, totals, languages))
        return real(language, label, logit, count, totals, languages)

    monkeypatch.setattr(toxicity, "thresholds_of", watched)
    model = toxicity.fit(docs, marks, sample=200)
    language, label, count, totals, languages = seen[0]
    assert languages == 2 and count.sum() == sum(totals) - 320  # all but the four fifths that taught
    assert min(count[(language == 1) & (label == k)].sum() for k in (0, 1)) >= toxicity.LEAST_ROWS
    assert model.thresholds[0] != model.thresholds[1]

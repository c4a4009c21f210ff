"""Byte-pair encoding by pair positions, against the tokenizers library."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brookflow.llm import bpe, queries, tokens

PATH = tokens.default_path()
FIXED = [
    None, "", " \n\t ", "aaaaaaaa aaaa aaaaaaaaaaaaa AAAAA!!!!!!!!! !!!! ...", "Hello wörld <|endoftext|> it's 12", "<|endoftext|><|startoftext|>x<|endoftext|>",
    "Straße ÉÉ 日本 ‖ a\x1cb it's İ Σας don't we'll  x　y\x85z é ẛ̣", "hahahahaha lalalala 0123456789 " * 50, "word " * 3, "word " * 3,
]


def random_texts(count):
    r = random.Random(1)
    return ["".join(r.choice("aaabbe tion'.,1é\n\t日İ́ß<|>") for _ in range(r.randint(0, 60))) for _ in range(count)]


@pytest.mark.parametrize("window", [64, bpe.WINDOW])
def test_ids_and_texts_equal_the_library(monkeypatch, window):
    own = bpe.encoder(PATH)
    monkeypatch.setattr(own, "window", window)
    texts = FIXED + random_texts(800 if window > 64 else 60)
    ids, first = own.encode_column(pa.array(texts))
    read = own.decode_column(ids, first).to_pylist()
    for i, t in enumerate(texts):
        want = own.tokenizer.encode(t or "", add_special_tokens=False).ids
        assert ids[first[i] : first[i + 1]].tolist() == want, t
        assert read[i] == own.tokenizer.decode(want, skip_special_tokens=False)


def test_merges_out_of_order_are_refused():
    vocab = {c: i for i, c in enumerate(tokens._BYTE_CHARS)}
    vocab |= {"ab": 256, "abc": 257}
    with pytest.raises(ValueError, match="used before"):
        bpe.PairIndex(vocab, [("ab", "c"), ("a", "b")], "")


def test_equal_symbols_merge_from_the_left():
    vocab = {c: i for i, c in enumerate(tokens._BYTE_CHARS)}
    a = vocab["a"]
    vocab |= {"aa": 256, "aaaa": 257}
    pairs = bpe.PairIndex(vocab, [("a", "a"), ("aa", "aa")], "")
    import numpy as np

    for n, want in ((1, [a]), (2, [256]), (3, [256, a]), (5, [257, a]), (7, [257, 256, a]), (12, [257] * 3)):
        data = np.frombuffer(b"a" * n, np.uint8)
        assert pairs.encode(data, np.array([0, n]))[0].tolist() == want


def test_op11_against_the_library(spark, tmp_path):
    texts = FIXED + ["a much longer text, it's of many words. " * 20_000]
    rows = [(i if i else None, t, "ids", "decoded") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op11_bpe(spark, str(tmp_path)).collect()}
    library = tokens.encoder(PATH).tokenizer
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_encode_then_decode_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "It's so.", "k"), (2, None, "l")], "id long, body string, extra string")
    made = bpe.encoded(df, PATH, id_col="id", text_col="body", keep=("extra",))
    read = {r["id"]: r for r in bpe.decoded(made, PATH).collect()}
    assert read[1]["decoded"] == "it</w> 's</w> so</w> .</w>" and read[2]["decoded"] == "" and read[2]["extra"] == "l"
    assert bpe.round_trip(df.where("false"), PATH, id_col="id", text_col="body").count() == 0
    with pytest.raises(ValueError):
        bpe.encoded(df.withColumn("ids", F.lit(1)), PATH, id_col="id", text_col="body", keep=("ids",))

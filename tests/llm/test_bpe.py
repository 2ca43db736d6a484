import hashlib
import random

import public_tokenizers
import pytest

from cartwright.llm import bpe
from .helpers import AWKWARD, docs

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ODD = [
    "it's we'll 'sx  's '", "a\x1cb \x1c c.\x1c", "a\x85b\x85 c", "  lead  x\n\n y\t\tz  ", "　　x \xa0 y ",
    "a\n \n b", "\U0001f600 \U0001f601é", "１２ ½ ²", "<|endoftext|> x<|endoftext|>", "\x00\x01 \x1f", "\r\n\r\nfoo\r\n bar ",
]


def want(doc_id, text):
    encoding = bpe.coder(RANKS, PATTERN)[0]
    ids = encoding.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def long_text(seed, n):
    rng = random.Random(seed)
    parts = ["word", "é", " ", "  ", "\n", "\n\n", "x" * 50, "1234", "...", "'s", "\U0001f600", "　", "\xa0"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_digests_are_those_of_the_library(spark):
    long = [(50, long_text(1, 60000), "s"), (51, " " * 70000, "s"), (52, "ab " + "y" * 150000 + " end", "s"),
            (53, "z" * (bpe.CHUNK + 1), "s"), (54, "a " * bpe.CHUNK, "s"), (55, ("k" * 5000 + " ") * 40, "s")]
    rows = [(100 + i, t, "s") for i, t in enumerate(ODD)] + AWKWARD + long + long[:1]
    got = bpe.digests(docs(spark, rows, "1 as digest; 2 as place; 3 as ids"), RANKS, PATTERN).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([want(d, t) for d, t, _ in rows], key=repr)


def test_repeated_long_texts_are_encoded_once(spark):
    long = long_text(2, 40000)
    rows = [(None, long, "s")] * 12 + [(1, long, "s")] * 3 + [(2, long, "s"), (None, long + "!", "s")]
    df = docs(spark, rows)
    got = bpe.digests(df, RANKS, PATTERN).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([want(d, t) for d, t, _ in rows], key=repr)
    places = -(-len(long) // bpe.CHUNK)
    assert bpe.chunks_of(df.selectExpr("doc_id", "sha2(text, 256) as digest", "text")).count() == 4 * places


@pytest.mark.parametrize("chunk, overlap", [(7, 3), (16, 5), (64, 1), (50, 40)])
def test_stitching_any_chunks(chunk, overlap, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    encoding = bpe.coder(RANKS, PATTERN)[0]
    for seed in range(60):
        text = long_text(seed, 40)
        places = range((len(text) - 1) // chunk + 1)
        made = []
        for p in places:
            part = text[p * chunk:(p + 1) * chunk + overlap]
            import pyarrow as pa
            one = pa.RecordBatch.from_pylist([{"doc_id": 1, "digest": "d", "place": p, "text": part}])
            made += next(bpe.chunked(RANKS, PATTERN)(iter([one]))).to_pylist()
        ids = [int(i) for x in bpe.stitch(made, lambda t: (encoding.encode_ordinary(t),)) for i in x]
        assert ids == encoding.encode_ordinary(text), (seed, text)


def test_ids_decode_to_the_text(spark):
    text = long_text(9, 30000)
    got = bpe.encode(docs(spark, [(1, text, "s"), (2, None, "s"), (3, "a b", "s")]), RANKS, PATTERN).collect()
    assert {r.doc_id: bpe.decode(r.ids, RANKS, PATTERN).decode() for r in got} == {1: text, 2: "", 3: "a b"}


def test_empty_table(spark):
    assert bpe.digests(docs(spark, []), RANKS, PATTERN).collect() == []

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwright.llm import orc_tokens
from cartwright.session import fresh_dir
from .helpers import AWKWARD, docs
from .test_bpe import ODD, long_text

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids + [0]


def rows():
    odd = [t for t in ODD if "endoftext" not in t]
    return [(300 - i, t, "s") for i, t in enumerate(odd)] + AWKWARD + [(50, long_text(2, 20000), "s")]


def test_files_hold_the_ids_in_order(spark):
    got = orc_tokens.roundtrip(docs(spark, rows(), "1 as seq; 2 as ids; 3 as file").repartition(5), VOCABULARY).collect()
    want = {}
    for d, t, _ in rows():
        i = ids_of(t)
        want.setdefault(d, []).append((len(i), zlib.crc32(np.array(i, "<u4").tobytes())))
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        start += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted((d for d, _, _ in rows()), key=lambda d: (d is not None, d or 0))


def test_a_filter_on_the_id_reaches_the_files(spark):
    path = fresh_dir(spark, "orc-test")
    orc_tokens.write(docs(spark, rows()), path, VOCABULARY)
    one = orc_tokens.read(spark, path).where(F.col("doc_id") == 50)
    assert one.first().ids == ids_of(long_text(2, 20000))
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,50)]" in one._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    assert orc_tokens.roundtrip(docs(spark, []), VOCABULARY).collect() == []


def test_a_word_is_remembered_once_and_takes_no_combinations_place(monkeypatch):
    made = []

    class Recorded(orc_tokens.Remembered):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

    monkeypatch.setattr(orc_tokens, "Remembered", Recorded)
    orc_tokens.pieces.cache_clear()
    known = orc_tokens.pieces(VOCABULARY)
    pieces = [" word", "word", " wörd", "Ärger", " word,", " word-word", " 12", "", " ", "naïveª", " Ġ", "日本"]
    got = [known(p) for p in pieces]
    orc_tokens.pieces.cache_clear()
    assert [np.frombuffer(i, "<i4").tolist() for i in got] == [ids_of(p)[:-1] for p in pieces]
    words, combined = made
    assert {" word", "word", " wörd", "Ärger"} <= words.keys() and " word," not in words
    assert not {" word", "word", " wörd", "Ärger"} & combined.keys()

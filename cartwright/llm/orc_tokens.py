"""Token ids as ORC files in document order.

Documents are range-partitioned by id and sorted, encoded, and written one file
per partition: ids as an array of integers (ORC's run-length encoding), row
indexes every 1,000 rows, and a Bloom filter on ``doc_id``, so a reader prunes
stripes by metadata and several tasks read one file by its stripes. ``seq``, the
running number of a row, keeps the order of rows across and inside files.

The start of a document is the number of ids before it: the sum over the files
before its own, plus a running sum inside its file. No window sees more than a
file's rows, without their ids, or one row per file.

Defined results: a null or empty text is the end id alone; null ids of documents
come first; rows that share a doc_id (repeated rows) lie together, ordered by the
hash of their text, and each has its own start; an empty table writes no rows;
other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_dir, stored
from .units import UNIT, Remembered

END = 0
ROW_INDEX_STRIDE = 1000
OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": str(ROW_INDEX_STRIDE),
    "compression": "zstd",
}
# monotonically_increasing_id() keeps the partition above, the row below these bits.
ROW_BITS = 33


# Pieces remembered per Python worker, and characters encoded at a time.
REMEMBERED, SLICE = 600_000, 8 << 20

# White space next to a space: where a text may not be cut at that space.
UNSAFE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNSAFE = f"{UNSAFE} | {UNSAFE}"


# A pre-token also ends between a letter and the digit or mark that follows it, here checked for ASCII ones.
LETTERS = "[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
MARKED = re.compile(f"( ?{LETTERS})([!-@\\[-`{{-~]+)")
WORD = re.compile(f" ?{LETTERS}")


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte, by the byte's Latin-1 character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(others)}}


@lru_cache(maxsize=2)
def pieces(vocabulary: str) -> Callable[[str], bytes]:
    """Piece -> its ids as little-endian 32-bit integers.

    Words and marks are encoded, what is made of several is put together from
    them. A word is one pre-token, so it goes to the model itself.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenize, letters = tokenizer.model.tokenize, byte_letters()
    blank = letters[ord(" ")]

    def encode(piece: str) -> bytes:
        if WORD.fullmatch(piece):
            # Of plain letters only the space is written as another.
            plain = piece.replace(" ", blank) if piece.isascii() else piece.encode().decode("latin-1").translate(letters)
            return array("i", [t.id for t in tokenize(plain)]).tobytes()
        return array("i", tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def put_together(piece: str) -> bytes:
        if marked := MARKED.fullmatch(piece):
            return words[marked[1]] + words[marked[2]]
        parts = UNIT.findall(piece)
        return words[piece] if len(parts) < 2 else b"".join([lookup(p) for p in parts])

    # Words keep their place when the far more various combinations fill up theirs.
    words, combined = Remembered(encode, REMEMBERED), Remembered(put_together, REMEMBERED // 3)

    def lookup(piece: str) -> bytes:
        found = words.get(piece)
        if found is None:
            # A word is remembered once, and takes no combination's place.
            found = words[piece] if piece[1:].isalpha() and WORD.fullmatch(piece) else combined[piece]
        return found

    return lookup


def spaced(texts: pa.Array, known: Callable) -> list[np.ndarray]:
    """Ids of texts in which every space stands alone: cut before each, distinct pieces looked up once."""
    cut = pc.split_pattern(texts, " ")
    offsets, distinct = cut.offsets.to_numpy(), cut.values.dictionary_encode()
    which = distinct.indices.to_numpy().astype(np.int64)
    # The first piece of a text has no space before it.
    first = cut.values.take(pa.array(offsets[:-1])).to_pylist()
    found = [known(" " + p) for p in distinct.dictionary.to_pylist()]
    which[offsets[:-1]] = len(found) + np.arange(len(first))
    found += [known(p) for p in first]
    sizes = np.array([len(f) // 4 for f in found], np.int64)
    table, begins = np.frombuffer(b"".join(found), "<i4"), np.cumsum(sizes) - sizes
    lengths = sizes[which]
    ends = np.cumsum(lengths)
    ids = table[np.arange(ends[-1]) + np.repeat(begins[which] - (ends - lengths), lengths)]
    return np.split(ids, ends[offsets[1:-1] - 1])


def ids_of(texts: pa.Array, known: Callable) -> list:
    """Ids of each text, as arrays or bytes."""
    unsafe = pc.match_substring_regex(texts, UNSAFE)
    fast = texts.filter(pc.invert(unsafe))
    done = iter(spaced(fast, known) if len(fast) else [])
    return [
        b"".join([known(u) for u in UNIT.findall(texts[i].as_py())]) if slow else next(done)
        for i, slow in enumerate(unsafe.to_pylist())
    ]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about ``SLICE`` bytes of text; a longer text is a run of its own."""
    sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + SLICE, "right")))
        yield batch.slice(at, end - at)
        at = end


def encoder(vocabulary: str) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = pieces(vocabulary), np.array([END], "<i4").tobytes()
        for b in batches:
            for part in slices(b):
                rows = [bytes(r) + end for r in ids_of(part.column(1), known)]
                offsets = np.cumsum([0] + [len(r) // 4 for r in rows], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    return encode


def write(docs: DataFrame, path: str, vocabulary: str) -> None:
    """Write (doc_id, ids, seq) of all documents below ``path``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    placed = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = placed.mapInArrow(encoder(vocabulary), "doc_id bigint, ids array<int>")
    encoded.select("*", F.monotonically_increasing_id().alias("seq")).write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, ids array<int>, seq bigint").orc(path)


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(1)
        values, offsets = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
        raw = memoryview(values).cast("B") if len(values) else memoryview(b"")
        crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(offsets.tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
            names=["doc_id", "seq", "n_tokens", "ids_crc32"])


def summary(spark: SparkSession, path: str) -> DataFrame:
    """From the files: where each document starts, how many ids it has, and their checksum."""
    rows = read(spark, path).mapInArrow(checksums, "doc_id bigint, seq bigint, n_tokens bigint, ids_crc32 bigint")
    rows = stored(rows.select("*", F.shiftright("seq", ROW_BITS).alias("file")), "orc-rows")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.select("*", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("here"))
        .join(files, "file")
        .select("doc_id", (F.col("offset") + F.col("here")).alias("start"), "n_tokens", "ids_crc32")
    )


def roundtrip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents to a new folder and summarise what the files hold."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "orc-tokens")
    write(docs, path, vocabulary)
    return summary(spark, path)

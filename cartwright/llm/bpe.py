"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

A text of up to ``CHUNK`` characters is one chunk. A longer one is cut into
chunks of that length, each reaching ``OVERLAP`` characters into the next. Every
chunk is cut into pieces (see :mod:`.units`) and its pieces are encoded, chunks
of one text in different tasks. A chunk knows neither what came before it nor
what follows, so its first and last piece may be wrong; the boundaries between
are right. Two neighbours are stitched at the first boundary both of them have
in their overlap. Where they share none (a word longer than the overlap), the
word is put together from the edges of the chunks it crosses and encoded then.
Decoding looks up the bytes of every id and concatenates them.

Only the chunks of long texts are shuffled; short texts never are. A long text that
several rows share with their id is cut, encoded and stitched once, and its row
repeated as often as it was counted. A task holds the ids of one text at a time.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows (and several null ids) give a row each; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .units import UNIT, Remembered

CHUNK, OVERLAP = 1 << 16, 1 << 12

DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
IDS = "doc_id bigint, ids array<int>"


@lru_cache(maxsize=2)
def coder(ranks: str, pattern: str):
    """The encoding of a rank file, and the bytes of each id."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return encoding, {rank: token for token, rank in table.items()}


@lru_cache(maxsize=2)
def pieces(ranks: str, pattern: str) -> Remembered:
    """Piece -> (ids, ids in decimal, number of ids, bytes they decode to)."""
    encoding, spelled = coder(ranks, pattern)

    def encode(piece: str) -> tuple:
        ids = encoding.encode_ordinary(piece)
        return ids, ",".join(map(str, ids)), len(ids), b"".join([spelled[i] for i in ids])

    return Remembered(encode)


def decode(ids, ranks: str, pattern: str) -> bytes:
    """The bytes of a sequence of ids."""
    spelled = coder(ranks, pattern)[1]
    return b"".join([spelled[i] for i in ids])


def digest_row(doc_id, encoded: list[tuple]) -> tuple:
    ids, decoded = hashlib.sha256(), hashlib.sha256()
    ids.update(",".join([e[1] for e in encoded if e[2]]).encode())
    decoded.update(b"".join([e[3] for e in encoded]))
    return doc_id, sum([e[2] for e in encoded]), ids.hexdigest(), decoded.hexdigest()


def ids_row(doc_id, encoded: list[tuple]) -> tuple:
    return doc_id, [i for e in encoded for i in e[0]]


ROWS = {DIGESTS: digest_row, IDS: ids_row}
ARROW = {
    DIGESTS: pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]),
    IDS: pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]),
}


def batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(ARROW[schema])
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, ARROW[schema])], schema=ARROW[schema])


def whole(ranks: str, pattern: str, schema: str) -> Callable:
    """Texts of one chunk."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row, cut = pieces(ranks, pattern), ROWS[schema], UNIT.findall
        for b in batches:
            ids = b.column(0).to_pylist()
            yield batch([row(i, [known[u] for u in cut(t.as_py())]) for i, t in zip(ids, b.column(1))], schema)

    return encode


CHUNKS = "doc_id bigint, digest string, place int, at array<int>, edge array<string>, counts array<int>, ids binary"


def chunked(ranks: str, pattern: str) -> Callable:
    """Chunks (doc_id, digest, place, text) -> their boundaries, edge pieces, and ids between the edges."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(ranks, pattern)
        for b in batches:
            at, edge, counts, out = [], [], [], []
            for place, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                cut = UNIT.findall(text)
                starts = np.cumsum([place * CHUNK] + [len(u) for u in cut]).tolist()
                encoded = [known[u] for u in cut[1:-1]]
                at.append(starts[1:-1])
                edge.append([cut[0], cut[-1]] if len(cut) > 1 else cut)
                counts.append([e[2] for e in encoded])
                out.append(np.array([i for e in encoded for i in e[0]], "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(at, pa.list_(pa.int32())),
                 pa.array(edge, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32())), pa.array(out, pa.binary())],
                names=["doc_id", "digest", "place", "at", "edge", "counts", "ids"])

    return encode


def stitch(chunks: list[dict], encode: Callable[[str], tuple]) -> list[tuple]:
    """The pieces of one text, encoded, from its chunks in order."""
    # Edge texts by where they start; between boundaries they hold all that no chunk has whole.
    edges, starts, spans = [], [0], {}
    for c in chunks:
        begin = c["place"] * CHUNK
        edges.append((begin, c["edge"][0]))
        if c["at"]:
            edges.append((c["at"][-1], c["edge"][1]))
        ids = np.frombuffer(c["ids"], "<u4")
        ends = np.cumsum([0] + c["counts"]).tolist()
        for i, (a, b) in enumerate(zip(c["at"], c["at"][1:])):
            spans.setdefault(a, (b, ids[ends[i]:ends[i + 1]]))
        starts += c["at"]
    starts = sorted(set(starts))
    end = max(begin + len(text) for begin, text in edges)
    out, e = [], 0
    edges.sort(key=lambda x: x[0])
    for a, b in zip(starts, starts[1:] + [end]):
        if a in spans and spans[a][0] == b:
            out.append(spans[a][1])
            continue
        word, at = [], a
        while e and edges[e - 1][0] > a:
            e -= 1
        for begin, text in edges[max(0, e - 3):]:
            if begin > at or at >= b:
                break
            if begin + len(text) > at:
                word.append(text[at - begin:b - begin])
                at += len(word[-1])
        while e < len(edges) and edges[e][0] <= a:
            e += 1
        assert at == b, "chunks of a text are missing"
        out.append(encode("".join(word))[0])
    return out


def stitched(ranks: str, pattern: str, schema: str) -> Callable:
    """The chunks of one text -> its row and digest."""

    def join(group: pa.Table) -> pa.Table:
        encoding, spelled = coder(ranks, pattern)
        chunks = sorted(group.to_pylist(), key=lambda c: c["place"])
        ids = np.concatenate([np.asarray(x, "<u4") for x in stitch(chunks, lambda t: (encoding.encode_ordinary(t),))]).tolist()
        encoded = [(ids, ",".join(map(str, ids)), len(ids), b"".join([spelled[i] for i in ids]))]
        row = pa.Table.from_batches([batch([ROWS[schema](chunks[0]["doc_id"], encoded)], schema)])
        return row.append_column("digest", pa.array([chunks[0]["digest"]], pa.string()))

    return join


def chunks_of(long: DataFrame) -> DataFrame:
    """The chunks (doc_id, digest, place, text) of (doc_id, digest, text), those of repeated rows once."""
    places = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / CHUNK).cast("int"))
    return (
        long.select("*", F.explode(places).alias("place"))
        .select("doc_id", "digest", "place", F.substr("text", F.col("place") * CHUNK + 1, F.lit(CHUNK + OVERLAP)).alias("text"))
        .dropDuplicates(["doc_id", "digest", "place"])
    )


def apply(docs: DataFrame, ranks: str, pattern: str, schema: str) -> DataFrame:
    """Encode (doc_id, text) of all documents; ``schema`` says what is returned of the ids."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = F.char_length("text")
    short = texts.where(size <= CHUNK).mapInArrow(whole(ranks, pattern, schema), schema)
    long = texts.where(size > CHUNK).select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text")
    # Chunks of one long text go to different tasks before the costly part.
    parts = chunks_of(long).repartition(F.col("doc_id"), F.col("digest"), F.col("place"))
    encoded = parts.mapInArrow(chunked(ranks, pattern), CHUNKS)
    rows = encoded.groupBy("doc_id", "digest").applyInArrow(stitched(ranks, pattern, schema), f"{schema}, digest string")
    counted = long.groupBy(F.col("doc_id").alias("id"), F.col("digest").alias("of")).agg(F.count("*").alias("times"))
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("time")
    repeated = rows.join(counted, rows["doc_id"].eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")))
    return short.unionByName(repeated.select(*short.columns, again).drop("time"))


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids in decimal, digest of the decoded bytes."""
    return apply(docs, ranks, pattern, DIGESTS)


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: its ids."""
    return apply(docs, ranks, pattern, IDS)

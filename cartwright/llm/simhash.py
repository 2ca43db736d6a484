"""SimHash near-duplicates by anchor-point covering.

A fingerprint has the majority bit of its shingles' hashes in every place.
Fingerprints that differ in at most three bits agree up to one bit in one of
their two halves, so each half is covered with threshold one: the anchors are the
codewords of the Hamming code on 31 bits, times the free 32nd bit, a perfect code
of covering radius one. A fingerprint's home is the anchor nearest to its half;
it is replicated to every anchor that a half one bit away has as its home, that
is within radius plus threshold, about 17 of 2^27. Two linked fingerprints meet
at the home of the smaller one, where they are compared.

Only distinct fingerprints are replicated, so copies cost nothing, however many.
An anchor with very many fingerprints is a skewed key of an inner join, which
adaptive execution splits.

Defined results: a text without words has fingerprint zero and links like any
other; a null text is an empty one; repeated rows have the same fingerprint and
component; a null doc_id is never the smallest of a component unless it has no
other; an empty table gives an empty result; :func:`deduplicate` and
:func:`deduplicate_similar` pass other columns through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import stored
from .components import components
from .words import packed

SHINGLE, SEED, THRESHOLD = 3, 42, 3
HALF = 0xFFFFFFFF
BLOCK = 1 << 15


def fingerprint(text: str | None) -> int:
    """The fingerprint of a text as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    # bytes.lower() and bytes.split() know A-Z and the six ASCII spaces only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)]))
    n = max(1, len(words) - SHINGLE + 1)
    hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[at:at + BLOCK].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield pd.Series([fingerprint(x) for x in t], dtype="int64")


def halves(fp: Column) -> list[Column]:
    return [fp.bitwiseAND(F.lit(HALF)), F.shiftrightunsigned(fp, 32)]


def syndrome(half: Column) -> Column:
    """Hamming syndrome of bits 0 to 30: 0 for a codeword, else the wrong bit's number plus one."""
    out = F.lit(0)
    for j in range(5):
        mask = sum(1 << i for i in range(31) if (i + 1) >> j & 1)
        out = out + F.bit_count(half.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1)) * (1 << j)
    return out.cast("int")


def flipped(half: Column, number: Column) -> Column:
    """``half`` with bit ``number - 1`` flipped; unchanged for 0."""
    return half.bitwiseXOR(F.when(number == 0, F.lit(0).cast("bigint")).otherwise(F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), number - 1)))


def home(half: Column) -> Column:
    """The nearest anchor."""
    return flipped(half, syndrome(half))


def reached(half: Column, s: Column) -> Column:
    """Homes of the half (whose syndrome is ``s``) and of the 32 halves one bit away."""
    own = flipped(half, s)
    near = F.transform(F.sequence(F.lit(1), F.lit(31)), lambda i: flipped(flipped(half, i), s.bitwiseXOR(i)))
    return F.array_distinct(F.concat(F.array(own, own.bitwiseXOR(F.lit(1 << 31))), near))


def links(prints: DataFrame) -> DataFrame:
    """(a, b) of the distinct fingerprints ``fp`` that differ in at most three bits, a < b."""
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), h.alias("half")) for i, h in enumerate(halves(F.col("fp")))]))
    split = prints.select("fp", sides.alias("x")).select("fp", "x.side", "x.half").select("*", syndrome(F.col("half")).alias("s"))
    homes = split.select("side", flipped(F.col("half"), F.col("s")).alias("anchor"), F.col("fp").alias("a"))
    visits = split.select("side", F.explode(reached(F.col("half"), F.col("s"))).alias("anchor"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= THRESHOLD
    return homes.join(visits, ["side", "anchor"]).where((F.col("a") < F.col("b")) & near).select("a", "b")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows as (doc_id, digest, fp), and per distinct ``fp`` its ``root``, the smallest fp of its component."""
    prints = stored(docs.select(
        "doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("digest"),
        fingerprints(F.col("text").cast("string")).alias("fp")), "simhash-prints")
    distinct = stored(prints.select("fp").distinct(), "simhash-distinct")
    roots = components(links(distinct), "a", "b").select(F.col("node").alias("fp"), "root")
    named = distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints, stored(named, "simhash-roots")


def report(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint and the smallest doc_id reachable over links."""
    prints, roots = classes(docs)
    smallest = (
        prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(roots, "fp")
        .groupBy("root").agg(F.min("doc_id").alias("component_id"))
    )
    named = stored(roots.join(smallest, "root").select("fp", "component_id"), "simhash-components")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each component of :func:`report`, the one with the smallest doc_id; of repeated rows one."""
    prints, roots = classes(docs)
    return kept(docs, prints.withColumnRenamed("fp", "node"), roots.withColumnRenamed("fp", "node"))


def kept(docs: DataFrame, prints: DataFrame, roots: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each root; ``prints`` has (doc_id, digest, node), ``roots`` (node, root)."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "digest")
    best = (
        prints.groupBy("node").agg(F.min(key).alias("key")).join(roots, "node")
        .groupBy("root").agg(F.min("key").alias("key"))
    )
    wanted = stored(best.select("key.id", "key.digest"), "simhash-kept")
    wanted = wanted.select(F.coalesce("id", F.lit(0)).alias("w_id"), F.col("id").isNull().alias("w_none"), F.col("digest").alias("w_text"))
    # Nearly every document stays: repeated rows go on the map side, and the join takes the rows as they are dealt then.
    rows = packed(docs).withColumn("of", F.col("row.doc_id").cast("bigint")).select(
        "row", F.coalesce("of", F.lit(0)).alias("id"), F.col("of").isNull().alias("none"),
        F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("text")).dropDuplicates(["id", "none", "text"])
    same = (rows["id"] == wanted["w_id"]) & (rows["none"] == wanted["w_none"]) & (rows["text"] == wanted["w_text"])
    return rows.join(wanted, same).select("row.*")


def documents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row of each wanted (id, digest), as ``row`` with its id and digest."""
    rows = packed(docs).select(
        "row", F.col("row.doc_id").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("text_digest"))
    found = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["id"]) & (F.col("text_digest") == F.col("digest")))
    return found.select("row", "id", "digest").dropDuplicates(["id", "digest"])


# --- five words and a similarity of 0.8 -----------------------------------------------------------
#
# Sets of five-word shingles that overlap by 0.8 differ in about 15 % of a fingerprint's bits, too many
# for anchors on halves of 64 bits. Fingerprints are 256 bits wide here and covered in many drawn blocks.
# The anchors of a block are the codewords of the Hamming code on 7 of its bits, times its free bits: a
# perfect code of covering radius one, as on the halves above. The threshold in a block is zero, so
# the anchors within radius plus threshold are one, the nearest: fingerprints that agree in a block meet,
# and so do those whose coded bits are nearest to one codeword. The number of a block's anchors follows
# the number of documents, so that strangers seldom meet, and the number of blocks follows that, so that
# similar ones nearly always do. At an anchor every fingerprint meets one representative; representatives
# differ from block to block. Candidates are decided by the exact overlap of whole shingle sets.

WORDS, SIMILAR = 5, 0.8
BITS, DIFFERING = 256, 72
# Share of bits that a pair at the threshold differs in; blocks expected to agree in such a pair.
SHARE, AGREEING = 0.155, 3.5
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
# Bits of a block under the code, and those of them that its codewords do not choose freely.
CODED, PARITY = 7, 3
# An anchor's bits beside its block's number; blocks are at most that wide.
ANCHOR_BITS = 40 + PARITY
# Anchors of fingerprints that a task brings together.
GATHERED = 1 << 20
# Parts of an anchor's members that are reduced apart, by the last bit of their numbers.
PARTS = 2
# Fingerprints whose anchors are taken at once.
SLICE = 2048
# Odd numbers that make four hashes of one.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def nearest_codewords() -> np.ndarray:
    """The codeword nearest to each value of the coded bits, at most one bit away."""
    values = np.arange(1 << CODED, dtype=np.int64)
    wrong = np.zeros_like(values)
    for i in range(CODED):
        wrong ^= (values >> i & 1) * (i + 1)
    return np.where(wrong > 0, values ^ (1 << np.maximum(wrong - 1, 0)), values)


NEAREST = nearest_codewords()


def blocks(count: int) -> np.ndarray:
    """The bits of each block, a row per block, the coded ones first, for a number of documents.

    Counted are blocks that agree wholly, which meet whatever the codewords are; a pair that differs in coded
    bits only meets in more.
    """
    width = min(ANCHOR_BITS - PARITY, max(14, int(count).bit_length() + 3))
    number = int(np.ceil(AGREEING / (1 - SHARE) ** (width + PARITY)))
    rng = np.random.default_rng(SEED)
    return np.array([rng.permutation(BITS)[:width + PARITY] for _ in range(number)])


def shingle_set(words: list[bytes]) -> np.ndarray:
    """The different hashes of a text's five-word shingles; of a shorter text that of all its words, of none nothing."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    shingles = [b" ".join(words)] if len(words) < WORDS else map(b" ".join, zip(*[words[i:] for i in range(WORDS)]))
    return np.unique(np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64))


def wide_bits(hashes: np.ndarray) -> np.ndarray:
    """The 256 majority bits of a set of hashes."""
    ones = np.zeros(BITS, np.int64)
    for i, m in enumerate(MIX):
        mixed = hashes * m
        mixed ^= mixed >> np.uint64(29)
        mixed *= MIX[0]
        mixed ^= mixed >> np.uint64(32)
        for j, column in enumerate(mixed.view(np.uint8).reshape(-1, 8).T):
            at = 64 * i + 8 * j
            ones[at:at + 8] = np.bincount(column, minlength=256) @ BYTE_BITS
    return 2 * ones > len(hashes)


def lowered(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def wide_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest, text) -> the words' digest and the wide fingerprint."""
    for b in batches:
        words = [lowered(text) for text in b.column("text").to_pylist()]
        prints = [np.packbits(wide_bits(shingle_set(w)), bitorder="little").view(np.int64) for w in words]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("digest"), pa.array([md5(b" ".join(w)).digest() for w in words], pa.binary()),
             pa.array(prints, pa.list_(pa.int64()))], names=["doc_id", "digest", "node", "fp"])


def held_keys(drawn: np.ndarray) -> Callable:
    """(n, fp) -> (key, n): a fingerprint's anchor in every block, the block's number above its bits."""
    number, width = drawn.shape
    block = np.arange(number, dtype=np.int64) << ANCHOR_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                prints = part.column("fp").flatten().to_numpy().reshape(-1, BITS // 64)
                bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little").astype(bool)
                keys = np.tile(block, (len(bits), 1))
                for j in range(width):
                    keys |= bits[:, drawn[:, j]].astype(np.int64) << j
                coded = keys & (1 << CODED) - 1
                keys ^= coded ^ NEAREST[coded]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(part.column("n").to_numpy(), number))], names=["key", "n"])

    return run


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> the words' digest and the set of shingles."""
    for b in batches:
        words = [lowered(text) for text in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([md5(b" ".join(w)).digest() for w in words], pa.binary()),
             pa.array([shingle_set(w).view(np.int64) for w in words], pa.list_(pa.int64()))], names=["node", "shingles"])


def meetings(held: DataFrame) -> DataFrame:
    """(key, rep, others) of the anchors with several members; ``others`` is null where they are too many for an aggregate.

    The representative is the member whose number, mixed with the anchor by exclusive or, is smallest.
    Members with an even and with an odd number are reduced apart: the smallest, the largest and the exclusive
    or of up to three numbers are these numbers, so that an anchor of up to three and three needs no join.
    """
    mixed, by_key = F.col("n").bitwiseXOR(F.xxhash64("key")), F.xxhash64("key")
    aggregates, numbers = [], []
    for i in range(PARTS):
        here = F.col("n").bitwiseAND(F.lit(PARTS - 1)) == i
        aggregates += [
            F.min(F.when(here, mixed)).alias(f"least{i}"), F.max(F.when(here, mixed)).alias(f"most{i}"),
            F.bit_xor(F.when(here, F.col("n"))).alias(f"all{i}"), F.count(F.when(here, 1)).alias(f"members{i}")]
        ends = [F.col(f"least{i}").bitwiseXOR(by_key), F.col(f"most{i}").bitwiseXOR(by_key)]
        numbers += [*ends, F.when(F.col(f"members{i}") == 3, F.col(f"all{i}").bitwiseXOR(ends[0]).bitwiseXOR(ends[1]))]
    members = [F.col(f"members{i}") for i in range(PARTS)]
    rep = F.least(*[F.col(f"least{i}") for i in range(PARTS)]).bitwiseXOR(by_key)
    others = F.array_except(F.array_compact(F.array(*numbers)), F.array(rep))
    return held.groupBy("key").agg(*aggregates).where(sum(members) > 1).select(
        "key", rep.alias("rep"), F.when(F.greatest(*members) <= 3, others).alias("others"))


def candidates(nodes: DataFrame, drawn: np.ndarray) -> DataFrame:
    """(n, rep, off): the pairs that meet at an anchor and differ in at most ``DIFFERING`` bits.

    Nearly all anchors have few members, which :func:`meetings` tells from one aggregate of numbers. They are
    moved as two numbers and reduced where they meet, since reducing them before would find hardly any equal
    ones and move more. Only the anchors with more are joined with their members, which are derived from the
    fingerprints again: a row for a fingerprint and block at most, however large the group.
    """
    held = nodes.select("n", "fp").mapInArrow(held_keys(drawn), "key bigint, n bigint")
    gathered = held.repartition(1 + nodes.count() * len(drawn) // GATHERED, "key")
    shared = stored(meetings(gathered), "simhash-reps")
    crowded = stored(shared.where("others IS NULL").select("key", "rep"), "simhash-crowded")
    met = held.join(crowded, "key").where("n <> rep").select("n", "rep")
    met = stored(shared.select(F.explode("others").alias("n"), "rep").unionByName(met).distinct(), "simhash-met")
    own, there = nodes.select("n", F.col("fp").alias("a")), nodes.select(F.col("n").alias("rep"), F.col("fp").alias("b"))
    words = [F.bit_count(F.get("a", F.lit(i)).bitwiseXOR(F.get("b", F.lit(i)))) for i in range(BITS // 64)]
    off = words[0] + words[1] + words[2] + words[3]
    return met.join(own, "n").join(there, "rep").select("n", "rep", off.alias("off")).where(F.col("off") <= DIFFERING)


def overlapping(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose shingle sets overlap by ``SIMILAR`` or more."""
    there = sets.select(F.col("n").alias("rep"), F.col("shingles").alias("other"))
    both = F.size(F.array_intersect("shingles", "other"))
    return pairs.join(sets, "n").join(there, "rep").where(
        both >= SIMILAR * (F.size("shingles") + F.size("other") - both)).select(*pairs.columns)


def deduplicate_similar(docs: DataFrame) -> DataFrame:
    """One document of each group of similar ones (five words, 0.8), the one with the smallest doc_id.

    Groups are the components of the pairs found. Of what a document meets, the closest is decided first;
    then only pairs that would still unite two groups, so a large group costs its size, not its pairs.
    Texts of the same words are one; those without words are alike; other results are as the module says.
    """
    drawn = blocks(docs.count())
    prints = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("digest"), F.col("text").cast("string").alias("text"))
    prints = stored(prints.mapInArrow(wide_prints, "doc_id bigint, digest bigint, node binary, fp array<bigint>"), "simhash-wide")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "digest", "fp"))
    # Stored with their numbers, which then stay as they are.
    nodes = prints.groupBy("node").agg(one.alias("p")).select(
        F.monotonically_increasing_id().alias("n"), "node", "p.id", "p.digest", "p.fp")
    nodes = stored(nodes, "simhash-nodes")
    near = stored(candidates(nodes, drawn), "simhash-near")
    involved = near.select("n").unionByName(near.select(F.col("rep").alias("n"))).distinct()
    wanted = stored(nodes.join(involved, "n").select("n", "node", "id", "digest"), "simhash-involved")
    sets = documents(docs, wanted.select("id", "digest")).select(F.col("row.text").cast("string").alias("text")).mapInArrow(
        shingle_sets, "node binary, shingles array<bigint>")
    sets = stored(wanted.select("n", "node").join(sets.dropDuplicates(["node"]), "node").select("n", "shingles"), "simhash-sets")

    closest = near.groupBy("n").agg(F.min_by("rep", "off").alias("rep"))
    links = stored(overlapping(closest, sets), "simhash-links")
    roots = stored(components(links, "n", "rep"), "simhash-groups")
    a, b = roots.select(F.col("node").alias("n"), F.col("root").alias("ra")), roots.select(F.col("node").alias("rep"), F.col("root").alias("rb"))
    apart = near.join(a, "n", "left").join(b, "rep", "left").select(
        "n", "rep", F.coalesce("ra", "n").alias("ra"), F.coalesce("rb", "rep").alias("rb")).where("ra <> rb")
    # What these pairs unite are groups, each named by its root.
    tops = components(stored(overlapping(apart, sets), "simhash-links"), "ra", "rb").select(
        F.col("node").alias("top_of"), F.col("root").alias("top"))
    named = nodes.select("n", "node").join(roots.withColumnRenamed("node", "of"), F.col("n") == F.col("of"), "left").select(
        "node", F.coalesce("root", "n").alias("group"))
    named = named.join(tops, F.col("group") == F.col("top_of"), "left").select("node", F.coalesce("top", "group").alias("root"))
    return kept(docs, prints.select("doc_id", "digest", "node"), stored(named, "simhash-roots"))

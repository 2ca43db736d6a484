"""Near-duplicate vectors by an exact blocked comparison.

Every vector belongs to the nearest of a few pivots, vectors of the table with
the smallest hashes. A pivot's group has a radius, the widest angle to its
pivot; two groups whose pivots stand further apart than both radii and the
angle of the threshold have no link between them and never meet. All other
groups meet, in tiles: a group is dealt into chunks of a bounded number of
values, and each pair of chunks is a task of its own that multiplies them in
double precision. So no link is missed, whatever the data; the price is the
square of the number of different vectors, less the groups kept apart.

A tile returns the links per class, and of its pairs only those that unite
something new in it, so it writes no more rows than it reads. These pairs give
the components.

Equal vectors are one class with a count before anything else, so a vector that
a third of all rows share is compared once.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, nor do those of another length; rows without a
vec_id link with nothing and have no component; repeated rows (same id and
vector) count as one vector and give a row each; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import components

COSINE = 0.9
# Values of a chunk, at least and at most; between them a table has about CHUNKS of them.
VALUES, CHUNKS = (1 << 18, 1 << 22), 32
PIVOTS = 256
TILE = 2048
# Angles of nearly equal vectors are this inexact.
SLACK = 1e-6


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def name(vector: Column) -> Column:
    """128 bits that stand for a vector."""
    parts = [F.lpad(F.hex(F.xxhash64(F.lit(i), vector)), 16, "0") for i in (1, 2)]
    return F.concat(*parts)


def unit(vectors: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of length one."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def by_length(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose vectors have one length."""
    sizes = np.array([len(v) for v in batch.column(column)])
    for d in np.unique(sizes):
        yield batch.filter(pa.array(sizes == d))


def pivots(classes: DataFrame, counts: dict[int, int], size: int | None) -> dict[int, np.ndarray]:
    """Per vector length with more than one chunk, unit vectors that stand for its groups."""
    every = {d: -(-n // min(PIVOTS, -(-n // rows_of(d, n, size)))) for d, n in counts.items() if n > rows_of(d, n, size)}
    if not every:
        return {}
    lengths = classes.sparkSession.createDataFrame(list(every.items()), "length int, every bigint")
    drawn = classes.join(lengths, F.size("vector") == F.col("length")).where(
        F.pmod(F.xxhash64(F.lit("pivot"), "class"), "every") == 0).select("class", "vector").collect()
    out = {}
    for d in every:
        chosen = sorted((r["class"], r["vector"]) for r in drawn if len(r["vector"]) == d)
        if chosen:
            out[d] = unit(pa.array([v for _, v in chosen], pa.list_(pa.float64())))
    return out


def rows_of(length: int, count: int, size: int | None) -> int:
    """How many vectors a chunk has."""
    least, most = (max(1, v // length) for v in VALUES)
    return size or min(max(least, -(-count // CHUNKS)), most)


def grouped(centers: dict[int, np.ndarray]) -> Callable:
    """(class, vector) -> with the number of the nearest pivot of its length, and the angle to it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in by_length(b, 1):
                x = unit(part.column(1))
                near, angle = np.zeros(len(x), np.int32), np.full(len(x), np.pi)
                if (c := centers.get(x.shape[1])) is not None:
                    cosine = x @ c.T
                    near = cosine.argmax(axis=1).astype(np.int32)
                    angle = np.arccos(np.clip(cosine.max(axis=1), -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(near), pa.array(angle)],
                    names=["class", "vector", "length", "near", "angle"])

    return add


def meetings(groups: list, centers: dict[int, np.ndarray], counts: dict[int, int], least: float, size: int | None) -> list[tuple]:
    """(root, chunks, other, other_chunks) of the groups that may have links between them, either way round.

    ``groups`` has a row (length, near, n, angle) per group.
    """
    out, widest = [], np.arccos(np.clip(least, -1, 1)) + SLACK
    for d in sorted({g["length"] for g in groups}):
        own = sorted((g for g in groups if g["length"] == d), key=lambda g: g["near"])
        near, radius = [g["near"] for g in own], np.array([g["angle"] for g in own])
        chunks = [-(-g["n"] // rows_of(d, counts[d], size)) for g in own]
        if d in centers:
            between = np.arccos(np.clip(centers[d][near] @ centers[d][near].T, -1, 1))
            meet = between <= radius[:, None] + radius[None, :] + widest
        else:
            meet = np.ones((len(own), len(own)), bool)
        np.fill_diagonal(meet, True)
        out += [(f"{d}:{near[i]}", chunks[i], f"{d}:{near[j]}", chunks[j]) for i, j in np.argwhere(meet).tolist()]
    return out


TILED = "class string, links bigint, peer string"


def tile(least: float) -> Callable:
    """The members of two chunks -> links per class, each counted with its copies, and pairs that unite them."""

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        names = group.column("class").to_pylist()
        x = unit(group.column("vector").combine_chunks())
        first, second = (group.column(c).to_numpy() for c in ("first", "second"))
        copies = group.column("copies").to_numpy().astype(np.float64)
        links, root, pairs = np.zeros(len(x)), np.arange(len(x)), []
        left, right = np.flatnonzero(first), np.flatnonzero(second)
        same = bool((first & second).any())
        for at in range(0, len(left), 512):
            rows = left[at:at + 512]
            close = x[rows] @ x[right].T >= least
            if same:
                close &= rows[:, None] != right[None, :]
                links[rows] += close @ copies[right]
            else:
                links[rows] += close @ copies[right]
                links[right] += copies[rows] @ close
            for k in np.flatnonzero(close.any(axis=1)).tolist():
                own = root[rows[k]]
                met = root[right[close[k]]]
                for other in np.unique(met[met != own]).tolist():
                    pairs.append((int(own), other))
                    root[root == other] = own
        some = np.flatnonzero(links)
        return pa.table({
            "class": pa.array([names[i] for i in some] + [names[a] for a, _ in pairs], pa.string()),
            "links": pa.array(np.rint(links[some]).astype(np.int64).tolist() + [0] * len(pairs), pa.int64()),
            "peer": pa.array([None] * len(some) + [names[b] for _, b in pairs], pa.string()),
        })

    return compare


def compared(members: DataFrame, met: DataFrame, least: float) -> DataFrame:
    """What :func:`tile` returns for all chunks of groups that meet.

    ``members`` has (root, class, vector, copies), ``met`` the columns of :func:`meetings`.
    """
    sent = members.join(met, "root").select(
        "root", "class", "vector", "copies", "other",
        F.pmod(F.xxhash64(F.lit("tile"), "class"), "chunks").cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("other_chunks").cast("int") - 1)).alias("other_chunk"))
    own, there = F.struct("root", "chunk"), F.struct(F.col("other").alias("root"), F.col("other_chunk").alias("chunk"))
    return (
        sent.select(F.least(own, there).alias("i"), F.greatest(own, there).alias("j"),
                    (own <= there).alias("first"), (own >= there).alias("second"), "class", "vector", "copies")
        .groupBy("i", "j").applyInArrow(tile(least), TILED)
    )


def count_links(members: DataFrame, least: float = COSINE, size: int = TILE) -> DataFrame:
    """(class, links) inside each group; ``members`` has (root, class, vector, copies)."""
    chunks = F.ceil(F.count("*") / size).cast("bigint")
    met = members.groupBy("root").agg(chunks.alias("chunks"), chunks.alias("other_chunks")).withColumn("other", F.col("root"))
    return compared(members, met, least).where("peer is null").groupBy("class").agg(F.sum("links").alias("links"))


def tiles(classes: DataFrame, copies: DataFrame, least: float = COSINE, size: int | None = None) -> DataFrame:
    """Links per class and uniting pairs of all (class, vector); ``copies`` has (class, copies).

    The driver sees a row per vector length and per group; ``size`` overrides the vectors of a chunk.
    """
    counts = {r["d"]: r["n"] for r in classes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()}
    centers = pivots(classes, counts, size)
    members = classes.mapInArrow(grouped(centers), "class string, vector array<double>, length int, near int, angle double")
    members = stored(members.join(copies, "class").select(
        F.concat_ws(":", "length", "near").alias("root"), "length", "near", "angle", "class", "vector", "copies"), "embedding-members")
    groups = members.groupBy("length", "near").agg(F.count("*").alias("n"), F.max("angle").alias("angle")).collect()
    met = classes.sparkSession.createDataFrame(
        meetings(groups, centers, counts, least, size), "root string, chunks bigint, other string, other_chunks bigint")
    return compared(members.select("root", "class", "vector", "copies"), met, least)


def report(vectors: DataFrame, least: float = COSINE, size: int | None = None) -> DataFrame:
    """Per vector: links, the smallest id of its component, and whether it is that one."""
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
    good = F.col("vec_id").isNotNull() & usable(F.col("vector"))
    rows = rows.select("*", F.when(good, name(F.col("vector"))).alias("class"))
    # Vectors travel once per class; ids travel without them.
    ids = stored(rows.select("vec_id", "class"), "embedding-ids")
    classes = rows.where("class is not null").groupBy("class").agg(F.first("vector").alias("vector"))
    classes = stored(classes, "embedding-classes")
    copies = ids.where("class is not null").distinct().groupBy("class").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    copies = stored(copies, "embedding-copies")
    tiled = stored(tiles(classes, copies.select("class", "copies"), least, size), "embedding-tiles")
    links = tiled.where("peer is null").groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(tiled.where("peer is not null"), "class", "peer").select(F.col("node").alias("class"), "root")
    named = stored(copies.join(roots, "class", "left").select("class", "copies", "low", F.coalesce("root", "class").alias("root")),
                   "embedding-roots")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    summary = named.join(lowest, "root").join(links, "class", "left").select(
        "class", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    summary = stored(summary, "embedding-summary")
    alone = F.col("component_id").isNull()
    return ids.join(summary, "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(alone, F.col("vec_id").isNotNull()).otherwise(F.col("vec_id") == F.col("component_id")), F.lit(False)).alias("kept"))

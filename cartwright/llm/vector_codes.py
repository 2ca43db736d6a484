"""Vector codes of bounded size, by k-means on parts with adaptive distance bounds.

A vector of integers ``floor(256 * x)`` is cut into 16 consecutive parts; every
part position has a codebook of at most 64 entries, seeded from the rows with
the smallest ids and moved for a number of rounds. The code of a vector is the
nearest entry of every part.

Which entry is nearest is mostly known without measuring (Drake and Hamerly).
Every part keeps its entry, the ``b`` closest other entries in the order of their
lower bounds, and one outer bound for all that are not listed. When the entries
have moved, a listed bound sinks by its entry's move and the outer bound by the
longest move; the distance to the own entry is measured anew. Where all bounds
are above it, the entry stays. Otherwise only the listed entries whose bounds
are not above are measured, and all entries only where the outer bound is
reached. Bounds are rounded down and every doubtful case is decided by exact
integer distances, ties to the lower index, so the result is that of measuring
everything. ``b`` starts at an eighth of the entries; every block of rows then
adapts its own to how deep its lists were searched, down to a sixteenth of the
entries. Bounds are stored as half floats, rounded down.

A round is two narrow passes over the stored state: one that assigns, one that
adds up components per part and entry inside each task. The driver sees the seeds and the
sums of 16 x 64 entries, whatever the input.

Defined results: vectors that are null or hold null or non-finite components are
dropped; the length of the table is that of its first row by id, and a vector of
another length has a null code and error; a length that 16 does not divide gives
the first parts a component more; components are held to ``LARGEST`` after
scaling, so that sums fit in 64 bits; with fewer than 64 rows there are as many
entries as rows; rows without an id come last among the seeds; repeated rows
count and are returned as often as they come; null labels are one label; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
LARGEST = 1 << 24
# Rows measured at once.
BLOCK = 2048


def finite(vector: Column) -> Column:
    """Whether every component is a number."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def scaled(vector: Column, largest: int = LARGEST) -> Column:
    """Components as integers, floors going down, none beyond ``largest``."""
    return F.transform(vector, lambda x: F.floor(
        F.greatest(F.least(x * SCALE, F.lit(float(largest))), F.lit(float(-largest)))).cast("int"))


def cuts(length: int, parts: int) -> list[slice]:
    """Where the parts of a vector lie."""
    at = np.cumsum([0] + [length // parts + (i < length % parts) for i in range(parts)])
    return [slice(int(a), int(b)) for a, b in zip(at, at[1:])]


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``x`` to each entry."""
    if x.shape[1] * 16 * max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0))) ** 2 < 1 << 53:
        x, entries = x.astype(np.float64), entries.astype(np.float64)
    else:
        x, entries = x.astype(np.int64), entries.astype(np.int64)
    own, there = (x * x).sum(axis=1), (entries * entries).sum(axis=1)
    return (own[:, None] - 2 * (x @ entries.T) + there[None, :]).astype(np.int64)


def below(distance: np.ndarray) -> np.ndarray:
    """Distances as single floats that are certainly not larger."""
    return np.maximum(np.nextafter((distance * (1 - 1e-9) - 1e-6).astype(np.float32), np.float32(-np.inf)), 0)


def halved(bounds: np.ndarray) -> np.ndarray:
    """Bounds as half floats that are not larger."""
    return np.maximum(np.nextafter(np.minimum(bounds, 65504).astype(np.float16), np.float16(-np.inf)), 0)


class Bounds:
    """One part position of a block of rows: its entries, listed entries with lower bounds, and outer bounds."""

    def __init__(self, own: np.ndarray, listed: np.ndarray, lower: np.ndarray, outer: np.ndarray):
        self.own, self.listed, self.lower, self.outer = own, listed, lower, outer


def measured(x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
    """Bounds of rows that are measured against every entry."""
    exact = squared(x, entries)
    order = np.argsort(exact, axis=1, kind="stable")[:, :b + 2]
    distance = below(np.sqrt(np.take_along_axis(exact, order, axis=1).astype(np.float64)))
    outer = distance[:, b + 1] if order.shape[1] > b + 1 else np.full(len(x), np.inf, np.float32)
    return Bounds(order[:, 0].astype(np.uint8), order[:, 1:b + 1].astype(np.uint8), distance[:, 1:b + 1], outer)


def moved(x: np.ndarray, entries: np.ndarray, moves: np.ndarray, state: Bounds) -> np.ndarray:
    """Bring the bounds of a block up to date after the entries moved; the depth to which each row's list was needed.

    Depth 0 means the entry stayed without doubt; one more than the list's length means all entries were measured.
    """
    n, b = state.listed.shape
    lower = below(state.lower.astype(np.float64) - moves[state.listed])
    outer = below(state.outer.astype(np.float64) - moves.max(initial=0.0))
    order = np.argsort(lower, axis=1, kind="stable")
    state.listed, state.lower = (np.take_along_axis(v, order, axis=1) for v in (state.listed, lower))
    state.outer = outer
    here = entries[state.own].astype(np.int64)
    exact = ((x - here) ** 2).sum(axis=1)
    reach = np.sqrt(exact.astype(np.float64))
    # Bounds are rounded down, so equal distances never pass as certain.
    depth = (state.lower <= reach[:, None]).sum(axis=1)
    depth[outer <= reach] = b + 1
    for rows in np.split(np.flatnonzero(depth == b + 1), range(BLOCK, n, BLOCK)):
        if len(rows):
            new = measured(x[rows], entries, b)
            state.own[rows], state.listed[rows], state.lower[rows], state.outer[rows] = new.own, new.listed, new.lower, new.outer
    doubt = np.flatnonzero((depth > 0) & (depth <= b))
    if len(doubt):
        near = int(depth[doubt].max())
        listed = state.listed[doubt, :near]
        found = ((x[doubt, None, :] - entries[listed].astype(np.int64)) ** 2).sum(axis=2)
        all_exact = np.concatenate([exact[doubt, None], found], axis=1)
        all_names = np.concatenate([state.own[doubt, None], listed], axis=1)
        order = np.lexsort((all_names, all_exact), axis=1)
        all_names = np.take_along_axis(all_names, order, axis=1)
        known = below(np.sqrt(np.take_along_axis(all_exact, order, axis=1).astype(np.float64)))
        state.own[doubt] = all_names[:, 0]
        state.listed[doubt, :near], state.lower[doubt, :near] = all_names[:, 1:], known[:, 1:]
    return depth


STATE = "vec_id bigint, label bigint, x array<int>, own binary, listed binary, lower binary, outer binary"
CODED = "vec_id bigint, label bigint, own binary, error bigint"


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of bounded size with their vectors as a matrix of 64-bit integers; all vectors have one length.

    Of rows that have bounds, those of a block have lists of one length.
    """
    for whole in batches:
        lengths = pc.binary_length(whole.column("listed")) if "listed" in whole.schema.names else None
        for part in [whole] if lengths is None else [whole.filter(pc.equal(lengths, n)) for n in pc.unique(lengths)]:
            for at in range(0, part.num_rows, BLOCK):
                b = part.slice(at, BLOCK)
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                yield b, x.reshape(b.num_rows, -1 if len(x) else 0)


def packed_bytes(parts: list[np.ndarray], kind) -> pa.Array:
    """Per row the values of all parts, as bytes."""
    rows = np.ascontiguousarray(np.stack(parts, axis=1).astype(kind))
    return pa.array([r.tobytes() for r in rows], pa.binary())


def unpacked(column: pa.Array, kind, *shape: int) -> np.ndarray:
    """What :func:`packed_bytes` packed; axes are rows, parts, and what each part has."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape).copy()


def opened(b: pa.RecordBatch, parts: int) -> list[Bounds]:
    """The stored bounds of a block, per part position."""
    width = len(b.column("listed")[0].as_py()) // parts
    own = unpacked(b.column("own"), np.uint8, parts)
    listed = unpacked(b.column("listed"), np.uint8, parts, width)
    lower = unpacked(b.column("lower"), np.float16, parts, width).astype(np.float32)
    outer = unpacked(b.column("outer"), np.float16, parts).astype(np.float32)
    return [Bounds(own[:, p], listed[:, p], lower[:, p], outer[:, p]) for p in range(parts)]


def fitted(state: Bounds, b: int) -> Bounds:
    """Bounds with lists of at most ``b``; what a shorter list leaves out goes under the outer bound."""
    if state.listed.shape[1] <= b:
        return state
    order = np.argsort(state.lower, axis=1, kind="stable")
    listed, lower = (np.take_along_axis(v, order, axis=1) for v in (state.listed, state.lower))
    return Bounds(state.own, listed[:, :b], lower[:, :b], np.minimum(state.outer, lower[:, b]))


def enough(depths: np.ndarray, least: int, part: float = 0.99) -> int:
    """The list length that all but one in a hundred of the doubtful parts were content with; ``depths`` counts them."""
    listed = depths[1:-1]
    if not listed.sum():
        return min(least, len(listed))
    return max(min(least, len(listed)), int(np.searchsorted(np.cumsum(listed), part * listed.sum())) + 1)


def first_pass(books: list[np.ndarray], at: list[slice], b: int) -> Callable:
    """Rows -> rows with bounds, all entries measured."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in blocks(batches):
            yield with_state(batch, [measured(x[:, s], book, b) for s, book in zip(at, books)])

    return run


def next_pass(books: list[np.ndarray], moves: list[np.ndarray], at: list[slice], least: int) -> Callable:
    """Rows with bounds -> rows with bounds after the entries moved, and with lists as long as they were needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in blocks(batches):
            states, depths = opened(batch, len(at)), 0
            for s, book, move, state in zip(at, books, moves, states):
                depths += np.bincount(moved(x[:, s], book, move, state), minlength=state.listed.shape[1] + 2)
            b = enough(depths, least)
            yield with_state(batch, [fitted(s, b) for s in states])

    return run


def with_state(batch: pa.RecordBatch, states: list[Bounds]) -> pa.RecordBatch:
    """The block with its bounds."""
    columns = [packed_bytes([s.own for s in states], np.uint8), packed_bytes([s.listed for s in states], np.uint8),
               packed_bytes([halved(s.lower) for s in states], np.float16),
               packed_bytes([halved(s.outer) for s in states], np.float16)]
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("label"), batch.column("x"), *columns],
        names=["vec_id", "label", "x", "own", "listed", "lower", "outer"])


def coded(books: list[np.ndarray], moves: list[np.ndarray], at: list[slice]) -> Callable:
    """Rows with bounds -> final codes and their errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in blocks(batches):
            states, error = opened(batch, len(at)), np.zeros(batch.num_rows, np.int64)
            for s, book, move, state in zip(at, books, moves, states):
                moved(x[:, s], book, move, state)
                error += ((x[:, s] - book[state.own]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), packed_bytes([s.own for s in states], np.uint8), pa.array(error)],
                names=["vec_id", "label", "own", "error"])

    return run


SUMS = "part int, entry int, n bigint, total array<bigint>"


def summed(at: list[slice], entries: int) -> Callable:
    """Rows with their entries -> per part and entry how many there are and the sums of components, one set a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(at), entries), np.int64)
        total = [np.zeros((entries, s.stop - s.start), np.int64) for s in at]
        for batch, x in blocks(batches):
            own = unpacked(batch.column("own"), np.uint8, len(at))
            for p, s in enumerate(at):
                n[p] += np.bincount(own[:, p], minlength=entries)
                np.add.at(total[p], own[:, p], x[:, s])
        some = np.argwhere(n)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some[:, 0].astype(np.int32)), pa.array(some[:, 1].astype(np.int32)), pa.array(n[n > 0]),
                 pa.array([total[p][e].tolist() for p, e in some], pa.list_(pa.int64()))],
                names=["part", "entry", "n", "total"])

    return run


def replaced(state: DataFrame, books: list[np.ndarray], at: list[slice]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Entries as the floors of their parts' means, and how far each moved; unused entries stay."""
    partial = state.select("x", "own").mapInArrow(summed(at, len(books[0])), SUMS)
    sums = partial.select("part", "entry", "n", F.posexplode_outer("total").alias("place", "value")).groupBy(
        "part", "entry", F.coalesce("place", F.lit(0)).alias("place")).agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    new = [book.copy() for book in books]
    for r in sums.collect():
        if r["value"] is not None:
            new[r["part"]][r["entry"], r["place"]] = r["value"] // r["n"]
    return new, [np.sqrt(((a - b) ** 2).sum(axis=1).astype(np.float64)) for a, b in zip(new, books)]


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in order."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def encode(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, own, error) of all usable rows of the table's length, and the codebooks.

    ``vectors`` has (vec_id, label, x) with integer components; ``own`` has a byte per part.
    """
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    length = len(seeds[0]["x"]) if seeds else 0
    seeds = [r["x"] for r in seeds if len(r["x"]) == length]
    at = cuts(length, parts)
    book = np.array(seeds, np.int64).reshape(len(seeds), length)
    books = [book[:, s].copy() for s in at]
    rows = vectors.where(F.size("x") == length)
    most = max(len(seeds) - 1, 0)
    width, least = min(most, max(1, entries // 8)), min(most, max(1, entries // 16))
    state = stored(rows.mapInArrow(first_pass(books, at, width), STATE), "codes-state")
    for i in range(rounds):
        books, moves = replaced(state, books, at)
        if i + 1 < rounds:
            state = stored(state.mapInArrow(next_pass(books, moves, at, least), STATE), "codes-state")
    return state.mapInArrow(coded(books, moves, at), CODED), books


def report(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per usable vector: its code, its error, its label's error, and the digest of the codebooks."""
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), vector.alias("v")
    ).where(finite(F.col("v"))).select("vec_id", "label", scaled(F.col("v")).alias("x"))
    codes, books = encode(rows, parts, entries, rounds)
    other = rows.where(F.size("x") != sum(book.shape[1] for book in books)).select(
        "vec_id", "label", F.lit(None).cast("binary").alias("own"), F.lit(None).cast("bigint").alias("error"))
    codes = stored(codes.unionByName(other), "codes-final")
    # Stored first: as an aggregate inside the plan a hot label's join could not be split.
    by_label = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    by_label = by_label.select(F.col("label").alias("of"), "label_error")
    return codes.join(by_label, codes["label"].eqNullSafe(F.col("of")), "left").select(
        "vec_id", F.lower(F.hex("own")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))

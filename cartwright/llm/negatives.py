"""Hard negatives from an inverted multi-index.

Every vector is cut into halves; each half has a codebook, and the pairs of
entries are the cells of the index. A cell's score with an anchor is at most the
sum of two half bounds: the anchor half times the entry, plus the anchor half's
length times the entry's radius (the farthest half it holds). Both half bounds
sorted, a heap walks the cells from the highest sum down (multi-sequence). It may
stop as soon as the sum falls below what is already found, or below the window
that is searched; a popped cell is also left out where its own radii prove that
it has nothing for the window. So results are those of comparing everything.

Positives are the first rows of the anchor's label, a window without ends.
Negatives are sought per positive in the window of scores that its score gives.
Each search has two rounds: a visit of the first cells, which gives bars, and a
visit of all further cells that the bars do not rule out. A round is one shuffle:
the rows of cells, dealt into chunks of bounded size, meet the anchors that visit
them; a cell larger than a chunk is dealt over several, and anchors beyond a
block's size come in several blocks. Every meeting returns at most ``k`` rows per
anchor and window.

Rows of equal label and vector are one class that carries its smallest ids, as
many as any result can hold: a vector that a third of all rows share is one row
of the index, and anchors of one class are searched for once.

The codebooks are fitted on about ``SAMPLE`` classes, drawn by hash; radii and
counts cover all rows, so the sample decides how much is visited, never what is
found. The driver sees the sample and a row per cell (at most 1,024).

Defined results: rows without an id, a label or a vector, or with null or
non-finite components, take no part, nor do vectors of another length than that
of the smallest id; repeated rows (same id, label and vector) count once, rows
that share only their id are rows of their own; components are held to
``LARGEST`` after scaling, so that products are exact in doubles; an anchor
without positives, and a positive without negatives, has no row; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .embeddings import name
from .vector_codes import finite, scaled

POSITIVES, NEGATIVES, LOW, HIGH, EVERY = 5, 10, 30, 90, 100
LARGEST = 1 << 20
ENTRIES, SAMPLE, STEPS = 32, 4096, 8
# Rows of the cells that the first round of a search visits.
FIRST = 1024
# Components of a chunk of rows, at least and at most, and of a block of anchors; between them an index has about CHUNKS.
VALUES, CHUNKS = (1 << 18, 1 << 23), 32

RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


@dataclass
class Index:
    """The rows by cell, and what the driver knows of the cells."""

    table: DataFrame  # chunk, cell, class, label, x, ids
    books: list[np.ndarray]
    radii: list[np.ndarray]  # per half and cell
    counts: np.ndarray  # per cell
    first: np.ndarray  # per cell, its first chunk
    chunks: np.ndarray  # per cell, how many
    length: int


def halves(x: np.ndarray) -> list[np.ndarray]:
    middle = (x.shape[1] + 1) // 2
    return [x[:, :middle], x[:, middle:]]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's closest entry and its distance."""
    entry = ((book * book).sum(axis=1)[None, :] - 2 * (x @ book.T)).argmin(axis=1)
    return entry, np.sqrt(((x - book[entry]) ** 2).sum(axis=1))


def codebook(x: np.ndarray, entries: int) -> np.ndarray:
    """Entries by k-means from evenly spaced rows in the order of the sample."""
    book = x[np.linspace(0, len(x) - 1, min(entries, len(x))).astype(int)].copy()
    for _ in range(STEPS):
        entry, _ = nearest(x, book)
        for e in np.unique(entry):
            book[e] = x[entry == e].mean(axis=0)
    return book


def matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length)


def located(books: list[np.ndarray], length: int) -> Callable:
    """Classes -> with their cell and the distances of their halves to its entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (i, first), (j, second) = (nearest(x, book) for x, book in zip(halves(matrix(b.column("x"), length)), books))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array((i * len(books[1]) + j).astype(np.int32)), pa.array(first), pa.array(second)],
                names=[*b.schema.names, "cell", "first", "second"])

    return run


def build(classes: DataFrame, count: int, length: int, entries: int = ENTRIES, rows: int | None = None) -> Index:
    """Index ``count`` classes (class, label, x, ids); ``rows`` overrides the size of a chunk."""
    every = -(-count // SAMPLE)
    sample = classes.where(F.pmod(F.xxhash64(F.lit("index"), "class"), F.lit(every)) == 0).select("class", "x").collect()
    if not sample:
        sample = classes.select("class", "x").limit(1).collect()
    sample = np.array([r["x"] for r in sorted(sample, key=lambda r: r["class"])], np.float64).reshape(len(sample), length)
    entries = max(1, min(entries, round(2 * count**0.25)))
    books = [codebook(x, entries) for x in halves(sample)]
    placed = stored(classes.mapInArrow(located(books, length), (
        "class string, label bigint, x array<int>, ids array<bigint>, cell int, first double, second double")), "index-cells")
    cells = len(books[0]) * len(books[1])
    counts, radii = np.zeros(cells, np.int64), [np.zeros(cells), np.zeros(cells)]
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("first").alias("a"), F.max("second").alias("b")).collect():
        counts[r["cell"]], radii[0][r["cell"]], radii[1][r["cell"]] = r["n"], r["a"], r["b"]
    size = rows or min(max(VALUES[0] // max(length, 1), -(-count // CHUNKS)), max(1, VALUES[1] // max(length, 1)))
    chunks = np.maximum(-(-counts // size), 1)
    first, chunk, room = np.zeros(cells, np.int64), -1, 0
    for cell in range(cells):
        # Cells share a chunk while they fit; a larger one has chunks of its own.
        if chunks[cell] > 1 or counts[cell] > room or chunk < 0:
            chunk, room = chunk + 1, size
            first[cell] = chunk
            chunk += int(chunks[cell]) - 1
        else:
            first[cell] = chunk
        room = room - int(counts[cell]) if chunks[cell] == 1 else 0
    place = placed.sparkSession.createDataFrame(
        [(c, int(first[c]), int(chunks[c])) for c in range(cells)], "of int, at bigint, many bigint")
    table = placed.join(F.broadcast(place), F.col("cell") == F.col("of")).select(
        (F.col("at") + F.pmod(F.xxhash64(F.lit("chunk"), "class"), "many")).alias("chunk"), "cell", "class", "label", "x", "ids")
    return Index(table, books, radii, counts, first, chunks, length)


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) from the highest sum down."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)]
    while heap:
        bound, p, q = heapq.heappop(heap)
        yield -bound, int(a[p]), int(b[q])
        if q + 1 < len(b):
            heapq.heappush(heap, (-(first[a[p]] + second[b[q + 1]]), p, q + 1))
        if q == 0 and p + 1 < len(a):
            heapq.heappush(heap, (-(first[a[p + 1]] + second[b[0]]), p + 1, 0))


class Walk:
    """The cells one anchor visits."""

    def __init__(self, index: Index):
        self.books, self.counts = index.books, index.counts
        self.cell_radii = [r.reshape(len(index.books[0]), len(index.books[1])) for r in index.radii]
        self.radii = [self.cell_radii[0].max(axis=1), self.cell_radii[1].max(axis=0)]
        far = [np.sqrt((b * b).sum(axis=1)).max(initial=0) + r.max(initial=0) for b, r in zip(self.books, self.radii)]
        self.slack = 1e-9 * sum(far)

    def __call__(self, x: np.ndarray, stop: float, high: float, later: bool) -> list[int]:
        """Cells of the first round, or those of the second: all others whose bound reaches ``stop``."""
        parts = halves(x[None, :])
        size = [float(np.sqrt((p * p).sum())) for p in parts]
        at = [(b @ p[0]) for b, p in zip(self.books, parts)]
        slack = self.slack * sum(size) + 1e-6
        out, rows = [], 0
        for bound, i, j in multi_sequence(*(d + s * r for d, s, r in zip(at, size, self.radii))):
            if bound + slack < stop:
                break
            cell = i * len(self.books[1]) + j
            center = at[0][i] + at[1][j]
            reach = size[0] * self.cell_radii[0][i, j] + size[1] * self.cell_radii[1][i, j] + slack
            if not self.counts[cell] or center - reach > high:
                continue
            early = rows < FIRST
            rows += self.counts[cell]
            if not later and not early:
                break
            if early != later and center + reach >= stop:
                out.append(cell)
        return out


def windows_of(scores: list[int] | None, low: int, high: int) -> list[tuple[float, float]]:
    """Per positive score the scores that its negatives may have; without positives one window without ends."""
    if scores is None:
        return [(-np.inf, np.inf)]
    return [(-(-low * p // 100), high * p // 100) for p in scores]


VISITS = ("chunk bigint, block int, query string, label bigint, x array<int>, cells array<int>, "
          "lows array<double>, highs array<double>, scores array<bigint>")


def visits(index: Index, blocks: int, low: int, high: int, later: bool) -> Callable:
    """Queries (query, label, x, scores, bars) -> a row per query and chunk it visits."""
    walk = Walk(index)
    first, chunks = index.first, index.chunks
    length = index.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("chunk", "block", "row", "cells", "lows", "highs")}
            x = matrix(b.column("x"), length)
            for row, (scores, bars, block) in enumerate(zip(*(b.column(c).to_pylist() for c in ("scores", "bars", "block")))):
                windows = windows_of(scores, low, high)
                if bars is not None:
                    windows = [(max(w[0], bar if bar is not None else w[0]), w[1]) for w, bar in zip(windows, bars)]
                open_ = [w for w in windows if w[0] <= w[1]]
                if not open_:
                    continue
                cells = walk(x[row], min(w[0] for w in open_), max(w[1] for w in open_), later)
                by_chunk: dict[int, list[int]] = {}
                for cell in cells:
                    for chunk in range(int(first[cell]), int(first[cell] + chunks[cell])):
                        by_chunk.setdefault(chunk, []).append(cell)
                for chunk, own in by_chunk.items():
                    for column, value in zip(out.values(), (chunk, block, row, own, [w[0] for w in windows], [w[1] for w in windows])):
                        column.append(value)
            rows = b.take(pa.array(out["row"], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["chunk"], pa.int64()), pa.array(out["block"], pa.int32()), rows.column("query"), rows.column("label"),
                 rows.column("x"), pa.array(out["cells"], pa.list_(pa.int32())), pa.array(out["lows"], pa.list_(pa.float64())),
                 pa.array(out["highs"], pa.list_(pa.float64())), rows.column("scores")],
                names=["chunk", "block", "query", "label", "x", "cells", "lows", "highs", "scores"])

    return run


FOUND = "query string, window int, score bigint, vec_id bigint, class string"


def meeting(length: int, cells: int, k: int, same: bool) -> Callable:
    """The rows of a chunk and the anchors that visit it -> at most ``k`` rows per anchor and window."""

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if held.num_rows and asked.num_rows:
            x, ids = matrix(held.column("x"), length), held.column("ids").to_pylist()
            cell, label = held.column("cell").to_numpy(), held.column("label").to_numpy()
            low_id, names = np.array([i[0] for i in ids]), held.column("class").to_pylist()
            q, query = matrix(asked.column("x"), length), asked.column("query").to_pylist()
            wanted, asked_label = asked.column("cells").to_pylist(), asked.column("label").to_numpy()
            lows, highs = asked.column("lows").to_pylist(), asked.column("highs").to_pylist()
            step = max(1, (1 << 22) // len(x))
            for at in range(0, len(q), step):
                block = q[at:at + step] @ x.T
                for n, score in enumerate(block, at):
                    visited = np.zeros(cells, bool)
                    visited[wanted[n]] = True
                    rows = np.flatnonzero(visited[cell] & ((label == asked_label[n]) == same))
                    own = score[rows]
                    for w, (low, high) in enumerate(zip(lows[n], highs[n])):
                        some = rows[(own >= low) & (own <= high)]
                        if len(some) > k:
                            bar = np.partition(score[some], len(some) - k)[len(some) - k]
                            some = some[score[some] >= bar]
                        some = some[np.lexsort((low_id[some], -score[some]))][:k]
                        best = sorted((-int(score[r]), i, names[r]) for r in some for i in ids[r])[:k]
                        out += [(query[n], w, -s, i, c) for s, i, c in best]
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        return pa.table({c: pa.array(list(v), t) for c, v, t in zip(("query", "window", "score", "vec_id", "class"), columns, kinds)})

    return run


def best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows per query and window, ranked."""
    order = Window.partitionBy("query", "window").orderBy(F.col("score").desc(), "vec_id", "class")
    return found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int, same: bool, low: int = LOW, high: int = HIGH, size: int | None = None) -> DataFrame:
    """Per query and window the first ``k`` rows of the same label, or of others: (query, window, score, vec_id, class, rank).

    ``queries`` has (query, label, x, scores); ``scores`` are the positive scores that give the windows, or null.
    """
    size = size or max(1, VALUES[1] // max(index.length, 1))
    blocks = max(1, -(-queries.count() // size))
    block = F.pmod(F.xxhash64(F.lit("block"), "query"), F.lit(blocks)).cast("int").alias("block")
    cells = len(index.counts)
    held = index.table.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def round_of(asked: DataFrame, later: bool) -> DataFrame:
        sent = asked.select("query", "label", "x", "scores", "bars", block).mapInArrow(visits(index, blocks, low, high, later), VISITS)
        return held.groupBy("chunk", "block").cogroup(sent.groupBy("chunk", "block")).applyInArrow(
            meeting(index.length, cells, k, same), FOUND)

    early = stored(best(round_of(queries.withColumn("bars", F.lit(None).cast("array<double>")), False), k), "search-first")
    bars = early.where(F.col("rank") == k).groupBy("query").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("bar"))
    windows = F.when(F.col("scores").isNull(), 1).otherwise(F.size("scores"))
    asked = queries.join(bars.withColumnRenamed("query", "of"), F.col("query") == F.col("of"), "left").select(
        "query", "label", "x", "scores",
        F.transform(F.sequence(F.lit(0), windows - 1), lambda w: F.element_at("bar", w).cast("double")).alias("bars"))
    further = stored(round_of(asked, True), "search-further")
    return best(early.drop("rank").unionByName(further), k)


def mine(
    rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, entries: int = ENTRIES, size: int | None = None,
) -> DataFrame:
    """(anchor, positive, rank, negative, scores); ``rows`` has (vec_id, label, x), ``anchor`` says which are anchors.

    ``size`` overrides the rows of a chunk and of a block.
    """
    spark = rows.sparkSession
    shortest = rows.agg(F.min(F.struct("vec_id", F.size("x").alias("n"))).alias("m")).first()["m"]
    if shortest is None:
        return spark.createDataFrame([], RESULT)
    length = shortest["n"]
    named = rows.where(F.size("x") == length).select(
        "vec_id", "label", "x", F.concat_ws(":", "label", name(F.col("x"))).alias("class"))
    ids = stored(named.select("vec_id", "class").distinct(), "negatives-ids")
    first_ids = ids.select("*", F.row_number().over(Window.partitionBy("class").orderBy("vec_id")).alias("n")).where(
        F.col("n") <= max(positives + 1, negatives)).groupBy("class").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    first_ids = stored(first_ids, "negatives-first")
    classes = named.groupBy("class").agg(F.first("label").alias("label"), F.first("x").alias("x")).join(first_ids, "class").select(
        "class", "label", "x", "ids")
    classes = stored(classes, "negatives-classes")
    anchors = ids.where(anchor).select(F.col("vec_id").alias("anchor_id"), F.col("class").alias("anchor_class"))
    index = build(classes, classes.count(), length, entries, size)
    asked = classes.join(anchors.select(F.col("anchor_class").alias("class")).distinct(), "class", "left_semi").select(
        F.col("class").alias("query"), "label", "x", F.lit(None).cast("array<bigint>").alias("scores"))
    asked = stored(asked, "negatives-asked")

    near = stored(search(index, asked, positives + 1, True, low, high, size), "negatives-near")
    others = anchors.join(near, F.col("anchor_class") == F.col("query")).where(
        (F.col("vec_id") != F.col("anchor_id")) | (F.col("class") != F.col("anchor_class")))
    order = Window.partitionBy("anchor_class", "anchor_id").orderBy("rank")
    chosen = others.select("*", F.row_number().over(order).alias("place")).where(F.col("place") <= positives).select(
        "anchor_id", "anchor_class", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    chosen = stored(chosen, "negatives-positives")

    scores = chosen.groupBy("anchor_class").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    windows = stored(asked.drop("scores").join(scores, F.col("query") == F.col("anchor_class")).select(
        "query", "label", "x", "scores"), "negatives-windows")
    hard = search(index, windows, negatives, False, low, high, size)
    hard = hard.join(windows.select(F.col("query").alias("of"), "scores"), F.col("query") == F.col("of")).select(
        "query", F.get("scores", F.col("window")).alias("window_score"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    hard = stored(hard, "negatives-hard")
    return chosen.join(hard, (F.col("anchor_class") == F.col("query")) & (F.col("positive_score") == F.col("window_score"))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def report(vectors: DataFrame, entries: int = ENTRIES, size: int | None = None) -> DataFrame:
    """Hard negatives of every hundredth id; the label of every seventh id is one further."""
    vec_id, label = F.col("vec_id").cast("bigint"), F.col("label").cast("bigint")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vectors.select(vec_id.alias("vec_id"), moved.alias("label"), F.col("embedding").cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v"))
    ).select("vec_id", "label", scaled(F.col("v"), LARGEST).alias("x"))
    return mine(rows, F.col("vec_id") % EVERY == 0, entries=entries, size=size)

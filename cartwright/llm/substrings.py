"""Removal of repeated passages by prefix-partitioned suffix trees.

A window of ``WINDOW`` words goes where the same words also start in a document
with a smaller doc_id. Whether two windows are equal is decided in subtrees of
the suffix tree of all texts, each small enough for a task:

* Sparse suffixes. Every window has an anchor: of the ``GRAM``-word grams in it,
  the one with the smallest hash, the leftmost of equals. Equal windows have
  equal anchors at the same place, so only grams matter that are an anchor in
  two documents or more, and a suffix is only sent to the subtrees of these.
* Variable-length prefixes. All windows of an anchor gram share that gram, which
  names their subtree; subtrees are put together into groups of about ``GROUP``
  anchors. A gram with more than ``HOT`` anchors (a line that very many documents
  share, a text with very many copies) gets its prefix lengthened to the whole
  window: its subtrees are single deep nodes, and their smallest doc_id is
  a sum-like aggregate that is combined before the shuffle.
* Deep nodes. In a group, word positions are named by the words that follow, for
  lengths 1, 2, 4, ... by sorting pairs of names (Karp, Miller and Rosenberg), up
  to ``WINDOW`` words. Positions of one name lie below one node at that depth; the
  node's smallest doc_id decides for all of them. Names are exact, not hashes.

A lengthened prefix is carried as the 128-bit digest of the window's words.

Words of a text travel only as far as its own row and, around shared anchors, as
the context its windows need. Texts without a shared anchor are finished where
they are read for the second time.

Defined results: a null or empty text has no word; texts of fewer than
``WINDOW`` words lose none; a null doc_id is larger than every other, and rows
with the same doc_id (or with none) never remove from each other; repeated rows
give a row each; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

WINDOW, GRAM = 50, 8
SPAN = WINDOW - GRAM + 1
GROUP, HOT = 20_000, 20_000
# Documents without an id come after all others.
NO_ID = (1 << 63) - 1
# Words hashed per Python worker before its table starts anew.
REMEMBERED = 300_000

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


class WordHashes(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxh64_intdigest(word)
        return value


HASHES = WordHashes()


def split(text: str | None) -> list[bytes]:
    """Words as UTF-8; bytes.split() knows the six ASCII spaces only."""
    return (text or "").encode().split()


def grams(words: list[bytes]) -> np.ndarray:
    """A well-mixed hash of every run of ``GRAM`` words."""
    known = HASHES
    h = np.fromiter([known[w] for w in words], np.uint64, len(words))
    n = len(h) - GRAM + 1
    out = np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(GRAM):
            out = (out + h[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out


def anchors(g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors, and the first and last window each of them serves."""
    n = len(g) - SPAN + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    # Leftmost minimum of SPAN grams, by doubling the length of the stretch.
    best, length = np.arange(len(g)), 1
    while length < SPAN:
        step = min(length, SPAN - length)
        left, right = best[:-step], best[step:]
        best = np.where(g[right] < g[left], right, left)
        length += step
    best = best[:n]
    first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    last = np.r_[first[1:], n] - 1
    return best[first], first, last


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, digest, text) -> (id, digest, gram, place, windows before and after it)."""
    for b in batches:
        ids, digests, gram, place, before, after = [], [], [], [], [], []
        for i, digest, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            words = split(text.as_py())
            if len(words) < WINDOW:
                continue
            g = grams(words)
            at, first, last = anchors(g)
            ids.append(np.full(len(at), i, np.int64))
            digests.append(np.full(len(at), digest, np.int64))
            gram.append(g[at].view(np.int64))
            place.append(at)
            before.append(at - first)
            after.append(at - last)
        if ids:
            columns = [np.concatenate(c) for c in (ids, digests, gram, place, before, after)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns[:4]] + [pa.array(c.astype(np.int16)) for c in columns[4:]],
                names=["id", "digest", "gram", "place", "before", "after"])


ANCHORS = "id bigint, digest bigint, gram bigint, place bigint, before smallint, after smallint"
SUFFIXES = "id bigint, digest bigint, gram bigint, first int, windows int, context binary"


def finish_or_keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their shared anchors -> the result of those without any, the text of the others."""
    for b in batches:
        keep = b.column(4).is_valid().to_pylist()
        n, digest = [], []
        for text, kept in zip(b.column(3), keep):
            words = [] if kept else split(text.as_py())
            n.append(None if kept else len(words))
            digest.append(None if kept else hashlib.sha256(b" ".join(words)).hexdigest())
        text = pc.if_else(pa.array(keep), b.column(3), pa.scalar(None, pa.string()))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), text, b.column(4), pa.array(n, pa.int64()), pa.array(digest, pa.string())],
            names=["doc_id", "id", "digest", "text", "spots", "n_words", "kept_sha256"])


SPOTS = "array<struct<gram:bigint,place:bigint,before:smallint,after:smallint,hot:boolean>>"
KEPT = f"doc_id bigint, id bigint, digest bigint, text string, spots {SPOTS}, n_words bigint, kept_sha256 string"


def cut_suffixes(hot: bool) -> Callable:
    """(id, digest, text, spots) -> contexts for the subtrees, or windows as lengthened prefixes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, digest, text, spots in zip(*[b.column(c) for c in range(4)]):
                i, digest, words = i.as_py(), digest.as_py(), split(text.as_py())
                for s in spots.as_py():
                    if s["hot"] != hot:
                        continue
                    first, last = s["place"] - s["before"], s["place"] - s["after"]
                    if not hot:
                        rows.append((i, digest, s["gram"], first, last - first + 1, b" ".join(words[first:last + WINDOW])))
                        continue
                    for at in range(first, last + 1):
                        window = b" ".join(words[at:at + WINDOW])
                        rows.append((i, digest, s["gram"], at, 1, hashlib.blake2b(window, digest_size=16).digest()))
                if len(rows) >= 4096:
                    yield suffix_batch(rows)
                    rows = []
            if rows:
                yield suffix_batch(rows)

    return cut


def suffix_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["id", "digest", "gram", "first", "windows", "context"])


def names_at_depth(words: np.ndarray, depth: int) -> np.ndarray:
    """Name of the ``depth`` words from each position on; equal names, equal words.

    ``words`` are word numbers. Positions with fewer words left have no name.
    """
    names, length = words, 1
    while length < depth:
        step = min(length, depth - length)
        pair = names[:-step].astype(np.int64) * (int(names.max()) + 1) + names[step:]
        names = np.unique(pair, return_inverse=True)[1]
        length += step
    return names


def subtree(group: pa.Table) -> pa.Table:
    """The contexts of some grams -> runs of windows that a smaller document has too."""
    ids = group.column("id").to_numpy()
    windows = group.column("windows").to_numpy().astype(np.int64)
    # Contexts laid end to end; their words numbered.
    contexts = [c.split(b" ") for c in group.column("context").to_pylist()]
    numbers: dict[bytes, int] = {}
    words = np.fromiter([numbers.setdefault(w, len(numbers)) for c in contexts for w in c], np.int64)
    sizes = np.array([len(c) for c in contexts])
    del contexts
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(ids)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    node = names_at_depth(words, WINDOW)[starts[owner] + offset]
    smallest = np.full(node.max() + 1, NO_ID)
    np.minimum.at(smallest, node, ids[owner])
    gone = smallest[node] < ids[owner]
    # Runs of windows that go, context by context.
    joined = np.r_[False, gone[1:] & gone[:-1] & (owner[1:] == owner[:-1])]
    begin = np.flatnonzero(gone & ~joined)
    end = np.flatnonzero(gone & ~np.r_[joined[1:], False])
    first = group.column("first").to_numpy()[owner[begin]] + offset[begin]
    return pa.table({
        "id": ids[owner[begin]], "digest": group.column("digest").to_numpy()[owner[begin]],
        "start": first.astype(np.int64), "n": (end - begin + 1).astype(np.int64)})


RUNS = "id bigint, digest bigint, start bigint, n bigint"


def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, runs) -> the result: runs of windows cover ``WINDOW`` - 1 words more than their number."""
    for b in batches:
        rows = []
        for doc_id, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            words = split(text.as_py())
            gone = 0
            if runs.is_valid and len(runs):
                edge = np.zeros(len(words) + 1, np.int64)
                for r in runs.as_py():
                    edge[r["start"]] += 1
                    edge[r["start"] + r["n"] + WINDOW - 1] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                gone = int(covered.sum())
                kept = [w for w, c in zip(words, covered.tolist()) if not c]
            else:
                kept = words
            rows.append((doc_id, len(words), gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
        if rows:
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, id, digest): ``id`` orders documents, with ``digest`` it names a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.lit(NO_ID)).alias("id"),
                       F.xxhash64(text).alias("digest"))


def shared_grams(found: DataFrame, hot: int) -> DataFrame:
    """Grams that are an anchor in two documents or more, and whether there are very many."""
    return (
        found.groupBy("gram").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high").select("gram", "n", (F.col("n") > hot).alias("hot"))
    )


def with_spots(texts: DataFrame, found: DataFrame, shared: DataFrame) -> DataFrame:
    """Every row with its shared anchors; rows without any are finished, and lose their text."""
    spots = found.join(shared.select("gram", "hot"), "gram").groupBy("id", "digest").agg(
        F.collect_set(F.struct("gram", "place", "before", "after", "hot")).alias("spots"))
    return texts.join(spots, ["id", "digest"], "left").select(
        "doc_id", "id", "digest", "text", "spots").mapInArrow(finish_or_keep, KEPT)


def repeated_runs(texts: DataFrame, contexts: int, group: int) -> DataFrame:
    """(id, digest, start, n): windows ``start`` to ``start + n - 1`` of a text are in a smaller document.

    ``texts`` has (id, digest, text, spots), ``contexts`` is how many contexts the subtrees get.
    """
    cold = texts.mapInArrow(cut_suffixes(False), SUFFIXES).select(
        "*", F.pmod(F.xxhash64("gram"), F.lit(contexts // group + 1)).alias("group"))
    trees = cold.groupBy("group").applyInArrow(subtree, RUNS)
    lengthened = texts.where(F.exists("spots", lambda s: s.hot)).mapInArrow(cut_suffixes(True), SUFFIXES)
    lengthened = stored(lengthened.select("id", "digest", "first", F.col("context").alias("prefix")), "substring-windows")
    nodes = stored(lengthened.groupBy("prefix").agg(F.min("id").alias("low")), "substring-nodes")
    deep = lengthened.join(nodes, "prefix").where("low < id").select(
        "id", "digest", F.col("first").cast("bigint").alias("start"), F.lit(1).cast("bigint").alias("n"))
    return trees.unionByName(deep)


def report(docs: DataFrame, hot: int = HOT, group: int = GROUP) -> DataFrame:
    """Per document: its words, how many of them go, and a digest of those that stay."""
    texts = keyed(docs)
    found = stored(texts.select("id", "digest", "text").mapInArrow(find_anchors, ANCHORS), "substring-anchors")
    shared = stored(shared_grams(found, hot), "substring-shared")
    contexts = shared.where("not hot").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = stored(with_spots(texts, found, shared), "substring-rows")
    kept = rows.where("spots is not null").select("doc_id", "id", "digest", "text", "spots")
    runs = repeated_runs(kept.select("id", "digest", "text", "spots"), contexts, group)
    runs = runs.groupBy("id", "digest").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    cut = kept.join(runs, ["id", "digest"], "left").select("doc_id", "text", "runs").mapInArrow(remove, RESULT)
    done = rows.where("spots is null").select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256")
    return done.unionByName(cut)

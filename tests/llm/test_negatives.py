import math

import numpy as np
import pytest

from cartwright.llm import negatives

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, more=""):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    return df.selectExpr("*", *[x for x in more.split("; ") if x])


def brute(rows):
    good = {(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    length = min((r[0], len(r[2])) for r in good)[1]
    good = sorted(r for r in good if len(r[2]) == length)
    x = np.array([r[2] for r in good], np.int64).reshape(len(good), length)
    out = []
    for n, a in enumerate(good):
        if a[0] % 100:
            continue
        ranked = sorted((-int(s), r[0], m) for m, (s, r) in enumerate(zip(x @ x[n], good)) if m != n)
        for ps, pid, _ in [r for r in ranked if good[r[2]][1] == a[1]][:5]:
            window = [r for r in ranked if good[r[2]][1] != a[1] and 30 * -ps <= 100 * -r[0] <= 90 * -ps][:10]
            out += [(a[0], pid, k, nid, -ps, -ns) for k, (ns, nid, _) in enumerate(window, 1)]
    return sorted(out)


def crowd(n, size, topics=7, spread=0.1, seed=1, labels=10):
    """Topics and labels overlap only in part, so that windows hold rows of several labels."""
    rng = np.random.default_rng(seed)
    center = rng.standard_normal((topics, size)) * 0.15
    topic = rng.integers(topics, size=n)
    x = center[topic] + spread * rng.standard_normal((n, size))
    label = (topic + rng.integers(3, size=n)) % labels
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))]


AWKWARD = [(-100, None, 1), (100000, [None] * 16, 1), (200000, [NAN] * 16, 2), (300000, [1.0, INF] * 8, 2), (400000, [1.0] * 15, 3),
           (500000, [], 3), (None, [0.01] * 16, 3), (600000, [0.1] * 16, None), (700000, [0.0] * 16, 4), (800000, [-0.2] * 16, 77)]


@pytest.mark.parametrize("n, size, topics, spread, chunk", [
    (900, 16, 7, 0.1, None), (1500, 64, 30, 0.03, 200), (1200, 7, 3, 0.4, 100), (300, 1, 4, 0.1, 50)])
def test_against_comparing_everything(spark, n, size, topics, spread, chunk):
    rows = crowd(n, size, topics, spread, seed=n)
    got = sorted(map(tuple, negatives.report(frame(spark, rows), size=chunk).collect()))
    assert got == brute(rows) and (size == 1 or len(got) > 100)


def test_awkward_rows_copies_and_ties(spark):
    rows = crowd(400, 16) + AWKWARD
    # A third of all rows one vector, of two labels and with anchors among them; repeated rows; one id with two vectors.
    rows += [(1000 + i, rows[3][1], 5 if i % 3 else 6) for i in range(250)]
    rows += rows[:30] + [(200, rows[9][1], 2), (201, rows[9][1], 2)]
    df = frame(spark, rows, "1 as class; 2 as x; 3 as query; 4 as ids")
    assert sorted(map(tuple, negatives.report(df, size=90).collect())) == brute(rows)


def test_cells_are_visited_in_order_and_only_while_they_may_count():
    rng = np.random.default_rng(2)
    a, b = rng.standard_normal(9), rng.standard_normal(5)
    walked = list(negatives.multi_sequence(a, b))
    sums = [s for s, _, _ in walked]
    assert sums == sorted(sums, reverse=True) and len({(i, j) for _, i, j in walked}) == 45
    assert all(math.isclose(s, a[i] + b[j]) for s, i, j in walked)
    books = [rng.standard_normal((6, 4)) * 50, rng.standard_normal((6, 4)) * 50]
    index = negatives.Index(None, books, [np.full(36, 2.0)] * 2, np.full(36, 400), np.arange(36), np.ones(36, np.int64), 8)
    walk, x = negatives.Walk(index), rng.standard_normal(8) * 50
    stop = 500.0
    size = [np.linalg.norm(x[:4]), np.linalg.norm(x[4:])]
    may = {i * 6 + j for i in range(6) for j in range(6)
           if books[0][i] @ x[:4] + books[1][j] @ x[4:] + 2 * sum(size) >= stop}
    early, later = walk(x, stop, np.inf, False), walk(x, stop, np.inf, True)
    assert set(early) | set(later) == may and not set(early) & set(later) and len(early) == 3 and len(may) < 36
    low = min(books[0][i] @ x[:4] + books[1][j] @ x[4:] for i in range(6) for j in range(6))
    assert len(walk(x, -np.inf, low, False) + walk(x, -np.inf, low, True)) < 36


def test_separate_topics_leave_cells_out(spark):
    """Far apart topics: an anchor's search of its positives visits a small part of the rows."""
    rng = np.random.default_rng(4)
    center = np.repeat(np.eye(16) * 4, 40, axis=0)
    x = np.floor(256 * (center + 0.01 * rng.standard_normal(center.shape))).astype(int)
    rows = spark.createDataFrame([(str(i), i // 40, v.tolist(), [i]) for i, v in enumerate(x)],
                                 "class string, label bigint, x array<int>, ids array<bigint>")
    index = negatives.build(rows, len(x), 16, rows=40)
    walk = negatives.Walk(index)
    for n in range(0, len(x), 40):
        bar = sorted(x[n // 40 * 40:n // 40 * 40 + 40] @ x[n])[-6]
        assert index.counts[walk(x[n].astype(float), float(bar), np.inf, False) + walk(x[n].astype(float), float(bar), np.inf, True)].sum() <= 120


def test_empty_tables(spark):
    assert negatives.report(frame(spark, [])).collect() == []
    assert negatives.report(frame(spark, [(1, [0.5] * 4, 1), (2, [0.5] * 4, 1)])).collect() == []
    assert negatives.report(frame(spark, [(100, [0.5] * 4, 1)])).collect() == []

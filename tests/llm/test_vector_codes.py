import hashlib
import math

import numpy as np
import pytest

from cartwright.llm import vector_codes

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, more=""):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    return df.selectExpr("*", *[x for x in more.split("; ") if x])


def brute(rows, parts=16, entries=64, rounds=2):
    """Everything measured, in Python integers."""
    good = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    length = len(good[0][2])
    sizes = [length // parts + (i < length % parts) for i in range(parts)]
    at = [sum(sizes[:i]) for i in range(parts)]
    fit = [r for r in good if len(r[2]) == length]
    cut = [[r[2][a:a + n] for a, n in zip(at, sizes)] for r in fit]
    books = [[c[p] for c, r in zip(cut, good) if len(r[2]) == length][:len([g for g in good[:entries] if len(g[2]) == length])]
             for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            member = [nearest(books[p], c[p])[1] for c in cut]
            for e in set(member):
                own = [c[p] for c, m in zip(cut, member) if m == e]
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{nearest(books[p], c[p])[1]:02x}" for p in range(parts)),
            sum(nearest(books[p], c[p])[0] for p in range(parts)), r[1]) for c, r in zip(cut, fit)]
    total = {}
    for _, _, e, label in out:
        total[label] = total.get(label, 0) + e
    out = [(i, c, e, total[label], sha) for i, c, e, label in out]
    return out + [(i, None, None, total.get(label), sha) for i, label, x in good if len(x) != length]


def crowd(n, size, seed=1, topics=9, spread=0.1):
    rng = np.random.default_rng(seed)
    center = rng.standard_normal((topics, size)) * 0.2
    x = center[rng.integers(topics, size=n)] + spread * rng.standard_normal((n, size))
    return [(int(i), v.tolist(), int(i) % 5 if i % 7 else None) for i, v in zip(rng.permutation(3 * n)[:n], x)]


AWKWARD = [(-9, None, 1), (-8, [None] * 32, 1), (-7, [NAN] * 32, 2), (-6, [1.0, INF] * 16, 2), (70000, [1.0] * 31, 3),
           (70001, [], None), (None, [0.01] * 32, 3), (None, [0.01] * 32, 3), (70002, [1e300] + [0.0] * 31, 99)]


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("n, size, spread", [(500, 32, 0.1), (400, 64, 0.02), (300, 17, 1.5), (50, 32, 0.1), (1, 16, 0.1), (200, 5, 0.3)])
def test_against_measuring_everything(spark, n, size, spread):
    rows = crowd(n, size, seed=n, spread=spread)
    same(vector_codes.report(frame(spark, rows)).collect(), brute(rows))


def test_awkward_rows_and_ties(spark):
    rows = crowd(150, 32) + [r for r in AWKWARD if r[0] != 70002]
    rows += [(80000 + i, rows[i % 3][1], 4) for i in range(200)]
    rows += rows[:20] + [(90000 + i, [float(x) for x in np.eye(32)[i % 32] * (i % 2)], 5) for i in range(64)]
    df = frame(spark, rows, "1 as x; 2 as own; 3 as error; 4 as v; 5 as of")
    same(vector_codes.report(df).collect(), brute(rows))


def test_huge_components_are_held(spark):
    rows = [(i, v, label) for i, v, label in crowd(80, 32)]
    got = {r.vec_id: r for r in vector_codes.report(frame(spark, rows + [AWKWARD[-1]])).collect()}
    want = {r[0]: r for r in brute(rows + [(70002, [vector_codes.LARGEST / 256] + [0.0] * 31, 99)])}
    assert tuple(got[70002]) == want[70002] and len(got) == 81


def test_bounds_hold_and_more_rounds_agree(spark):
    """Bounds never exceed the true distances, and five rounds with changing lists still give the exact result."""
    rows = crowd(400, 32, seed=8, spread=0.3)
    same(vector_codes.report(frame(spark, rows), rounds=5).collect(), brute(rows, rounds=5))
    rng = np.random.default_rng(0)
    x, e = rng.integers(-90, 90, (300, 4)), rng.integers(-90, 90, (64, 4))
    state = vector_codes.measured(x, e, 8)
    for step in range(4):
        new = e + rng.integers(-3, 4, e.shape)
        vector_codes.moved(x, new, np.sqrt(((new - e) ** 2).sum(axis=1)), state)
        e = new
        exact = vector_codes.squared(x, e)
        assert (state.own == exact.argmin(axis=1)).all()
        true = np.sqrt(exact)
        assert (state.lower <= np.take_along_axis(true, state.listed.astype(int), axis=1)).all()
        for r in range(len(x)):
            rest = np.delete(true[r], [state.own[r], *state.listed[r]])
            assert state.outer[r] <= rest.min()
        state = vector_codes.fitted(state, 8 - step)


def test_most_parts_are_never_measured_against_all():
    """What the bounds save: after a small move few parts are in doubt."""
    rng = np.random.default_rng(3)
    x, e = rng.integers(-90, 90, (2000, 4)), rng.integers(-90, 90, (64, 4))
    state = vector_codes.measured(x, e, 8)
    moved = e + rng.integers(-1, 2, e.shape)
    depth = vector_codes.moved(x, moved, np.sqrt(((moved - e) ** 2).sum(axis=1)), state)
    assert (depth == 0).mean() > 0.6 and (depth == 9).mean() < 0.05


def test_empty_table(spark):
    assert vector_codes.report(frame(spark, [])).collect() == []

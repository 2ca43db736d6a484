import numpy as np

from cartwright.llm import embeddings
from .test_simhash import unite

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, more=""):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    return df.selectExpr("*", *[x for x in more.split("; ") if x])


def brute(rows):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i, tuple(v)] = np.array(v) / np.linalg.norm(v)
    keys = list(good)
    links = [(a, b) for n, a in enumerate(keys) for b in keys[n + 1:]
             if len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.9]
    root = unite(keys, links)
    n = {k: sum(k in p for p in links) for k in keys}
    out = []
    for i, v in rows:
        k = (i, tuple(v or ()))
        if k in good:
            c = min(x[0] for x in keys if root[x] == root[k])
            out.append((i, n[k], c, i == c))
        else:
            out.append((i, 0, i, i is not None))
    return sorted(out, key=repr), len(links)


def corpus(seed=3, n=150, size=16):
    rng = np.random.default_rng(seed)
    rows = [(1000 - i, v.tolist()) for i, v in enumerate(rng.standard_normal((n, size)))]
    center = rng.standard_normal(size)
    rows += [(2000 + i, (center + 0.12 * rng.standard_normal(size)).tolist()) for i in range(120)]
    for i in range(30):
        v = np.array(rows[i][1])
        rows.append((3000 + i, (v * 3 + 0.1 * rng.standard_normal(size)).tolist()))
    return rows + [(4000 + i, rows[5][1]) for i in range(40)]


AWKWARD = [(1, None), (2, []), (3, [0.0] * 16), (4, [1.0, None] + [0.0] * 14), (5, [NAN] * 16), (6, [INF] + [1.0] * 15),
           (None, [1.0] * 16), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [5.0] * 16), (9, [5.0] * 16), (10, [1e-300] * 16), (11, [1e200] * 16)]


def test_against_brute_force(spark):
    rows = corpus() + AWKWARD
    got = sorted(map(tuple, embeddings.report(frame(spark, rows, "1 as class; 2 as vector; 3 as root")).collect()), key=repr)
    assert got == brute([r for r in rows if r[0] != 10 and r[0] != 11] + [(10, [5.0] * 16), (11, [6.0] * 16)])[0]


def test_recall_of_the_passes_alone(spark):
    """Spread-out pairs just above the threshold, each in a place of its own."""
    rng = np.random.default_rng(1)
    rows, size = [], 32
    for i in range(400):
        v = rng.standard_normal(size)
        v /= np.linalg.norm(v)
        w = rng.standard_normal(size)
        w -= (w @ v) * v
        w /= np.linalg.norm(w)
        rows += [(2 * i, v.tolist()), (2 * i + 1, (0.92 * v + (1 - 0.92**2) ** 0.5 * w).tolist())]
    got = {r.vec_id: r.n_links for r in embeddings.report(frame(spark, rows)).collect()}
    assert sum(got.values()) >= 0.95 * 800 and max(got.values()) == 1


def test_tiles_count_every_link_once(spark):
    rows = corpus(5, 10)
    df = frame(spark, rows).selectExpr("'r' as root", "cast(vec_id as string) as class", "embedding as vector", "1L as copies")
    a, b = ({r["class"]: r.links for r in embeddings.count_links(df, size=s).collect()} for s in (2048, 17))
    assert a == b and sum(a.values()) == 2 * brute(rows)[1]


def crowded(n, topics, spread, seed=11, size=64):
    """Vectors around a few topics, and a pair at cosine 0.91 for every tenth."""
    rng = np.random.default_rng(seed)
    center = rng.standard_normal((topics, size))
    x = center[rng.integers(topics, size=n)] + spread * rng.standard_normal((n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    v = x[::10]
    w = rng.standard_normal(v.shape)
    w -= (w * v).sum(axis=1, keepdims=True) * v
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    return np.vstack([x, 0.91 * v + (1 - 0.91**2) ** 0.5 * w])


def test_every_link_of_crowded_vectors(spark):
    """Also where topics are dense: links and components equal brute force, over one chunk and over many."""
    for n, topics, spread, chunk in ((500, 5, 0.7, None), (2400, 12, 0.3, 300), (2400, 3, 0.6, 700)):
        x = crowded(n, topics, spread)
        got = sorted(map(tuple, embeddings.report(frame(spark, list(enumerate(x.tolist()))), size=chunk).collect()))
        close = x @ x.T >= 0.9
        np.fill_diagonal(close, False)
        low = np.arange(len(x))
        while True:
            new = np.array([min(low[i], low[c].min(initial=len(x))) for i, c in enumerate(close)])
            if (new == low).all():
                break
            low = new
        assert [r[:3] for r in got] == [(i, int(k), int(low[i])) for i, k in enumerate(close.sum(axis=1))]


def test_groups_far_apart_do_not_meet():
    centers = {2: np.array([[1.0, 0.0], [0.0, 1.0], [0.94, 0.342]])}
    groups = [dict(length=2, near=i, n=n, angle=0.1) for i, n in enumerate((10, 25, 10))]
    met = embeddings.meetings(groups, centers, {2: 45}, 0.9, 10)
    assert {(a, b) for a, _, b, _ in met} == {("2:0", "2:0"), ("2:1", "2:1"), ("2:2", "2:2"), ("2:0", "2:2"), ("2:2", "2:0")}
    assert {(a, n) for a, n, _, _ in met} == {("2:0", 1), ("2:1", 3), ("2:2", 1)}


def test_empty_table(spark):
    assert embeddings.report(frame(spark, [])).collect() == []

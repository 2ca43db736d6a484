import hashlib
import random

import numpy as np
import pytest

from cartwright.llm import substrings
from .helpers import AWKWARD, WORD, docs


def brute(rows):
    lowest = {}
    split = [(d, WORD.findall(t or "")) for d, t, _ in rows]
    for d, w in split:
        for i in range(len(w) - 49):
            if d is not None:
                k = tuple(w[i:i + 50])
                lowest[k] = min(d, lowest.get(k, d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 49):
            if lowest.get(tuple(w[i:i + 50]), d) != d and (d is None or lowest[tuple(w[i:i + 50])] < d):
                gone.update(range(i, i + 50))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)] + ["é", " x", "\U0001f600"]
    passages = [[rng.choice(vocabulary) for _ in range(k)] for k in (12, 49, 50, 51, 64, 200)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))] + rng.choice(passages)
        rows.append((rng.randrange(10 * n), rng.choice([" ", "\n", " \t "]).join(words), "s"))
    rows += [(5000 + i, rows[0][1], "s") for i in range(5)] + [(None, rows[1][1], "s"), (None, rows[1][1], "s"), rows[2], rows[2]]
    rows += [(7000, "same " * 120, "s"), (7001, "same " * 130, "s"), (7002, "a b " * 100, "s"), (7003, "x " + "a b " * 80, "s")]
    return rows


@pytest.mark.parametrize("hot, group", [(substrings.HOT, substrings.GROUP), (3, 5), (0, 1)])
def test_against_brute_force(spark, hot, group):
    rows = corpus() + [r for r in AWKWARD if r[0] != 6] + [(6, "long " * 3000 + "end", "t")]
    df = docs(spark, rows, "1 as id; 2 as digest; 3 as spots; 4 as gram")
    assert sorted(map(tuple, substrings.report(df, hot, group).collect()), key=repr) == brute(rows)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    shared = [str(rng.randrange(9)).encode() for _ in range(70)]
    for _ in range(30):
        texts = [[str(rng.randrange(9)).encode() for _ in range(rng.randrange(60))] + shared +
                 [str(rng.randrange(9)).encode() for _ in range(rng.randrange(60))] for _ in range(2)]
        seen = []
        for w in texts:
            g = substrings.grams(w)
            at, first, last = substrings.anchors(g)
            assert first[0] == 0 and last[-1] == len(w) - 50 and (first[1:] == last[:-1] + 1).all()
            serves = np.repeat(np.arange(len(at)), last - first + 1)
            begin = next(i for i in range(len(w)) if w[i:i + 70] == shared)
            seen.append([(g[at[serves[begin + i]]], at[serves[begin + i]] - begin - i) for i in range(21)])
        assert seen[0] == seen[1]


def test_names_are_equal_exactly_for_equal_words():
    words = np.array([1, 2, 1, 2, 1, 2, 3, 1, 2, 1, 2, 1, 2, 3])
    names = substrings.names_at_depth(words, 5)
    for i in range(len(names)):
        for j in range(len(names)):
            assert (names[i] == names[j]) == (words[i:i + 5].tolist() == words[j:j + 5].tolist())


def test_empty_table(spark):
    assert substrings.report(docs(spark, [])).collect() == []

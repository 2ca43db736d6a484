import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np

from cartwright.llm import personal
from .helpers import AWKWARD, docs

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def valid(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for k, pattern, least, most in ((2, CARD, 14, 19), (3, PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (k == 3 or valid(digits)):
                out.append((m.start(), k, m.end()))
    return sorted(out)


CASES = [
    "a@b.c_d@e.f, x@y x@y.z@w.v a@b..c .@-.- é.u+1%@mail-1.example.com.", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.2.3 1.2.3",
    "4111 1111-1111 1111 x 4111111111111112 41111111111111111111 4111  1111", "+1 (234) 567-8901. +123 +1" + " " * 30 + "234567890 ++4420",
    "\U0001f600 é +49 (30) 901820-111 user@host.de 10.0.0.1", "@" * 50 + "a@" * 50 + "a.b", "1-1 1-1 1", "+" + "1" * 15 + "+" + "1" * 16,
]


def digest(spans):
    return hashlib.sha256(personal.listed(spans).encode()).hexdigest()


def fuzz(n, seed=1):
    rng = random.Random(seed)
    bits = ["@", ".", "-", " ", "+", "(", ")", "1", "22", "333", "4444", "255", "256", "a", "b.c", "é", "4111111111111111", "\n", "_", "\t"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_pattern_spans_against_plain_patterns():
    for text in CASES + fuzz(20000):
        assert personal.pattern_spans(text) == brute(text), text


def test_report_against_brute_force(spark):
    rows = [(100 + i, t, "s") for i, t in enumerate(CASES + fuzz(300, 2))] + AWKWARD
    out = personal.report(docs(spark, rows, "1 as text_; 2 as spans; 3 as row"))
    got = sorted([(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in out.collect()], key=repr)
    want = []
    for d, t, _ in rows:
        spans = brute(t)
        want.append((d, *[sum(k == y for _, k, _ in spans) for y in range(4)], digest(spans)))
    assert got == sorted(want, key=repr)
    for r in out.collect():
        text = {d: t for d, t, _ in rows}[r.doc_id] or ""
        assert set(personal.listed(brute(text)).split(",")) - {""} <= set(r.spans.split(","))


def card(rng, right=True):
    body = "".join(rng.choice("0123456789") for _ in range(15))
    check = next(d for d in "0123456789" if valid(body + d) == right)
    return body + check


def sentence(rng, value):
    words = ["the", "caller", "left", "a", "note", "near", "Ångström", "street", "again,", "so", "it", "goes."]
    return " ".join(rng.choices(words, k=rng.randrange(3, 9)) + [value] + rng.choices(words, k=rng.randrange(3, 9)))


def corpus(n, seed):
    """(text, form or None): strict forms the patterns know, and numbers that are no personal data."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)
        octets = ".".join(str(rng.randrange(256)) for _ in range(4))
        name = rng.choice(["ann", "bo.li", "c_d", "eve+x"]) + str(rng.randrange(99))
        out += [sentence(rng, v) for v in (
            f"+1 ({a}) {b}-{c}", card(rng), octets, f"{name}@mail{rng.randrange(9)}.example.com",
            card(rng, False), str(rng.randrange(10**6)), f"{rng.randrange(1990, 2030)}", f"v{rng.randrange(9)}.{rng.randrange(9)}",
            f"{rng.randrange(1, 29)}.{rng.randrange(1, 13)}.{rng.randrange(1990, 2030)}", f"{rng.randrange(300, 999)}.1.1.1",
            f"{rng.randrange(99)}%", f"#{rng.randrange(10**9)}", f"{rng.randrange(24)}:{rng.randrange(10, 60)}", f"id{rng.getrandbits(64):x}")]
    return out


def unseen(n, seed):
    """(text, kind, start, end) in forms the patterns do not know."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)
        whole = card(rng)
        for kind, value in (("phone", f"({a}) {b}-{c}"), ("phone", f"{a}-{b}-{c}"), ("phone", f"{a}.{b}.{c}"),
                            ("card", ".".join(whole[i:i + 4] for i in range(0, 16, 4))),
                            ("ip", "[.]".join(str(rng.randrange(256)) for _ in range(4))),
                            ("email", f"ann{rng.randrange(99)}[@]mail{rng.randrange(9)}.example.org")):
            text = sentence(rng, value)
            out.append((text, kind, text.index(value), text.index(value) + len(value)))
    return out


def test_held_out_accuracy(spark):
    """Trained on what the patterns find, the field finds other forms in new texts and leaves numbers alone."""
    df = docs(spark, [(i, t, "s") for i, t in enumerate(corpus(60, 1))])
    model = personal.train(df)
    hard = unseen(60, 2)
    hits = 0
    for text, kind, a, b in hard:
        assert not any(x <= a and y >= b for x, _, y in personal.pattern_spans(text))
        hits += f"{kind}:{a}:{b}" in personal.listed(personal.all_spans(text, model)[1]).split(",")
    assert hits >= 0.95 * len(hard)
    plain, wrong = corpus(60, 3), 0
    for text in plain:
        base, spans = personal.all_spans(text, model)
        assert set(base) <= set(spans)
        wrong += spans != base
    assert wrong <= 0.01 * len(plain)


def test_the_best_segmentation_is_found():
    """Dynamic programming against trying every segmentation."""
    rng = np.random.default_rng(5)
    for text in ("1a+2@3", "(12) 3.4", "a@1.b", "1.2.3.4"):
        toks = personal.tokens(text, 0, len(text))
        found = list(personal.features(text, toks))
        names = {n for _, _, f in found for n in f} | {"noned", "nonea", "nonep"}
        model = personal.Field({n: rng.standard_normal(5) for n in sorted(names)}, rng.standard_normal((5, 5)))
        by_start = {}
        for i, j, f in found:
            by_start.setdefault(i, []).append((j, f))

        def paths(i, prior):
            if i == len(toks):
                yield 0.0, ()
                return
            kind = toks[i][2] if toks[i][2] in "da" else "p"
            for j, f in [(i + 1, None)] + by_start.get(i, []):
                for y in [0] if f is None else range(1, 5):
                    own = model.score(("none" + kind,) if f is None else f)[y] + model.moves[prior, y]
                    for s, rest in paths(j, y):
                        yield own + s, (((toks[i][0], y - 1, toks[j - 1][1]),) if y else ()) + rest

        best = max(paths(0, 0))
        assert tuple(model.spans(text, 0, len(text))) == best[1]


def test_gradient_of_the_likelihood():
    texts = ["+1 (234) 567-8901", "10.0.0.1", "v3.0 12", "a1@b.cd 5"]
    made = Counter()
    for n, t in enumerate(texts):
        made[personal.structure(t, 0, len(t), brute(t))] += n + 1
    likelihood = personal.Likelihood(made)
    rng = np.random.default_rng(1)
    w, m = rng.standard_normal((len(likelihood.names), 5)) * 0.3, rng.standard_normal((5, 5)) * 0.3
    _, dw, dm = likelihood.gradient(w, m)
    for (i, y), h in itertools.product([(0, 0), (3, 2), (7, 4), (11, 1), (0, 4)], [1e-5]):
        up, down = w.copy(), w.copy()
        up[i, y] += h
        down[i, y] -= h
        assert abs((likelihood.gradient(up, m)[0] - likelihood.gradient(down, m)[0]) / (2 * h) - dw[i, y]) < 1e-5
    up, down = m.copy(), m.copy()
    up[0, 4] += 1e-5
    down[0, 4] -= 1e-5
    assert abs((likelihood.gradient(w, up)[0] - likelihood.gradient(w, down)[0]) / 2e-5 - dm[0, 4]) < 1e-5


def test_islands_are_words_with_a_digit_or_an_at():
    for text in CASES + fuzz(3000, 9):
        words = [(m.start(), m.end()) for m in re.finditer(r"\S+", text) if re.search("[0-9@]", m[0])]
        joined = []
        for a, b in words:
            if joined and joined[-1][1] + 1 == a:
                joined[-1][1] = b
            else:
                joined.append([a, b])
        assert [list(x) for x in personal.islands(text)] == joined


def test_long_texts_take_linear_time(spark):
    model = personal.train(docs(spark, [(i, t, "s") for i, t in enumerate(corpus(5, 1))]))
    for text in ("x" * 1_000_000, "1" * 300_000, "a@" * 150_000, "1.2." * 50_000, "+1" + " " * 500_000, "12 " * 5_000, "_.-" * 200_000 + "@"):
        started = time.time()
        personal.all_spans(text, model)
        assert time.time() - started < 15, text[:10]


def test_redact(spark):
    rows = [(1, "é call +1 (234) 567-8901 or a@b.co\nnow", "s"), (2, None, "s"), (3, "plain", "s"), (4, "at 10.0.0.1, ok", "s")]
    df = docs(spark, rows, "1 as spans; 2 as row; 3 as clean")
    out = personal.redact(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "é call [PHONE] or [EMAIL]\nnow", 2: None, 3: "plain", 4: "at [IP], ok"}


def test_empty_table(spark):
    assert personal.report(docs(spark, [])).collect() == []
    assert personal.redact(docs(spark, [])).collect() == []

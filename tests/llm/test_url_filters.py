import math
import random
import re

import pytest

from cartwright.llm import url_filters as uf

ODD = [
    "http://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/1", "https://a.www.example.com/en/", "https://example.com/en",
    "x.net/fr/1", "ftp://net/es/", "http://a.net/es/?q", "http://a.net?es/", "http://a.net#/fr/", "http://notnet/fr/",
    "a://b://c.com/d", "://com/", "http://", "", "no scheme", "http://ÄB.org/É", "http://a.org\n/x", "http://" + "a" * 9000 + ".org/",
    "http://anet/es/", "http://sub.example.com/en/x", "http://COM/", "http://com",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


def frame(spark, urls, more=""):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    return df.selectExpr("*", *[x for x in more.split("; ") if x])


def test_parts_and_rules(spark):
    urls = ODD + [None] + ODD[:3]
    for r in uf.report(frame(spark, urls, "1 as host; 2 as path; 3 as rule; 4 as found; 5 as score; 6 as block")).collect():
        host, path, rule = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == ("block" if rule.block else "allow") if rule else r.verdict in ("allow", "block")


def labelled(n, seed):
    rng = random.Random(seed)
    good, bad = ["news", "blog", "wiki", "shop", "docs"], ["casino", "track", "adserv", "click", "spam"]
    out = []
    for i in range(n):
        words = (bad, good)[i % 2]
        out.append((f"http://{rng.choice(words)}{rng.randrange(99)}.org/{rng.choice(words)}/{rng.randrange(9999)}", 1 - i % 2))
    return out


def test_held_out_accuracy(spark):
    model = uf.train(spark.createDataFrame(labelled(300, 1), "url string, label int"))
    test = labelled(300, 2)
    got = uf.judge(frame(spark, [u for u, _ in test]), model).collect()
    assert sum((r.verdict == "block") == bool(test[r.page_id][1]) for r in got) >= 0.97 * len(test)


def test_training_is_plain_gradient_descent(spark):
    rows = labelled(40, 3)
    df = uf.parts(spark.createDataFrame(rows, "url string, label int")).select("label", uf.features().alias("f"))
    data = [(r.label, r.f) for r in df.collect()]
    bias, w = 0.0, [0.0] * uf.BUCKETS
    for _ in range(4):
        slope, step = [0.0] * uf.BUCKETS, 0.0
        for y, f in data:
            m = bias + sum(w[i] for i in f) / math.sqrt(len(f))
            e = (1 / (1 + math.exp(-m)) - y) / len(data)
            step += e
            for i in f:
                slope[i] += e / math.sqrt(len(f))
        bias -= uf.RATE * step
        w = [a * (1 - uf.RATE * uf.DECAY) - uf.RATE * s for a, s in zip(w, slope)]
    model = uf.train(spark.createDataFrame(rows, "url string, label int"), steps=4)
    assert model.bias == pytest.approx(bias) and model.weights == pytest.approx(w)


def test_one_label_none_and_empty(spark):
    urls = ["http://a.com/x", "http://b.org/x", None]
    assert [r.verdict for r in uf.report(frame(spark, urls)).collect()] == ["allow"] * 3
    urls = ["http://a.net/es/x", "http://b.org/x"]
    assert [r.verdict for r in uf.report(frame(spark, urls)).collect()] == ["block"] * 2
    assert uf.report(frame(spark, ["http://b.org/x"])).first().verdict == "allow"
    assert uf.report(frame(spark, [])).collect() == []


def test_labelled_table_is_bounded_and_has_each_url_once(spark):
    urls = ["http://a.com/x"] * 50 + [f"http://a.net/fr/{i}" for i in range(50)]
    got = uf.labelled_by_rules(frame(spark, urls), most=20).collect()
    assert sorted(r.label for r in got) == [0] + [1] * 20 and len({r.url for r in got}) == 21


def test_no_python_where_pages_are_judged(spark):
    plan = uf.judge(frame(spark, []), uf.Model(0.0, (0.0,) * uf.BUCKETS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan

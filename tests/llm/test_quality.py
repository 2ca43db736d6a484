from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwright.llm import quality
from .helpers import AWKWARD, WORD, docs


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


CASES = [
    "a b c d e f a b c d e", "a a a a a a a", "a b c d e", "a b c d e a b c d e\na b c d e\na b c d e", "### $$ |x|",
    "A B C\nA B C\n\n \nA B C", "É È ß　x y", "one two three four five six seven eight nine ten\n" * 3,
]


def test_measurements(spark):
    rows = [(100 + i, t, "s") for i, t in enumerate(CASES)] + AWKWARD
    got = quality.report(docs(spark, rows)).collect()
    want = sorted([(d, *brute(t)) for d, t, _ in rows], key=repr)
    assert sorted([(r.doc_id, *r[1:6]) for r in got], key=repr) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_clean_text_is_kept_and_junk_goes(spark):
    clean = " ".join(f"word{i} goes on" for i in range(40))
    junk = " ".join(f"word{i}%%% goes### on$$$" for i in range(40))
    shout = " ".join(f"WORD{i}!! GOES!! ON!!" for i in range(40))
    kept = quality.keep(docs(spark, [(1, clean, "s"), (2, junk, "s"), (3, shout, "s"), (4, "", "s")])).collect()
    assert [r.doc_id for r in kept] == [1]


def test_clashing_columns_stay(spark):
    more = "1 as n_words; 'x' as failed; 2 as row; 3 as kept; 4 as w; 5 as lines"
    df = docs(spark, [(1, " ".join(map(str, range(100, 140))), "s")], more)
    assert quality.keep(df).columns == df.columns
    assert quality.report(df).first().n_words == 40


def test_empty_table(spark):
    assert quality.report(docs(spark, [])).collect() == [] and quality.keep(docs(spark, [])).count() == 0


def test_ablations_agree_with_switching_rules_off(spark):
    rows = [(i, t, "s") for i, t in enumerate(CASES * 2)] + AWKWARD
    judged = quality.ledger(docs(spark, rows)).cache()
    for r in quality.ablations(judged).collect():
        policy = next(p for p in quality.POLICIES if p.version == r.version)
        without = quality.Policy("trial", tuple(x for x in policy.rules if x != r.rule))
        now, then = (quality.apply_policy(judged, p).where("kept").count() for p in (policy, without))
        assert then - now == r.saved
        assert r.fails == judged.where(F.col("failed").bitwiseAND(F.lit(quality.BIT[r.rule])) != 0).count()


@pytest.mark.parametrize("policy", quality.POLICIES)
def test_no_python_and_no_shuffle(spark, policy):
    plan = quality.keep(docs(spark, []), policy)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan

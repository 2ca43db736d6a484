import os
import subprocess
import sys
from collections import Counter

import corpus_pipeline
from cartwright.llm import mixing, secrets
from cartwright.session import stored
from .helpers import AWKWARD, docs
from .test_bpe import want as encoded
from .test_quality import brute as measured
from .test_simhash import corpus, similar_pairs, unite

CLEAN = " ".join(f"clean{i} words here" for i in range(30))


def table(spark):
    rows = [(d, t, "ab"[d % 2]) for d, t, _ in corpus()] + AWKWARD
    rows += [(9000 + i, f"{CLEAN} {i} password=abcdefghijkl{i:04d}", "c") for i in range(5)]
    return rows, docs(spark, rows, "'en' as lang; cast(length(text) as bigint) as n_chars; 1 as row; 2 as s; 3 as fp")


def test_stages_against_plain_versions(spark):
    rows, df = table(spark)
    # 1: rejected documents go; the method's further rules reject nothing of these.
    one = stored(corpus_pipeline.quality_rules(spark, df, ""), "t")
    good = []
    for d, t, s in rows:
        n, _, _, _, repeats = measured(t)
        if not (n < 10 or 100 * repeats > 20 * n):
            good.append((d, t, s))
    assert one.columns == df.columns
    assert {r.doc_id for r in one.collect()} <= {d for d, _, _ in good}
    assert {d for d, _, _ in good} - {r.doc_id for r in one.collect()} <= {None, 7}
    # 2: one document of each group that is similar by five words and 0.8.
    left = [(r.doc_id, r.text) for r in one.collect()]
    root = unite(range(len(left)), similar_pairs([t for _, t in left]) + [
        (i, j) for i, (_, t) in enumerate(left) for j, (_, u) in enumerate(left[:i]) if t.lower().split() == u.lower().split()])
    best = {}
    for i, (d, _) in enumerate(left):
        best[root[i]] = min(best.get(root[i], (True, 0)), (d is None, d))
    two = stored(corpus_pipeline.near_dedup(spark, one, ""), "t")
    assert two.columns == df.columns
    assert sorted((r.doc_id for r in two.collect()), key=repr) == sorted((d for _, d in best.values()), key=repr)
    # 3: the spans are gone, everything else stays.
    three = stored(corpus_pipeline.secret_scan(spark, two, ""), "t")
    assert three.columns == df.columns and three.count() == two.count()
    assert not any("password=abc" in (r.text or "") for r in three.collect())
    assert all(r.n_chars == len(r.text) for r in three.collect() if r.text)
    again = secrets.report(three).collect()
    assert all(r.n_assign == r.n_access == r.n_hex == 0 for r in again)
    # 4: each document as often as the mix takes it.
    four = stored(corpus_pipeline.mix(spark, three, ""), "t")
    assert four.columns == df.columns
    took = {r.doc_id: r.taken // r.size for r in mixing.report(three).collect() if r.size}
    assert Counter(r.doc_id for r in four.collect()) == Counter({d: n for d, n in took.items() if n})
    # 5: ids as the library gives them.
    five = corpus_pipeline.encode(spark, four, "").collect()
    assert sorted(map(tuple, five), key=repr) == sorted([encoded(r.doc_id, r.text) for r in four.collect()], key=repr)


def test_clean_documents_stay_clean_documents(spark):
    df = docs(spark, [(i, f"{CLEAN} {' '.join(f'own{i}x{j}' for j in range(200))}", "s") for i in range(30)])
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, df, "")
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_empty_table(spark):
    df = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, "").collect() == []


def test_the_rest_imports_without_this_package(tmp_path):
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in os.listdir(root):
        if name == "cartwright":
            (tmp_path / name).mkdir()
            for part in os.listdir(f"{root}/{name}"):
                if part != "llm":
                    os.symlink(f"{root}/{name}/{part}", tmp_path / name / part)
        elif name != "corpus_pipeline.py":
            os.symlink(f"{root}/{name}", tmp_path / name)
    # A copied entry: a linked one would put the original folder on the path.
    os.unlink(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(f"{root}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and not any(k.startswith('op1_') for k in e.queries())"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)

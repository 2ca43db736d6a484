import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cartwright.llm import simhash
from cartwright.llm.components import components
from .helpers import AWKWARD, WORD, docs


def brute_print(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def unite(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def corpus():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 30, 300]))]
        out.append((1000 - 7 * i, " ".join(words), "s"))
        if i % 3 == 0:
            for k in range(3):
                words[rng.randrange(len(words))] = "CHANGED"
                out.append((2000 + 3 * i + k, "  ".join(words), "s"))
    return out + [(5000, "É Ä SECOND third", "s"), (5001, "É Ä second THIRD", "s")]


def test_fingerprints_and_components(spark):
    rows = corpus() + AWKWARD
    prints = {(d, t): brute_print(t) for d, t, _ in rows}
    fps = sorted(set(prints.values()))
    root = unite(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
    smallest = {}
    for (d, _), p in prints.items():
        if d is not None:
            smallest[root[p]] = min(d, smallest.get(root[p], d))
    want = sorted([(d, f"{prints[d, t]:016x}", smallest.get(root[prints[d, t]])) for d, t, _ in rows], key=repr)
    got = simhash.report(docs(spark, rows, "1 as fp; 2 as digest; 3 as root")).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_every_link_is_found(spark):
    rng = random.Random(4)
    fps = []
    for _ in range(300):
        x = rng.getrandbits(64)
        for bits in (0, 1, 2, 3, 4):
            y = x
            for j in rng.sample(range(64), bits):
                y ^= 1 << j
            fps.append(y)
    signed = sorted({x - (1 << 64) if x >> 63 else x for x in fps})
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = {tuple(r) for r in simhash.links(df).collect()}
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert got == want


def test_anchors_are_a_perfect_code(spark):
    df = spark.range(4096).select((F.col("id") * 1048583 % (1 << 32)).alias("h"))
    s = simhash.syndrome(F.col("h"))
    for r in df.select("h", simhash.home(F.col("h")).alias("a"), simhash.reached(F.col("h"), s).alias("r")).collect():
        assert (r.a ^ r.h).bit_count() <= 1 and all((x ^ r.h).bit_count() <= 2 for x in r.r) and len(r.r) <= 17 + 1


def test_deduplicate(spark):
    rows = corpus() + AWKWARD
    df = docs(spark, rows, "1 as fp; 2 as row; 3 as id; 4 as digest; 5 as text_digest; 6 as root")
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    components_of = {r.component_id for r in simhash.report(df).collect()}
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == sorted(components_of, key=repr)


def test_empty_table(spark):
    assert simhash.report(docs(spark, [])).collect() == [] and simhash.deduplicate(docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [
        (500, i) for i in range(501, 560)]
    rng.shuffle(pairs)
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint"), "a", "b").collect()
    assert {r.node: r.root for r in got} == unite(nodes, pairs) if all(p[0] in nodes and p[1] in nodes for p in pairs) else True
    assert len(got) == len(nodes)


def sets_of(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar_pairs(texts, most=10**9):
    """All pairs of different word sequences that overlap by 0.8, through the shingles they share.

    ``most`` leaves out shingles of more texts, which are boilerplate: pairs are found by their other shingles.
    """
    sets = [sets_of(t) for t in texts]
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    shared = {}
    for own in holders.values():
        for x, a in enumerate(own if len(own) <= most else []):
            for b in own[x + 1:]:
                shared[a, b] = shared.get((a, b), 0) + 1
    both = {(a, b): len(sets[a] & sets[b]) for (a, b), n in shared.items() if 2 * n >= min(len(sets[a]), len(sets[b]))}
    return [(a, b) for (a, b), n in both.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]


def edited(n, seed=7):
    """Texts, and copies of each with single words changed so that some are just above and some below 0.8."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(40, 400))
        out.append(" ".join(words))
        for _ in range(3):
            copy = list(words)
            for at in rng.sample(range(len(words)), max(1, round(len(words) * rng.uniform(0.002, 0.03)))):
                copy[at] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    return out


def kept_of(texts, pairs):
    root = unite(range(len(texts)), pairs)
    return {min(j for j in range(len(texts)) if root[j] == root[i]) for i in range(len(texts))}


def test_similar_documents_recall_and_precision(spark):
    texts = edited(150)
    pairs = similar_pairs(texts)
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    out = simhash.deduplicate_similar(docs(spark, rows, "1 as node; 2 as row; 3 as fp; 4 as anchors"))
    assert out.columns[:3] == ["doc_id", "text", "source"] and len(out.columns) == 7
    got, want = {r.doc_id for r in out.collect()}, kept_of(texts, pairs)
    gone = set(range(len(texts))) - want
    assert want <= got and len(pairs) > 200
    assert len(gone & got) <= 0.05 * len(gone)


def test_similar_recall_on_the_given_documents(spark):
    """Pairs that are no exact copies, against brute force over shared shingles."""
    found = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "source")
    rows = {}
    for r in found.orderBy("doc_id").collect():
        rows.setdefault(b" ".join((r.text or "").encode().lower().split()), r)
    rows = list(rows.values())
    pairs = similar_pairs([r.text for r in rows], most=60)
    got = {r.doc_id for r in simhash.deduplicate_similar(spark.createDataFrame(rows, found.schema)).collect()}
    root = unite(range(len(rows)), pairs)
    gone = {r.doc_id for i, r in enumerate(rows) if any(root[i] == root[j] and j < i for p in pairs for j in p)} if pairs else set()
    want = {r.doc_id for r in rows} - gone
    assert want <= got and len(gone & got) <= 0.1 * len(gone)


def test_similar_edges(spark):
    """Nulls, empty and short texts, repeated rows, a large group of near copies and one of copies."""
    base = [f"b{i}" for i in range(120)]
    near = [(5000 + i, " ".join(base[:i % 100] + [f"x{i}"] + base[i % 100:]), "n") for i in range(300)]
    rows = AWKWARD + near + [(6000 + i, "Five words make one SHINGLE", "c") for i in range(50)] + [(None, " ".join(base), "n")]
    got = simhash.deduplicate_similar(docs(spark, rows)).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted([1, 4, None, 5, 6, 7, 5000, 6000], key=repr)
    assert simhash.deduplicate_similar(docs(spark, [])).collect() == []


def test_similar_pairs_meet_at_every_size():
    """The chance that a pair at the threshold shares an anchor, with the blocks for small and large corpora."""
    rng = np.random.default_rng(1)
    for count in (1000, 200_000, 50_000_000):
        drawn = simhash.blocks(count)
        met = 0
        for _ in range(400):
            off = np.zeros(simhash.BITS, bool)
            off[rng.permutation(simhash.BITS)[:rng.binomial(simhash.BITS, simhash.SHARE)]] = True
            met += bool((~off[drawn].any(axis=1)).any())
        assert met >= 0.8 * 400 and drawn.max() < simhash.BITS


def test_anchors_of_blocks_cover_all_values_within_one_bit():
    """The perfect code's codewords: every value has one within one bit, which eight values share."""
    values = np.arange(1 << simhash.CODED)
    assert np.bitwise_count(values ^ simhash.NEAREST).max() == 1
    anchors, around = np.unique(simhash.NEAREST, return_counts=True)
    assert len(anchors) == 1 << simhash.CODED - simhash.PARITY and set(around) == {simhash.CODED + 1}
    assert (simhash.NEAREST[anchors] == anchors).all()


def test_fingerprints_next_to_one_codeword_meet_at_it():
    drawn = simhash.blocks(1000)
    coded, free = drawn[0, :simhash.CODED], drawn[0, simhash.CODED:]

    def first_key(*ones):
        bits = np.zeros(simhash.BITS, bool)
        bits[list(ones)] = True
        batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array(
            [np.packbits(bits, bitorder="little").view(np.int64)], pa.list_(pa.int64()))], names=["n", "fp"])
        out, = simhash.held_keys(drawn)(iter([batch]))
        assert out.num_rows == len(drawn) and set(out.column("n").to_pylist()) == {7}
        return out.column("key")[0].as_py()

    assert {first_key(b) for b in coded} == {first_key()}
    assert first_key() not in {first_key(b) for b in free} and first_key(*coded[:2]) != first_key()


def test_members_of_small_anchors_need_no_join(spark):
    """Anchors of 1 to 9 members: those known from the aggregate are exactly the members but the representative."""
    rng = random.Random(5)
    held = {key: rng.sample(range(1 << 40), 1 + key % 9) for key in range(90)}
    rows = simhash.meetings(spark.createDataFrame([(k, n) for k, m in held.items() for n in m], "key bigint, n bigint"))
    got = {r.key: r for r in rows.collect()}
    assert set(got) == {k for k, m in held.items() if len(m) > 1}
    mix = {r.key: r.h for r in spark.range(90).select(F.col("id").alias("key"), F.xxhash64("id").alias("h")).collect()}
    for k, r in got.items():
        assert r.rep == min(held[k], key=lambda n: n ^ mix[k])
        odd = sum(n % 2 for n in held[k])
        assert (r.others is None) == (max(odd, len(held[k]) - odd) > 3)
        assert r.others is None or sorted([*r.others, r.rep]) == sorted(held[k])
    assert {len(held[k]) for k, r in got.items() if r.others is not None} >= {2, 3, 4, 5}


def test_a_group_of_near_copies_meets_at_a_row_for_each_member_and_block(spark):
    """However large the group: no pairs of its members are made."""
    drawn, rng = simhash.blocks(1000), np.random.default_rng(2)
    bits = (rng.random(simhash.BITS) < 0.5) ^ (rng.random((400, simhash.BITS)) < 0.05)
    prints = np.packbits(bits, axis=1, bitorder="little").view(np.int64).tolist()
    nodes = spark.createDataFrame(list(enumerate(prints)), "n bigint, fp array<bigint>")
    pairs = simhash.candidates(nodes, drawn).collect()
    assert 400 <= len(pairs) <= 400 * len(drawn)
    assert len({r.n for r in pairs} | {r.rep for r in pairs}) == 400

import random

import brute
import numpy as np
import pytest
from govlake.llm import jaccard_join as jj

SCHEMA = "doc_id long, text string, member long, label long, grp string"


def result(spark, docs, **more):
    df = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in jj.jaccard_join(df, **more).collect()), key=repr)


def variants(seed, families, copies, words, most):
    rnd = random.Random(seed)
    out = []
    for _ in range(families):
        base = [f"v{rnd.randrange(500)}" for _ in range(rnd.randrange(4, words))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randrange(most + 1)):
                w[rnd.randrange(len(w))] = f"e{rnd.randrange(9999)}"
            if rnd.random() < 0.3:
                w += [f"t{rnd.randrange(99)}" for _ in range(rnd.randrange(6))]
            out.append((len(out) * 7 % 1009 + len(out) * 1009, " ".join(w)))
    return out


def test_documents_match_brute_force(spark, documents):
    expected = brute.jaccard(documents)
    assert any(d != c for d, _, c in expected)
    assert result(spark, documents) == expected


def test_variants_match_brute_force(spark):
    docs = variants(5, 40, 12, 120, 6)
    assert result(spark, docs) == brute.jaccard(docs)


def test_groups_of_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(jj, "LEAF", 16)
    docs = variants(6, 4, 90, 160, 6)
    assert result(spark, docs) == brute.jaccard(docs)


def test_lower_share(spark):
    docs = variants(7, 10, 12, 60, 6)
    assert result(spark, docs, share=70) == brute.jaccard(docs, share=70)


def test_odd_rows(spark, odd):
    docs = odd + [(30, "A b"), (31, "a  B"), (32, "a b c"), (33, "A\tB\nC"), (34, "a")]
    assert result(spark, docs) == brute.jaccard(docs)


def test_empty_table(spark):
    assert result(spark, []) == []


@pytest.mark.parametrize("share", [70, 90])
def test_traversal_loses_no_pair(share):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.unique(np.concatenate((rng.choice(base, rng.integers(150, 400), False), rng.integers(0, 2**63, 5).astype(np.uint64)))) for _ in range(80)]
    tree = jj.Tree(sets, np.argsort([len(s) for s in sets]))
    u, v = jj.traverse(tree, tree, share)
    found = {frozenset((int(a), int(b))) for a, b in zip(tree.order[u], tree.order[v])}
    for i in range(80):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= share * (len(sets[i]) + len(sets[j]) - n):
                assert frozenset((i, j)) in found


@pytest.mark.parametrize("share", [70, 90])
def test_bitmaps_never_rule_out_a_link(share):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 600).astype(np.uint64)
    sets = []
    for k in range(120):
        n = rng.integers(1, 140) if k % 2 else rng.integers(400, 600)
        start = base[: n] if k % 3 else base[rng.integers(0, 20) :][:n]
        sets.append(np.unique(np.concatenate((start, rng.integers(0, 2**63, rng.integers(0, max(1, n // 6) + 1)).astype(np.uint64)))))
    parent = list(range(120))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def union(a, b):
        parent[find(a)] = find(b)

    jj.plausible(list(range(120)), np.array([len(s) for s in sets]), [jj.parity(s, share) for s in sets], share, find, union)
    linked = 0
    for i in range(120):
        for j in range(i):
            k = len(np.intersect1d(sets[i], sets[j]))
            if 100 * k >= share * (len(sets[i]) + len(sets[j]) - k):
                linked += 1
                assert find(i) == find(j)
    assert linked > 50 and len({find(x) for x in range(120)}) > 2

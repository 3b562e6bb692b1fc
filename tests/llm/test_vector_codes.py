import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from govlake.llm import vector_codes as op

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int, id int"


def plain(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, code, error) and codebooks, in Python integers."""
    kept = [(i, v, c) for i, v, c in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    fit = [r for r in kept if len(r[1]) % parts == 0]
    kept = [r for r in kept if fit and len(r[1]) == len(fit[0][1])]
    if not kept:
        return [], [[] for _ in range(parts)]
    size = len(kept[0][1]) // parts
    ints = [[max(-(1 << 24), min(1 << 24, math.floor(4096 * x))) for x in v] for _, v, _ in kept]
    cut = [[v[k * size : k * size + size] for v in ints] for k in range(parts)]
    books = [[list(v) for v in c[:entries]] for c in cut]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, book: min((away(v, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for c, book in zip(cut, books):
            groups = {}
            for v in c:
                groups.setdefault(near(v, book)[1], []).append(v)
            for e, g in groups.items():
                book[e] = [sum(x) // len(g) for x in zip(*g)]
    out = []
    for j, (i, _, c) in enumerate(kept):
        best = [near(cut[k][j], books[k]) for k in range(parts)]
        out.append((i, None if c is None else str(c), "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return sorted(out, key=repr), books


def result(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(i, v, c, "x", 1, 2) for i, v, c in rows], SCHEMA).repartition(parts)
    codes, books = op.vector_codes(df, **more)
    return sorted((tuple(r) for r in codes.collect()), key=repr), books


def clusters(n, width=16, seed=3, spread=0.05):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    single = lambda x: float(np.float32(x))
    return [(i, [single(x + rnd.gauss(0, spread)) for x in centres[i % 5]], i % 3 or None) for i in range(n)]


@pytest.mark.parametrize("spread", [0.001, 0.05, 1.0])
def test_same_as_plain_lloyd(spark, spread):
    rows = clusters(700, spread=spread)
    assert result(spark, rows) == plain(rows)


def test_odd_rows(spark):
    good = clusters(60, 8)
    v = good[0][1]
    rows = good + [(100, None, 1), (101, [], 1), (102, v[:7] + [None], 1), (103, v[:7] + [float("nan")], 2), (104, v[:7] + [float("inf")], 2)]
    rows += [(105, v[:5], 1), (106, v + v, 1), (None, v, None), (None, v[::-1], 4), (3, v, 9), (3, v, 9), (-5, [0.0] * 8, 1), (-6, [1e9] * 8, 1), (-7, [-0.0001] * 8, 1)]
    assert result(spark, rows) == plain(rows)


def test_few_rows_ties_and_copies(spark):
    few = clusters(3, 8)
    assert result(spark, few) == plain(few)
    copies = [(i, [0.5] * 8, 1) for i in range(200)] + [(300 + i, [0.25 * (i % 4)] * 8, None) for i in range(40)]
    assert result(spark, copies) == plain(copies)
    assert result(spark, copies, entries=4, rounds=2) == plain(copies, entries=4, rounds=2)


def test_nothing_to_encode(spark):
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)]):
        assert result(spark, rows) == ([], [[] for _ in range(8)])


def test_cover_tree():
    rng = np.random.Generator(np.random.PCG64(6))
    rows = (rng.normal(0, 900, (3000, 3))).astype(np.int64) // 40 * 40
    tree, of_row = op.Tree.build(rows)
    assert (tree.points[of_row] == rows).all() and tree.weights.sum() == len(rows)
    for k, (a, b, c, x, y) in enumerate(tree.nodes):
        away = np.sqrt(((tree.points[a:b] - tree.points[c]) ** 2).sum(axis=1))
        assert a <= c < b and away.max() <= tree.radii[k] + 1e-9
        if x < y:  # children split the node and cover half its radius each
            assert tree.nodes[x, 0] == a and tree.nodes[y - 1, 1] == b and (tree.nodes[x + 1 : y, 0] == tree.nodes[x : y - 1, 1]).all()
            assert (tree.radii[x:y] <= tree.radii[k] / 2 + 1e-9).all() and tree.nodes[x, 2] == c
    entries = rows[:16]
    of, away = tree.codes(entries)
    exact = ((tree.points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (of == exact.argmin(axis=1)).all() and (away == exact.min(axis=1)).all()
    # far entries: whole subtrees go at once
    ranges, _ = tree.assign(np.array([[0, 0, 0], [10**6, 0, 0]]))
    assert len(ranges) == 1


def test_large_integers_stay_exact():
    big = np.array([[1 << 24, -(1 << 24)], [(1 << 24) - 1, -(1 << 24)]] * 40, np.int64)
    assert op.distances(big, np.array([[-(1 << 24), 1 << 24]]))[:2, 0].tolist() == [2 * (1 << 25) ** 2, ((1 << 25) - 1) ** 2 + (1 << 25) ** 2]


def test_query_digest_and_sql(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    codes, books = plain(rows)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    total = {}
    for _, c, _, e in codes:
        total[c] = total.get(c, 0) + e
    got = sorted(tuple(r) for r in op.op12_vector_codes(spark, sf_small).collect())
    assert got == sorted((i, code, e, total[c], sha) for i, c, code, e in codes)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_small}/embeddings.parquet')")
    names = [d[0] for d in con.execute(op.SQL).description]
    assert names == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and sorted(con.fetchall()) == got

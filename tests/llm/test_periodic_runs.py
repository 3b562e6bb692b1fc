import hashlib
import random

import numpy as np
from govlake.llm import periodic_runs as op

SCHEMA = "doc_id long, text string, runs string, start int, id int"


def plain(words, least=12):
    """All runs by trying every period; of one extent the smallest period stays."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                found.setdefault((i, j - i + p), p)
            i = j
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def expected(docs, order=lambda d, n: None):
    out = []
    for d, t in docs:
        w = [x for x in op_words(t)]
        new = order(d, len(w))
        if new is not None:
            w = [w[i] for i in new]
        runs = plain(w)
        out.append((d, len(w), runs, collapsed(w, runs)))
    return sorted(out, key=repr)


def op_words(t):
    import brute

    return brute.SPACED.findall(t or "")


def result(spark, docs, parts=3, **more):
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(parts)
    rows = op.periodic_runs(df, **more).collect()
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in rows), key=repr)


def arrays(docs):
    """Word numbers of several documents as the operator takes them."""
    size = [len(d) for d in docs]
    codes = np.random.Generator(np.random.PCG64(1)).integers(1, 2**63, 64).astype(np.uint64)
    end = np.cumsum(size)
    flat = np.array([x for d in docs for x in d], np.int64)
    return codes[flat], end - size, end


def test_every_run_of_small_alphabets():
    rnd = random.Random(4)
    for letters in (1, 2, 3):
        for least in (2, 3, 12):
            docs = [[rnd.randrange(letters) for _ in range(rnd.randrange(60))] for _ in range(250)]
            got = op.runs_of_words(*arrays(docs), least)
            for k, d in enumerate(docs):
                assert [tuple(r[1:]) for r in got.tolist() if r[0] == k] == plain(d, least)


def test_structured_words():
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    thue = [bin(i).count("1") % 2 for i in range(512)]
    nested = ([0] * 9 + [1]) * 7 + [2] + ([0] * 9 + [1]) * 7
    docs = [fib[-1], thue, nested, nested * 3, [0, 1, 2] * 50 + [0, 1] * 30, list(range(20)) * 5 + [3], [5] * 300]
    got = op.runs_of_words(*arrays(docs), 2)
    for k, d in enumerate(docs):
        assert [tuple(r[1:]) for r in got.tolist() if r[0] == k] == plain(d, 2)


def test_collisions_of_hashes_cannot_show(monkeypatch):
    rnd = random.Random(9)
    docs = [[rnd.randrange(3) for _ in range(80)] for _ in range(40)]
    hashes, begin, end = arrays(docs)

    class Equal(op.Rolling):
        def spans(self, begin, end):
            return np.zeros(len(begin), np.uint64)

    monkeypatch.setattr(op, "Rolling", Equal)
    got = op.runs_of_words(hashes, begin, end, 4)
    for k, d in enumerate(docs):
        assert {tuple(r[1:]) for r in got.tolist() if r[0] == k} >= set(plain(d, 4))


def test_odd_rows(spark, odd):
    docs = [x for x in odd if len(x[1] or "") < 20000] + [(30, "a b  c\n" * 30), (31, "  x " * 11), (32, "x " * 12), (None, None)]
    assert result(spark, docs) == expected(docs)


def test_very_long_text(spark):
    out = result(spark, [(1, "word " * 30000), (2, None), (3, " ".join(f"w{i % 1000}" for i in range(30000)))])
    assert out[0][1:] == (30000, [(0, 30000, 1)], "word") and out[2][2] == [(0, 30000, 1000)] and len(out[2][3].split()) == 1000


def test_rewritten_documents_and_digest(spark, documents, sf_small):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = []
    for d, _, runs, text in expected(documents, op.repeated_tail):
        s, n, p = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        rows.append((d, len(runs), s, n, p, None if n is None else 1000 * n // p, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(text)))
    got = sorted((tuple(r) for r in op.op13_periodic_runs(spark, sf_small).collect()), key=repr)
    assert got == sorted(rows, key=repr) and any(r[1] for r in got)


def test_empty_table(spark):
    assert result(spark, []) == []

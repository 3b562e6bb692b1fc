import hashlib
import random

import pytest
from govlake.llm import line_dedup as op

SCHEMA = "doc_id long, text string, lines string, a int, keep int, gone int"
SPACES = " \t\n\x0b\f\r"


def plain(docs, chars=20, least=3):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(SPACES))
    holders = {}
    for d, t in docs:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(d)
    top = {k: max(h, key=lambda d: (d is not None, d or 0)) for k, h in holders.items() if len(k) >= chars and len(h) >= least}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in top or top[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(spark, docs, parts=3, **more):
    df = spark.createDataFrame([(d, t, "x", 1, 2, 3) for d, t in docs], SCHEMA).repartition(parts)
    rows = op.line_dedup(df, with_text=True, **more).collect()
    for r in rows:  # the bitmap says the same as the figures
        assert sum(k["lines"] for k in r.keep) == r.n_lines - r.n_dropped
        assert all(k["lines"] > 0 for k in r.keep)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows), key=repr)


def test_odd_rows(spark, odd):
    docs = odd + [(20, "\n\n"), (21, "x\n"), (22, "ß" * 19), (23, "ß" * 20), (24, " " + "ß" * 20 + "\t"), (25, "a\n" + "ß" * 20 + "\r")]
    assert result(spark, docs) == plain(docs)


def test_case_space_and_length(spark):
    line = "Only A to Z are lowered, É is not"
    docs = [(1, f"{line}\nown"), (2, f" \t{line.upper().replace('É', 'É')}\x0b"), (3, line.replace("É", "é")), (4, f"{line}\n{line}\nend")]
    docs += [(i, "nineteen characters\nx") for i in range(10, 20)] + [(i, "twenty characters ok\nx") for i in range(20, 30)]
    assert result(spark, docs) == plain(docs)


def test_repeated_ids_and_null_id(spark):
    line = "a line that several rows of one document have"
    two = [(1, line), (1, line), (1, line + "\nx"), (2, line)]
    assert all(r[2] == 0 for r in result(spark, two))  # two documents only
    docs = two + [(None, line), (None, line + "\ny")]
    assert result(spark, docs) == plain(docs)
    nothing_else = [(None, line)] * 5
    assert result(spark, nothing_else) == plain(nothing_else)


@pytest.mark.parametrize("least", [2, 3])
def test_random_lines(spark, least):
    rnd = random.Random(5)
    pool = [f"line number {i} of a pool that documents share" for i in range(40)]
    docs = [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.4 else f"own line {i} {k} with some words" for k in range(rnd.randrange(8)))) for i in range(300)]
    assert result(spark, docs, least_docs=least) == plain(docs, least=least)


def test_hot_line_is_sliced(spark, monkeypatch):
    """A line in a third of all documents, many times over, is dealt over several tasks."""
    hot = "one line that a third of all documents hold"
    docs = [(i, f"{hot}\n{hot}\nbody of document {i} that is its own") if i % 3 == 0 else (i, f"body of document {i} that is its own") for i in range(3000)]
    seen = []
    real = op.hot_keys
    monkeypatch.setattr(op, "hot_keys", lambda *a: seen.append(real(*a)) or seen[-1])
    assert result(spark, docs) == plain(docs)
    assert [r.slices > 8 for r in seen[0].collect()] == [True]


def test_plan_has_no_python_and_one_shuffle_for_the_windows(spark, sf_small):
    plan = op.op11_line_dedup(spark, sf_small)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    group = ["a", "b", "slice"]
    lines = spark.range(10).selectExpr("id a", "2 * id b", "id % 3 slice", "id doc", "id + 1 pos").repartitionByRange(*group).sortWithinPartitions(*group, "doc", "pos")
    w = op.Window.partitionBy(*group).orderBy("doc")
    executed = lines.withColumn("rank", op.F.dense_rank().over(w))._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange") == 1 and executed.count("Sort [") == 1


def test_empty_table_and_digest(spark, sf_small):
    assert result(spark, []) == []
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = sorted(tuple(r) for r in op.op11_line_dedup(spark, sf_small).collect())
    assert got == sorted((d, n, g, sha(t)) for d, n, g, t in plain(docs))

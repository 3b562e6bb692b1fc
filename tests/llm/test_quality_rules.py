import random

import brute
from govlake.llm import quality_rules as q

SCHEMA = "doc_id long, text string, source string, line string, words int, row int"


def result(spark, docs, **more):
    df = spark.createDataFrame([(d, t, h, "x", 1, 2) for d, t, h in docs], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in q.quality_rules(df, **more).drop("removed_lines").collect()), key=repr)


def test_odd_rows(spark, odd):
    docs = [(d, t, None if i % 3 else "h") for i, (d, t) in enumerate(odd)] + [(50, "a b c d e a b c d e x y #1|2", "h")]
    assert result(spark, docs) == brute.quality(docs)


def test_shared_lines_and_copies(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    docs = []
    for i in range(200):
        body = [" ".join(word() for _ in range(9)) for _ in range(rnd.randrange(4))]
        notice = [f"Page {i}  of Our SITE notice and six more words that fill it"] * (i % 4 == 0) + ["\tshared by hosts, rarely"] * (i % 40 == 0)
        docs.append((i, "\n".join(notice * rnd.randrange(1, 3) + body), None if i % 5 == 0 else f"h{i % 2}"))
    docs += [(300 + i, "one long copy of a text that is here many times over, in exact form", "h0") for i in range(30)]
    expected = brute.quality(docs)
    assert any(r[-1] for r in expected) and any(not r[-3] and not r[-2] for r in expected)
    assert all(r[-2] for r in expected if r[0] >= 300)  # copies are one text
    assert result(spark, docs) == expected


def test_texts_without_removed_lines(spark):
    notice = "Page {} of our site and six more words that fill it"
    docs = [(i, f"own line {chr(97 + i // 6) * (1 + i % 6)} of text\n\n{notice.format(i)}\n  \nlast words {'abcdefghijklmnopqrstuvwxyz'[i % 26] * (1 + i // 26)}\n{notice.format(7)}\n", "h") for i in range(40)]
    docs += [(100, None, "h"), (101, "", "h"), (102, notice.format(3), "other"), (103, notice.format(3), "h"), (103, notice.format(3), "h"), (None, "a b\n\nc", None)]
    df = spark.createDataFrame([(d, t, h, "x", 1, 2) for d, t, h in docs], SCHEMA).repartition(3)
    got = {(r.doc_id, r.text): r for r in q.quality_rules(df, with_text=True).collect()}
    for d, t, h in docs:
        lines = (t or "").split("\n")
        gone = [k for k, x in enumerate(lines) if h == "h" and x.startswith("Page")]
        r = got[d, "\n".join(x for k, x in enumerate(lines) if k not in gone)]
        assert r.removed_lines == gone and r.n_line_words == sum(len(lines[k].split()) for k in gone)
    assert sum(r.doc_id == 103 for r in q.quality_rules(df).collect()) == 2 and len(got) == len(docs) - 1


def test_empty_table(spark):
    assert result(spark, []) == []


def test_no_python_in_the_plan(spark, sf_small):
    plan = q.op8_quality_rules(spark, sf_small)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

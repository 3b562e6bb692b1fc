import brute
import corpus_pipeline as cp
import pytest
from test_packing import check, expected_pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    """What each stage returned, its predecessor's rows being its input."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = [docs.collect()]
    for _, f in cp.STAGES:
        out.append(f(spark, docs, sf_small).collect())
        if f is not cp.packing:
            docs = spark.createDataFrame(out[-1], SCHEMA)
    return out


def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_columns(stages):
    for rows in stages[1:-1]:
        assert rows and all(r.__fields__ == COLUMNS for r in rows)


def test_language_keeps_prose(stages):
    kept = {r.doc_id for r in stages[1]}
    prose = {r.doc_id for r in stages[0] if sum(c.isalpha() for c in r.text) > 40}
    assert prose <= kept and set(stages[1]) <= set(stages[0])


def test_one_of_each_group_stays(stages):
    components = brute.jaccard(pairs(stages[1]), 5, 80)
    assert sorted(r.doc_id for r in stages[2]) == sorted({c for _, _, c in components})
    assert len(stages[2]) < len(stages[1]) and set(stages[2]) <= set(stages[1])


def test_contaminated_documents_go(spark, sf_small, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    clean = sorted(d for d, *_, hit in brute.decontaminate(pairs(stages[2]), items) if not hit)
    assert sorted(r.doc_id for r in stages[3]) == clean and len(stages[3]) < len(stages[2])


def test_personal_data_is_replaced(stages):
    from govlake.llm import pii

    old = {r.doc_id: r for r in stages[3]}
    assert len(stages[4]) == len(old)
    changed = 0
    for r in stages[4]:
        found = pii.entities(old[r.doc_id].text)
        changed += bool(found)
        assert bool(found) == (r.text != old[r.doc_id].text) and r.n_chars == len(r.text)
        assert not any(old[r.doc_id].text[a:b] in r.text for a, b, _, _ in found)
    assert changed


def test_packed_whole(stages):
    rows = stages[5]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == expected_pieces(pairs(stages[4]))
    assert check(rows) <= -(-sum(r.length for r in rows) // 2048) + 2


def test_run_is_the_chain(spark, sf_small, stages):
    got = cp.run(spark, sf_small).collect()
    key = lambda rows: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows)
    assert key(got) == key(stages[5])


def test_odd_rows_and_empty_tables(spark, sf_small, odd):
    rows = [(d, t, "en" if i % 2 else None, None, None) for i, (d, t) in enumerate(odd)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, SCHEMA)
        for _, f in cp.STAGES:
            out = f(spark, docs, sf_small)
            if f is not cp.packing:
                assert out.columns == COLUMNS
                docs = spark.createDataFrame(out.collect(), SCHEMA)
            else:
                out.collect()


def test_rejects_and_clashing_names(spark, sf_small):
    """Texts without a letter go; columns named like the stages' own come through untouched."""
    known = spark.read.parquet(f"{sf_small}/documents.parquet").where("text IS NOT NULL").limit(60).select(COLUMNS).collect()
    bad = [(-1, "1234 5678 -- 90", "en", "s", 15), (-2, "", "en", "s", 0), (-3, None, "en", "s", None), (-4, "\u2003 !? \n", None, None, 5)]
    extra = "lang_pred string, Score int, n_replaced string, __row string, __row_0 int"
    rows = [(*r, "p", i, "n", "r", i) for i, r in enumerate([*map(tuple, known), *bad])]
    docs = spark.createDataFrame(rows, f"{SCHEMA}, {extra}")
    want = {r[0]: tuple(r[5:]) for r in rows}
    names = docs.columns
    for name, f in cp.STAGES[:4]:
        out = f(spark, docs, sf_small)
        got = out.collect()
        assert out.columns == names and got and all(tuple(r)[5:] == want[r.doc_id] for r in got), name
        assert not {r.doc_id for r in got} & {-1, -2, -3, -4}
        docs = spark.createDataFrame(got, docs.schema)

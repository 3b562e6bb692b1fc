import brute
import pytest
from govlake.llm import decontamination as dec
from pyspark.sql import functions as F


def result(spark, tmp_path, docs, items):
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return sorted((tuple(r) for r in dec.op1_decontamination(spark, str(tmp_path)).collect()), key=repr)


def test_matches_brute_force(spark, sf_small, documents, tmp_path):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute.decontaminate(documents, items)
    assert any(r[-1] for r in expected)
    assert result(spark, tmp_path, documents, items) == expected


def test_odd_rows_and_short_items(spark, odd, tmp_path):
    items = [(1, None), (2, ""), (3, "..."), (4, "a"), (5, "WORD word"), (6, " ".join(f"w{i}" for i in range(40, 60))),
             (7, "w1-w2 w3"), (7, "Ünïcode TEXT"), (None, "w50 w51"), (9, "word " * 30), (9, "word " * 30)]
    docs = odd + [(20, "x W1, w2... w3 y"), (21, "ünïcode text"), (22, "Ünïcode text")]
    assert result(spark, tmp_path, docs, items) == brute.decontaminate(docs, items)


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty_tables(spark, tmp_path, empty):
    docs, items = ([], [(1, "a b")]) if empty == "docs" else ([(1, "a b")], [])
    assert result(spark, tmp_path, docs, items) == brute.decontaminate(docs, items)


def test_every_fingerprint_is_in_the_bitmap(spark):
    import numpy as np

    h = np.random.default_rng(1).integers(0, 2**63 - 1, 3000) * np.random.default_rng(2).choice([1, -1], 3000)
    windows = spark.createDataFrame([(int(x),) for x in h], "h long").withColumn("size", F.lit(10))
    bits, _ = dec.bitmap_of(spark, windows)
    assert dec.possible(bits, h.view(np.uint64)).all()
    others = np.random.default_rng(3).integers(0, 2**63 - 1, 3000).view(np.uint64)
    assert dec.possible(bits, others).mean() < 0.01


def test_clashing_column_names(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "q")], "doc_id long, text string, row long, h string")
    items = spark.createDataFrame([(1, "b", 7)], "item_id long, text string, size int")
    got, matches = dec.decontaminate(docs, items)
    assert [tuple(r)[1:] for r in matches.collect()] == [(1, 1, "1")]

import zlib

import numpy as np
from govlake.llm import language_id as lid


def test_held_out_accuracy(spark):
    out = lid.op6_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in out if r.held_out]
    assert len(out) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)
    sure = [r for r in held if r.score > 0.9]
    assert len(sure) > 0.8 * len(held)


def test_odd_rows(spark, odd):
    texts = {"de": "der hund und die katze sind im haus", "fr": "le chien et la chatte dans une maison"}
    rows = [(i, texts[k], k) for i in range(20) for k in texts] + [(100, texts["de"], None), (101, None, "de")]
    model = lid.fit(spark.createDataFrame(rows, "id long, text string, label string"))
    assert model.labels == ["de", "fr"] and 0 < (model.weights != 0).mean() < 0.2
    docs = [(d, t, 1.5) for d, t in odd] + [(60, "der hund", 1.0), (61, "LA CHATTE", 1.0), (62, "12 3!", 1.0), (63, "😀"[:0], 1.0)]
    out = lid.identify(spark.createDataFrame(docs, "doc_id long, text string, score double"), model).collect()
    got = {r.doc_id: r.lang_pred for r in out}
    assert len(out) == len(docs) and got[60] == "de" and got[61] == "fr" and got[62] == got[1] == got[2] == got[3] == "und"


def test_empty_table_and_no_labels(spark):
    schema = "id long, text string, label string"
    model = lid.fit(spark.createDataFrame([(1, "abc", None)], schema))
    out = lid.identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]
    assert lid.identify(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_every_letter_counts():
    assert len(lid.letters("1 2 ...")) == 0 and len(lid.letters("é")) == 3
    assert "".join(map(chr, lid.letters("A-b  c"))) == " a b c "
    used, counts = lid.features("ab ab")
    assert counts.sum() == 7 + 6 + 5
    assert "".join(map(chr, lid.letters("\U00030000\U00031350"))) == " \U00030000\U00031350 "


def test_more_languages_than_sampled_rows(spark):
    words = {f"l{k}": chr(0x4E00 + 9 * k) * 3 for k in range(12)}
    rows = [(i, w, k) for i in range(3) for k, w in words.items()]
    model = lid.fit(spark.createDataFrame(rows, "id long, text string, label string"), sample=5)
    assert model.labels == sorted(words)
    out = lid.identify(spark.createDataFrame([(w, k) for k, w in words.items()], "text string, truth string"), model).collect()
    assert all(r.lang_pred in words for r in out) and len({r.lang_pred for r in out}) > 1

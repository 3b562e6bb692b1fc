import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from govlake.llm import packing
from tokenizers import Tokenizer

TOK = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def expected_pieces(docs, capacity=2048):
    out = []
    for d, t in docs:
        ids = TOK.encode(t or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            out.append((d, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def check(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_documents_round_trip(spark, sf_small, documents):
    rows = packing.op3_best_fit_packing(spark, sf_small).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == expected_pieces(documents)
    least = -(-sum(r.length for r in rows) // 2048)
    assert check(rows) <= least + 2


def test_odd_rows(spark, odd):
    docs = odd + [(40, "<|endoftext|> a <|startoftext|>"), (41, "ΑΣ ΣΑΣ İI"), (42, "don't 'TIS it's...,. A.B, x,. Ü u v w"), (43, "日本語 テスト 12,5 ½")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, task int, length int").repartition(3)
    rows = packing.pack(df).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == expected_pieces(docs)
    check(rows)


def test_separators_that_are_no_white_space_keep_their_tokens(spark):
    docs = [(k, f"one{c}two {c} three{c}\u2003 End.{c}") for k, c in enumerate("\x1c\x1d\x1e\x1f\x85\xa0\v\u3000")]
    docs += [(20, "\x1f"), (21, "a \x1c\x1d\x1e\x1f\tb " * 700), (22, "x\x1cy <|endoftext|>")]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == expected_pieces(docs)
    check(rows)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_near_the_least(seed):
    rnd = random.Random(seed)
    spread = [lambda: rnd.randrange(1, 2049), lambda: min(2048, int(rnd.lognormvariate(6, 1)) + 1), lambda: rnd.choice([700, 690, 660, 1340, 5]),
              lambda: rnd.randrange(500, 1100), lambda: 683, lambda: rnd.randrange(1, 60)][seed]
    histogram = {}
    for _ in range(20000):
        n = spread()
        histogram[n] = histogram.get(n, 0) + 1
    out = packing.plan(histogram)
    load, count = {}, {}
    for length, first, k, seq, offset in out.placed:
        count.setdefault(length, []).append((first, k))
        for s in range(seq, seq + k):
            load.setdefault(s, []).append((offset, length))
    for n, spans in count.items():
        at = 0
        for first, k in sorted(spans):
            assert first == at
            at += k
        assert at == histogram[n]
    for parts in load.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(load) == list(range(out.sequences))
    least = -(-sum(n * k for n, k in histogram.items()) // 2048)
    # lengths of 683 fit only twice; others with few sizes or no small ones leave room by necessity
    bound = {2: 1.04, 3: 1.05, 4: 1.5}.get(seed, 1.01)
    assert out.sequences <= least * bound + 2, (out.sequences, least)

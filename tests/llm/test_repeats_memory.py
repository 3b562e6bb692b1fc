"""What a task of the window search holds doesn't grow with its keys, and a chunk's hashes not with 50 times its text."""

import base64
import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from govlake.llm import common, repeats
from govlake.llm.substring_dedup import Words
from govlake.session import checkpoint_dir

FIELDS = [("h", pa.int64()), ("x", pa.int64()), ("id", pa.int64()), ("chunk", pa.int64()), ("place", pa.int32()), ("many", pa.bool_())]


class Keys:
    """Stands for the keys of one partition: gives the function that a task runs over them."""

    def repartition(self, *_):
        return self

    sortWithinPartitions = drop = repartition

    def mapInArrow(self, task, schema):  # noqa: N802
        return task


def batch(columns):
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, FIELDS)], names=[n for n, _ in FIELDS])


def decisions_of(found):
    out = []
    for b in found:
        for chunk, places, codes in zip(*(b.column(c).to_pylist() for c in ("chunk", "places", "codes"))):
            out += zip(itertools.repeat(chunk), np.frombuffer(places, "<i4").tolist(), codes)
    return out


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("earlier", [False, True])
def test_a_task_holds_few_of_its_keys(earlier, whole):
    """A million keys with one hash: runs of one common passage, two of each text."""
    start, most, size, n = pa.total_allocated_bytes(), 0, 10_000, 100
    task = repeats.decide(Keys(), 1, earlier, whole)

    def batches():
        nonlocal most
        for k in range(n):
            most = max(most, pa.total_allocated_bytes() - start)
            at = np.arange(k * size, (k + 1) * size)
            yield batch([np.full(size, 7), at // 2, at, at % 1000, at // 1000, np.zeros(size, bool)])

    tracemalloc.start()
    try:
        count = sum(len(c) for b in task(batches()) for c in b.column("codes").to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert count == (n * size // 2 if earlier and whole else n * size)
    assert most < 8e6 and peak < 60e6


def test_decisions_do_not_depend_on_batches():
    """Sorted keys cut anywhere, against a plain version."""
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(14)
        keys = sorted((rng.randrange(3), rng.randrange(3), rng.randrange(3), c, rng.randrange(1000), rng.random() < 0.3) for c in range(n))
        cuts = sorted(rng.randrange(n + 1) for _ in range(rng.randrange(6)))
        parts = [batch(zip(*keys[a:b]) if a < b else [[]] * 6) for a, b in itertools.pairwise([0, *cuts, n])]
        for earlier, whole in itertools.product((False, True), (False, True)):
            wanted = []
            for k, (h, x, _, chunk, place, many) in enumerate(keys):
                equal = [i for i, y in enumerate(keys) if y[:2] == (h, x)]
                mark = k != equal[0] if earlier else len(equal) > 1 or many
                opened = not whole and k == equal[0] and len({y[1] for y in keys if y[0] == h}) > 1
                if mark or opened:
                    wanted.append((chunk, place, repeats.MARK * mark + repeats.OPEN * opened))
            assert sorted(decisions_of(repeats.decide(Keys(), 1, earlier, whole)(iter(parts)))) == sorted(wanted)


def test_word_hashes_by_blocks():
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefgh  \n", k=400_000)) for _ in range(5)] + ["é" * 300_000 + " x", "", None, " "]
    words = Words(pa.array(texts, pa.string()))
    tracemalloc.start()
    try:
        units = words.units()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(words.buf) > 2_600_000 and peak < 60e6
    for k, hashes in enumerate((units.first, units.second)):
        assert np.array_equal(hashes, common.word_hashes(words.buf, words.first, words.past, k))
    assert len(Words(pa.array([None, " "], pa.string())).units().first) == 0


def test_chunks_are_read_a_few_at_a_time(spark):
    rng = random.Random(7)
    docs = [(k, base64.b64encode(rng.randbytes(1_200_000)).decode()) for k in range(20)]
    chunks = common.chunked(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    assert sorted(i for r in chunks.select("ids").collect() for i in r.ids) == list(range(20)) and checkpoint_dir(spark)
    groups = []
    for path in chunks.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:").replace("///", "/")).metadata
        groups += [meta.row_group(k).num_rows for k in range(meta.num_row_groups)]
    assert sum(groups) == 10 and max(groups) <= 8

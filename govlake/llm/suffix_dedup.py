"""Suffix-array dedup (7): bytes covered by a long string that also starts earlier are removed.

The method dealt, prefix doubling with a Spark sort of position ranks at growing
offsets, is not used here; the search is ``govlake.llm.repeats``'s over bytes. Of
each ``length // 2``-byte window the position with the smallest hash is a seed:
equal windows keep the same one, so a window none of whose seeds repeats is
unique, and one row stands for about 26 positions. Seeds are dealt by hash and
sorted in each task; windows of ``length`` bytes around repeated seeds are then
compared by 128-bit hashes, equal stretches once. It finds the strings that the
doubling would.

A null text is empty. Texts are UTF-8 bytes; matches never cross documents.
"Earlier" is a smaller id (null is the smallest), on equal ids input order,
then an earlier start in the same text. Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from govlake.llm import repeats
from govlake.llm.common import BYTE_CODES, buffer_of, chunked, table
from govlake.llm.substring_dedup import covered, runs_of

LENGTH = 100
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<begin:int,end:int>>"
DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def byte_units(texts: pa.Array) -> repeats.Units:
    buf, begin, end = buffer_of(texts)
    return repeats.Units(BYTE_CODES[0][buf], BYTE_CODES[1][buf], begin, end)


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, digest: bool = False
) -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs (in bytes) and the remaining bytes."""
    half = max(1, length // 2)
    decided, marked = repeats.find(chunked(docs, id_col, text_col), byte_units, length, half, earlier=True)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                texts = repeats.list_of(batch, "texts", k)
                flags = covered(marked(batch, k, repeats.Runs(byte_units(texts), length, half)), length)
                yield rows(repeats.list_of(batch, "ids", k), texts, flags, digest)

    return decided.mapInArrow(finish, DIGEST if digest else SCHEMA)


def rows(ids: pa.Array, texts: pa.Array, flags: np.ndarray, digest: bool) -> pa.RecordBatch:
    buf, begin, end = buffer_of(texts)
    removed, spans, kept = [], [], []
    for a, b in zip(begin, end, strict=True):
        gone = flags[a:b]
        x, y = runs_of(gone)
        removed.append(int((y - x).sum()))
        spans.append([{"begin": int(i), "end": int(j)} for i, j in zip(x, y, strict=True)])
        kept.append(buf[a:b][~gone].tobytes() if len(x) else buf[a:b].tobytes())
    columns = [ids, pa.array(end - begin, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(x) for x in spans], pa.int64())]
    if digest:
        columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    columns += [pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), digest=True)

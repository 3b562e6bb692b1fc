"""Shared helpers: stored intermediate tables, chunked texts and unit hashes.

Intermediate results are written as Parquet under ``spark.checkpoint.dir`` and
read back, which cuts lineage and survives lost executors: a lost task is
recomputed from stored rows, whose ids are data and never change.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.session import checkpoint_dir

U64 = np.uint64
#: UTF-8 text per chunk row; a longer document is a chunk of its own.
CHUNK_BYTES = 2_000_000
#: Parquet looks at sizes every 100 rows, which may be 200 MB of chunks; a batch of the reader ends with its row group.
CHUNK_FILES = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
CHUNK_SCHEMA = "chunk long, ids array<long>, texts array<string>, nulls array<boolean>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back; ``options`` are the writer's."""
    spark, schema = df.sparkSession, df.schema
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the context cleaner drop the shuffle files of stored steps before a step that needs room.

    Plans are let go of in two turns: Python's references reach the JVM with a
    delay of about a second, and only then can it collect them.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(1.2)
        spark.sparkContext._jvm.System.gc()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, wherever it was imported from."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="govlake-code-")) / "govlake.zip"  # on the driver; Spark sends it on
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; extra columns cannot clash."""
    ship(df.sparkSession)
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------------ chunks
def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored rows of about ``CHUNK_BYTES`` of text: chunk id and aligned arrays.

    Every input row is in exactly one chunk, repeated rows included; within a
    chunk rows are in order of (id, input order), null ids first. A null text
    is kept as empty and marked.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 16, 0
        held, size = [], 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            lengths = text_lengths(texts)
            begin = 0
            for end in cuts(lengths, size, CHUNK_BYTES):
                held.append((ids.slice(begin, end - begin), texts.slice(begin, end - begin)))
                yield chunk_row(base + count, held)
                held, size, begin, count = [], 0, end, count + 1
            if begin < len(ids):
                held.append((ids.slice(begin), texts.slice(begin)))
                size += int(lengths[begin:].sum())
        if held:
            yield chunk_row(base + count, held)

    frame = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long"), "text")
    return stored(frame.mapInArrow(build, CHUNK_SCHEMA), "chunks", **CHUNK_FILES)


def text_lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def cuts(lengths: np.ndarray, size: int, limit: int) -> list[int]:
    """Row numbers after which a chunk is full."""
    out, total = [], size
    for k, n in enumerate(lengths.tolist(), 1):
        total += n + 64  # a row counts besides its text, so empty texts end a chunk too
        if total >= limit:
            out.append(k)
            total = 0
    return out


def chunk_row(chunk: int, held: list) -> pa.RecordBatch:
    ids = pa.concat_arrays([x for x, _ in held])
    texts = pa.concat_arrays([x for _, x in held])
    order = pa.array(np.argsort(sort_ids(ids), kind="stable"))
    ids, texts = ids.take(order), texts.take(order)
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), one(ids), one(texts.fill_null("")), one(texts.is_null())],
        names=["chunk", "ids", "texts", "nulls"],
    )


def sort_ids(ids: pa.Array) -> np.ndarray:
    """Ids as int64 with null as the smallest value."""
    return ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, a 0x0A after each, and each text's first and past-the-end byte."""
    texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    buf = np.insert(raw, offsets[1:], 10)
    begin = offsets[:-1] + np.arange(len(texts))
    return buf, begin, begin + np.diff(offsets)


# ------------------------------------------------------------------ unit hashes
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODES = tuple(_rng.integers(1, 2**64 - 1, 256, dtype=U64) | U64(1) for _ in BASES)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            steps = np.full(size, b, U64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        if size > 1 << 24:
            return out[0], out[1]
        _powers[which] = have = (out[0], out[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0x9FB21C651E98DF25)
    x ^= x >> U64(32)
    return x


class Rolling:
    """Rabin-Karp prefix sums: the hash of any span of units in constant time."""

    def __init__(self, units: np.ndarray, which: int):
        n = len(units)
        p, self.inverse = powers(which, n + 1)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(units * p[:n], out=self.sums[1:])

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.inverse[begin]

    def windows(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.inverse[:n] if n > 0 else np.zeros(0, U64)


def byte_class(chars: str) -> np.ndarray:
    """Which byte values belong to a word, for a set written as ranges of ASCII separators."""
    out = np.ones(256, bool)
    for a, b in (x.split("-") for x in chars.split()):
        out[int(a, 16) : int(b, 16) + 1] = False
    return out


#: ``[^\x20\x09-\x0D]+`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``; bytes of non-ASCII characters are all 80 or above.
SPACED = byte_class("20-20 09-0D")
ALNUM = byte_class("00-2F 3A-60 7B-7F")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word."""
    mask = in_word[buf]
    edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    return edge[0::2], edge[1::2]


def word_hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    return mix(Rolling(BYTE_CODES[which][buf], which).spans(begin, end) + (end - begin).astype(U64))


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, by block prefixes and suffixes."""
    n = len(keys) - width + 1
    if n <= 0:
        return keys[:0]
    if width == 1:
        return keys
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` consecutive k-gram hashes the place of the smallest, leftmost on ties.

    The place is packed into the low bits, so equal stretches of text choose
    the same relative place whatever surrounds them.
    """
    bits = max(1, int(len(hashes)).bit_length())
    low = U64((1 << bits) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=U64)
    return (sliding_min(keys, width) & low).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

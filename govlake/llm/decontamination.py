"""Benchmark decontamination (1): winnowed fingerprints, joined and extended to exact windows.

Winnowing keeps, of every ``window - gram + 1`` consecutive ``gram``-word
hashes, the smallest (leftmost on ties). A shared span of ``window`` words has
the same hashes in a document and in an item, so both keep the same one: every
span that long is found. Kept document fingerprints are joined with those of
the items; hits are extended to the ``window``-word texts around them, which
are compared as text, so a hash collision cannot mark a clean document. Items
of fewer words are one window, found through the fingerprints of all
item-length grams that begin a document word.

Only fingerprints that can meet an item leave the scan: a bitmap of the items'
fingerprints, of fixed size (``FILTER_BITS``; larger benchmarks make it less
selective, never wrong), is sent to the tasks. Documents are read once.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
Null or empty texts have no words and no windows. Repeated rows are separate
documents; rows of an item id are separate passages of that item. Null ids are
kept as null; a null item id counts as the item ''. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from govlake.llm.common import (
    ALNUM,
    LOWER,
    U64,
    Rolling,
    buffer_of,
    minimizers,
    mix,
    pick,
    signed,
    stored,
    table,
    word_hashes,
    word_spans,
)

WINDOW = 10
GRAM = 5
FILTER_BITS = 1 << 22
DOC_SCHEMA = "row long, doc_id long, n_words long, hits array<struct<h:long,begin:int,size:int,words:string>>"
ITEM_SCHEMA = "item_id string, h long, size int, words string"


class Text:
    """The words of a batch of texts, lower-cased, with their hashes."""

    def __init__(self, texts: pa.Array):
        raw, begin, end = buffer_of(texts)
        self.buf = LOWER[raw]
        self.first, self.past = word_spans(self.buf, ALNUM)
        self.begin = np.searchsorted(self.first, begin)
        self.end = np.searchsorted(self.first, end)
        self.rolling = Rolling(word_hashes(self.buf, self.first, self.past, 0), 0)
        self.spaced = np.where(ALNUM[self.buf], self.buf, np.uint8(32)).tobytes()

    def words(self, a: int, size: int) -> str:
        return " ".join(x for x in self.spaced[self.first[a] : self.past[a + size - 1]].decode().split(" ") if x)

    def grams(self, size: int) -> np.ndarray:
        return mix(self.rolling.windows(size) + U64(size))

    def inside(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Of sorted word numbers, those whose span of ``size`` words is within one text."""
        doc = np.searchsorted(self.begin, starts, "right") - 1
        return starts[starts + size <= self.end[doc]]


def item_windows(items: DataFrame, window: int, gram: int) -> DataFrame:
    """Every window of every item, with the fingerprint that stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                t = Text(batch.column(1).slice(k, 1))
                n = len(t.first)
                if n == 0:
                    continue
                size = min(n, window)
                if n >= window:
                    grams = t.grams(gram)
                    h = grams[minimizers(grams, window - gram + 1)]
                else:
                    h = t.grams(n)
                words = [t.words(a, size) for a in range(n - size + 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[k].as_py()] * len(words), pa.string()),
                        pa.array(signed(h)),
                        pa.array([size] * len(words), pa.int32()),
                        pa.array(words, pa.string()),
                    ],
                    names=["item_id", "h", "size", "words"],
                )

    return items.mapInArrow(run, ITEM_SCHEMA).distinct()


def bitmap_of(spark: SparkSession, windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A bitmap of the items' fingerprints, ``FILTER_BITS`` long whatever their number, and the short sizes."""
    bits = (
        windows.select((F.pmod("h", F.lit(FILTER_BITS)) + 1).alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in bits:  # buckets and bits count from 1
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["bucket"] - 1) * len(part) : r["bucket"] * len(part)] = part
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most ``window`` values
    return out, sizes


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> tuple[DataFrame, DataFrame]:
    """Documents (row, doc_id, n_words) and their matches (row, begin, size, item_id).

    A match is an occurrence of an item window at word ``begin`` of the
    document. ``row`` numbers the stored input rows.
    """
    spark = docs.sparkSession
    frame = pick(items, item_id=item_id_col, text=item_text_col)
    frame = frame.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    windows = stored(item_windows(frame, window, gram), "item-windows")
    bits, sizes = bitmap_of(spark, windows)
    sent = spark.sparkContext.broadcast(bits)
    short = [s for s in sizes if s < window]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, row = sent.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                yield scan_rows(part, row, filled, short, window, gram)
                row += part.num_rows

    frame = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long"), "text")
    scanned = stored(frame.mapInArrow(scan, DOC_SCHEMA), "document-hits")
    hits = scanned.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    found = hits.join(windows, ["h", "size", "words"]).select("row", "begin", "size", "item_id")
    return scanned.select("row", "doc_id", "n_words"), found


def possible(filled: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h % U64(FILTER_BITS)
    return (filled[bit >> U64(3)] >> (bit & U64(7)).astype(np.uint8)) & 1 > 0


def scan_rows(part: pa.RecordBatch, row: int, filled, short: list[int], window: int, gram: int) -> pa.RecordBatch:
    t = Text(part.column(1))
    found: list[tuple[int, int, int]] = []  # begin, size, fingerprint
    n = len(t.first)
    if n >= window:
        grams = t.grams(gram)
        chosen = minimizers(grams, window - gram + 1)
        starts = t.inside(np.arange(len(chosen)), window)
        at = chosen[starts]
        ok = possible(filled, grams[at])
        starts, h = starts[ok], grams[at[ok]]
        found += [(int(s), window, int(x)) for s, x in zip(starts, signed(h), strict=True)]
    for size in short:
        if n >= size:
            grams = t.grams(size)
            starts = t.inside(np.flatnonzero(possible(filled, grams)), size)
            found += [(int(s), size, int(x)) for s, x in zip(starts, signed(grams[starts]), strict=True)]
    hits: list[list[dict]] = [[] for _ in range(part.num_rows)]
    if found:
        owner = np.searchsorted(t.begin, np.array([s for s, _, _ in found]), "right") - 1
        for d, (s, size, h) in zip(owner, found, strict=True):
            hits[d].append({"h": h, "begin": s - int(t.begin[d]), "size": size, "words": t.words(s, size)})
    kind = pa.list_(pa.struct([("h", pa.int64()), ("begin", pa.int32()), ("size", pa.int32()), ("words", pa.string())]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(row, row + part.num_rows)),
            part.column(0),
            pa.array(t.end - t.begin, pa.int64()),
            pa.array(hits, kind),
        ],
        names=["row", "doc_id", "n_words", "hits"],
    )


def hit_words(matches: DataFrame) -> DataFrame:
    """Per row the number of words inside any match: matches are merged from left to right."""
    ends = matches.groupBy("row", "begin").agg(F.max(F.col("begin") + F.col("size")).alias("stop"))
    before = W.partitionBy("row").orderBy("begin").rowsBetween(W.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("begin", F.coalesce(F.max("stop").over(before), F.lit(0))))
    return ends.withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, matches = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    matches = stored(matches, "matches")
    listed = (
        matches.select("row", "item_id")
        .distinct()
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("item_id"))).alias("items"))
    )
    return (
        docs.join(hit_words(matches), "row", "left")
        .join(listed, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), it AS (
  SELECT DISTINCT id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM it
), dw AS (
  SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)
), hit AS (SELECT DISTINCT dw.row, dw.i, dw.n, it.id FROM dw JOIN it ON dw.n = it.n AND dw.g = it.g
), words AS (SELECT row, count(DISTINCT i + k) AS n FROM hit, (SELECT unnest(range(10)) AS k) WHERE k < n GROUP BY row
), items AS (SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, id FROM hit) GROUP BY row)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row) LEFT JOIN items USING (row)
"""

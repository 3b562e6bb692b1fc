"""Substring dedup (5): repeated fixed-length word windows merged into removal intervals.

Rabin-Karp hashes are taken of every ``window``-word window; those that start
more than once anywhere in the corpus (the same document included) are marked,
and each document's marked windows merge into maximal removal intervals.
``govlake.llm.repeats`` compares the windows in Spark: a window is compared
only if its seed (its smallest k-gram) repeats, which every repeated window's
does, so all windows are covered and only undecided ones are shuffled.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A null or empty text, and a text
of fewer than ``window`` words, has nothing removed. Repeated rows are separate
documents, so their windows repeat. Null ids are kept as null. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from govlake.llm import repeats
from govlake.llm.common import SPACED, buffer_of, chunked, table, word_hashes, word_spans

WINDOW = 35
#: Bytes of text hashed at once; a word that begins in a block belongs to it as a whole.
BLOCK = 1 << 18
SCHEMA = "doc_id long, n_words long, n_removed long, n_spans long, kept string, spans array<struct<begin:int,end:int>>"
DIGEST = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string"


def word_units(texts: pa.Array) -> repeats.Units:
    return Words(texts).units()


class Words:
    def __init__(self, texts: pa.Array):
        self.buf, begin, end = buffer_of(texts)
        self.first, self.past = word_spans(self.buf, SPACED)
        self.begin = np.searchsorted(self.first, begin)
        self.end = np.searchsorted(self.first, end)

    def units(self) -> repeats.Units:
        """Hashes of the words, by blocks of words, as a hash takes about 50 bytes a byte of text meanwhile."""
        one, two = (np.empty(len(self.first), np.uint64) for _ in range(2))
        edges = np.unique(np.searchsorted(self.first, np.arange(0, len(self.buf) + BLOCK, BLOCK)))
        for a, b in pairwise(edges.tolist()):
            lo, hi = self.first[a], self.past[b - 1]
            for k, out in enumerate((one, two)):
                out[a:b] = word_hashes(self.buf[lo:hi], self.first[a:b] - lo, self.past[a:b] - lo, k)
        return repeats.Units(one, two, self.begin, self.end)


def covered(starts: np.ndarray, width: int) -> np.ndarray:
    """Units covered by a marked window."""
    edge = np.zeros(len(starts) + width + 1, np.int32)
    edge[: len(starts)] += starts
    edge[width : width + len(starts)] -= starts
    return np.cumsum(edge)[: len(starts)] > 0


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(flags, prepend=False, append=False))
    return edge[0::2], edge[1::2]


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False
) -> DataFrame:
    """Per document: words, removed words, removal intervals (in words) and the kept text.

    Kept words are joined by one space. With ``digest`` the kept text is
    replaced by its SHA-256 and the intervals by their number.
    """
    seed = (window + 1) // 2
    decided, marked = repeats.find(chunked(docs, id_col, text_col), word_units, window, seed, earlier=False)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words = Words(repeats.list_of(batch, "texts", k))
                flags = covered(marked(batch, k, repeats.Runs(words.units(), window, seed)), window)
                yield rows(repeats.list_of(batch, "ids", k), words, flags, digest)

    return decided.mapInArrow(finish, DIGEST if digest else SCHEMA)


def rows(ids: pa.Array, words: Words, flags: np.ndarray, digest: bool) -> pa.RecordBatch:
    keep = ~flags
    edge = np.zeros(len(words.buf) + 1, np.int8)
    edge[words.first[keep]] += 1
    edge[words.past[keep] + 1] -= 1  # with the byte behind each word, which becomes a space
    spaced = np.where(SPACED[words.buf], words.buf, np.uint8(32))
    mask = np.cumsum(edge, dtype=np.int8)[:-1] > 0
    text = spaced[mask].tobytes()
    sizes = np.concatenate(([0], np.cumsum(np.where(keep, words.past - words.first + 1, 0))))
    removed = np.concatenate(([0], np.cumsum(flags)))
    n_words, n_removed = words.end - words.begin, removed[words.end] - removed[words.begin]
    kept = [text[a : max(a, b - 1)] for a, b in zip(sizes[words.begin], sizes[words.end], strict=True)]
    # an interval ends with its document
    spans = []
    for a, b in zip(words.begin, words.end, strict=True):
        x, y = runs_of(flags[a:b]) if removed[b] > removed[a] else ((), ())
        spans.append([{"begin": int(i), "end": int(j)} for i, j in zip(x, y, strict=True)])
    counts = pa.array([len(x) for x in spans], pa.int64())
    columns = [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), counts]
    if digest:
        columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256"])
    columns += [
        pa.array([x.decode() for x in kept], pa.string()),
        pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "n_spans", "kept", "spans"])


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), digest=True)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT row, i, array_to_string(w[i:i + 34], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 33)) AS i)
), again AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1
), gone AS (SELECT DISTINCT row, i + k AS i FROM again, (SELECT unnest(range(35)) AS k)
), words AS (SELECT row, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM d
), kept AS (SELECT words.row, string_agg(x, ' ' ORDER BY words.i) AS t FROM words ANTI JOIN gone ON words.row = gone.row AND words.i = gone.i GROUP BY words.row
), removed AS (SELECT row, count(*) AS n, count(*) FILTER (first) AS spans
               FROM (SELECT row, i, coalesce(lag(i) OVER (PARTITION BY row ORDER BY i) < i - 1, TRUE) AS first FROM gone) GROUP BY row)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(removed.n, 0)::BIGINT AS n_removed, coalesce(removed.spans, 0)::BIGINT AS n_spans,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (row) LEFT JOIN kept USING (row)
"""

"""Periodic run detection (13): stretches of words that repeat with a period, and texts without the repetition.

A dictionary of basic factors is kept per chunk of documents: for each power of
two m, equal stretches of m words of one document have one name, made of the
names of their halves; only stretches that occur again go on to the next m. The
occurrences of a name, in order, form arithmetic progressions: neighbours at a
distance of m/2 at most lie at the factor's own period, so a progression is one
group and its step is proposed. Beyond that, each occurrence proposes its
distance to the first occurrence of the groups that lie within twice m of it.

No run is lost. Let a run begin at s with smallest period q and m <= q < 2m, u
its first m words; u occurs at s + q. If both lie in one progression, q is its
step. If not, one of them begins its progression: else u's period d would give
the word before s equal to the one q after it, and the run would begin earlier.

Proposals of neighbouring places with one period are one; each is extended both
ways by Rabin-Karp hashes and binary search, and every run is then compared word
by word, so a hash collision cannot show in the result (that document's periods
are then tried one by one). Of proposals with one extent the smallest period
stays.

One pass over the documents, no shuffle. Words are ``[^\\x20\\x09-\\x0D]+``. A
null or empty text has no words and no runs. Repeated rows are separate
documents. Null ids are kept; extra columns are ignored; an empty table gives an
empty result. A very long text is a chunk of its own: its task needs a few
arrays as long as its words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.llm.common import CHUNK_BYTES, SPACED, Rolling, buffer_of, cuts, pick, table, text_lengths, word_hashes, word_spans

LEAST = 12
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)
#: (doc_id, words) -> the original word number of each word, or None for the text as it is.
Order = Callable[[int | None, int], np.ndarray | None]


def level_names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys that occur twice or more, sorted by key and place, and a name for each."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.append(True, sorted_keys[1:] != sorted_keys[:-1])
    again = ~new | ~np.append(new[1:], True)
    return order[again], np.cumsum(new)[again]


def proposals(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) over one sequence of word names; names are never shared by documents."""
    n = len(words)
    at, period = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if n == 0:
        return at[0], period[0]
    places, names = level_names(words)
    m = 1
    while len(places):
        for i, p in steps(places, names, m):
            at.append(i)
            period.append(p)
        # the next level: both halves occur again
        name = np.full(n + m, -1, np.int64)
        name[places] = names
        left = np.flatnonzero((name[:n] >= 0) & (name[m : n + m] >= 0))
        del places, names
        if not len(left):
            break
        some, names = level_names(name[left] * (n + 1) + name[left + m])
        places, m = left[some], 2 * m
    return np.concatenate(at), np.concatenate(period)


def steps(places: np.ndarray, names: np.ndarray, m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Periods that one level proposes."""
    same = names[1:] == names[:-1]
    gap = places[1:] - places[:-1]
    inside = same & (2 * gap <= m)
    here = np.flatnonzero(inside)
    yield places[here], gap[here]
    group = np.concatenate(([0], np.cumsum(~inside)))
    first = np.flatnonzero(np.concatenate(([True], ~inside)))  # the first occurrence of each group
    lead, lead_name = places[first], names[first]
    for r in (1, 2, 3):  # gaps between groups are over m/2, so a fourth is out of reach
        later = group + r
        ok = np.flatnonzero(later < len(first))
        ok = ok[lead_name[later[ok]] == names[ok]]
        p = lead[later[ok]] - places[ok]
        near = p < 2 * m
        yield places[ok][near], p[near]
        earlier = group - r
        ok = np.flatnonzero(earlier >= 0)
        ok = ok[lead_name[earlier[ok]] == names[ok]]
        p = places[ok] - lead[earlier[ok]]
        near = p < 2 * m
        yield lead[earlier[ok]][near], p[near]


def extent(same: Callable[[np.ndarray], np.ndarray], most: np.ndarray) -> np.ndarray:
    """The largest length up to ``most`` for which ``same`` holds; it holds for all shorter ones too."""
    low, high = np.zeros_like(most), most.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) >> 1
        good = same(middle)
        low = np.where(open_ & good, middle, low)
        high = np.where(open_ & ~good, middle - 1, high)


def runs_of_words(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, in order; starts count from the document's first word."""
    n_docs, total = len(begin), int(end[-1]) if len(end) else 0
    doc = np.repeat(np.arange(n_docs), end - begin)
    # names of (document, word), numbered from 0
    names = np.unique(hashes[:total], return_inverse=True)[1].astype(np.int64)
    names = np.unique(doc * (int(names.max(initial=0)) + 1) + names, return_inverse=True)[1].astype(np.int64)
    at, period = proposals(names)
    none = np.zeros((0, 4), np.int64)
    if not len(at):
        return none
    # neighbouring places with one period lie in one run
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.append(True, (period[1:] != period[:-1]) | (at[1:] - at[:-1] > 1) | (doc[at[1:]] != doc[at[:-1]]))
    at, period = at[new], period[new]
    ends = end[doc[at]]
    inside = at + period < ends
    at, period, ends = at[inside], period[inside], ends[inside]
    begins = begin[doc[at]]
    rolling = Rolling(hashes[:total], 0)
    equal = lambda a, b, size: rolling.spans(a, a + size) == rolling.spans(b, b + size)
    right = extent(lambda x: equal(at, at + period, x), ends - at - period)
    left = extent(lambda x: equal(at - x, at + period - x, x), at - begins)
    start, length = at - left, left + right + period
    long = length >= np.maximum(least, 2 * period)
    found = np.stack([doc[at], start, length, period], axis=1)[long]
    if not len(found):
        return none
    order = np.lexsort((found[:, 3], found[:, 2], found[:, 1]))
    found = found[order]
    found = found[np.append(True, (found[1:, 1:3] != found[:-1, 1:3]).any(axis=1))]
    wrong = {int(d) for d, s, size, p in found if not (names[s : s + size - p] == names[s + p : s + size]).all()}
    if wrong:
        found = found[~np.isin(found[:, 0], list(wrong))]
        again = [run for d in sorted(wrong) for run in plain_runs(names, int(begin[d]), int(end[d]), d, least)]
        found = np.concatenate([found, np.array(again, np.int64).reshape(-1, 4)])
    found[:, 1] -= begin[found[:, 0]]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def plain_runs(names: np.ndarray, a: int, b: int, doc: int, least: int) -> list[tuple[int, int, int, int]]:
    """The runs of one document by trying every period."""
    seen: dict[tuple[int, int], int] = {}
    for p in range(1, (b - a) // 2 + 1):
        same = names[a : b - p] == names[a + p : b]
        edge = np.flatnonzero(np.diff(same, prepend=False, append=False))
        for s, e in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - s + p >= max(least, 2 * p):
                seen.setdefault((a + s, e - s + p), p)
    return [(doc, s, size, p) for (s, size), p in seen.items()]


def covered(runs: np.ndarray, begin: np.ndarray, total: int) -> np.ndarray:
    """Words in some run after its first period."""
    edge = np.zeros(total + 1, np.int32)
    first = begin[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, first + runs[:, 3], 1)
    np.add.at(edge, first + runs[:, 2], -1)
    return np.cumsum(edge)[:total] > 0


class Chunk:
    """The words of some documents, in the order that ``order`` gives them."""

    def __init__(self, ids: pa.Array, texts: pa.Array, order: Order | None):
        self.ids = ids
        self.buf, first, last = buffer_of(texts)
        self.first, self.past = word_spans(self.buf, SPACED)
        self.begin, self.end = np.searchsorted(self.first, first), np.searchsorted(self.first, last)
        self.hashes = word_hashes(self.buf, self.first, self.past, 0)
        self.sizes = self.past - self.first + 1  # as the text has them, with the space behind each
        self.moved = np.zeros(len(ids), bool)
        if order is not None:
            for k, (i, a, b) in enumerate(zip(ids.to_pylist(), self.begin.tolist(), self.end.tolist(), strict=True)):
                new = order(i, b - a)
                if new is not None:
                    self.moved[k] = True
                    for x in (self.hashes, self.first, self.past):
                        x[a:b] = x[a:b][new]

    def texts(self, gone: np.ndarray) -> list[bytes]:
        """Per document the words that stay, joined by one space."""
        raw, out = self.buf.tobytes(), []
        whole = self.texts_as_they_are()
        lost = np.concatenate(([0], np.cumsum(gone)))
        for k, (a, b) in enumerate(zip(self.begin.tolist(), self.end.tolist(), strict=True)):
            if not self.moved[k] and lost[a] == lost[b]:
                out.append(whole[k])
                continue
            stay = a + np.flatnonzero(~gone[a:b])
            out.append(b" ".join([raw[x:y] for x, y in zip(self.first[stay].tolist(), self.past[stay].tolist(), strict=True)]))
        return out

    def texts_as_they_are(self) -> list[bytes]:
        in_word = SPACED[self.buf]
        keep = in_word.copy()
        keep[1:] |= in_word[:-1]  # a word and one space behind it
        text = np.where(in_word, self.buf, np.uint8(32))[keep].tobytes()
        at = np.concatenate(([0], np.cumsum(self.sizes)))
        return [text[x : max(x, y - 1)] for x, y in zip(at[self.begin].tolist(), at[self.end].tolist(), strict=True)]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    order: Order | None = None,
    digest: bool = False,
) -> DataFrame:
    """Per document its runs of at least ``least`` words and two periods, and the text with one period of each.

    ``order`` may rearrange a document's words first. With ``digest`` the runs
    are given by their number, the longest one and hashes.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = sorted({*cuts(text_lengths(batch.column(1)), 0, CHUNK_BYTES), batch.num_rows})
            for a, b in zip([0, *ends], ends, strict=False):
                if b > a:
                    yield answer(Chunk(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), order), least, digest)

    frame = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long"), F.col("text").cast("string"))
    return frame.mapInArrow(build, DIGEST if digest else SCHEMA)


def answer(chunk: Chunk, least: int, digest: bool) -> pa.RecordBatch:
    runs = runs_of_words(chunk.hashes, chunk.begin, chunk.end, least)
    texts = chunk.texts(covered(runs, chunk.begin, len(chunk.first)))
    cut = np.searchsorted(runs[:, 0], np.arange(len(chunk.ids) + 1)).tolist()
    each = [runs[a:b, 1:].tolist() for a, b in zip(cut, cut[1:], strict=False)]
    if not digest:
        named = [[{"start": s, "length": n, "period": p} for s, n, p in x] for x in each]
        words = pa.array(chunk.end - chunk.begin, pa.int64())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        columns = [chunk.ids, words, pa.array(named, kind), pa.array([x.decode() for x in texts], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "text"])
    best = [min(x, key=lambda r: (-r[1], r[0], r[2])) if x else (None, None, None) for x in each]
    sha = lambda x: hashlib.sha256(x).hexdigest()
    columns = [
        chunk.ids,
        pa.array([len(x) for x in each], pa.int64()),
        *[pa.array([x[k] for x in best], pa.int64()) for k in range(3)],
        pa.array([None if n is None else 1000 * n // p for _, n, p in best], pa.int64()),
        pa.array([sha("".join(f"{s},{n},{p}\n" for s, n, p in x).encode()) for x in each], pa.string()),
        pa.array([sha(x) for x in texts], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in DIGEST.split(", ")])


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The query's rewriting: in a tenth of the documents, words from a place on repeat with a period."""
    if doc_id is None or n == 0:
        return None
    g, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), order=repeated_tail, digest=True)

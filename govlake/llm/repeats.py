"""Windows of fixed length that occur more than once, over any sequence of hashed units.

Shared by substring dedup over words (op5) and suffix dedup over bytes (op7).
Windows of ``width`` units are compared in three steps, each a Spark shuffle
by hash, each on only what the step before left undecided:

1. *Seeds.* Every window contains ``width - seed + 1`` k-grams of ``seed``
   units; the smallest by hash is the window's seed. Equal windows choose the
   same seed at the same relative place, so a window whose seed text occurs
   once in the corpus is unique. Consecutive windows with one seed form a
   *run*; each run is one row (seed hash, hash of the run's whole text).
2. *Runs.* Equal runs hold equal windows. A run equal to another is decided as
   a whole; only a run whose seed also occurs with a different run text stays
   open.
3. *Windows.* Every window of one copy of each open run is compared by hash.

Each step compares 128 bits (two independent 64-bit Rabin-Karp hashes). Rows
that are equal within one chunk are shuffled once, so the number of rows of one
key is bounded by the number of chunks, not by the number of copies.

``earlier=True`` marks a window when an equal one starts before it (smaller
document id, input order on ties, then earlier start); ``earlier=False`` when
an equal one starts anywhere else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.llm.common import U64, Rolling, minimizers, mix, partitions, release, signed, stored

#: Decisions about a run: bit 1, every window is marked; bit 2, its windows are compared one by one.
MARK, OPEN = 1, 2
#: Decisions that a task holds until it gives them out.
HELD = 1 << 18
KEYS = "h long, x long, id long, chunk long, place int, many boolean"
FOUND = "chunk long, places binary, codes binary"


class Units:
    """The units of a chunk: two hashes each, and the documents' first and past-the-end unit."""

    def __init__(self, first: np.ndarray, second: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.first, self.second, self.begin, self.end = first, second, begin, end


class Runs:
    """Windows of a chunk, grouped into runs that share a seed."""

    def __init__(self, units: Units, width: int, seed: int):
        n = len(units.first)
        self.width = width
        self.rolling = Rolling(units.first, 0), Rolling(units.second, 1)
        inside = np.zeros(n + 1, np.int32)
        long_enough = units.end - units.begin >= width
        np.add.at(inside, units.begin[long_enough], 1)
        np.add.at(inside, units.end[long_enough] - width + 1, -1)
        valid = np.cumsum(inside[:n]) > 0
        place = np.full(n, -1, np.int64)
        if n >= width:
            place[: n - width + 1] = minimizers(mix(self.rolling[0].windows(seed)), width - seed + 1)
        place[~valid] = -1
        edge = np.flatnonzero(np.diff(place, prepend=-2))
        lo, at = edge, place[edge]
        hi = np.append(edge[1:], n) - 1
        keep = at >= 0
        self.lo, self.hi, at = lo[keep], hi[keep], at[keep]
        # documents without units share a begin with the next one, which owns the run
        self.doc = np.searchsorted(units.begin, self.lo, "right") - 1
        self.h = mix(self.rolling[0].spans(at, at + seed))
        extent = ((at - self.lo).astype(U64) << U64(32)) | (self.hi - self.lo).astype(U64)
        self.x = mix(self.rolling[1].spans(self.lo, self.hi + width) + mix(extent))

    def windows_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All window starts of the given runs, and for each the run's place in ``which``."""
        sizes = self.hi[which] - self.lo[which] + 1
        owner = np.repeat(np.arange(len(which)), sizes)
        starts = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.lo[which][owner]
        return starts, owner

    def window_hashes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        end = starts + self.width
        return mix(self.rolling[0].spans(starts, end)), mix(self.rolling[1].spans(starts, end))


def first_of_equal(h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the first of each (h, x), how many there are, and for every place its group."""
    if len(h) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    key = h ^ (x * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    new = np.diff(key[order], prepend=key[order[0]] ^ U64(1)) != 0
    group_sorted = np.cumsum(new) - 1
    group = np.empty(len(h), np.int64)
    group[order] = group_sorted
    return order[new], np.bincount(group_sorted), group


def find(
    chunks: DataFrame,
    units_of: Callable[[pa.Array], Units],
    width: int,
    seed: int,
    earlier: bool,
) -> tuple[DataFrame, Callable[[pa.RecordBatch, int, Runs], np.ndarray]]:
    """Decide every window; returns the chunks with their decisions and a function that reads them.

    The function gives, for a chunk row and its runs, the marked windows as a
    boolean per unit (true where a marked window starts).
    """
    n = partitions(chunks.sparkSession)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, runs = read_chunk(batch, k, units_of, width, seed)
                first, counts, _ = first_of_equal(runs.h, runs.x)
                yield key_rows(runs.h[first], runs.x[first], ids[runs.doc[first]], batch.column("chunk")[k], first, counts > 1)

    run_table = stored(decide(chunks.mapInArrow(seeds, KEYS), n, earlier, whole=False), "runs")
    release(chunks.sparkSession)
    with_runs = chunks.join(gathered(run_table, "run").hint("merge"), "chunk", "left")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                places, codes = decisions(batch, k, "run")
                opened = np.sort(places[(codes & OPEN) > 0])
                if len(opened) == 0:
                    continue
                many = np.isin(opened, places[(codes & MARK) > 0]) & (not earlier)
                ids, runs = read_chunk(batch, k, units_of, width, seed)
                starts, owner = runs.windows_of(opened)
                h, x = runs.window_hashes(starts)
                first, counts, group = first_of_equal(h, x)
                sure = counts > 1
                if not earlier:
                    np.logical_or.at(sure, group, many[owner])
                yield key_rows(h[first], x[first], ids[runs.doc[opened[owner[first]]]], batch.column("chunk")[k], starts[first], sure)

    window_table = stored(decide(with_runs.mapInArrow(windows, KEYS), n, earlier, whole=True), "windows")
    release(chunks.sparkSession)
    decided = with_runs.join(gathered(window_table, "window").hint("merge"), "chunk", "left")

    def marked(batch: pa.RecordBatch, k: int, runs: Runs) -> np.ndarray:
        total = len(runs.rolling[0].sums) - 1
        out = np.zeros(total, bool)
        places, codes = decisions(batch, k, "run")
        if len(runs.h) == 0:
            return out
        first, counts, group = first_of_equal(runs.h, runs.x)
        sure = np.zeros(len(runs.h), bool)
        sure[places[(codes & MARK) > 0]] = True
        copies = counts[group] > 1
        if earlier:
            copies[first] = False
        starts, _ = runs.windows_of(np.flatnonzero(sure | copies))
        out[starts] = True
        opened = np.sort(places[(codes & OPEN) > 0])
        if len(opened):
            starts, _ = runs.windows_of(opened)
            h, x = runs.window_hashes(starts)
            first, counts, group = first_of_equal(h, x)
            copies = counts[group] > 1
            if earlier:
                copies[first] = False
            out[starts[copies]] = True
            out[decisions(batch, k, "window")[0]] = True
        return out

    return decided, marked


def read_chunk(batch: pa.RecordBatch, k: int, units_of, width: int, seed: int) -> tuple[np.ndarray, Runs]:
    ids = list_of(batch, "ids", k).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    return ids, Runs(units_of(list_of(batch, "texts", k)), width, seed)


def list_of(batch: pa.RecordBatch, name: str, k: int) -> pa.Array:
    column = batch.column(name)
    a, b = column.offsets[k].as_py(), column.offsets[k + 1].as_py()
    return column.values.slice(a, b - a)


def key_rows(h, x, ids, chunk, places, many) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(signed(h)),
            pa.array(signed(x)),
            pa.array(ids),
            pa.array(np.full(len(h), chunk.as_py(), np.int64)),
            pa.array(places.astype(np.int32)),
            pa.array(many),
        ],
        names=["h", "x", "id", "chunk", "place", "many"],
    )


def decide(keys: DataFrame, n: int, earlier: bool, whole: bool) -> DataFrame:
    """Sort the keys by hash and decide each against its equals, per chunk.

    ``whole``: only marked places are returned (of windows); else also open runs.
    Spark sorts the keys of a hash range, with room on disk; a task reads them
    in that order and holds one batch and ``HELD`` decisions, however many keys
    there are and however many share a hash.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for found in judged(batches, earlier, whole):
            held.append(found)
            count += len(found[2])
            if count >= HELD:
                yield found_rows(held)
                held, count = [], 0
        if count:
            yield found_rows(held)

    ordered = keys.repartition(n, "h").sortWithinPartitions("h", "x", "id", "chunk", "place")
    return ordered.drop("id").mapInArrow(reduce, FOUND)


def judged(batches: Iterator[pa.RecordBatch], earlier: bool, whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunk, place and decision of sorted keys, of those that have one.

    A key needs the keys before and after it: the last of a batch waits for the
    next batch. The first key of a seed is open if another text follows its
    equals, so it waits until they end.
    """
    rest = before = waiting = None
    for batch in chain(batches, [None]):
        if batch is None:
            if rest is None:
                return
            columns, k = rest, 1
        elif batch.num_rows:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "x", "chunk", "place", "many")]
            if rest is not None:
                columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
            k = len(columns[0]) - 1
        else:
            continue
        h, x, chunk, place, many = columns
        new_h, new = np.ones((2, len(h)), bool)
        new_h[1:] = h[1:] != h[:-1]
        new[1:] = new_h[1:] | (x[1:] != x[:-1])
        if before is not None:
            new_h[0] = h[0] != before[0]
            new[0] = new_h[0] or x[0] != before[1]
        mark = ~new[:k]
        if not earlier:
            mark = mark | ~np.append(new, True)[1 : k + 1] | many[:k]
        code = mark.astype(np.uint8) * MARK
        if not whole and new.any():
            starts = np.flatnonzero(new)
            joins = ~new_h[starts]  # a further text of the seed
            if waiting is not None:
                yield told(*waiting, joins[0])
                waiting = None
            opened = starts[joins | np.append(joins[1:], False)]
            code[opened[opened < k]] |= OPEN
            at = starts[-1]
            if at < k and not joins[-1]:
                waiting = chunk[at : at + 1].copy(), place[at : at + 1].copy(), code[at : at + 1].copy()
                code[at] = 0
        keep = code > 0
        if keep.any():
            yield chunk[:k][keep], place[:k][keep], code[keep]
        if k:
            before = h[k - 1], x[k - 1]
        rest = [c[k:].copy() for c in columns]
    if waiting is not None:
        yield told(*waiting, False)


def told(chunk: np.ndarray, place: np.ndarray, code: np.ndarray, opened: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A key that waited, which may have no decision."""
    code |= np.uint8(OPEN * bool(opened))
    keep = code > 0
    return chunk[keep], place[keep], code[keep]


def found_rows(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A row per chunk of the decisions."""
    chunk, place, code = (np.concatenate(x) for x in zip(*held, strict=True))
    by = np.argsort(chunk, kind="stable")
    chunk, place, code = chunk[by], place[by].astype("<i4"), code[by]
    edges = np.flatnonzero(np.diff(chunk, prepend=~chunk[:1]) != 0)
    rows = list(zip(edges, np.append(edges[1:], len(chunk)), strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(chunk[edges]),
            pa.array([place[a:b].tobytes() for a, b in rows], pa.binary()),
            pa.array([code[a:b].tobytes() for a, b in rows], pa.binary()),
        ],
        names=["chunk", "places", "codes"],
    )


def gathered(found: DataFrame, name: str) -> DataFrame:
    """One row per chunk: its decisions, bounded by the chunk's own size (joined by key, as they grow with the texts)."""
    return found.groupBy("chunk").agg(
        F.collect_list(F.struct("places", "codes")).alias(name),
    )


def decisions(batch: pa.RecordBatch, k: int, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name)
    if not column[k].is_valid:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    found = list_of(batch, name, k)
    if len(found) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    first, second = found.flatten()
    places = np.frombuffer(b"".join(first.to_pylist()), "<i4").astype(np.int64)
    return places, np.frombuffer(b"".join(second.to_pylist()), np.uint8)

"""Best-fit packing (3): a linear grouping scheme over the histogram of piece lengths.

Each text is tokenised, closed by an end id, and cut into pieces of at most
``capacity`` tokens only where it is longer. What is packed is the histogram of
piece lengths, which has at most ``capacity`` entries whatever the input, so
the driver plans in memory bounded by ``capacity``:

* *Large* pieces (over ``capacity / share``) are cut by length into ``groups``
  groups of equal cardinality and rounded up to the group's longest.
* *Configurations* of the few rounded sizes are optimised by a linear program
  (column generation: each step adds the configuration worth most at the
  present prices, by a knapsack over ``capacity``), and used a whole number of
  times.
* *Substitution*: slots of a group take its actual pieces, longest first, which
  frees the rounding; equal fillings are kept as one run of sequences.
* *Best fit*: what is left, and the small pieces, go longest first to the
  sequences with the least room that still holds them; others open sequences.

The plan is made for each (share, groups) of ``SCHEMES`` in turn until one is
within ``GOOD`` of the fewest sequences that the tokens need; the one with the
fewest sequences is used.

The plan is a list of runs: ``count`` pieces of one length, numbered from
``first``, are placed in as many consecutive sequences at one offset. Pieces
are numbered within their length by task-local counts plus prefix sums, so a
length that a third of all rows have is numbered in parallel.

A null or empty text is only its end id. Repeated rows are separate documents;
null ids are kept. Extra columns are ignored; an empty table gives no pieces.
The tokenizer's file is a parameter and must be present on every executor.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from govlake.llm.common import pick, stored, table

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: (share, groups): pieces up to capacity / share tokens are small; the others are rounded to so many sizes.
SCHEMES = ((2, 32), (3, 32), (4, 32), (8, 64))
GOOD = 1.0005
#: Words that a worker keeps with their ids, and as many of the time before; then the older ones go.
CACHE = 500_000
#: The tokenizer's white space is str.split's without these, which are tokens of their own.
SEPARATORS = "\x1c\x1d\x1e\x1f"
WORDS = re.compile(rf"[\S{SEPARATORS}]+")
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, rank int"


# ------------------------------------------------------------------ tokens
def encoder(name: str) -> Callable[[str], bytes]:
    """Ids of a text as little-endian unsigned 32-bit numbers, end id not included.

    Exact for a vocabulary that drops white space: no token spans it, so a text's
    ids are those of its space-separated words, which are kept once computed.
    White space is the tokenizer's, to which U+001C to U+001F do not belong.
    Texts with a special token's opening go to the tokenizer whole.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))

    def direct(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    model, printable = tokenizer.model, byte_characters()

    def plain(word: str) -> bytes:
        """Ids of a lower-case, composed word of letters: normalising and splitting leave it as it is."""
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(printable)
        return np.array([x.id for x in model.tokenize(spelt)], "<u4").tobytes()

    class Words(dict):
        older: dict[str, bytes] = {}

        def __missing__(self, word: str) -> bytes:
            ids = self.older.get(word)
            if ids is None:
                if len(word) > 1 and word[-1] in ".," and word[:-1].isalpha():
                    ids = self[word[:-1]] + self[word[-1]]  # letters and punctuation are split from each other
                elif word.isalpha() and word.islower() and unicodedata.is_normalized("NFC", word):
                    ids = plain(word)
                elif word.isascii() and word.isalpha():
                    ids = self[word.lower()]
                else:
                    ids = direct(word)
            self[word] = ids
            return ids

    words = Words()

    def encode(text: str) -> bytes:
        if "<|" in text:
            return direct(text)
        if len(words) > CACHE:
            words.older = dict(words)
            words.clear()
        split = WORDS.findall(text) if any(c in text for c in SEPARATORS) else text.split()
        return b"".join(map(words.__getitem__, split))

    return encode


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(other)}


_encoders: dict[str, Callable[[str], bytes]] = {}


def pieces(docs: DataFrame, capacity: int, tokenizer: str, end_id: int) -> DataFrame:
    """One row per piece; ``task`` and ``rank`` number the pieces of a length within a task."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = encoder(tokenizer)
        encode = _encoders[tokenizer]
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = memoryview(encode(text.as_py() or "") + end)
                for k, a in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * a : 4 * (a + capacity)]
                    n = len(part) // 4
                    rows.append((doc_id, k, a, n, zlib.crc32(part), task, int(seen[n])))
                    seen[n] += 1
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
                names = [x.split()[0] for x in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    frame = pick(docs, id="doc_id", text="text").select(F.col("id").cast("long"), "text")
    return frame.mapInArrow(run, PIECES)


# ------------------------------------------------------------------ plan
def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations (how many of each size) and how often to use each, rounded down."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    demand = np.array(counts, float)
    for _ in range(50 * k):
        prices = np.linalg.solve(basis.T, np.ones(k))
        # unbounded knapsack: the best value of every fill, and the size taken last
        best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        order = np.array(sizes)
        for c in range(min(sizes), capacity + 1):
            value = np.where(order <= c, best[np.maximum(c - order, 0)] + prices, 0)
            g = int(value.argmax())
            best[c], last[c] = (value[g], g) if value[g] > best[c - 1] else (best[c - 1], -1)
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                column[last[c]] += 1
                c -= sizes[last[c]]
        x, d = np.linalg.solve(basis, demand), np.linalg.solve(basis, column)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    x = np.linalg.solve(basis, demand)
    return [([int(v) for v in basis[:, i]], int(x[i] + 1e-9)) for i in range(k) if x[i] >= 1]


class Plan:
    """Runs of equally filled sequences, and where each piece of a length goes."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: first sequence, count
        self.placed: list[tuple[int, int, int, int, int]] = []  # length, first, count, first sequence, offset
        self.used = np.zeros(capacity + 1, np.int64)

    def open(self, count: int) -> tuple[int, int]:
        self.sequences += count
        return self.sequences - count, count

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.placed.append((length, int(self.used[length]), count, sequence, offset))
        self.used[length] += count

    def best_fit(self, length: int, count: int) -> None:
        """Place pieces where the least room is left, opening sequences for what fits nowhere."""
        room = length
        while count:
            while room <= self.capacity and not self.runs[room]:
                room += 1
            if room > self.capacity:
                self.runs[self.capacity].append(self.open(-(-count // (self.capacity // length))))
                room = self.capacity
            first, there = self.runs[room].pop()
            take = min(there, count)
            if take < there:
                self.runs[room].append((first + take, there - take))
            self.put(length, take, first, self.capacity - room)
            self.runs[room - length].append((first, take))
            count -= take
            room = max(length, room - length) if room - length >= length else room


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The scheme with the fewest sequences."""
    best = None
    for share, groups in SCHEMES:
        found = grouped_plan(histogram, capacity, share, groups)
        if best is None or found.sequences < best.sequences:
            best = found
        if best.sequences <= GOOD * sum(n * k for n, k in histogram.items()) / capacity:
            break
    return best


def grouped_plan(histogram: dict[int, int], capacity: int, share: int, most: int) -> Plan:
    out = Plan(capacity)
    left = dict(histogram)
    large = sorted((n for n in left if n > capacity // share), reverse=True)
    total = sum(left[n] for n in large)
    groups: list[list[int]] = []
    below = 0
    for n in large:  # groups of equal cardinality; a length is not split
        if not groups or below >= total * len(groups) / most:
            groups.append([])
        groups[-1].append(n)
        below += left[n]
    if groups:
        sizes = [g[0] for g in groups]
        for config, times in configurations(sizes, [sum(left[n] for n in g) for g in groups], capacity):
            slots = [g for g, k in enumerate(config) for _ in range(k)]
            while times:
                # the slots' present lengths, as long as all of them last
                need: dict[int, int] = {}
                lengths = []
                for g in slots:
                    n = next((n for n in groups[g] if left[n] > need.get(n, 0)), None)
                    if n is None:  # the group is used up
                        continue
                    need[n] = need.get(n, 0) + 1
                    lengths.append(n)
                if not lengths:
                    break
                count = min(times, *(left[n] // k for n, k in need.items()))
                sequence, _ = out.open(count)
                offset = 0
                for n in lengths:
                    out.put(n, count, sequence, offset)
                    left[n] -= count
                    offset += n
                out.runs[capacity - offset].append((sequence, count))
                times -= count
    for n in sorted(left, reverse=True):
        if left[n]:
            out.best_fit(n, left[n])
    return out


# ------------------------------------------------------------------ packing
def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: its document, place in it, checksum of its ids, sequence and offset there."""
    frame = pick(docs, doc_id=id_col, text=text_col)
    cut = stored(pieces(frame, capacity, tokenizer, end_id), "pieces")
    per_task = stored(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    out = plan(histogram, capacity)

    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    base = stored(per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-bases")
    numbered = cut.join(base, ["length", "task"]).withColumn("number", F.col("base") + F.col("rank"))

    # sorted by (length, first); as many rows as the plan has runs, a number set by the capacity
    placed = np.array(sorted(out.placed), np.int64).reshape(-1, 5)
    sent = docs.sparkSession.sparkContext.broadcast(placed)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = sent.value
        begin = np.searchsorted(runs[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length, number = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "number"))
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                rows = length == n
                a, b = begin[n], begin[n + 1]
                at[rows] = a + np.searchsorted(runs[a:b, 1], number[rows], "right") - 1
            sequence = runs[at, 3] + number - runs[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) if c != "length" else pa.array(length) for c in columns), pa.array(sequence), pa.array(runs[at, 4])],
                names=[*columns, "sequence_id", "offset"],
            )

    return numbered.select(*columns, "number").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

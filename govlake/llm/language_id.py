"""Language ID (6): sparse multinomial logistic regression on TF-IDF character n-grams.

* *Features.* Texts are lower-cased; runs of letters are kept, everything else
  is one blank. Character 1- to ``LONGEST``-grams are hashed to ``DIMENSIONS``
  slots; a text's weights are log(1 + count) times the slot's inverse document
  frequency, scaled to length one. Whole texts are used.
* *Document frequencies* are counted over all training documents: a task adds
  up its own and sends one row per used slot, so the shuffle is bounded by slots.
* *Training* takes a sample of labelled rows, bounded by ``SAMPLE`` rows (the
  smallest by a hash of their id, per language an equal part). Weights are
  learned by follow-the-regularised-leader with elastic-net (L1 and L2)
  penalties, which leaves most of them zero.
* *Calibration.* One temperature is fitted on a fifth of the sample that
  training does not see, by least log loss.

Training reads only text and label of training rows; the caller says which
those are. Predictions read only the text.

A null text, and one without a letter, is ``und`` with score 0. Labels that are
null are not learned. With no training rows all is ``und``. Repeated rows are
separate documents; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from govlake.llm.common import U64, mix, pick, ship, table

DIMENSIONS = 1 << 14
LONGEST = 3
#: Labelled rows that training may use, all languages together; with more languages than this, one row of each.
SAMPLE = 3000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.0005, 0.0005
UNKNOWN = "und"


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of non-letters as one blank; empty without letters."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = is_letter(code)
    if not keep.any():
        return code[:0]
    code = np.where(keep, code, np.uint32(32))
    code = code[keep | np.append(True, keep[:-1])]  # the first blank of a run stays
    return np.concatenate(([np.uint32(32)], code, [np.uint32(32)]))


def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


_letters: list[np.ndarray] = []


def is_letter(code: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(letter_table())
    return _letters[0][code]


def slots(code: np.ndarray) -> np.ndarray:
    """Hashed slot of every n-gram."""
    c = mix(code.astype(U64) + U64(1))
    out, h = [], np.zeros(len(c), U64)
    for n in range(1, LONGEST + 1):
        if len(c) < n:
            break
        h = h[: len(c) - n + 1] * U64(0x9E3779B97F4A7C15) + c[n - 1 :]
        out.append(((h * U64(0xD6E8FEB86659FD93)) >> U64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Used slots and their counts."""
    code = letters(text or "")
    if len(code) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = np.bincount(slots(code), minlength=DIMENSIONS)
    used = np.flatnonzero(counts)
    return used, counts[used]


def weighted(used: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[used]
    norm = np.sqrt(x @ x)
    return x / norm if norm > 0 else x


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # slots by labels
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        used, counts = features(text)
        if len(used) == 0 or not self.labels:
            return UNKNOWN, 0.0
        z = (weighted(used, counts, self.idf) @ self.weights[used] + self.bias) / self.temperature
        p = softmax(z)
        k = int(p.argmax())
        return self.labels[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[int, str, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """FTRL-proximal over (order, label, slots, counts) rows, then one temperature."""
    labels = sorted({label for _, label, _, _ in rows})
    k = len(labels)
    if not k:
        return Model([], idf, np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0), 1.0)
    index = {x: i for i, x in enumerate(labels)}
    data = [(index[label], np.append(used, DIMENSIONS), np.append(weighted(used, counts, idf), 1.0)) for _, label, used, counts in sorted(rows, key=lambda r: r[0]) if len(used)]
    held, seen = data[::5], [x for i, x in enumerate(data) if i % 5] or data
    z, n = np.zeros((DIMENSIONS + 1, k)), np.zeros((DIMENSIONS + 1, k))

    def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    for _ in range(EPOCHS):
        for y, used, x in seen:
            w = solved(z[used], n[used])
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            more = n[used] + g * g
            z[used] += g - (np.sqrt(more) - np.sqrt(n[used])) / ALPHA * w
            n[used] = more
    w = solved(z, n)
    scores = np.array([x @ w[used] for _, used, x in held]).reshape(-1, k)
    truth = np.array([y for y, _, _ in held], np.int64)
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.02, 10, 60) if len(held) else ():
        loss = -np.log(np.maximum(softmax(scores / t)[np.arange(len(truth)), truth], 1e-12)).mean()
        if loss < best:
            best, temperature = loss, float(t)
    return Model(labels, idf, w[:DIMENSIONS].astype(np.float32), w[DIMENSIONS], temperature)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Over all rows: how many documents have each slot, and how many documents have a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                used, _ = features(text.as_py())
                total[used] += 1
                total[DIMENSIONS] += len(used) > 0
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    counted = texts.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    df = np.zeros(DIMENSIONS + 1, np.int64)
    for r in counted.collect():  # at most DIMENSIONS + 1 rows
        df[r["slot"]] = r["n"]
    return df[:DIMENSIONS], int(df[DIMENSIONS])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from all rows of ``docs`` (id, text, label) with a label."""
    ship(docs.sparkSession)
    rows = docs.where("text IS NOT NULL AND label IS NOT NULL")
    df, total = document_frequencies(rows.select("text"))
    idf = np.log((1 + total) / (1 + df)) + 1

    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    each = max(1, sample // max(1, len(counts)))
    # an equal part of each language by hash order: a threshold on the hash first, so that few rows are sorted
    order = F.xxhash64(F.lit("sample"), "id", F.xxhash64("text"))
    part = {label: min(1.0, 2.0 * each / n + 100.0 / n) for label, n in counts.items()}
    share = F.try_element_at(F.map_from_arrays(F.lit(list(part)), F.lit(list(part.values()))), "label") if part else F.lit(0.0)
    near = rows.withColumn("at", order).where(F.pmod("at", F.lit(1 << 30)) < share * (1 << 30))
    first = near.withColumn("rank", F.row_number().over(W.partitionBy("label").orderBy("at"))).where(F.col("rank") <= each)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("label"), pa.array([u.astype("<i4").tobytes() for u, _ in found], pa.binary()), pa.array([c.astype("<i4").tobytes() for _, c in found], pa.binary())],
                names=["at", "label", "slots", "counts"],
            )

    chosen = first.select("at", "label", "text").mapInArrow(describe, "at long, label string, slots binary, counts binary")
    taken = [
        (r["at"], r["label"], np.frombuffer(r["slots"], "<i4").astype(np.int64), np.frombuffer(r["counts"], "<i4"))
        for r in chosen.toLocalIterator()
    ]
    return train(taken, idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred and score to ``docs``, which must have a ``text`` column."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            found = [m.predict(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    training = pick(docs, id="doc_id", text="text", label="lang").where(~held_out(F.col("id")))
    model = fit(training)
    out = identify(pick(docs, doc_id="doc_id", text="text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

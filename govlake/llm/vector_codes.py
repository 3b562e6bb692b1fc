"""Vector code compression (12): product codes whose codebooks are trained by Lloyd rounds over cover trees.

Vectors are scaled to integers and cut into equal parts; each part position has
a codebook. Rows are dealt into blocks; a block keeps, per part position, a
cover tree of its part vectors:

* A node has a centre that is one of its points, and a radius that covers them.
  Its children are a greedy net: the node's own centre first, then the first
  point that no child covers yet, each covering half the node's radius. Equal
  part vectors are one point with a weight, so copies cost one point a block.
* Points lie in the order of the tree, so a node is a range and the sum of its
  points is a difference of two cumulative sums.
* An entry that is nearer to a node's centre than every other by more than twice
  the radius is nearest to all of its points (triangle inequality), and the node
  goes to it whole. Only ambiguous nodes descend, and only ambiguous leaves
  compare their points, exactly and with ties to the lower entry.

A round is one job over the stored blocks: every task adds up its blocks, Spark
adds up the tasks, and the driver divides a few figures per entry and component;
their number is set by parameters, not by rows. The last round writes codes.

Arithmetic is in integers: distances between integers below 2^53 are exact in
doubles, larger ones use 64-bit integers; the triangle test leaves a margin for
its square roots, in favour of descending.

Rows whose vector is null, empty, or has a null or non-finite component are
dropped, as are vectors that have another length than the kept vector of
smallest id whose length the parts divide. Scaled components are held to
+-2^24 (plain components to +-4096), which keeps 64-bit sums exact. Repeated
rows are separate rows; ids may repeat, then the smaller vector comes first.
Null ids come last and are kept. Fewer rows than entries give shorter codebooks.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.llm.common import pick, stored, table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MOST = 1 << 24
#: Rows of a block and points of a leaf.
BLOCK, LEAF = 8192, 24
FIELDS = ("points", "weights", "of_row", "nodes", "radii")
BLOCKS = "ids array<long>, labels array<string>, " + ", ".join(f"{x} array<binary>" for x in FIELDS)
CODES = "vec_id long, label string, code string, error long"


class Tree:
    """A cover tree over weighted points, in tree order.

    ``nodes`` has a row per node: first and past-the-end point, centre point,
    first and past-the-end child. Children have higher numbers than parents.
    """

    def __init__(self, points: np.ndarray, weights: np.ndarray, nodes: np.ndarray, radii: np.ndarray):
        self.points, self.weights, self.nodes, self.radii = points, weights, nodes, radii
        self.counts = np.concatenate(([0], np.cumsum(weights)))
        self.sums = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(points * weights[:, None], axis=0)))

    @classmethod
    def build(cls, rows: np.ndarray) -> tuple[Tree, np.ndarray]:
        """The tree of the rows of an integer matrix, and each row's point."""
        points, of_row, weights = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        order, nodes, radii = cover(points.astype(np.float64))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(points[order], weights[order], nodes, radii), place[of_row.ravel()]

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of points and the entry nearest to all points of each, as rows (first, past), entry."""
        ranges, chosen = [], []
        frontier = np.zeros(min(1, len(self.nodes)), np.int64)
        while len(frontier):
            node = self.nodes[frontier]
            away = np.sqrt(distances(self.points[node[:, 2]], entries).astype(np.float64))
            best = away.argmin(axis=1)
            nearest = away[np.arange(len(best)), best]
            away[np.arange(len(best)), best] = np.inf
            sure = away.min(axis=1) > (nearest + 2 * self.radii[frontier]) * (1 + 1e-9) + 1e-6
            ranges.append(node[sure, :2])
            chosen.append(best[sure])
            open_ = node[~sure]
            leaf = open_[:, 3] == open_[:, 4]
            at = spread(open_[leaf, 0], open_[leaf, 1])
            ranges.append(np.stack([at, at + 1], axis=1))
            chosen.append(distances(self.points[at], entries).argmin(axis=1))  # the first of equal ones
            frontier = spread(open_[~leaf, 3], open_[~leaf, 4])
        if not ranges:
            return np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        return np.concatenate(ranges), np.concatenate(chosen)

    def totals(self, entries: np.ndarray) -> np.ndarray:
        """Per entry the number of rows that go to it, then their componentwise sums."""
        ranges, chosen = self.assign(entries)
        out = np.zeros((len(entries), 1 + self.points.shape[1]), np.int64)
        np.add.at(out[:, 0], chosen, self.counts[ranges[:, 1]] - self.counts[ranges[:, 0]])
        np.add.at(out[:, 1:], chosen, self.sums[ranges[:, 1]] - self.sums[ranges[:, 0]])
        return out

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every point."""
        ranges, chosen = self.assign(entries)
        of = np.empty(len(self.points), np.int64)
        of[spread(ranges[:, 0], ranges[:, 1])] = np.repeat(chosen, ranges[:, 1] - ranges[:, 0])
        return of, ((self.points - entries[of]) ** 2).sum(axis=1)


def spread(first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    size = past - first
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if points.shape[1] * 4 * most * most < 1 << 52:
        a, b = points.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    return np.stack([((points - e) ** 2).sum(axis=1) for e in entries], axis=1)


def cover(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points, nodes and radii; all nodes of a level are split at once."""
    n = len(points)
    order = np.arange(n)
    if n == 0:
        return order, np.zeros((0, 5), np.int64), np.zeros(0)
    middle = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order[[0, middle]] = order[[middle, 0]]
    nodes = [np.array([[0, n, 0, 0, 0]])]
    radii = [np.sqrt(((points - points[middle]) ** 2).sum(axis=1).max(keepdims=True))]
    count = 1
    while True:
        level, radius = nodes[-1], radii[-1]
        wide = np.flatnonzero((level[:, 1] - level[:, 0] > LEAF) & (radius > 0))
        if not len(wide):
            return order, np.concatenate(nodes), np.concatenate(radii)
        at = spread(level[wide, 0], level[wide, 1])  # places, and the node of each
        node = np.repeat(np.arange(len(wide)), level[wide, 1] - level[wide, 0])
        child, away = net(points[order[at]], node, radius[wide] / 2)
        new = np.lexsort((away, child, node))  # a child's centre comes first, at distance 0
        order[at] = order[at][new]
        child, away, node = child[new], away[new], node[new]
        first = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (child[1:] != child[:-1])))
        begin, past = at[first], np.append(at[first[1:]], at[-1] + 1)
        # ``at`` has gaps between nodes; a child ends where its node ends
        last = np.append(first[1:], len(at)) - 1
        past = at[last] + 1
        made = np.stack([begin, past, begin, np.zeros_like(begin), np.zeros_like(begin)], axis=1)
        cut = np.searchsorted(node[first], np.arange(len(wide) + 1))
        level[wide, 3], level[wide, 4] = count + cut[:-1], count + cut[1:]
        count += len(made)
        nodes.append(made)
        radii.append(away[last])


def net(points: np.ndarray, node: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy net within every node: the child that covers each point and its distance to the child's centre.

    Points of a node stand together, its centre first. In each turn the first
    uncovered point of every node becomes a centre.
    """
    child, away = np.zeros(len(points), np.int64), np.zeros(len(points))
    left, turn = np.arange(len(points)), 0
    while len(left):
        of = node[left]
        centre = left[np.flatnonzero(np.append(True, of[1:] != of[:-1]))]
        which = np.cumsum(np.append(0, of[1:] != of[:-1]))
        step = np.sqrt(((points[left] - points[centre[which]]) ** 2).sum(axis=1))
        near = step <= reach[of]
        child[left[near]], away[left[near]] = turn, step[near]
        left, turn = left[~near], turn + 1
    return child, away


# ------------------------------------------------------------------ blocks
def integers(vectors: pa.Array, width: int) -> np.ndarray:
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    return np.clip(np.floor(flat * SCALE), -MOST, MOST).astype(np.int64).reshape(-1, width)


def block_row(ids: list, labels: list, rows: np.ndarray, parts: int) -> dict:
    out = {"ids": ids, "labels": labels} | {x: [] for x in FIELDS}
    for part in np.split(rows, parts, axis=1):
        tree, of_row = Tree.build(part)
        for name, value, kind in zip(FIELDS, (tree.points, tree.weights, of_row, tree.nodes, tree.radii), "iiiid", strict=True):
            out[name].append(value.astype(kind).tobytes())
    return out


def trees_of(row: dict, width: int, parts: int) -> list[Tree]:
    size = width // parts
    read = lambda x, kind: np.frombuffer(x, kind).astype("f8" if kind == "d" else "i8")
    return [
        Tree(read(p, "i").reshape(-1, size), read(w, "i"), read(n, "i").reshape(-1, 5), read(r, "d"))
        for p, w, n, r in zip(row["points"], row["weights"], row["nodes"], row["radii"], strict=True)
    ]


def blocks(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """Stored blocks of rows with the cover tree of each part position."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(len(b) for b in held) >= BLOCK:
                whole = pa.Table.from_batches(held)
                yield one(whole.slice(0, BLOCK))
                held = whole.slice(BLOCK).to_batches()
        if sum(len(b) for b in held):
            yield one(pa.Table.from_batches(held))

    def one(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        row = block_row(t["id"].to_pylist(), t["label"].to_pylist(), integers(t["vector"].chunk(0), width), parts)
        kinds = [pa.list_(pa.int64()), pa.list_(pa.string())] + [pa.list_(pa.binary())] * len(FIELDS)
        return pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in zip(row, kinds, strict=True)], names=list(row))

    return stored(rows.mapInArrow(build, BLOCKS), "vector-blocks")


def lloyd_round(trees: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """New codebooks: every entry becomes the floored mean of its parts, an unused one stays."""
    parts = len(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(b), 1 + b.shape[1]), np.int64) for b in books]
        for batch in batches:
            for row in batch.to_pylist():
                for k, tree in enumerate(trees_of(row, width, parts)):
                    total[k] += tree.totals(books[k])
        rows = [(k * ENTRIES_MOST + e, i, x) for k, t in enumerate(total) for e, r in enumerate(t.tolist()) if r[0] for i, x in enumerate(r)]
        key, place, value = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(place, pa.int32()), pa.array(value, pa.int64())], names=["key", "place", "value"])

    sums = trees.select("points", "weights", "nodes", "radii").mapInArrow(add, "key long, place int, value long")
    found: dict[int, dict[int, int]] = {}
    for r in sums.groupBy("key", "place").agg(F.sum("value").alias("value")).collect():  # parts x entries x (1 + components)
        found.setdefault(r["key"], {})[r["place"]] = r["value"]
    out = [b.copy() for b in books]
    for key, figures in found.items():
        k, e = divmod(key, ENTRIES_MOST)
        out[k][e] = [figures[i + 1] // figures[0] for i in range(out[k].shape[1])]
    return out


#: Entries of a codebook, at most: a code is two hex digits.
ENTRIES_MOST = 256


def encoded(trees: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, error = [], np.zeros(len(row["ids"]), np.int64)
                for k, (tree, of_row) in enumerate(zip(trees_of(row, width, len(books)), row["of_row"], strict=True)):
                    of, away = tree.codes(books[k])
                    at = np.frombuffer(of_row, "i")
                    codes.append(of[at])
                    error += away[at]
                text = [bytes(x).hex() for x in np.stack(codes, axis=1).astype(np.uint8)]
                columns = [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()), pa.array(text, pa.string()), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(write, CODES)


def vector_codes(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[list[list[int]]]]:
    """(codes, codebooks): vec_id, label (as text), code and error of every kept row; entries by part."""
    if not 0 < entries <= ENTRIES_MOST:
        raise ValueError(f"a code has two hex digits: 1 to {ENTRIES_MOST} entries")
    spark = rows.sparkSession
    frame = pick(rows, id=id_col, vector=vector_col, label=label_col)
    frame = frame.select(F.col("id").cast("long"), F.col("vector").cast("array<double>"), F.col("label").cast("string"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    frame = frame.where(F.col("vector").isNotNull() & finite & (F.size("vector") > 0))
    order = [F.col("id").asc_nulls_last(), "vector"]
    first = frame.where(F.size("vector") % parts == 0).orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], CODES), [[] for _ in range(parts)]
    width = len(first[0]["vector"])
    frame = frame.where(F.size("vector") == width)
    start = frame.orderBy(*order).limit(entries).collect()  # a codebook's size
    begin = integers(pa.array([r["vector"] for r in start], pa.list_(pa.float64())), width)
    books = [x.copy() for x in np.split(begin, parts, axis=1)]
    trees = blocks(frame, width, parts)
    for _ in range(rounds):
        books = lloyd_round(trees, books, width)
    return encoded(trees, books, width), [b.tolist() for b in books]


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    codes = stored(codes, "vector-codes")
    errors = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return codes.join(errors, codes["label"].eqNullSafe(errors["of"])).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, width: int = 64) -> str:
    """The same in DuckDB: one pair of steps per round, every part compared with every entry of its codebook."""
    size = width // parts
    steps = [
        f"""v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {width} AND list_count(embedding) = {width} AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), p AS (SELECT r, part, e[part * {size} + 1 : part * {size} + {size}] AS x FROM v, (SELECT unnest(range({parts})) AS part)
), b0 AS (SELECT part, r - 1 AS entry, x FROM p WHERE r <= {entries})"""
    ]
    for k in range(rounds + 1):
        away = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"a{k} AS (SELECT p.r, p.part, min(struct_pack(d := {away}::BIGINT, entry := b.entry)) AS m FROM p JOIN b{k} b ON p.part = b.part GROUP BY p.r, p.part)")
        if k < rounds:
            steps.append(
                f"s{k} AS (SELECT p.part, m.entry AS entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k} JOIN p ON a{k}.r = p.r AND a{k}.part = p.part, "
                f"(SELECT unnest(range(1, {size} + 1)) AS i) GROUP BY p.part, m.entry, i)"
            )
            steps.append(f"m{k} AS (SELECT part, entry, list((s - ((s % n + n) % n)) // n ORDER BY i) AS x FROM s{k} GROUP BY part, entry)")
            steps.append(f"b{k + 1} AS (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON b.part = m.part AND b.entry = m.entry)")
    last = rounds
    return f"""
WITH {", ".join(steps)},
c AS (SELECT r, string_agg(printf('%02x', m.entry), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{last} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM c JOIN v USING (r), h
"""


SQL = oracle()

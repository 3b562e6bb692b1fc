"""N-gram Jaccard join (9): signature trees over shingle sets, joined by dual traversal.

Two documents link when ``share`` percent of the union of their distinct
``shingle``-word shingles is shared. All links are found exactly:

1. *Classes.* Documents with equal sets are one class (128-bit fingerprint);
   from here on a class is one member, whatever the number of its copies.
2. *Forests.* Which members can meet in one tree. Put all shingles in one
   order; two sets that link share one of their first
   ``n - ceil(share * n / 100) + 1`` shingles, n being each set's size. Any
   order will do; rare shingles come first, by counts in ``SLOTS`` hashed
   slots over all documents, so what many documents share (passages, lines)
   does not bring unrelated members together. Members are routed by each of
   those shingles. Of the members that share one, two are connected only if
   their parity bitmaps allow a link (a bit is the parity of the shingles that
   hash to it, so bitmaps differ in no more bits than the sets in shingles,
   and sets that differ in many differ in about half). The connected members
   are a tree group.
3. *Trees.* A group is cut into leaves of bounded size by size range; each leaf
   is a task. A task builds a signature tree (nodes hold the OR and the AND of
   token bitmaps and a size range) and walks it against itself or another
   leaf's: node pairs whose largest possible overlap is too small are cut, so
   are pairs already in one component; what is left is compared exactly.
   Round one joins every leaf with itself and with a few pivots of its group;
   round two joins members outside their group's largest component with all
   leaves of fitting size. Pairs inside one component need no comparison.

The result is one row per document with its component, not the pairs; a task
emits at most one link per merged component.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; with fewer than
``shingle`` words the whole sequence is one shingle; null, empty and blank texts
have empty sets and link with nothing. Repeated rows are separate documents.
A null id counts as larger than any other. Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.llm import graph
from govlake.llm.common import (
    LOWER,
    SPACED,
    U64,
    Rolling,
    buffer_of,
    chunked,
    mix,
    partitions,
    release,
    signed,
    stored,
    table,
    word_hashes,
    word_spans,
)
from govlake.llm.repeats import list_of

SHINGLE = 3
SHARE = 90
#: Members of a leaf; a task holds two leaves.
LEAF = 256
#: Hashed counters of shingles, and the rows they are sent in.
SLOTS, BLOCKS = 1 << 18, 16
BITS = 1024
FANOUT = 8


# ------------------------------------------------------------------ sets
def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, by text and hash, and each text's offset into them."""
    raw, begin, end = buffer_of(texts)
    buf = LOWER[raw]
    first, past = word_spans(buf, SPACED)
    a, b = np.searchsorted(first, begin), np.searchsorted(first, end)
    rolling = Rolling(word_hashes(buf, first, past, 0), 0)
    count = np.where(b > a, np.maximum(b - a - shingle + 1, 1), 0)
    doc = np.repeat(np.arange(len(a)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + a[doc]
    size = np.minimum(shingle, (b - a)[doc])
    h = mix(rolling.spans(start, start + size) + size.astype(U64))
    order = np.argsort(h)
    narrow = np.uint16 if len(a) < 1 << 16 else np.int64  # a radix sort where it can be
    order = order[np.argsort(doc[order].astype(narrow), kind="stable")]
    h, doc = h[order], doc[order]
    fresh = (np.diff(h, prepend=~h[:1]) != 0) | (np.diff(doc, prepend=-1) != 0)
    h, doc = h[fresh], doc[fresh]
    return h, np.searchsorted(doc, np.arange(len(a) + 1))


def sums(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """64-bit wrapping sums by group."""
    low = np.bincount(group, (values & U64(0xFFFFFFFF)).astype(np.float64), n).astype(U64)
    high = np.bincount(group, (values >> U64(32)).astype(np.float64), n).astype(U64)
    return low + (high << U64(32))


def prefix_keys(h: np.ndarray, offsets: np.ndarray, docs: np.ndarray, counts: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, shingle) of each given document's first shingles in order of (count of the slot, hash)."""
    size = offsets[docs + 1] - offsets[docs]
    owner = np.repeat(np.arange(len(docs)), size)
    begin = np.cumsum(size) - size
    at = np.arange(size.sum()) - begin[owner] + offsets[docs][owner]
    key = h[at]
    order = np.lexsort((key, counts[slot_of(key)], owner))
    place = np.arange(len(order)) - begin[owner]  # sorted by owner first, so owners stay where they are
    first = size - -(-share * size // 100) + 1
    keep = place < first[owner]
    return docs[owner[keep]], key[order[keep]]


def parity(h: np.ndarray, share: int) -> bytes:
    """Parity bitmap of a set: four bits for each shingle by which a link of its size
    may differ, rounded up to a power of two, 64 at least."""
    differ = (100 - share) * 2 * len(h) // (100 + share)
    bits = max(64, 1 << max(0, 4 * differ - 1).bit_length())
    odd = np.bincount((h & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(words: np.ndarray) -> np.ndarray:
    """Parity bitmaps at half their width."""
    half = words.shape[1] // 2
    return words[:, :half] ^ words[:, half:]


def plausible(members: list[int], size: np.ndarray, bitmaps: list[bytes], share: int, find, union) -> None:
    """Connect the members between which the bitmaps allow a link, each reached once.

    From a member all that are not yet reached are compared at once; the rest
    are compared from those that were reached, so a dense group costs little
    more than its size.
    """
    width = np.array([len(b) for b in bitmaps])
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        wide = np.flatnonzero(width == 2 * w)
        at = np.concatenate((own, wide))
        words = np.frombuffer(b"".join(bitmaps[i] for i in own), U64).reshape(len(own), -1)
        if len(wide):
            words = np.concatenate((words, folded(np.frombuffer(b"".join(bitmaps[i] for i in wide), U64).reshape(len(wide), -1))))
        native = np.arange(len(at)) < len(own)
        left = np.arange(len(at))
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                x = queue.pop()
                a, b = size[at[x]], size[at[left]]
                ok = (np.bitwise_count(words[left] ^ words[x]).sum(1, dtype=np.int64) * (100 + share) <= (100 - share) * (a + b)) & (
                    100 * np.minimum(a, b) >= share * np.maximum(a, b)
                )
                if not native[x]:
                    ok &= native[left]  # two wide ones are compared at their own width
                for y in left[ok].tolist():
                    union(members[at[x]], members[at[y]])
                    queue.append(y)
                left = left[~ok]


def slot_of(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def slot_counts(described: DataFrame, n: int) -> np.ndarray:
    """Sets per slot over all documents: ``SLOTS`` numbers, whatever the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(counts.as_buffer(), "<i8")
                total[block] = total[block] + part if block in total else part.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["block", "counts"])

    parts = described.where("block IS NOT NULL").select("block", "counts")
    out = np.zeros(SLOTS, np.int64)
    for r in parts.repartition(min(n, BLOCKS), "block").mapInArrow(add, "block int, counts binary").collect():  # BLOCKS rows
        width = SLOTS // BLOCKS
        out[r["block"] * width : (r["block"] + 1) * width] += np.frombuffer(r["counts"], "<i8")
    return out


# ------------------------------------------------------------------ trees
class Tree:
    """Bitmaps and size ranges of members, bottom-up; level 0 are the members themselves."""

    def __init__(self, sets: list[np.ndarray], order: np.ndarray):
        self.order = order
        bitmaps = np.zeros((len(order), BITS), bool)
        for k, m in enumerate(order):
            bitmaps[k, sets[m] % U64(BITS)] = True
        packed = np.packbits(bitmaps, axis=1).view(U64)
        sizes = np.array([len(sets[m]) for m in order], np.int64)
        self.any, self.all, self.low, self.high = [packed], [packed], [sizes], [sizes]
        while len(self.low[-1]) > 1:
            cut = np.arange(0, len(self.low[-1]), FANOUT)
            self.any.append(np.bitwise_or.reduceat(self.any[-1], cut))
            self.all.append(np.bitwise_and.reduceat(self.all[-1], cut))
            self.low.append(np.minimum.reduceat(self.low[-1], cut))
            self.high.append(np.maximum.reduceat(self.high[-1], cut))


def children(tree: Tree, level: int, nodes: np.ndarray) -> list[np.ndarray]:
    n = len(tree.low[level])
    return [np.arange(x * FANOUT, min(n, (x + 1) * FANOUT)) for x in nodes]


def possible(s: Tree, t: Tree, i: int, j: int, u: np.ndarray, v: np.ndarray, share: int) -> np.ndarray:
    """Node pairs that some linked pair could be under, by the largest possible overlap."""
    out = np.empty(len(u), bool)
    for a in range(0, len(u), 1 << 15):
        x, y = u[a : a + (1 << 15)], v[a : a + (1 << 15)]
        left = np.bitwise_count(s.all[i][x] & ~t.any[j][y]).sum(1, dtype=np.int64)  # in every x and in no y
        right = np.bitwise_count(t.all[j][y] & ~s.any[i][x]).sum(1, dtype=np.int64)
        overlap = np.minimum(s.high[i][x] - left, t.high[j][y] - right)
        union = np.maximum(s.low[i][x] + right, t.low[j][y] + left)
        out[a : a + (1 << 15)] = 100 * overlap >= share * union
    return out


def traverse(s: Tree, t: Tree, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Member places (in s, in t) that may link; with s is t each pair once."""
    i, j = len(s.low) - 1, len(t.low) - 1
    u = v = np.zeros(1, np.int64)
    while True:
        keep = possible(s, t, i, j, u, v, share)
        u, v = u[keep], v[keep]
        if len(u) == 0 or i == j == 0:
            break
        if i >= j:  # descend the taller side, or both
            step = children(s, i - 1, u)
            u, v = np.concatenate(step), np.repeat(v, [len(x) for x in step])
            i -= 1
        if j > i:
            step = children(t, j - 1, v)
            u, v = np.repeat(u, [len(x) for x in step]), np.concatenate(step)
            j -= 1
        if s is t and i == j:
            keep = u <= v
            u, v = u[keep], v[keep]
    if s is t:
        keep = u < v
        u, v = u[keep], v[keep]
    return u, v


def links(sets: list[np.ndarray], guest: np.ndarray, label: np.ndarray, share: int, own_pairs: bool) -> list[tuple[int, int]]:
    """Links that merge components: among own members and between own members and guests."""
    parent = {int(x): int(x) for x in label}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    sizes = np.array([len(x) for x in sets])
    lead = np.array([int(x[0]) if len(x) else 0 for x in sets], U64)  # smallest hash: like members come near each other
    order = np.lexsort((lead, sizes))
    own = Tree(sets, order[~guest[order]]) if (~guest).any() else None
    other = Tree(sets, order[guest[order]]) if guest.any() else None
    out = []
    for s, t in ((own, own) if own_pairs else (None, None), (own, other)):
        if s is None or t is None:
            continue
        u, v = traverse(s, t, share)
        for x, y in zip(s.order[u].tolist(), t.order[v].tolist(), strict=True):
            a, b = find(int(label[x])), find(int(label[y]))
            if a == b:
                continue
            shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * shared >= share * (len(sets[x]) + len(sets[y]) - shared):
                parent[max(a, b)] = min(a, b)
                out.append((x, y))
    return out


# ------------------------------------------------------------------ the join
KEYS = ("member", "grp", "leaf", "partner", "guest", "label")


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    share: int = SHARE,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (its component's smallest id)."""
    spark = docs.sparkSession
    n = partitions(spark)
    chunks = chunked(docs, id_col, text_col)

    names = ["chunk", "place", "doc_id", "n_shingles", "f", "g", "bitmap", "block", "counts"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document, and at the end of a task its slot counts in ``BLOCKS`` rows."""
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                ids = list_of(batch, "ids", k)
                h, offsets = shingle_sets(list_of(batch, "texts", k), shingle)
                total += np.bincount(slot_of(h), minlength=SLOTS)
                doc = np.repeat(np.arange(len(ids)), np.diff(offsets))
                one, two = (sums(mix(h + U64(c)), doc, len(ids)) for c in (1, 2))
                chunk = np.full(len(ids), batch.column("chunk")[k].as_py())
                rows = [chunk, np.arange(len(ids)), ids, np.diff(offsets), signed(one), signed(two)]
                columns = [pa.array(x, t) if isinstance(x, np.ndarray) else x for x, t in zip(rows, kinds, strict=False)]
                columns.append(pa.array([parity(h[a:b], share) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(ids), t) for t in kinds[7:])], names=names)
        if total.any():
            parts = [x.astype("<i8").tobytes() for x in total.reshape(BLOCKS, -1)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(BLOCKS, t) for t in kinds[:7]), pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names=names)

    schema = "chunk long, place int, doc_id long, n_shingles long, f long, g long, bitmap binary, block int, counts binary"
    described = stored(chunks.mapInArrow(describe, schema), "sets")
    counts = spark.sparkContext.broadcast(slot_counts(described, n))
    described = described.where("block IS NULL").drop("block", "counts")

    classes = stored(
        described.where("n_shingles > 0")
        .groupBy("f", "g", "n_shingles")
        .agg(F.min("doc_id").alias("least"), F.min(F.struct("chunk", "place")).alias("at"), F.first("bitmap").alias("bitmap"))
        .select("f", "g", "n_shingles", "least", "bitmap", (F.shiftleft(F.col("at.chunk"), 24) + F.col("at.place")).alias("member")),
        "classes",
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                h, offsets = shingle_sets(list_of(batch, "texts", k), shingle)
                size = np.diff(offsets)
                f = sums(mix(h + U64(1)), np.repeat(np.arange(len(size)), size), len(size))
                _, first = np.unique(f, return_index=True)  # of equal sets in a chunk one is routed
                whose, key = prefix_keys(h, offsets, first[size[first] > 0], counts.value, share)
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(signed(f[whose]))], names=["key", "f"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The members of every key that several have; the key is their own hash, so keys with equal members are one."""
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        key, f = t.column("key").to_numpy(), t.column("f").to_numpy()
        order = np.lexsort((f, key))
        key, f = key[order], f[order]
        new_key = np.diff(key, prepend=~key[:1]) != 0
        fresh = new_key | (np.diff(f, prepend=~f[:1]) != 0)
        key, f, new_key = key[fresh], f[fresh], new_key[fresh]
        group = np.cumsum(new_key) - 1
        size = np.bincount(group)
        members = sums(mix(f.view(U64)), group, len(size)) + size.astype(U64)
        _, first = np.unique(members, return_index=True)
        keep = np.zeros(len(size), bool)
        keep[first] = True
        keep = (keep & (size > 1))[group]
        yield pa.RecordBatch.from_arrays([pa.array(signed(members)[group[keep]]), pa.array(f[keep])], names=["key", "f"])

    routed = chunks.mapInArrow(route, "key long, f long").repartition(n, "key")
    common = stored(routed.mapInArrow(shared, "key long, f long").distinct(), "common")
    release(spark)
    known = classes.select("f", "member", "n_shingles", "bitmap").hint("merge")
    near = connected(common.join(known, "f").select("key", "member", "n_shingles", "bitmap"), n, share)
    groups = graph.components(stored(near, "near"))
    release(spark)

    # leaves: a small group is one leaf; a large one is cut by level of size, then by hash
    members = stored(
        groups.join(classes.select(F.col("member").alias("id"), "n_shingles"), "id").select(
            F.col("id").alias("member"), F.col("label").alias("grp"), "n_shingles"
        ),
        "members",
    )
    large = stored(members.groupBy("grp").count().where(F.col("count") > LEAF).select("grp", F.lit(True).alias("large")), "large")
    level_of = F.floor(F.log(100.001 / share, F.col("n_shingles").cast("double"))).cast("int")
    members = stored(
        members.join(large, "grp", "left").select("member", "grp", "large", F.when(F.col("large"), level_of).otherwise(0).alias("level")), "members"
    )
    leaves = stored(members.groupBy("grp", "level").agg(F.ceil(F.count(F.lit(1)) / LEAF).cast("int").alias("k")), "leaves")
    placed = stored(
        members.join(leaves, ["grp", "level"]).select("member", "grp", "large", "level", leaf_of("k").alias("leaf")), "placed"
    )
    sets = shingles_of(chunks, placed, shingle)

    release(spark)
    big = placed.where("large")
    wide = not big.isEmpty()
    round_one = sets.select("member", "grp", "leaf", *own_keys(guest=False), "shingles")
    if wide:
        # the large groups' pivots, one per level, are guests of all leaves of the level
        pivot = big.groupBy("grp", "level").agg(F.min_by("member", F.xxhash64("member")).alias("member"))
        homes = big.select("grp", "leaf", "level").distinct().join(pivot, ["grp", "level"])
        guests = homes.select("member", "grp", "leaf", *own_keys(guest=True))
        round_one = round_one.unionByName(guests.join(sets.select("member", "shingles"), "member").select(*KEYS, "shingles"))
    found = stored(joined(round_one, n, share, own_pairs=True), "links")
    if wide:
        found = stored(found.unionByName(second_round(found, big, sets, n, share)), "links")

    labels = graph.components(found)
    named = (
        classes.join(labels.withColumnRenamed("id", "member"), "member", "left")
        .select("f", "g", "n_shingles", "least", F.coalesce("label", "member").alias("label"))
    )
    named = stored(named, "named")
    smallest = stored(named.groupBy("label").agg(F.min("least").alias("component_id")), "smallest")
    of_set = stored(named.join(smallest, "label").select("f", "g", "n_shingles", "component_id"), "of-set")
    return described.join(of_set, ["f", "g", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def connected(rows: DataFrame, n: int, share: int) -> DataFrame:
    """Edges that connect the members of each key between which a link is possible; per task a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        edges: list[tuple[int, int]] = []

        def union(a: int, b: int) -> None:
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((a, b))

        for held in grouped(batches, ["key"]):
            t = pa.Table.from_batches(held)
            members = t.column("member").to_pylist()
            if len({find(x) for x in members}) > 1:
                plausible(members, t.column("n_shingles").to_numpy(), t.column("bitmap").to_pylist(), share, find, union)
            if len(edges) > 100_000:
                yield edge_rows(edges)
                edges.clear()
        if edges:
            yield edge_rows(edges)

    return rows.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct()


def edge_rows(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each key, of a partition sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in names], 1)
        edges = np.concatenate(([0], np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1, [len(keys)]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(keys[a])
            if held and key != last:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield held


def second_round(found: DataFrame, big: DataFrame, sets: DataFrame, n: int, share: int) -> DataFrame:
    """Links of large groups' members outside their group's largest component, with all leaves of fitting size."""
    labels = graph.components(found)
    state = stored(
        big.join(labels.withColumnRenamed("id", "member"), "member", "left")
        .select("member", "grp", "level", "leaf", F.coalesce("label", "member").alias("label")),
        "state",
    )
    main = state.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("grp").agg(F.max_by("label", F.struct("k", "label")).alias("main"))
    rest = state.join(stored(main, "main"), "grp").where("label <> main")
    counts = rest.groupBy("grp", "level").agg(F.ceil(F.count(F.lit(1)) / LEAF).cast("int").alias("k"))
    rest = stored(
        rest.join(stored(counts, "rest-leaves"), ["grp", "level"]).select("member", "grp", "level", "label", leaf_of("k").alias("partner")), "rest"
    )
    near = F.explode(F.array(*[F.col("level") + d for d in (-1, 0, 1)])).alias("level")
    meets = rest.select("grp", "partner", near).distinct().join(state.select("grp", "level", "leaf").distinct(), ["grp", "level"])
    meets = stored(meets.select("grp", "leaf", "partner").distinct(), "meets")
    own = state.join(meets, ["grp", "leaf"]).select("member", "grp", "leaf", "partner", F.lit(False).alias("guest"), "label")
    visitors = rest.join(meets, ["grp", "partner"]).select("member", "grp", "leaf", "partner", F.lit(True).alias("guest"), "label")
    rows = own.unionByName(visitors).join(sets.select("member", "shingles"), "member").select(*KEYS, "shingles")
    return joined(rows, n, share, own_pairs=False)


def own_keys(guest: bool) -> list[Column]:
    """Round one: no partner leaf, and every member is a component of its own."""
    return [F.lit(0).alias("partner"), F.lit(guest).alias("guest"), F.col("member").alias("label")]


def leaf_of(leaves: str) -> Column:
    return F.col("level") * (1 << 20) + F.pmod(F.xxhash64("member"), F.col(leaves)).cast("int")


def shingles_of(chunks: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """The sets of the given members, read from their chunks."""
    wanted = (
        members.withColumn("chunk", F.shiftright("member", 24))
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("member", "grp", "leaf")).alias("wanted"))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                member, grp, leaf = list_of(batch, "wanted", k).flatten()
                place = pa.array(member.to_numpy() & ((1 << 24) - 1))
                h, offsets = shingle_sets(list_of(batch, "texts", k).take(place), shingle)
                yield pa.RecordBatch.from_arrays(
                    [member, grp, leaf, pa.array([h[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())],
                    names=["member", "grp", "leaf", "shingles"],
                )

    # the list grows with the texts: a join by key at every size
    picked = chunks.join(wanted.hint("merge"), "chunk").select("texts", "wanted")
    return stored(picked.mapInArrow(read, "member long, grp long, leaf int, shingles binary"), "shingles")


def joined(rows: DataFrame, n: int, share: int, own_pairs: bool) -> DataFrame:
    """Tree join of every (group, leaf, partner): one link per merged component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in grouped(batches, keys):
            t = pa.Table.from_batches(held)
            member, guest, label = (t.column(c).to_numpy() for c in ("member", "guest", "label"))
            if len(member) < 2:
                continue
            sets = [np.frombuffer(x.as_buffer(), U64) for c in t.column("shingles").chunks for x in c]
            found = links(sets, guest, label, share, own_pairs)
            if found:
                yield edge_rows([(int(member[x]), int(member[y])) for x, y in found])

    keys = ["grp", "leaf", "partner"]
    return rows.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT row, array_to_string(w[i:i + 2], ' ') AS g
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i) WHERE len(w) > 0
), n AS (SELECT row, count(*) AS n FROM s GROUP BY row
), shared AS (SELECT a.row AS a, b.row AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.row < b.row GROUP BY 1, 2
), link AS (SELECT a, b FROM shared JOIN n x ON x.row = a JOIN n y ON y.row = b WHERE 100 * k >= 90 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach(a, b) AS (SELECT row, row FROM d UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (row)
JOIN (SELECT reach.a AS row, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.row = reach.b GROUP BY 1) c USING (row)
"""

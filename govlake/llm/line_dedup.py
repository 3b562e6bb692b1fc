"""Line dedup (11): lines shared by several documents stay in one of them; the answer is a bitmap per document.

DataFrame functions only. Every line has a 128-bit key; keys are dealt by range
and sorted with document and position behind them, so equal lines stand in a
row with the document that keeps them first:

* ``repartitionByRange`` on the key and ``sortWithinPartitions`` on key,
  document (largest first) and position. A window over the key then needs
  neither a further shuffle nor a sort: it streams over the rows, the first
  document is the first occurrence and a dense rank counts the documents.
* A key that holds more than a quarter of a partition's share of all lines is
  cut into slices by document. Which keys those are is told by a sample, which
  decides how rows are dealt and nothing else; each slice streams by itself,
  and the slices of a key, a few figures each, are put together afterwards.
* The result is not text but, per document, its kept lines as runs (first
  line, number of lines): a run-length compressed keep bitmap. ``kept_text``
  applies it.

A key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. Keys of
at least ``least_chars`` code points that ``least_docs`` documents have lose all
their lines but those in the largest doc_id that has them.

Documents are told apart by doc_id: rows with one id count as one document, and
all of them keep the line if that id does. A null id is one document, smaller
than all others. A null or empty text is one empty line. Rows of equal id and
text share a bitmap. A very long text is one row of lines and of one bitmap.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from govlake.llm.common import partitions, pick, stored, table

SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_DOCS = 20, 3
#: A key is cut into slices of this part of a partition's share of all lines.
SLICE = 0.25
#: Sampled lines per slice; a key is hot from half of it on.
SAMPLED = 32


def lines_of(docs: DataFrame) -> DataFrame:
    """doc, text_key, n_lines and the lines of every document."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc", F.xxhash64(text).alias("text_key"), F.split(text, "\n", -1).alias("lines"), text.alias("text"))


def keyed(docs: DataFrame, least_chars: int) -> DataFrame:
    """(a, b, doc, text_key, pos): the two halves of the key of every line that is long enough."""
    rows = lines_of(docs).select("doc", "text_key", F.posexplode("lines").alias("pos", "line"))
    rows = rows.select("doc", "text_key", "pos", F.btrim("line", F.lit(SPACES)).alias("line")).where(F.char_length("line") >= least_chars)
    rows = rows.withColumn("line", F.translate("line", UPPER, LOWER))
    return rows.select(F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"), "doc", "text_key", "pos")


def hot_keys(lines: DataFrame, total: int) -> DataFrame:
    """(a, b, slices) of keys over a slice's size; at most a few per partition, so small enough to broadcast."""
    share = max(1.0, SLICE * total / partitions(lines.sparkSession))
    fraction = min(1.0, SAMPLED / share)
    counts = lines.select("a", "b").sample(fraction, 11).groupBy("a", "b").agg((F.count(F.lit(1)) / fraction).alias("n"))
    found = counts.where(F.col("n") > max(share / 2, 2 * LEAST_DOCS))
    return stored(found.select("a", "b", F.ceil(F.col("n") / share).cast("int").alias("slices")), "hot-lines")


def dropped_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """(doc, text_key, pos) of lines that go."""
    total = lines.count()
    hot = hot_keys(lines, total)
    dealt = lines.join(F.broadcast(hot), ["a", "b"], "left").withColumn(
        "slice", F.when(F.col("slices").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("doc"), "slices").cast("int"))
    )
    group, largest = ["a", "b", "slice"], F.col("doc").desc_nulls_last()
    ranged = dealt.drop("slices").repartitionByRange(*group).sortWithinPartitions(*group, largest, "pos")
    streamed = Window.partitionBy(*group).orderBy(largest)
    ranked = ranged.withColumn("rank", F.dense_rank().over(streamed))
    ranked = ranked.withColumn("n_docs", F.max("rank").over(Window.partitionBy(*group)))
    whole = (F.col("slice") == 0) & (F.col("rank") > 1) & (F.col("n_docs") >= least_docs)
    told = stored(ranked.where(whole | (F.col("slice") > 0)), "ranked-lines")
    # the slices of a hot key, put together: its documents and the one that keeps it
    parts = told.where((F.col("slice") > 0) & (F.col("rank") == 1)).groupBy(*group).agg(F.max("n_docs").alias("n"), F.max("doc").alias("top"))
    keys = parts.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    keys = stored(keys.where(F.col("n") >= least_docs).select("a", "b", "top"), "hot-decisions")  # no more rows than ``hot``
    sliced = told.where("slice > 0").join(F.broadcast(keys), ["a", "b"]).where(~F.col("doc").eqNullSafe(F.col("top")))
    place = ["doc", "text_key", "pos"]
    return told.where("slice = 0").select(*place).unionByName(sliced.select(*place))


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc, text_key, gone) of the documents that lose lines: sorted line numbers."""
    lines = stored(keyed(docs, least_chars), "line-keys")
    gone = dropped_lines(lines, least_docs)
    return stored(gone.groupBy("doc", "text_key").agg(F.sort_array(F.collect_set("pos")).alias("gone")), "line-bitmaps")


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    with_text: bool = False,
) -> DataFrame:
    """Per row doc_id, n_lines, n_dropped and ``keep``: runs (first, lines) of kept lines, a compressed bitmap.

    ``with_text`` adds the kept text.
    """
    rows = pick(docs, doc=id_col, text=text_col).select(F.col("doc").cast("long"), "text")
    gone = keep_bitmaps(rows, least_chars, least_docs).withColumnsRenamed({"doc": "of", "text_key": "of_text"})
    all_rows = lines_of(rows)
    # sorted by document at every size: memory is bounded, and texts move once
    out = all_rows.join(gone.hint("merge"), all_rows["doc"].eqNullSafe(gone["of"]) & (all_rows["text_key"] == gone["of_text"]), "left")
    n = F.size("lines")
    # kept lines lie between one dropped line and the next
    before = F.concat(F.array(F.lit(-1)), F.coalesce("gone", F.array().cast("array<int>")))
    run = lambda x, i: F.struct((x + 1).alias("first"), (F.coalesce(F.get("gone", i), n) - x - 1).alias("lines"))
    keep = F.filter(F.transform(before, run), lambda r: r["lines"] > 0)
    out = out.select(
        F.col("doc").alias("doc_id"),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        keep.alias("keep"),
        *([F.col("lines").alias("__lines"), F.col("text").alias("__text")] if with_text else []),
    )
    return out.withColumn("text", kept_text("__lines", "__text")).drop("__lines", "__text") if with_text else out


def kept_text(lines: str, text: str):
    """The text that a keep bitmap leaves: its runs cut from the lines."""
    runs = F.transform("keep", lambda r: F.slice(lines, r["first"] + 1, r["lines"]))
    return F.when(F.col("n_dropped") == 0, F.col(text)).otherwise(F.array_join(F.flatten(runs), "\n"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"), with_text=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), ln AS (
  SELECT row, doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS x FROM d
), keyed AS (
  SELECT *, translate(trim(x, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM ln
), shared AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), told AS (
  SELECT keyed.*, shared.k IS NOT NULL AND doc_id <> top AS gone FROM keyed LEFT JOIN shared ON keyed.k = shared.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY row, doc_id
"""

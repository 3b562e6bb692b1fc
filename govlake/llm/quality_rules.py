"""Quality rules (8): lines that many documents of one host share are removed, depleted documents rejected.

DataFrame functions only. One pass over the texts gives the per-document rules
and a (line key, words) array; the line statistics work on that:

* A line is normalised (lower case, digits to 0, white space to one space) and
  hashed together with its host (``source``). Per host and line the distinct
  texts that have it are counted, so exact copies of a document count once.
* Lines in more than ``max(min_docs, max_share`` of the host's distinct texts)
  are removed. The limit is a share, so it means the same at every size.
* The result names the removed lines of a document by number and, if asked, has
  its text without them; op8's columns are derived from it.
* A document that keeps less than ``min_left`` percent of its words is rejected,
  as is one that fails the base rules.

Counting is partial before each shuffle, and the removed lines are a stored
table that is joined back, so neither a hot host nor a hot line meets in a task.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words and fails the
base rules; the text without lines is empty too. A very long text is one row, and
its line numbers one array. A null host is a host of its own. Repeated rows are separate
documents with one text between them. Null ids are kept; extra columns are
ignored; an empty table gives an empty result. Window and line keys are 64-bit
hashes; windows are compared only within one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.llm.common import pick, stored, table

SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEATED = 10, 20
MIN_DOCS, MAX_SHARE, MIN_LEFT = 10, 0.01, 30


def with_repeated_words(rows: DataFrame, words: str, n: int = WINDOW) -> DataFrame:
    """Adds n_repeat_words: words inside any ``n``-word window that occurs twice or more in the array.

    Each step is a column of its own, so an array is made once per row.
    """
    count = F.size(words) - n + 1
    rows = rows.withColumn("hashed", F.transform(words, lambda w: F.xxhash64(w)))
    rows = rows.withColumn(
        "keys",
        F.when(count >= 2, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*[F.get("hashed", i + k) for k in range(n)]))),
    )
    rows = rows.withColumn("some", F.size(F.array_distinct("keys")) < F.size("keys"))
    # sorted pairs bring equal windows together
    rows = rows.withColumn("pairs", F.when(F.col("some"), F.sort_array(F.transform("keys", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda p, k: p["h"].eqNullSafe(F.get("pairs", k)["h"])
    twice = F.filter("pairs", lambda p, k: near(p, k + 1) | near(p, k - 1))
    rows = rows.withColumn("starts", F.sort_array(F.transform(twice, lambda p: p["i"])))
    # each start covers up to the next one, n words at most
    covered = F.transform("starts", lambda s, k: F.least(F.lit(n), F.coalesce(F.get("starts", k + 1) - s, F.lit(n))))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda t, x: t + x), F.lit(0))
    return rows.withColumn("n_repeat_words", total.cast("long")).drop("hashed", "keys", "some", "pairs", "starts")


def measured(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, host, base figures and the lines of every document; one pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("number")))
    with_words = F.filter(numbered, lambda x: F.regexp_like(x["line"], F.lit(WORD)))
    normal = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), F.lit(f"{SPACE}+"), F.lit(" ")), F.lit("[0-9]"), F.lit("0")))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "host",
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        with_words.alias("numbered"),
    ).withColumn("lines", F.col("numbered.line"))
    key = lambda x: F.xxhash64("host", normal(x))
    return with_repeated_words(rows, "words").select(
        "row",
        "doc_id",
        "host",
        "text_key",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", f"{SPACE}+", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform(
            "numbered", lambda x: F.struct(key(x["line"]).alias("line"), F.regexp_count(x["line"], F.lit(WORD)).alias("words"), x["number"])
        ).alias("lines"),
        *(["text"] if with_text else []),
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    min_left: int = MIN_LEFT,
    with_text: bool = False,
) -> DataFrame:
    """Per document its base figures, words in removed lines, the verdict ``kept`` and
    ``removed_lines``, the numbers (from 0, in order) of the removed lines of its text
    split at \\n; ``with_text`` adds ``text``, the other lines joined by \\n."""
    rows = stored(measured(pick(docs, doc_id=id_col, text=text_col, host=host_col), with_text), "measured")
    lines = rows.select("row", "host", "text_key", F.explode("lines").alias("l")).select(
        "row", "host", "text_key", F.col("l.line").alias("line"), F.col("l.words").alias("words"), F.col("l.number").alias("number")
    )
    texts = rows.groupBy("host", "text_key").agg(F.lit(1).alias("one")).groupBy("host").agg(F.sum("one").alias("n_texts"))
    sharing = lines.groupBy("host", "line", "text_key").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.sum("one").alias("n_docs"))
    # at most 1 / max_share lines of a host's mean length in lines can be over its limit
    common = stored(sharing.where(F.col("n_docs") > min_docs), "common-lines")
    limits = stored(texts.select("host", F.greatest(F.lit(float(min_docs)), max_share * F.col("n_texts")).alias("limit")), "host-limits")
    over = stored(
        common.join(limits, common["host"].eqNullSafe(limits["host"])).where(F.col("n_docs") > F.col("limit")).select("line"), "removed-lines"
    )
    removed = lines.join(over, "line").groupBy("row").agg(
        F.sum("words").cast("long").alias("n_line_words"), F.sort_array(F.collect_list("number")).alias("removed_lines")  # of one document
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    out = rows.drop("lines", "text_key").join(removed, "row", "left").withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0).cast("long")))
    depleted = 100 * (F.col("n_words") - F.col("n_line_words")) < min_left * F.col("n_words")
    gone = F.coalesce("removed_lines", F.array().cast("array<int>"))
    split = F.split("text", "\n")
    stays = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), gone)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_line_words", gone.alias("removed_lines"),
        *([F.array_join(F.transform(stays, lambda i: F.get(split, i)), "\n").alias("text")] if with_text else []),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("removed_lines")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT row, i, w[i:i+4] AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)
), rep AS (
  SELECT DISTINCT row, i + k AS pos
  FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM win), (SELECT unnest(range(5)) AS k)
  WHERE n > 1
), reps AS (SELECT row, count(*) AS n FROM rep GROUP BY row
), ln AS (
  SELECT row, source, text, x,
         trim(regexp_replace(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g'), ' ') AS k,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT row, source, text, unnest(l) AS x FROM d)
), over_limit AS (
  SELECT s.source, s.k
  FROM (SELECT source, k, count(DISTINCT text) AS n_docs FROM ln GROUP BY source, k) s
  JOIN (SELECT source, count(DISTINCT text) AS n_texts FROM d GROUP BY source) h ON s.source IS NOT DISTINCT FROM h.source
  WHERE n_docs > greatest(10, 0.01::DOUBLE * n_texts)
), gone AS (
  SELECT ln.row, sum(ln.n) AS n FROM ln JOIN over_limit o ON ln.k = o.k AND ln.source IS NOT DISTINCT FROM o.source GROUP BY ln.row
), m AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(d.l) - len(list_distinct(d.l)))::BIGINT AS n_dup_lines,
         coalesce(reps.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_line_words
  FROM d LEFT JOIN reps USING (row) LEFT JOIN gone USING (row)
), f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * (n_words - n_line_words) < 30 * n_words) AS kept, n_line_words
FROM f
"""

"""Incremental CSV ingestion into bronze, and the streaming silver gate
(A1-A3, C7).

A feed is a folder that receives CSV files, each with a header line. A file
stream finds the new files of a run (``availableNow``: each file is taken
exactly once across runs, tracked by the checkpoint folder), whatever their
names. A batch's lines are read once and kept on the executors' disks while it
runs; they serve the headers, the types and the rows. Lines become
records (``streaming/records.py``), and records are parsed by the header of their
file, so columns may come in any order. Values are read as text and typed with
``try_cast``. What does not fit is kept in ``_rescued_data`` (a JSON object
``{column: text}``): a value of the wrong type, a column that the schema does not
have, and under ``_line`` the whole record where it has more or fewer fields than
the header, or a quote that is never closed. A column that the file lacks is NULL.

A schema is given, or a ``SchemaStore`` that follows the feed.
"""

from __future__ import annotations

import csv
import datetime as _dt
import re
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake import config as C
from govlake.operators.control import DRIFT_CONTROL_SCHEMA, GUARDIAN_CONTROL_SCHEMA, Decision, read_decision
from govlake.operators.gate import route
from govlake.sources.sinks import latest_version_path, partition_values
from govlake.streaming.records import records, with_quotes
from govlake.streaming.schemas import SchemaStore

RESCUED = "_rescued_data"


# --------------------------------------------------------------------------- A2
def infer_feed_schema(spark: SparkSession, sample_dir: str) -> T.StructType:
    """Infer a feed's schema from a sample drop (batch read); a ``SchemaStore``
    does so for each batch of a stream and keeps what it found."""
    return spark.read.option("header", True).option("inferSchema", True).csv(sample_dir).schema


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


# --------------------------------------------------------------------------- A3
#: Marks a column of the file that the schema does not have.
EXTRA = "__extra__"


def with_rescued(df_text: DataFrame, schema: T.StructType) -> DataFrame:
    """Type text columns by ``schema``; failed values and columns marked with
    ``EXTRA`` go to ``_rescued_data``.

    An empty field is NULL, not a failure. ``_rescued_data`` is NULL when
    every value of the row fitted its type and no other column had a value.
    """
    typed, bad = [], []
    for f in schema.fields:
        raw = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            typed.append(raw.alias(f.name))
            continue
        raw = F.when(F.trim(raw) != "", raw)  # a blank field of a typed column is missing, not malformed
        value = raw.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        bad += [F.lit(f.name), F.when(raw.isNotNull() & value.isNull(), raw)]
    for c in df_text.columns:
        if c.startswith(EXTRA):
            bad += [F.lit(c[len(EXTRA):]), F.col(f"`{c}`")]
    if not bad:
        return df_text.select(*typed, F.lit(None).cast("string").alias(RESCUED))
    failed = F.map_filter(F.create_map(*bad), lambda k, v: v.isNotNull())
    rescued = F.when(F.size(failed) > 0, F.to_json(failed))
    return df_text.select(*typed, rescued.alias(RESCUED))


# --------------------------------------------------------------------------- A1
#: New files that one micro-batch takes; bounds the headers the driver handles.
MAX_FILES = 1000
#: The columns of a binary file source; ``content`` is never selected, so never read.
FILES = "path string, modificationTime timestamp, length long, content binary"
#: Key of a whole record in the rescued data.
LINE = "_line"
#: Folder of a batch's rows, and of what was pinned for it.
BATCH = "batch"


def bronze_stream(spark: SparkSession, directory: str, max_files: int = MAX_FILES) -> DataFrame:
    """The stream of a feed's new files: path, length and time of each; no content is read."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", max_files).load(directory)
    return files.select("path", "length", "modificationTime")


def file_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of the named files, with the file and the place of its block in the file.

    Characters that a path pattern would give a meaning are escaped. (A text
    stream would read the files of a batch several times if one is named so.)
    """
    literal = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
    return spark.read.text(literal).select("value", "_metadata.file_path", "_metadata.file_block_start")


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with an id that rises within a block, and what their quotes do."""
    return with_quotes(lines.withColumn("id", F.monotonically_increasing_id()))


def headers(lines: DataFrame) -> list[Row]:
    """file_path, first (id and text of the header line) and opens (some field goes on behind its line), a row per file."""
    first = F.min(F.when(F.col("file_block_start") == 0, F.struct("id", "value")))
    return lines.groupBy("file_path").agg(first.alias("first"), F.max("opens").alias("opens")).collect()  # at most ``max_files`` rows


def text_rows(lines: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """(column names, text rows c0, c1, ... and ``_line``) per header of a batch's numbered lines."""
    spark, files = lines.sparkSession, headers(lines)
    groups: dict[str, list[Row]] = {}
    for r in files:
        if r["first"] is not None:
            groups.setdefault(r["first"]["value"].lstrip("\ufeff"), []).append(r)
    rows = lines.select("file_path", "id", "value", F.lit(False).alias("broken"))
    if any(r["opens"] for r in files):
        state = F.broadcast(spark.createDataFrame([(r["file_path"], r["opens"]) for r in files], "file_path string, open_file boolean"))
        told = lines.join(state, "file_path")
        plain = told.where(~F.col("open_file")).select(F.col("file_path").alias("of_file"), "id", "value", F.lit(False).alias("broken"))
        whole = records(told.where("open_file").drop("open_file")).withColumnRenamed("file_path", "of_file")
        rows = plain.unionByName(whole).withColumnRenamed("of_file", "file_path")
    out = []
    for header, members in sorted(groups.items()):
        names = [n.strip() for n in next(csv.reader([header]), [])]
        known = spark.createDataFrame([(r["file_path"], r["first"]["id"]) for r in members], "file_path string, header_id long")
        some = rows.join(F.broadcast(known), "file_path").where((F.col("id") != F.col("header_id")) & (F.col("value") != ""))
        fields = ", ".join([f"c{i} string" for i in range(len(names))] + [f"{LINE} string"])
        parsed = F.from_csv("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE})
        some = some.select(parsed.alias("p"), F.when(F.col("broken"), F.col("value")).alias("whole"))
        out.append((names, some.select(*[f"p.c{i}" for i in range(len(names))], F.coalesce("whole", f"p.{LINE}").alias(LINE))))
    return out


def by_name(names: list[str]) -> dict[str, str]:
    """Text column per name; of equal names the first."""
    return {n: f"c{i}" for i, n in reversed(list(enumerate(names))) if n}


def read_by_header(lines: DataFrame, schema: T.StructType, parts: list[tuple[list[str], DataFrame]] | None = None) -> DataFrame:
    """The rows of the files of one batch, columns matched by header name."""
    spark = lines.sparkSession
    out = None
    for names, rows in text_rows(lines) if parts is None else parts:
        place = by_name(names)
        known = [F.col(place[f.name]).alias(f.name) if f.name in place else F.lit(None).cast("string").alias(f.name) for f in schema.fields]
        extra = {n: f"c{i}" for i, n in enumerate(names) if place.get(n) != f"c{i}" or n not in schema.fieldNames()}
        part = with_rescued(rows.select(*known, *[F.col(c).alias(f"{EXTRA}{n}") for n, c in extra.items()], F.col(LINE).alias(f"{EXTRA}{LINE}")), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else with_rescued(spark.createDataFrame([], text_schema(schema)), schema)


def evolved(store: SchemaStore, number: int, parts: list[tuple[list[str], DataFrame]]) -> T.StructType:
    """The feed's schema after a batch: the types of all its files merged into the stored one."""
    named: dict[str, None] = {}
    for names, _ in parts:
        named.update(dict.fromkeys(n for n in names if n))
    rows = None
    for names, part in parts:
        place = by_name(names)
        some = part.select(*[(F.col(place[n]) if n in place else F.lit(None).cast("string")).alias(n) for n in named])
        rows = some if rows is None else rows.unionByName(some)
    return store.at(number) or T.StructType([]) if rows is None else store.evolve(number, rows)


def ingest(
    stream: DataFrame, schema: T.StructType | SchemaStore, path: str, checkpoint: str,
    transform: Callable[[DataFrame, int], DataFrame] | None = None, partition_by: list[str] | None = None,
    after: Callable[[int], None] | None = None,
) -> None:
    """Append the rows of all new files, passed through ``transform`` (rows and
    number of the batch), to the parquet table at ``path``, and stop.

    A batch is written to a folder of its own number, replacing what a failed
    attempt left there, so a batch that is run again adds nothing twice. With a
    ``SchemaStore`` the batch's types are merged first. ``after`` is called when a
    batch is written.
    """

    def write(batch: DataFrame, number: int) -> None:
        paths = sorted(r["path"] for r in batch.select("path").distinct().collect())  # at most ``max_files``
        lines = numbered(file_lines(batch.sparkSession, paths)).persist(StorageLevel.DISK_ONLY)
        try:
            parts = text_rows(lines)
            rows = read_by_header(lines, evolved(schema, number, parts) if isinstance(schema, SchemaStore) else schema, parts)
            writer = (rows if transform is None else transform(rows, number)).write.mode("overwrite")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(f"{path}/{BATCH}={number}")
        finally:
            lines.unpersist()
        if after is not None:
            after(number)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


# --------------------------------------------------------------------------- C7
def stream_route(
    stream: DataFrame, schema: T.StructType | SchemaStore, decision: Decision, path: str, checkpoint: str, as_of: _dt.datetime = C.DEFAULT_AS_OF
) -> None:
    """The silver gate on a stream: the same stateless ``route`` plan, written
    partitioned by ``route`` (silver and each quarantine reason), so one pass
    over each new file feeds both datasets. The decision is fixed for the run;
    ``stream_governed`` follows the control tables instead."""
    ingest(stream, schema, path, checkpoint, lambda rows, _: route(rows.drop(RESCUED), decision, as_of), ["route"])


def pinned_versions(spark: SparkSession, pins: str, number: int, controls: list[str]) -> list[str | None]:
    """The control table versions that a batch goes by: those current at its first
    attempt, kept under its number, so a repeated batch takes the same ones."""
    path = f"{pins}/{BATCH}={number}"
    if str(number) not in partition_values(spark, pins, BATCH):
        rows = [(i, latest_version_path(spark, c)) for i, c in enumerate(controls)]
        spark.createDataFrame(rows, "place int, version string").coalesce(1).write.mode("overwrite").parquet(path)
    return [r["version"] for r in spark.read.parquet(path).orderBy("place").collect()]  # one row per control table


def stream_governed(
    stream: DataFrame, schema: T.StructType | SchemaStore, table: str, guardian: str, drift: str, path: str, checkpoint: str,
    as_of: _dt.datetime = C.DEFAULT_AS_OF, after: Callable[[int], None] | None = None,
) -> None:
    """The silver gate on a stream, by the decision in force when a batch begins.

    ``guardian`` and ``drift`` are versioned control tables (folders of version
    folders). Each batch pins their current versions, reads the decision of
    ``table`` from them, and writes the versions' names with its rows
    (``control_version``). No version yet is a neutral decision.
    """
    spark = stream.sparkSession

    def gate(rows: DataFrame, number: int) -> DataFrame:
        versions = pinned_versions(spark, f"{path}-pins", number, [guardian, drift])
        empty = [spark.createDataFrame([], s) for s in (GUARDIAN_CONTROL_SCHEMA, DRIFT_CONTROL_SCHEMA)]
        g, d = [spark.read.parquet(v) if v else e for v, e in zip(versions, empty, strict=True)]
        names = ",".join(v.rstrip("/").rsplit("/", 1)[1] if v else "none" for v in versions)
        return route(rows.drop(RESCUED), read_decision(g, d, table), as_of).withColumn("control_version", F.lit(names))

    ingest(stream, schema, path, checkpoint, gate, ["route"], after)

"""CSV records from lines (A1, A3): quoted line breaks put together across lines and file blocks.

A text scan gives lines in order within each block of a file. Whether a line
begins inside a quoted field depends on all lines before it; a line either keeps
that state, or sets it whatever it was, or turns it around. So the state before a
line is what the last setting line left, turned once per turning line since then:
windows within a block, and one over the blocks of a file, tell it. No window
holds more than a block of lines, and only files that have an open quote at a
line's end go through them.

A quote opens a field only at the field's start and closes it only before a
comma or the line's end, so an inch mark inside a field opens nothing. A record
that is still open at the end of its file is marked as broken; so are the lines of
one of more than ``MOST_LINES`` lines, which stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lines that one record may span.
MOST_LINES = 1000
#: Inside a quoted field: anything but its closing quote; a backslash takes the next character along.
INNER = r'[^"\\]*+(?:(?:\\[\s\S]|"(?!,|$))[^"\\]*+)*+'
#: A whole quoted field; the rest of one that an earlier line opened; a field that this line leaves open.
WHOLE = rf'(?<=^|,)"{INNER}"(?=,|$)'
CLOSING = rf'^{INNER}"(?=,|$)'
OPENING = r'(?:^|,)"'
PLACE = ["file_path", "file_block_start"]


def _open_after(line: Column) -> Column:
    """Whether a field is open after a line that begins outside quotes."""
    return F.regexp_replace(line, WHOLE, "").rlike(OPENING)


def with_quotes(lines: DataFrame) -> DataFrame:
    """Adds ``opens``: a field is open after the line if none was before; ``stays``: if one was."""
    line, quoted = F.col("value"), F.contains("value", F.lit('"'))
    rest = F.regexp_replace(line, CLOSING, "")
    return lines.withColumns({
        "opens": F.when(quoted, _open_after(line)).otherwise(F.lit(False)),
        "stays": F.when(quoted, ~line.rlike(CLOSING) | _open_after(rest)).otherwise(F.lit(True)),
    })


def _states(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds ``turned``, the turns up to a row, and what decides the state before it:
    ``set_before`` (NULL if no row before has set it) and ``turned_before``."""
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*group).orderBy(*order)
    rows = rows.withColumn("turned", F.coalesce(F.sum("turns").over(upto), F.lit(0)) % 2)
    left = F.last(F.when(F.col("fixed").isNotNull(), (F.col("fixed") + F.col("turned")) % 2), ignorenulls=True).over(before)
    turned_before = F.coalesce(F.lag("turned").over(upto), F.lit(0))
    return rows.withColumn("set_before", left).withColumn("turned_before", turned_before)


def records(lines: DataFrame) -> DataFrame:
    """(file_path, id, value, broken): one row per record of the files; ``id`` is that of its first line.

    ``lines`` has file_path, file_block_start, id (rising within a block), value,
    opens and stays.
    """
    same = F.col("opens") == F.col("stays")
    rows = lines.withColumns({"fixed": F.when(same, F.col("opens").cast("int")), "turns": F.when(F.col("opens") & ~F.col("stays"), 1).otherwise(0)})
    rows = _states(rows, PLACE, ["id"])
    # what a block does to the state as a whole: its last setting line, turned by those after it, or its turns alone
    whole = rows.groupBy(*PLACE).agg(
        F.max_by("fixed", F.when(F.col("fixed").isNotNull(), F.col("id"))).alias("last_fixed"),
        F.max_by("turned", F.when(F.col("fixed").isNotNull(), F.col("id"))).alias("turned_there"),
        F.max_by("turned", "id").alias("turned_at_end"),
    )
    whole = whole.select(*PLACE, F.when(F.col("last_fixed").isNotNull(), (F.col("last_fixed") + F.col("turned_there") + F.col("turned_at_end")) % 2).alias("fixed"),
                         F.when(F.col("last_fixed").isNull(), F.col("turned_at_end")).otherwise(0).alias("turns"))
    blocks = _states(whole, ["file_path"], ["file_block_start"])  # a row per block of the batch
    entry = (F.coalesce("set_before", F.lit(0)) + F.col("turned_before")) % 2
    rows = rows.join(blocks.select(*PLACE, entry.alias("entry")), PLACE)
    inside = (F.coalesce("set_before", F.col("entry")) + F.col("turned_before")) % 2
    starts = F.when(inside == 0, F.col("id"))
    upto = Window.partitionBy(*PLACE).orderBy("id")
    rows = rows.withColumn("starts", starts).withColumn("record", F.last("starts", ignorenulls=True).over(upto))
    # lines before a block's first start belong to the last record of an earlier block
    carried = rows.groupBy(*PLACE).agg(F.max("starts").alias("last_start"))
    earlier = Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select(*PLACE, F.last("last_start", ignorenulls=True).over(earlier).alias("carried"))
    rows = rows.join(carried, PLACE).select(*PLACE, "id", "value", "opens", F.coalesce("record", "carried").alias("record"))
    size = rows.groupBy("file_path", "record").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = rows.join(size, ["file_path", "record"], "left")
    long = F.coalesce("size", F.lit(1)) > MOST_LINES
    apart = rows.where(F.col("size").isNull() | long).select("file_path", "id", "value", (long | F.col("opens")).alias("broken"))
    parts = F.array_sort(F.collect_list(F.struct("file_block_start", "id", "value")))
    joined = rows.where(F.col("size").isNotNull() & ~long).groupBy("file_path", "record").agg(
        F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value"))
    return apart.unionByName(joined.select("file_path", F.col("record").alias("id"), "value", _open_after(F.col("value")).alias("broken")))

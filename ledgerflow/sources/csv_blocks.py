"""Records of CSV files whose quoted cells may hold line breaks, read block by block.

A line break ends a record unless it lies inside a quoted cell, and whether it does
depends on everything before it.  Spark's multi-line CSV reader therefore gives each
file to one task.  Here the text reader splits files at lines, and the open question is
settled by a prefix scan:

1. Each line maps the state before it (outside or inside a quoted cell) to the state
   after it.  A line without a quote keeps the state, so only lines with quotes are
   looked at; the maps of a block's lines are composed to one map per (file, block).
2. A window over the blocks of a file composes those maps in order: the last block whose
   map is constant, and the number of swaps since.  Only blocks that end inside a quoted
   cell are brought to the driver (none for most files), each with the next block that
   has a quote: every block begun in between begins inside.
3. The second scan knows how each of its blocks begins and cuts it into records.  Whole
   records leave the task at once.  The pieces of records that cross block borders, only
   read if step 2 found any and only from those files, are put together by a group per
   record.

Lines end with LF or CR LF; the line ends inside quoted cells stay as they are.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.session import ship

QUOTE, DELIMITER = '"', ","
_PIECE = "file string, start long, first boolean, begins boolean, ends boolean, record string"
_NAMES = [c.split()[0] for c in _PIECE.split(", ")]


def quoted_after(line: str, quoted: bool) -> bool:
    """Is the line's end inside a quoted cell, if its beginning is (or is not)?

    A quote opens a cell only as its first character and is doubled inside it;
    text after a closing quote, and quotes inside a bare cell, are plain text
    up to the next delimiter.
    """
    at = 0
    while True:
        if not quoted:
            if line.startswith(QUOTE, at):
                at += 1
            else:
                at = line.find(DELIMITER, at) + 1
                if not at:
                    return False
                continue
        quoted = True
        at = line.find(QUOTE, at)
        if at < 0:
            return True
        if line.startswith(QUOTE, at + 1):
            at += 2
            continue
        at = line.find(DELIMITER, at + 1) + 1
        if not at:
            return False
        quoted = False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _block_maps(lines: DataFrame) -> DataFrame:
    """(file, start, from_outside, from_inside): the state after each block that has a quote, for both states before it."""
    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, maps = None, {}
        for batch in batches:
            for file, start, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (file, start) != block:
                    block = (file, start)
                    maps.setdefault(block, (False, True))
                outside, inside = maps[block]
                maps[block] = (quoted_after(line, outside), quoted_after(line, inside))
        keys, ends = list(maps), list(maps.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([e[0] for e in ends], pa.bool_()), pa.array([e[1] for e in ends], pa.bool_())],
            names=["file", "start", "from_outside", "from_inside"])

    return lines.where(F.col("line").contains(QUOTE)).mapInArrow(compose, "file string, start long, from_outside boolean, from_inside boolean")


def open_blocks(lines: DataFrame) -> dict[str, list[tuple[int, int | None]]]:
    """{file: [(start of a block that ends inside a quoted cell, start of the next block with a quote)]}."""
    order = Window.partitionBy("file").orderBy("start")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    constant = F.col("from_outside") == F.col("from_inside")
    swap = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    maps = _block_maps(lines).withColumn("swaps", F.sum(swap).over(so_far))
    # the state after the last constant map, turned around by every swap since; files begin outside
    known = F.last(F.when(constant, F.struct("from_outside", "swaps")), ignorenulls=True).over(so_far)
    scanned = maps.withColumn("known", known)
    inside = ((F.coalesce(F.col("known.from_outside"), F.lit(False)).cast("int")
               + F.col("swaps") - F.coalesce(F.col("known.swaps"), F.lit(0))) % 2) == 1
    found = scanned.select("file", "start", inside.alias("inside"), F.lead("start").over(order).alias("upto")).where("inside")
    out: dict[str, list[tuple[int, int | None]]] = {}
    for r in found.orderBy("file", "start").collect():
        out.setdefault(r.file, []).append((r.start, r.upto))
    return out


def _pieces(lines: DataFrame, opened: dict[str, list[tuple[int, int | None]]]) -> DataFrame:
    """``_PIECE`` rows: records and, where a block border cuts one, its pieces; ``first``: the file's first that is not blank."""
    def begins_inside(file: str, start: int) -> bool:
        spans = opened.get(file, [])
        at = bisect.bisect_left(spans, (start,)) - 1  # the last that began earlier
        return at >= 0 and (spans[at][1] is None or start <= spans[at][1])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, begins, inside, header = None, [], True, False, False
        for batch in batches:
            files, starts, column = (batch.column(i) for i in range(3))
            if block is not None and not inside and not header and not pc.any(pc.match_substring(column, QUOTE)).as_py() \
                    and pc.all(pc.equal(files, block[0])).as_py() and pc.all(pc.equal(starts, block[1])).as_py():
                yes, no = pa.array([True] * len(column)), pa.array([False] * len(column))
                yield pa.RecordBatch.from_arrays([files, starts, no, yes, yes, column], names=_NAMES)
                continue
            out: list[tuple] = []

            def emit(ends: bool) -> None:
                nonlocal held, begins, header
                record = "\n".join(held)
                first = header and bool(record.strip())
                header = header and not first
                out.append((*block, first, begins, ends, record.removeprefix("\ufeff") if first else record))
                held, begins = [], True

            for file, start, line in zip(files.to_pylist(), starts.to_pylist(), column.to_pylist()):
                if (file, start) != block:
                    if held:
                        emit(False)
                    block, header = (file, start), start == 0
                    inside = begins_inside(file, start)
                    begins = not inside
                held.append(line)
                inside = quoted_after(line, inside) if QUOTE in line else inside
                if not inside:
                    emit(True)
            yield _batch(out)
        if held:
            yield _batch([(*block, header and any(x.strip() for x in held), begins, False, "\n".join(held))])

    return lines.mapInArrow(cut, _PIECE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * 6, kinds)], names=_NAMES)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): the logical records of the CSV files under ``path``, blank ones left out; ``first``: a file's header."""
    ship(spark)
    lines = _lines(spark, path)
    opened = open_blocks(lines)
    pieces = _pieces(lines, opened)
    whole = F.col("begins") & F.col("ends")
    records = pieces.where(whole).select("file", "first", "record")
    if opened:
        order = Window.partitionBy("file").orderBy("start", "begins")  # what goes on from before comes first in its block
        cut = _pieces(lines.where(F.col("file").isin(list(opened))), opened).where(~whole)
        owned = cut.withColumn("owner", F.sum(F.col("begins").cast("int")).over(order))
        joined = owned.groupBy("file", "owner").agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "begins", "record"))).alias("parts"))
        records = records.unionByName(joined.select("file", "first", F.concat_ws("\n", F.col("parts.record")).alias("record")))
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).where(F.length(F.trim("record")) > 0)

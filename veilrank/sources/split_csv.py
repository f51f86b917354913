"""CSV with quoted line ends, read in byte ranges by many tasks.

A range cannot tell by itself whether it begins inside a quoted cell.  One pass counts the quotes of every
range; whether the number before a range is odd says so, and that table has one row for each range.  A second
pass cuts each range into records where it lies.  Only the pieces of records that cross the ends of
ranges, at most two for each range, are brought together.

Files follow RFC 4180: a cell with a quote in it is quoted and its quotes are doubled.  Records end with LF or
CRLF.  A compressed file is one range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veilrank.sources.readers import CORRUPT, RESUME_SCHEMA, too_many_cells, with_corrupt

_PIECE = "file string, range long, ord int, first boolean, last boolean, record string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").option("encoding", "UTF-8").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value"
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """``(file, range, inside)`` for each range that has lines: whether it begins in a quoted cell."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "range").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begun = counted.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    return begun.select("file", "range", "inside")


def _cut(ranges: dict[tuple[str, int], bool]):
    """Cuts the lines of whole ranges into records and pieces; ``ranges`` tells which begin inside a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("range", pa.int64()), ("ord", pa.int32()),
                            ("first", pa.bool_()), ("last", pa.bool_()), ("record", pa.string())])
        at: tuple[str, int] | None = None
        held: list[str] = []  # lines of the open record
        whole, inside, made = True, False, 0
        out: list[tuple] = []

        def close(last: bool) -> None:
            nonlocal held, whole, made
            if held:
                out.append((*at, made, whole, last, "\n".join(held)))
                made += 1
            held, whole = [], True

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            files, starts, values = (batch.column(i) for i in range(3))
            key = np.asarray(starts)
            new_file = np.asarray(pc.not_equal(files.slice(1), files.slice(0, max(0, len(files) - 1))))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | new_file) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(key)]):
                if begin == end:
                    continue
                here = (files[int(begin)].as_py(), int(key[begin]))
                if here != at:
                    if at is not None:
                        close(last=not inside)
                    at, inside, made = here, ranges[here], 0
                    whole = not inside
                texts = values.slice(int(begin), int(end - begin))
                odd = np.asarray(pc.count_substring(texts, '"')) % 2
                ends = (np.cumsum(odd) + inside) % 2 == 0  # of the lines that close a record
                for line, closes in zip(texts.to_pylist(), ends):
                    held.append(line)
                    if closes:
                        close(last=True)
                inside = not ends[-1]
            yield batch_of()
            out.clear()
        if at is not None:
            close(last=not inside)
            yield batch_of()

    return run


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, range, ord, record)``: the text of every record, and where it begins; ``ord`` counts in its range."""
    lines = _lines(spark, path)
    # One row for each range of files, some hundred bytes: the list of ranges that the driver made to plan the scan.
    begun = {(r.file, r.range): r.inside for r in _ranges(lines).collect()}
    pieces = lines.mapInArrow(_cut(begun), _PIECE)
    whole = pieces.where("first AND last").select("file", "range", "ord", "record")
    # The lines of a file in order: a piece that begins a record, and those behind it up to the next beginning.
    line = Window.partitionBy("file").orderBy("range", "ord")
    parts = pieces.where("NOT (first AND last)").withColumn("nth", F.count_if("first").over(line))
    place = F.struct("range", "ord")
    joined = parts.groupBy("file", "nth").agg(
        F.min(place).alias("begin"), F.sort_array(F.collect_list(F.struct("range", "ord", "record"))).alias("parts")
    ).select(
        "file", "begin.range", "begin.ord", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")
    )
    return whole.unionByName(joined)


def read_csv_split(
    spark: SparkSession, path: str | list[str], schema: StructType = RESUME_SCHEMA, header: bool = True
) -> DataFrame:
    """Every record, with ``rejected`` true for those with more cells than columns, as ``read_csv_with_rejects``.

    Empty lines between records are no records; a byte order mark is left out.
    """
    found = records(spark, path)
    if header:
        found = found.where("NOT (range = 0 AND ord = 0)")
    found = found.select(F.regexp_replace("record", r"\A\x{FEFF}|\r\z", "").alias("record")).where("record <> ''")
    options = {
        "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    }
    read = found.select(F.from_csv("record", with_corrupt(schema).toDDL(), options).alias("r"))
    rejected = too_many_cells(F.col(f"r.{CORRUPT}"), F.col(f"r.`{schema.names[-1]}`"), len(schema.names))
    return read.select(*(F.col(f"r.`{n}`").alias(n) for n in schema.names), rejected.alias("rejected"))

"""Delimited text with a header: strict column count, malformed rows kept apart."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BAD = "_bad"
LINE = "_line"


def split_delimited(
    lines: DataFrame,
    header: Sequence[str],
    value: str = "value",
    sep: str = "\t",
    trailing_empty: str = "malformed",
) -> DataFrame:
    """Split text lines into string columns named by ``header``.

    A row with fewer columns than the header is flagged in ``_bad``; further columns are ignored.
    Empty columns at the end do not count, so an empty last column is malformed too;
    ``trailing_empty="null"`` accepts it as a null instead.
    """
    if trailing_empty not in ("malformed", "null"):
        raise ValueError("trailing_empty is 'malformed' or 'null'")
    line = F.col(value)
    cells = F.split(line, re.escape(sep))
    # A line of separators alone has no column at all; an empty line has one empty column.
    if trailing_empty == "malformed":
        filled = F.transform(cells, lambda cell, i: F.when(cell != "", i + 1).otherwise(0))
        columns = F.when(F.length(line) == 0, 1).otherwise(F.array_max(filled))
    else:
        columns = F.size(cells)
    kept = [c for c in lines.columns if c != value]

    def cell(i: int, name: str):
        text = F.get(F.col("_cells"), F.lit(i))
        return (F.nullif(text, F.lit("")) if trailing_empty == "null" else text).alias(name)

    return lines.select(
        *kept, line.alias(LINE), (columns < len(header)).alias(BAD), cells.alias("_cells")
    ).select(*kept, *[cell(i, name) for i, name in enumerate(header)], BAD, LINE)


def good_rows(split: DataFrame) -> DataFrame:
    return split.where(~F.col(BAD)).drop(BAD, LINE)


def quarantined_rows(split: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The malformed lines, unchanged, with the columns of ``keep``."""
    return split.where(F.col(BAD)).select(*keep, F.col(LINE).alias("line"))


def header_of(spark: SparkSession, path: str, sep: str = "\t") -> list[str]:
    """Column names from the first line of a file (line ends of either kind are stripped)."""
    first = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).first()
    if first is None:
        raise ValueError(f"no header in {path}")
    return first["value"].split(sep)


def _without_header(title: str) -> Callable:
    """Drops the first line of each file if it is the header. Lines of one file block come in order to one task, so
    a line is the first of its file if its block starts at 0 and the line before is of another block."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            file, block, value = batch.columns
            new = np.ones(n, dtype=bool)
            new[0] = (file[0].as_py(), block[0].as_py()) != last
            for column in (file, block):
                same = pc.equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
                new[1:] = ~same if column is file else new[1:] | ~same
            header = new & pc.equal(block, 0).to_numpy(zero_copy_only=False) & pc.equal(value, title).to_numpy(zero_copy_only=False)
            last = (file[n - 1].as_py(), block[n - 1].as_py())
            yield pa.RecordBatch.from_arrays([value.filter(pa.array(~header))], names=["value"])

    return drop


def read_delimited(
    spark: SparkSession,
    path: str,
    header: Sequence[str] | None = None,
    sep: str = "\t",
    trailing_empty: str = "malformed",
    streaming: bool = False,
    positions: bool = False,
    **options: str,
) -> DataFrame:
    """Read a file or folder whose files each start with the same header line.

    Use ``good_rows`` and ``quarantined_rows`` on the result; nothing is lost. Only the first line of a
    file can be its header; a later line equal to it is data, on streams as in tables. With ``positions`` the columns ``_file``, ``_block`` and
    ``_row`` put the lines in file order.
    """
    if streaming and positions:
        raise ValueError("a stream of lines has no file order")
    header = list(header) if header else header_of(spark, path, sep)
    reader = (spark.readStream if streaming else spark.read).options(**options)
    lines = reader.text(path)
    title = F.lit(sep.join(header))
    if streaming:
        placed = lines.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), "value")
        lines = placed.mapInArrow(_without_header(sep.join(header)), "value string")
        return split_delimited(lines, header, sep=sep, trailing_empty=trailing_empty)
    # Lines of one file block are read in order by one task, so row ids grow within a block.
    lines = lines.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )
    # One row per file: its first line, if that is the header.
    first = lines.where(F.col("_block") == 0).groupBy("_file").agg(F.min_by("value", "_row").alias("_first"), F.min("_row").alias("_at"))
    first = first.where(F.col("_first") == title).select(F.col("_file").alias("_in"), "_at")
    lines = lines.join(first, (F.col("_file") == F.col("_in")) & (F.col("_row") == F.col("_at")), "left_anti")
    lines = lines if positions else lines.select("value")
    return split_delimited(lines, header, sep=sep, trailing_empty=trailing_empty)

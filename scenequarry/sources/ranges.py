"""Large files in parts: line numbers that hold across splits, and byte ranges of binary files as rows of work."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scenequarry.operators.scale import attach
from scenequarry.session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a file that one task reads, about, and tasks at most.
RANGE_BYTES, TASKS = 64 << 20, 8192


def local_path(path: str) -> str | None:
    """The path on a file system that all workers mount; null for other stores."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else path


def open_path(path: str) -> BinaryIO:
    """A file that can be read from any place on: a mounted one, or one in a store that Arrow knows by its address."""
    if (local := local_path(path)) is not None:
        return open(local, "rb")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system.open_input_file(name)


def same_path(path: Column) -> Column:
    """Paths as Spark's file metadata and its binary reader give them, in one form."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), "^file:/+", "file:/")


def numbered_lines(spark: SparkSession, path: str | list[str], keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """(file, line, value): lines of text files with their number in the file, from 0, among those that ``keep`` passes.

    Spark splits large files at line ends. A line's number is its place in its split, counted as the task reads it, and the
    lines of earlier splits, which a table of one row per split tells. Line order, and so the numbers, don't depend on
    where files are split.
    """
    raw = spark.read.text(path).select(same_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("_start"), "value")
    raw = raw.filter(keep(F.col("value"))) if keep else raw
    sizes = raw.groupBy("file", "_start").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("file", "_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            files, starts = b.column(0).dictionary_encode(), b.column(1).to_numpy()
            codes = files.indices.to_numpy()
            new = np.concatenate([[True], (codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])])
            first = np.flatnonzero(new)
            at = np.arange(b.num_rows) - np.repeat(first, np.diff([*first, b.num_rows]))
            if (files.dictionary[codes[0]].as_py(), starts[0]) == last:
                at[: first[1] if len(first) > 1 else None] += n
            last, n = (files.dictionary[codes[-1]].as_py(), starts[-1]), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], ["file", "_start", "value", "_at"])

    rows = raw.mapInArrow(number, "file string, _start long, value string, _at long")
    return attach(rows, before, ["file", "_start"]).select("file", (F.col("_at") + F.col("_before")).alias("line"), "value")


def listed_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length) of files; nothing of their content is read."""
    r = spark.read.format("binaryFile")
    return (r.option("recursiveFileLookup", True).option("pathGlobFilter", glob) if glob else r).load(path).select("path", "length")


def in_tasks(ranges: DataFrame) -> DataFrame:
    """A table of ranges dealt out so that each has its own task, up to ``TASKS``."""
    ranges = cut(ranges)
    return ranges.repartition(max(1, min(ranges.count(), TASKS)))


def ranged_records(
    spark: SparkSession, path: str, index: Callable[[BinaryIO], Iterator[tuple[int, int]]], parse: Callable[[BinaryIO, int], Iterator[pa.RecordBatch]], schema: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``path`` and the columns of ``schema``: records of variable length, of whole folders of files.

    ``index`` walks over a file's record heads and gives (offset, end) of each record; it runs once per file, next to other
    files. Runs of about ``range_bytes`` then are read by tasks of their own, with ``parse`` from a file at its place.
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                out, start, n = [], None, 0
                with open_path(p) as f:
                    for offset, end in index(f):
                        start, n = offset if start is None else start, n + 1
                        if end - start >= range_bytes:
                            out.append((p, start, n))
                            start, n = None, 0
                if n:
                    out.append((p, start, n))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "start", "n"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, start, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with open_path(p) as f:
                    f.seek(start)
                    for out in parse(f, n):
                        yield pa.RecordBatch.from_arrays([pa.array([p] * out.num_rows, pa.string()), *out.columns], ["path", *out.schema.names])

    ranges = listed_files(spark, path).select("path").mapInArrow(plan, "path string, start long, n long")
    return in_tasks(ranges).mapInArrow(read, f"path string, {schema}")

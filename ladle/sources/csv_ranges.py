"""CSV files with line breaks in quoted cells, read by byte ranges.

Spark's multi-line CSV reader gives a file to one task, because a range of
bytes cannot tell whether it begins inside a quoted cell.  Quote parity can:

1. Files are scanned as plain lines, which split by byte ranges.  Each range
   counts its quotes; the parity of all quotes before a range (a prefix over
   the ranges of its file, a few numbers per range) says how it begins.
2. In a second scan every range joins its lines to records: a line that begins
   outside quotes begins a record.  Records that lie in one range never leave
   their task.
3. Only the lines before a range's first record and its last, perhaps
   unfinished, record are put together across ranges: each belongs to the last
   range before it that begins a record, so a record over many ranges meets
   under one key.
4. Records are parsed by Spark's CSV expression with the given schema.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators.bounded import broadcast_if_small
from ladle.session import materialize
from ladle.sources.files import lowercase_columns, parse_text_array

_RANGE = ["file", "range_start"]
_PART = "file string, range_start long, place string, n long, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, range_start): lines end at LF only, so a CR stays with its line."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("range_start")))


def range_parities(lines: DataFrame) -> DataFrame:
    """(file, range_start, inside): whether each range begins inside a quoted cell."""
    quotes = F.octet_length("line") - F.octet_length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy(*_RANGE).agg(F.pmod(F.sum(quotes), F.lit(2)).alias("odd"))
    before = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    after = F.pmod(F.sum("odd").over(Window.partitionBy("file")), F.lit(2))
    return counted.select(*_RANGE, (F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)) == 1).alias("inside"),
                          (after == 1).alias("unclosed"))


def _joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """Lines from each start to the next, joined by line feeds."""
    if not len(starts):
        return pa.array([], pa.string())
    ends = pa.array(np.r_[starts, len(lines)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, lines), "\n")


class _Range:
    """Records of one range, whose lines come in order, some at a time."""

    def __init__(self, file: str, start: int, inside: bool):
        self.key, self.inside, self.n = (file, start), inside, 0
        self.waiting: list[str] = []   # of the record not known to be over
        self.led = False               # whether a record has begun here

    def _row(self, place: str, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        number = np.arange(self.n, self.n + n)
        self.n += n
        return pa.RecordBatch.from_arrays([pa.array([self.key[0]] * n, pa.string()), pa.array([self.key[1]] * n, pa.int64()),
                                           pa.array([place] * n, pa.string()), pa.array(number, pa.int64()), records],
                                          names=["file", "range_start", "place", "n", "record"])

    def close(self) -> list[pa.RecordBatch]:
        """The last record, or the lines that all belong to an earlier range's."""
        if not self.waiting:
            return []
        return [self._row("last" if self.led else "first", pa.array(["\n".join(self.waiting)], pa.string()))]

    def add(self, lines: pa.Array) -> list[pa.RecordBatch]:
        odd = pc.count_substring(lines, '"').to_numpy() & 1
        inside = (np.cumsum(odd) - odd + self.inside) & 1
        self.inside = bool((inside[-1] + odd[-1]) & 1)
        starts = np.flatnonzero(inside == 0)
        if not len(starts):
            self.waiting += lines.to_pylist()
            return []
        out, head = [], lines[:int(starts[0])].to_pylist()
        if self.waiting or head:
            done = pa.array(["\n".join(self.waiting + head)], pa.string())
            # What comes before the first record belongs to an earlier range.
            out.append(self._row("whole" if self.led else "first", done))
        self.led = True
        if len(starts) > 1:
            out.append(self._row("whole", _joined(lines[:int(starts[-1])], starts[:-1])))
        self.waiting = lines[int(starts[-1]):].to_pylist()
        return out


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (line, file, range_start, inside), ranges one after the other: parts of records."""
    held: _Range | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
        code = files.indices.to_numpy()
        cuts = np.r_[0, np.flatnonzero((code[1:] != code[:-1]) | (starts[1:] != starts[:-1])) + 1, batch.num_rows].tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = (batch.column(1)[a].as_py(), int(starts[a]))
            if held is None or held.key != key:
                if held:
                    yield from held.close()
                inside = batch.column(3)[a].as_py()
                if inside is None:
                    raise RuntimeError(f"{key}: the file was split differently in its two scans")
                held = _Range(*key, inside)
            yield from held.add(batch.column(0).slice(a, b - a))
    if held:
        yield from held.close()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, range_start, n, record): the records of all files, their header
    included; blank records are left out.  (file, range_start, n) is unique
    and follows the order in a file.  A file whose quotes are not closed
    raises an error (a lone quote inside an unquoted cell counts as one too).
    """
    lines = _lines(spark, path)
    ranges = materialize(range_parities(lines), "csv-ranges")
    broken = ranges.where("unclosed").select("file").first()
    if broken:
        raise ValueError(f"{broken[0]}: odd number of quotes")
    known = broadcast_if_small(ranges.select(*_RANGE, "inside"))
    parts = materialize(lines.join(known, _RANGE, "left").select("line", *_RANGE, "inside").mapInArrow(_assemble, _PART), "csv-parts")
    # Lines that lead a range belong to the nearest range before it in which a record begins.
    edges = parts.where("place <> 'whole'")
    owner = F.last(F.when(F.col("place") == "last", F.struct("range_start", "n")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("range_start", "n").rowsBetween(Window.unboundedPreceding, 0))
    owned = edges.select("file", "range_start", "n", "record", owner.alias("owner"))
    across = (owned.groupBy("file", "owner")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("range_start", "n", "record"))), lambda p: p["record"]),
                                "\n").alias("record"))
              .select("file", "owner.range_start", "owner.n", "record"))
    whole = parts.where("place = 'whole'").select("file", "range_start", "n", "record")
    return whole.unionByName(across).where(F.trim(F.col("record"), F.lit(" \t\r\n")) != "")


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType | str,
                    array_columns: Sequence[str] = ()) -> DataFrame:
    """``files.read_csv(multi_line=True)`` with every file split into byte
    ranges: header, quoted cells with doubled quotes, line breaks inside them,
    explicit schema, array texts parsed.  In a file whose header ends with CR
    LF, every CR LF is read as LF, also in cells, as by the multi-line reader.

    An empty file gives no rows; so does a header alone.  A record must fit a
    task; one range of a file (``spark.sql.files.maxPartitionBytes``) is
    streamed, not held.
    """
    records = csv_records(spark, path)
    first = F.struct("range_start", "n")
    crlf = F.min_by(F.col("record").endswith("\r"), first).alias("crlf")
    headers = records.groupBy("file").agg(F.min(first).alias("header"), crlf)
    line_feeds = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    body = (records.join(broadcast_if_small(headers), "file").where(first != F.col("header"))
            .select(F.from_csv(F.when(F.col("crlf"), line_feeds).otherwise(F.col("record")), schema if isinstance(schema, str) else schema.simpleString()[7:-1],
                               {"escape": '"', "multiLine": "true"}).alias("r")).select("r.*"))
    out = lowercase_columns(body)
    for c in array_columns:
        if c.lower() in out.columns:
            out = out.withColumn(c.lower(), parse_text_array(F.col(c.lower())))
    return out

"""Lines of files as a data source of one's own: byte ranges, numbered lines, streams.

``LineSource`` cuts files into ranges of bytes, each read by one task in Arrow batches; a line
belongs to the range it begins in. Every line comes with its file, the start of its range and
its number inside the range, so a line's number in its file, or in the corpus, is that plus the
lines of the ranges before: a sum over a narrow table of ranges. Lines are not moved and
nothing is checkpointed for it. As a stream the same source gives the lines of new files; its
offset is the time and name of the newest file, however many there were.

Paths are folders or files of any file system that pyarrow knows, on a cluster a shared one.
Files that are compressed by their name are one range each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..shipping import ship
from .readers import _finish, parse_lines, split_field_map

FORMAT = "corpusflow_lines"
SCHEMA = "value string, file string, range long, line long"
_ARROW = pa.schema([("value", pa.string()), ("file", pa.string()), ("range", pa.int64()), ("line", pa.int64())])
#: Bytes of a range, bytes taken from a file at once, and lines of a batch.
RANGE_BYTES, READ_BYTES, BATCH_LINES = 64 << 20, 1 << 20, 4096
#: Ranges, some 50 bytes each, whose sums are broadcast; more are joined by a shuffle.
BROADCAST_RANGES = 1_000_000
_COMPRESSED = re.compile(r"\.(gz|bz2|zst|lz4|br)\Z")


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int | None


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if urlparse(path).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(path).path
    return pafs.FileSystem.from_uri(path)


def _files(path: str) -> list[pafs.FileInfo]:
    """The files of a path, those with hidden names left out, as other readers do."""
    fs, inner = _file_system(path)
    top = fs.get_file_info(inner)
    if top.type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"no such path: {path}")
    every = [top] if top.is_file else fs.get_file_info(pafs.FileSelector(inner, recursive=True))
    return [f for f in every if f.is_file and not f.base_name.startswith(("_", "."))]


def _ranges(files: list[pafs.FileInfo], size: int) -> list[Range]:
    out = []
    for f in sorted(files, key=lambda f: f.path):
        if _COMPRESSED.search(f.path):
            out.append(Range(f.path, 0, None))
        else:
            out += [Range(f.path, at, min(at + size, f.size)) for at in range(0, f.size, size)]
    return out


def _lines(stream, start: int, end: int | None) -> Iterator[bytes]:
    """The lines that begin in a range of a stream that stands at its start, or at the byte
    before it. Lines end as Spark's do, by LF, CR or both; ranges are cut at LFs."""
    at, rest, skip = start - (start > 0), b"", start > 0
    while True:
        chunk = stream.read(READ_BYTES)
        data = rest + chunk
        low = 0
        while (cut := data.find(b"\n", low)) >= 0 or (not chunk and low < len(data)):
            high = cut if cut >= 0 else len(data)
            if not skip:
                if end is not None and at >= end:
                    return
                parts = data[low:high].split(b"\r")
                # before an LF, or the end of the file, a last CR ends no line of its own
                yield from parts[:-1] if len(parts) > 1 and not parts[-1] else parts
            skip = False
            at += high + 1 - low
            low = high + 1
        if not chunk:
            return
        rest = data[low:]


def _read(path: str, part: Range) -> Iterator[pa.RecordBatch]:
    fs, _ = _file_system(path)
    if part.end is None:
        stream = fs.open_input_stream(part.file, compression="detect")
    else:
        stream = fs.open_input_file(part.file)
        stream.seek(max(0, part.start - 1))
    with stream:
        values, n = [], 0
        for line in _lines(stream, part.start, part.end):
            values.append(line.decode("utf-8", "replace"))
            if len(values) == BATCH_LINES:
                yield _batch(values, part, n)
                n, values = n + len(values), []
        if values:
            yield _batch(values, part, n)


def _batch(values: list[str], part: Range, n: int) -> pa.RecordBatch:
    k = len(values)
    columns = [pa.array(values, pa.string()), pa.array([part.file] * k, pa.string()), pa.array([part.start] * k, pa.int64()), pa.array(range(n, n + k), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class LineSource(DataSource):
    """``spark.read.format("corpusflow_lines")``, and ``readStream``; options ``path`` and
    ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LineReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LineStream(self.options)


class _Options:
    def __init__(self, options) -> None:
        if not options.get("path"):
            raise ValueError(f"{FORMAT} needs a path")
        self.path, self.size = options["path"], int(options.get("range_bytes", RANGE_BYTES))


class LineReader(_Options, DataSourceReader):
    def partitions(self) -> list[Range]:
        # Spark takes no empty list
        return _ranges(_files(self.path), self.size) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition) if partition.file else iter([])


class LineStream(_Options, DataSourceStreamReader):
    """New files in the order of their times and names. A file has to be whole when it gets
    its name, and to be newer than those before it."""

    def _after(self, low: dict, high: dict) -> list[pafs.FileInfo]:
        def place(o: dict) -> tuple:
            return o["time"], o["file"]

        return [f for f in _files(self.path) if place(low) < (f.mtime_ns or 0, f.path) <= place(high)]

    def initialOffset(self) -> dict:
        return {"time": -1, "file": ""}

    def latestOffset(self) -> dict:
        newest = max(((f.mtime_ns or 0, f.path) for f in _files(self.path)), default=(-1, ""))
        return {"time": newest[0], "file": newest[1]}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return _ranges(self._after(start, end), self.size) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition) if partition.file else iter([])

    def commit(self, end: dict) -> None:
        pass


def register_lines(spark: SparkSession) -> None:
    """Make the format known to the session."""
    ship(spark)
    spark.dataSource.register(LineSource)


def scan_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    register_lines(spark)
    return spark.read.format(FORMAT).option("range_bytes", str(range_bytes)).load(path)


def numbered(lines: DataFrame, out: str = "position") -> DataFrame:
    """Number the rows of a line scan from 0 in file order, without moving them.

    Ranges are counted in a pass over the files, summed up, and the sums, one row per range,
    joined to the lines. ``lines`` is a whole scan; filter it afterwards.
    """
    counted = lines.select("file", "range").groupBy("file", "range").agg(F.count(F.lit(1)).alias("_rows"))
    per_file = counted.groupBy("file").agg(F.sum("_rows").alias("_rows"))
    before_file = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    before_range = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    files = per_file.select("file", F.coalesce(F.sum("_rows").over(before_file), F.lit(0)).alias("_files"))
    ranges = counted.select("file", "range", F.coalesce(F.sum("_rows").over(before_range), F.lit(0)).alias("_ranges"))
    sums = ranges.join(files, "file").select("file", "range", (F.col("_files") + F.col("_ranges")).alias("_before"))
    if counted.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES:
        sums = F.broadcast(sums)
    return lines.join(sums, ["file", "range"]).withColumn(out, F.col("_before") + F.col("line")).drop("_before")


def read_ranges(spark: SparkSession, cfg: dict) -> DataFrame:
    """JSON lines under ``path`` by byte ranges: the rows of the ``jsonl`` source. With
    ``id_fallback`` ``position`` rows without an id get the number of their line, blank and
    malformed ones counted, and no text moves for it."""
    id_field, fields = split_field_map(cfg.get("field_map"))
    fallback = cfg.get("id_fallback", "hash")
    lines = scan_lines(spark, cfg["path"], int(cfg.get("range_bytes", RANGE_BYTES)))
    if fallback in ("position", "place"):
        lines = numbered(lines, f"_{fallback}")
    rows = parse_lines(lines.drop("file", "range", "line"), {"_id": id_field, **fields})
    return _finish(rows, list(fields), fallback)


def stream_ranges(spark: SparkSession, path: str, field_map: dict[str, str]) -> DataFrame:
    """New files of JSON lines as ``source_id`` plus logical fields, for ``stream_publish``."""
    register_lines(spark)
    id_field, fields = split_field_map(field_map)
    lines = spark.readStream.format(FORMAT).load(path).select("value")
    return _finish(parse_lines(lines, {"_id": id_field, **fields}), list(fields), "hash")

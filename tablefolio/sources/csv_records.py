"""CSV files of any width as records: a Python data source for batches and for streams.

A partition is a byte range of one file and owns the records that begin in it; it reads on to the end of the last one,
wherever that lies. Whether a range begins inside quotes is known from one earlier count of quote signs per range, which
only files of more than one range need. The stream's offset is the modification time and name of the last file taken, so
a restarted stream goes on where it stopped, and files that are still being listed are never taken twice.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

RANGE_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
SCHEMA = "file_path string, range_start long, seq long, fields array<string>"
NAMES = ("file_path", "range_start", "seq", "fields")


def opened(path: str) -> io.BufferedReader:
    """A file under a plain path or URI (not encoded)."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        files, place = fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    else:
        files, place = fs.FileSystem.from_uri(path)
    return io.BufferedReader(files.open_input_file(place), 1 << 20)


@dataclass
class Range(InputPartition):
    """The records of `path` that begin in [start, end); `odd`: an odd number of quote signs lies before `start`."""

    path: str
    start: int = 0
    end: int | None = None
    odd: bool = False


def raw_records(part: Range) -> Iterator[bytes]:
    """The raw records of a range; blank lines between records are left out."""
    csv.field_size_limit((1 << 31) - 1)
    with opened(part.path) as f:
        place, odd = part.start, part.odd
        if place:
            f.seek(place - 1)
            begins = f.read(1) == b"\n" and not odd
            while not begins:  # the rest of a record that an earlier range owns
                line = f.readline()
                if not line:
                    return
                place += len(line)
                odd ^= line.count(b'"') & 1
                begins = not odd and line.endswith(b"\n")
        while part.end is None or place < part.end:
            lines, odd = [], 0
            while not lines or odd:
                line = f.readline()
                if not line:
                    break
                lines.append(line)
                odd ^= line.count(b'"') & 1
            if not lines or odd:  # the end, or a quote that is never closed
                return
            record = b"".join(lines)
            if not place:
                record = record.removeprefix(b"\xef\xbb\xbf")
            place += sum(map(len, lines))
            if record.strip(b"\r\n"):
                yield record


def read_range(part: Range | None) -> Iterator[pa.RecordBatch]:
    """Batches of the records of a range; a scan without any range asks for None."""
    rows, size, seq = [], 0, 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part.path] * len(rows)), pa.array([part.start] * len(rows), pa.int64()),
             pa.array(range(seq - len(rows), seq), pa.int64()), pa.array(rows, pa.list_(pa.string()))], names=NAMES)

    if part is None or part.end is None and not closed(part.path):
        return
    for raw in raw_records(part):
        for row in csv.reader(io.StringIO(raw.decode("utf-8", "replace"), newline="")):
            rows.append(row)
            size += len(raw)
            seq += 1
        if size >= BATCH_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def quotes(path: str, start: int = 0, end: int | None = None) -> int:
    """Quote signs in a range of a file."""
    found, left = 0, None if end is None else end - start
    with opened(path) as f:
        f.seek(start)
        while left is None or left > 0:
            block = f.read(BATCH_BYTES if left is None else min(BATCH_BYTES, left))
            if not block:
                break
            found += block.count(b'"')
            left = None if left is None else left - len(block)
    return found


def closed(path: str) -> bool:
    """Whether every quote of a file is closed."""
    return quotes(path) % 2 == 0


class RangeReader(DataSourceReader):
    def __init__(self, ranges: list[Range]):
        self.ranges = ranges

    def partitions(self) -> list[Range]:
        return self.ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(partition)


def listed(folder: str) -> list[tuple[int, str]]:
    """(modification time, path) of the files of a folder, oldest first; names that begin with . or _ are not data."""
    scheme, colon, rest = folder.partition(":")
    local = not colon or scheme == "file"
    files, place = (fs.LocalFileSystem(), "/" + (rest if colon else folder).lstrip("/")) if local else fs.FileSystem.from_uri(folder)
    found = files.get_file_info(fs.FileSelector(place, allow_not_found=True))
    return sorted((i.mtime_ns or 0, i.path if local else f"{scheme}://{i.path}") for i in found
                  if i.type == fs.FileType.File and i.base_name[0] not in "._")


class NewFiles(DataSourceStreamReader):
    """The files of a folder, each once, in the order of their modification."""

    def __init__(self, folder: str, most: int):
        self.folder, self.most, self.last = folder, most, None

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        begin = self.last or (-1, "")
        new = [x for x in listed(self.folder) if x > begin][:self.most]
        self.last = new[-1] if new else begin
        return {"time": self.last[0], "path": self.last[1]}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        self.last = max(self.last or low, high)
        return [Range(p) for t, p in listed(self.folder) if low < (t, p) <= high]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(partition)


class CsvRecords(DataSource):
    """Options: `ranges` (JSON: path, start, end, odd) for batches, `path` and `maxFiles` (of a batch) for streams."""

    @classmethod
    def name(cls) -> str:
        return "csv_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RangeReader([Range(*r) for r in json.loads(self.options["ranges"])])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return NewFiles(self.options["path"], int(self.options.get("maxFiles", 1000)))


def csv_files(spark: SparkSession, path: str) -> DataFrame:
    """file_path, length: every file under `path` with content, by Spark's own listing; paths in plain characters."""
    plain = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    known = spark.read.format("binaryFile").load(path).select("_metadata.file_path", "length")
    return known.select(F.regexp_replace(plain, "^file:///", "file:/").alias("file_path"), "length")


def read_csv_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file_path, record_idx (from 0 without gaps), fields (empty cells are empty texts).

    A file with a quote that is never closed gives no records. The driver holds a row per range, as it does for any scan.
    """
    spark.dataSource.register(CsvRecords)
    files = csv_files(spark, path)
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    cut = files.withColumn("range_start", start).withColumn("end", F.least(F.col("range_start") + range_bytes, F.col("length")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [quotes(*x) for x in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())],
                                             names=["file_path", "range_start", "end", "quotes"])

    several = cut.where(F.col("length") > range_bytes).select("file_path", "range_start", "end")
    spread = several.repartition("file_path", "range_start").mapInArrow(counted, "file_path string, range_start long, end long, quotes long")
    before = Window.partitionBy("file_path").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    known = spread.withColumns({"odd": F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1,
                                "total": F.sum("quotes").over(Window.partitionBy("file_path"))}).where("total % 2 = 0")
    whole = cut.where(F.col("length") <= range_bytes).select(
        "file_path", "range_start", F.lit(None).cast("long").alias("end"), F.lit(False).alias("odd"))
    ranges = [tuple(r) for r in whole.unionByName(known.select("file_path", "range_start", "end", "odd")).collect()]
    read = spark.read.format("csv_records").option("ranges", json.dumps(ranges)).load()
    if all(end is None for _, _, end, _ in ranges):
        return read.select("file_path", F.col("seq").alias("record_idx"), "fields")
    sizes = read.groupBy("file_path", "range_start").agg(F.count("*").alias("n"))
    done = sizes.select("file_path", "range_start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("done"))
    return read.join(done, ["file_path", "range_start"]).select("file_path", (F.col("done") + F.col("seq")).alias("record_idx"), "fields")

"""WARC archives of pages: deterministic shards in id order, records for repeated payloads, files of a bounded size.

* Pages are sorted by id into shards of about `SHARD_BYTES` of payload. The borders come from an exact histogram of ids,
  not from a sample, so the same pages always give the same files. A histogram row covers `BUCKET` ids.
* A task writes its shards from sorted rows one record at a time, each a gzip member of its own, and begins a new file
  when the compressed size reaches `ROLL_BYTES`. Record ids, digests and lengths are made from the content.
* Of pages with equal payloads of at least `REVISIT_BYTES`, the one with the largest id is the response, the others are
  revisits that name it. Which ones they are is found without the payloads; a note about each travels to its shard and
  is sorted before it, so payloads are shuffled once.
* A file is written under a temporary name and renamed when complete. The manifest, a Parquet table, is written last and
  names all files with their SHA-256; readers open nothing else. A lost task writes the same files again.

Defined results: a null html is an empty payload, a null url an empty address; null ids come first and have no id in
their record; rows with equal id and payload are records of their own, all responses if that id is the largest; control
characters in addresses are percent-encoded; other columns are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefolio.llm.common import NO_ID, at, bound_batches, committed

SHARD_BYTES, ROLL_BYTES, REVISIT_BYTES = 64 << 20, 32 << 20, 1000
BUCKET, SPAN = 256, 4096
RECORD_OVERHEAD = 1024
# fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id: int | None, payload_sha1: str, repeat: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{payload_sha1}:{repeat}')}>"


def address(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), f"WARC-Block-Digest: {base32(hashlib.sha1(block).digest())}",
             f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str, payload: bytes, sha1: str, date: str, refers: tuple[int, str] | None,
                repeat: int = 0) -> bytes:
    """A response, or a revisit of the page `refers` = (id, url)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", record_id(page_id, sha1, repeat)),
              ("WARC-Date", date), ("WARC-Target-URI", address(url)), ("WARC-Payload-Digest", base32(bytes.fromhex(sha1))),
              ("Content-Type", "application/http; msgtype=response"), ("X-Page-ID", page_id)]
    if refers:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers[0], sha1)),
                   ("WARC-Refers-To-Target-URI", address(refers[1])), ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-ID", refers[0])]
    return record(fields, http if refers else http + payload)


class Roller:
    """Files of one shard: a new one when the last has reached its size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str):
        self.folder, self.shard, self.roll_bytes, self.date = folder, shard, roll_bytes, date
        self.files: list[dict] = []
        self.open = None

    def add(self, data: bytes, page_id: int | None) -> None:
        if self.open is None:
            name = f"shard-{self.shard:06d}-{len(self.files):04d}.warc.gz"
            self.files.append({"file": name, "records": 0, "bytes": 0, "first_id": page_id})
            self.open, self.sha = committed(self.folder, name), hashlib.sha256()
            self.out = self.open.__enter__()
            info = b"software: tablefolio\r\nformat: WARC File Format 1.1\r\n"
            self._put(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
                              ("WARC-Date", self.date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))
        self._put(data)
        self.files[-1]["records"] += 1
        self.files[-1]["last_id"] = page_id
        if self.files[-1]["bytes"] >= self.roll_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.files[-1]["bytes"] += len(data)

    def close(self) -> None:
        if self.open is not None:
            self.open.__exit__(None, None, None)
            self.files[-1]["sha256"] = self.sha.hexdigest()
            self.open = None


MANIFEST = "file string, records long, bytes long, first_id long, last_id long, sha256 string"


def shard_borders(pages: DataFrame, shard_bytes: int) -> list[int]:
    """First bucket of each shard: one number for each `shard_bytes` of payload."""
    buckets = pages.groupBy(F.floor(F.col("k") / BUCKET).alias("bucket")).agg(F.sum(F.col("size") + RECORD_OVERHEAD).alias("size"))
    buckets = buckets.withColumn("span", F.floor(F.col("bucket") / SPAN))
    before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # a row for each BUCKET * SPAN ids
    spans = buckets.groupBy("span").agg(F.sum("size").alias("size")).select("span", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("span").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.select("span", "bucket", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("at")).join(spans, "span")
    firsts = placed.groupBy(F.floor((F.col("base") + F.col("at")) / shard_bytes).alias("shard")).agg(F.min("bucket").alias("first"))
    return sorted(r["first"] for r in firsts.collect())


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               date: str = "1970-01-01T00:00:00Z", shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write all pages to `folder` and give the manifest."""
    spark = pages.sparkSession
    bound_batches(spark)
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("k"),
                        F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("size"))
    slim = rows.select("id", "k", "url", "sha1", "size")
    borders = np.array(shard_borders(slim, shard_bytes), np.int64)

    @F.pandas_udf(T.IntegerType())
    def shard(k: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(borders, np.floor_divide(k.to_numpy(), BUCKET), side="right") - 1, 0))

    # which pages repeat an earlier payload, without the payloads
    large = slim.where(F.col("size") >= REVISIT_BYTES)
    latest = large.groupBy("sha1", "size").agg(F.max(F.struct("id", "url")).alias("latest"), F.count("*").alias("n")).where("n > 1")
    notes = large.join(latest, ["sha1", "size"]).where(~F.col("id").eqNullSafe(F.col("latest.id"))).select(
        "id", "k", F.lit(0).alias("kind"), "sha1", F.col("latest.url").alias("url"), F.col("latest.id").alias("refers"),
        F.lit(None).cast("binary").alias("payload")).distinct()
    full = rows.select("id", "k", F.lit(1).alias("kind"), "sha1", "url", F.lit(None).cast("long").alias("refers"), "payload")
    dealt = full.unionByName(notes).select(shard("k").alias("shard"), "*").repartition("shard").sortWithinPartitions(
        "shard", "k", F.col("id").isNotNull(), "sha1", "kind", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, note, last, repeat = None, (None, None), None, 0

        def done() -> Iterator[pa.RecordBatch]:
            if roller:
                roller.close()
                yield pa.RecordBatch.from_pylist(roller.files, schema=pa.schema(
                    [("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("first_id", pa.int64()),
                     ("last_id", pa.int64()), ("sha256", pa.string())]))

        for batch in batches:
            for row in (r for i in range(0, batch.num_rows, 64) for r in batch.slice(i, 64).to_pylist()):
                if roller is None or roller.shard != row["shard"]:
                    yield from done()
                    roller = Roller(folder, row["shard"], roll_bytes, date)
                key = (row["id"], row["sha1"])
                if row["kind"] == 0:
                    note = (key, (row["refers"], row["url"]))
                    continue
                repeat = repeat + 1 if key == last else 0
                last = key
                roller.add(page_record(row["id"], row["url"], row["payload"], row["sha1"], date,
                                       note[1] if note[0] == key else None, repeat), row["id"])
        yield from done()

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def records(folder: str, name: str) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields, block) of each record of a file; one record is in memory at a time."""
    files, base = at(folder)
    with files.open_input_stream(f"{base}/{name}", compression=None) as source:
        offset, pending = 0, b""
        while True:
            unpacker, parts, used = zlib.decompressobj(31), [], 0
            while not unpacker.eof:
                data = pending or source.read(1 << 20)
                pending = b""
                if not data:
                    if used:
                        raise ValueError(f"{name}: cut off at {offset}")
                    return
                parts.append(unpacker.decompress(data))
                used += len(data) - len(unpacker.unused_data)
            pending = unpacker.unused_data
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield offset, used, fields, rest[:int(fields["Content-Length"])]
            offset += used


def read_warc(spark: SparkSession, folder: str, id_col: str = "page_id", keep: bool = False) -> DataFrame:
    """Each page record of a complete folder, digests checked: `id_col`, payload_bytes, payload_digest, record_type,
    refers_to, target_uri, file, offset, length; with `keep` also the payload (null for revisits)."""
    schema = f"{id_col} long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, file string, offset long, length long"
    schema += ", payload binary" if keep else ""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])

    def number(fields: dict[str, str], name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                for offset, length, fields, block in records(folder, name):
                    if fields["WARC-Block-Digest"] != base32(hashlib.sha1(block).digest()):
                        raise ValueError(f"{name}: wrong digest at {offset}")
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    revisit = fields["WARC-Type"] == "revisit"
                    sha1 = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                    if not revisit and hashlib.sha1(payload).digest() != sha1:
                        raise ValueError(f"{name}: wrong payload digest at {offset}")
                    row = {id_col: number(fields, "X-Page-ID"), "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
                           "payload_digest": sha1.hex(), "record_type": fields["WARC-Type"], "refers_to": number(fields, "X-Refers-To-Page-ID"),
                           "target_uri": fields["WARC-Target-URI"], "file": name, "offset": offset, "length": length}
                    rows.append(row | ({"payload": None if revisit else payload} if keep else {}))
                    size += len(payload) * keep + 300
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file")
    return files.repartition(max(1, files.count()), "file").mapInArrow(read, schema)

"""Token ids on disk: one zstandard frame per document, all with one dictionary, and an index to reach each of them.

A folder holds
* `dictionary.zdict`: trained on the id arrays of a bounded sample of documents (`sample_docs` documents with the
  smallest hash, `sample_tokens` ids of each at most). Only the size of the files depends on it, not their content.
* `part-NNNNN.ids`: documents in ascending id order. Header (magic, length, JSON with the dictionary's SHA-256, the
  width of an id, the end id), frames, then the index: per document id, null mark, offset and length of its frame,
  number of ids, ids before it in this file; last the place of the index, the number of documents and the magic.
* `manifest`: a Parquet table with a row per file: name, documents, ids, bytes, SHA-256, and `base`, the ids in all
  files before it. It is written last, so a folder without it is not complete.

Defined results: a null text has the end id only; null ids come first; rows with equal ids are ordered by a hash of
their text, so repeated rows stand together; other columns are ignored; an empty table gives a folder without parts.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablefolio.llm.bpe import bounded, codec
from tablefolio.llm.common import at, bound_batches, committed

MAGIC = b"TFIDS001"
TAIL = "<QQ8s"
INDEX = np.dtype([("id", "<i8"), ("none", "u1"), ("offset", "<u8"), ("length", "<u4"), ("tokens", "<u8"), ("start", "<u8")])
LEVEL = 3
SAMPLE_DOCS, SAMPLE_TOKENS, DICTIONARY_BYTES = 512, 16_384, 65_536


def train_dictionary(docs: DataFrame, path: str, id_col: str, text_col: str, width: str, end_id: int,
                     sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS,
                     dictionary_bytes: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary for serialized id arrays; empty if the sample is too small to train one."""
    tagged = docs.select(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    last = tagged.select("h").distinct().orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    if last is None:
        return b""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            raw = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            ids = [serialized(c.encode([t])[0], end_id, width)[:sample_tokens * int(width[2:])] for t in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["h", "ids"])

    sample = tagged.where(F.col("h") <= last).dropDuplicates(["h"]).mapInArrow(encode, "h long, ids binary")
    arrays = [r.ids for r in sample.orderBy("h").collect()]
    try:
        return zstandard.train_dictionary(dictionary_bytes, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def serialized(ids: bytes, end_id: int, width: str) -> bytes:
    return np.append(np.frombuffer(ids, "<u4"), end_id).astype(width).tobytes()


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              parts: int | None = None) -> DataFrame:
    """Encode all texts, write them to `folder`, and give the manifest."""
    spark = docs.sparkSession
    bound_batches(spark)
    size = max(codec(path).tok.get_vocab_size(with_added_tokens=True), end_id + 1)
    width = "<u2" if size <= 1 << 16 else "<u4"
    trained = train_dictionary(docs, path, id_col, text_col, width, end_id)
    mark = hashlib.sha256(trained).hexdigest()
    with committed(folder, "dictionary.zdict") as out:
        out.write(trained)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        c, name = codec(path), f"part-{TaskContext.get().partitionId():05d}.ids"
        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        index, start, sha = [], 0, hashlib.sha256()
        with committed(folder, name) as out:
            def put(data: bytes) -> None:
                out.write(data)
                sha.update(data)

            head = json.dumps({"dictionary_sha256": mark, "width": width, "end_id": end_id}, sort_keys=True).encode()
            put(MAGIC + struct.pack("<I", len(head)) + head)
            place = len(MAGIC) + 4 + len(head)
            for batch in (b for many in ([first], batches) for b in many):
                keys, raw = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
                for part in bounded(raw):
                    for key, ids in zip(keys[part].to_pylist(), c.encode([t or b"" for t in raw[part]]), strict=True):
                        frame = packer.compress(serialized(ids, end_id, width))
                        n = len(ids) // 4 + 1
                        put(frame)
                        index.append((key or 0, key is None, place, len(frame), n, start))
                        place, start = place + len(frame), start + n
            put(np.array(index, INDEX).tobytes())
            put(struct.pack(TAIL, place, len(index), MAGIC))
        total = place + len(index) * INDEX.itemsize + struct.calcsize(TAIL)
        yield pa.RecordBatch.from_pylist([{"file": name, "docs": len(index), "tokens": start, "bytes": total,
                                           "sha256": sha.hexdigest()}], schema=pa.schema(
            [("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    placed = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    made = placed.sortWithinPartitions(*keys).mapInArrow(
        write, "file string, docs long, tokens long, bytes long, sha256 string")
    made.write.parquet(f"{folder}/_files")  # the files are written once, here
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = spark.read.schema(made.schema).parquet(f"{folder}/_files")
    files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, folder: str, name: str):
        files, base = at(folder)
        self.file = files.open_input_file(f"{base}/{name}")
        size = self.file.size()
        place, n, magic = struct.unpack(TAIL, self._bytes(size - struct.calcsize(TAIL), struct.calcsize(TAIL)))
        head = self._bytes(0, len(MAGIC) + 4)
        if magic != MAGIC or head[:len(MAGIC)] != MAGIC:
            raise ValueError(f"{name}: not an id file")
        self.about = json.loads(self._bytes(len(head), struct.unpack("<I", head[len(MAGIC):])[0]))
        self.index = np.frombuffer(self._bytes(place, n * INDEX.itemsize), INDEX)
        with files.open_input_file(f"{base}/dictionary.zdict") as f:
            trained = f.read()
        if hashlib.sha256(trained).hexdigest() != self.about["dictionary_sha256"]:
            raise ValueError(f"{name}: written with another dictionary")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)

    def _bytes(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.index)

    def ids(self, i: int) -> np.ndarray:
        """Ids of the i-th document of this file, as unsigned 32-bit integers."""
        row = self.index[i]
        data = self.unpacker.decompress(self._bytes(int(row["offset"]), int(row["length"])),
                                        max_output_size=int(row["tokens"]) * int(self.about["width"][2:]))
        return np.frombuffer(data, self.about["width"]).astype("<u4")

    def position(self, doc_id: int) -> int:
        """Where a document is in this file; ids ascend behind the rows without one."""
        first = int(self.index["none"].sum())
        i = first + int(np.searchsorted(self.index["id"][first:], doc_id))
        if i >= len(self) or int(self.index["id"][i]) != doc_id:
            raise KeyError(doc_id)
        return i


def read_ids(spark: SparkSession, folder: str, id_col: str = "doc_id", keep: bool = False) -> DataFrame:
    """Each document of a complete folder: id, `start` (ids of all documents before it), `n_tokens`, `ids_crc32`;
    with `keep` also `ids` as little-endian unsigned 32-bit integers."""
    names = [id_col, "start", "n_tokens", "ids_crc32", *(["ids"] if keep else [])]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = Reader(folder, name)
                for begin in range(0, len(reader), 1000):
                    some = reader.index[begin:begin + 1000]
                    ids = [reader.ids(begin + i).tobytes() for i in range(len(some))]
                    columns = [pa.array(some["id"], mask=some["none"].astype(bool)),
                               pa.array(some["start"].astype("i8") + base), pa.array(some["tokens"].astype("i8")),
                               pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.binary())] if keep else []), names=names)

    files = spark.read.parquet(f"{folder}/manifest").select("file", "base")
    return files.repartition(max(1, files.count()), "file").mapInArrow(
        read, f"{id_col} long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep else ""))

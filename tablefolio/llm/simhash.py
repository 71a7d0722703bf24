"""Near-duplicate documents by SimHash fingerprints of 64 bits.

1. Each text becomes one fingerprint: a bit is set if it is set in over half the hashes of its shingles, repeats
   included. Texts with equal fingerprints are one class, so groups of copies cost one row each.
2. A fingerprint has `BLOCKS` blocks of 16 bits. `RADIUS` differing bits touch at most as many blocks, so two close
   fingerprints agree in the other two blocks at least: each of the six choices of two blocks is a table, its key the bits
   of these blocks. Fingerprints that share a key meet, and pairs are verified by Hamming distance.
3. Most keys have one holder and go at once. Holders of keys with up to `SMALL` are compared in one short array. Beyond
   that, a key is split exactly and without pairs: its holders are dealt to the values that differ from them in at most
   one bit. Two fingerprints within two bits of each other share such a value, and no more than 33 fingerprints of a key
   can share one; they link to the smallest of them. Keys with more than 1 / `SHARE` of all classes, at most 6 x `SHARE`
   in number, are recognised by a broadcast list and never shuffled by key.
4. Links form components; the smallest id reachable names them.

Defined results: a null or empty text has fingerprint zero and is linked like any other; fewer words than a shingle are
one shingle; repeated rows give repeated rows; rows with one id are one document, which links through each of its texts;
rows without id link like others, name no component, and have a null component where nobody else names it; other columns
are ignored; an empty table gives an empty table. Ids of any type that has an order.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.llm.common import bound_batches
from tablefolio.llm.minhash import components
from tablefolio.llm.wordlists import PIECE, WHITE, word_lists
from tablefolio.session import written

SHINGLE, SEED = 3, 42
BLOCKS, WIDTH, RADIUS = 4, 16, 2
SMALL, SHARE = 32, 500


def fingerprint(text: bytes, piece: int = PIECE) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit integer."""
    counts, n, last = np.zeros(64, np.int64), 0, []

    def add(hashes: list[int]) -> int:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add(counts, bits.sum(axis=0, dtype=np.int64), out=counts)
        return len(hashes)

    for words in word_lists(text, WHITE, piece):
        words = last + words
        if len(words) >= SHINGLE:
            n += add([xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(SHINGLE)), strict=False)])
        last = words[1 - SHINGLE:]
    if not n and last:
        n = add([xxhash.xxh64_intdigest(b" ".join(last), SEED)])
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, fp) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, f"id {kind}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def tables() -> list[tuple[int, list[int]]]:
    """For each table the mask of its blocks, and the changes of at most one bit outside them."""
    out = []
    for chosen in combinations(range(BLOCKS), BLOCKS - RADIUS):
        mask = sum(((1 << WIDTH) - 1) << (WIDTH * b) for b in chosen)
        free = [1 << b for b in range(BLOCKS * WIDTH) if not mask >> b & 1]
        out.append((_signed(mask), [0, *map(_signed, free)]))
    return out


def close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= RADIUS


def close_pairs(fps: DataFrame, small: int = SMALL, share: int = SHARE) -> DataFrame:
    """(a, b), a < b: links between the distinct fingerprints `fp` whose components are those of all pairs within
    `RADIUS` bits. Pairs that meet in short keys are all there; those of long keys are there or linked through a third."""
    masks = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(mask).alias("mask")) for t, (mask, _) in enumerate(tables())])
    rows = fps.select("fp", F.explode(masks).alias("x")).select("x.t", F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"), "fp")
    shared = written(rows.groupBy("t", "key").agg(F.count("*").alias("members")).where("members > 1"), "simhash-keys")
    limit = max(small, fps.count() // share)
    hot = rows.join(F.broadcast(shared.where(F.col("members") > limit).select("t", "key")), ["t", "key"])
    met = rows.join(shared.where(F.col("members") <= limit), ["t", "key"])

    short = met.where(F.col("members") <= small).groupBy("t", "key").agg(F.collect_list("fp").alias("xs"))
    pairs = short.select(F.explode(F.flatten(F.transform("xs", lambda x: F.transform(
        F.filter("xs", lambda y: (y > x) & close(x, y)), lambda y: F.struct(x.alias("a"), y.alias("b"))))))).select("col.a", "col.b")

    changes = F.array(*[F.array(*[F.lit(c) for c in free]) for _, free in tables()])
    long = met.where(F.col("members") > small).select("t", "fp").unionByName(hot.select("t", "fp"))
    around = long.select("t", "fp", F.explode(F.element_at(changes, F.col("t") + 1)).alias("change")).select(
        "t", "fp", F.col("fp").bitwiseXOR(F.col("change")).alias("value"))
    stars = around.groupBy("t", "value").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("xs")).where(
        F.size("xs") > 1).select("a", F.explode("xs").alias("b")).where((F.col("a") < F.col("b")) & close(F.col("a"), F.col("b")))
    return pairs.unionByName(stars).distinct()


def looked_up(rows: DataFrame, names: DataFrame, key: str, total: int, share: int = SHARE) -> DataFrame:
    """`rows` with the columns of `names` (one row per key; `size`: the rows that ask for it). Keys that more than
    1 / `share` of the rows ask for, at most `share` in number, are broadcast; the others meet in a shuffle."""
    hot = F.broadcast(names.where(F.col("size") * share > total).drop("size"))
    cool = names.where(F.col("size") * share <= total).drop("size")
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cool, key))


def near_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL,
                      share: int = SHARE) -> DataFrame:
    """Per row: `id_col`, `fingerprint` (16 hexadecimal digits), `component_id`."""
    spark = docs.sparkSession
    bound_batches(spark)
    found = written(fingerprints(docs, id_col, text_col), "simhash-fingerprints")
    classes = written(found.groupBy("fp").agg(F.count("*").alias("size"), F.min("id").alias("least")), "simhash-classes")
    several = found.where("id IS NOT NULL").groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).where("a < last")
    same_id = found.join(several.select("id", "a"), "id").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    links = written(close_pairs(classes.select("fp"), small, share).unionByName(same_id), "simhash-links")

    comps = components(spark, links)
    placed = written(classes.join(comps, classes.fp == comps.id, "left").select(
        "fp", F.col("size").alias("copies"), "least", F.coalesce("comp", "fp").alias("comp")), "simhash-placed")
    named = placed.groupBy("comp").agg(F.count("*").alias("size"), F.min("least").alias("component_id"))
    labels = written(looked_up(placed.select("fp", "copies", "comp"), named, "comp", placed.count(), share).select(
        "fp", F.col("copies").alias("size"), "component_id"), "simhash-labels")
    return looked_up(found, labels, "fp", found.count(), share).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Resampling documents by importance: how much likelier a target distribution makes the features of each.

1. Features are words and pairs of neighbouring words, hashed to `BUCKETS` buckets. One scan of the documents and one of
   the target count the buckets, added up within each task before they are shuffled.
2. A bucket's gain is the scaled logarithm of its smoothed share in the target over that in the documents. All gains are
   one array of `BUCKETS` integers; a second scan scores each document by it: the floored mean over its features.
3. A score is the weight plus Gumbel noise that depends on the id alone, so the highest scores are a draw without
   replacement in proportion to exp(weight / 1000).
4. The last score that is drawn is found by a distributed quickselect over composite keys (score, id, row), which have no
   ties: random pivot keys split what is left, exact counts of what lies below, on and above each pivot tell where the
   k-th key is, and the next round looks only there. The driver sees pivots and counts, nothing else.
5. Winners alone are sorted, by ranges of keys, and ranked: place in the range plus the sizes of the ranges before.

Defined results: a null or empty text has no features and weight 0; rows without id have a weight but neither score nor
rank, and do not count among those drawn from; repeated rows are drawn and ranked one by one; null or empty target texts
add nothing; other columns are ignored; empty tables count as no features; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.llm.common import bound_batches
from tablefolio.llm.wordlists import PIECE, TERMS, word_lists
from tablefolio.session import written

BUCKETS = 10_000
PIVOTS = 31
RANGE_ROWS = 200_000


def buckets(text: bytes, piece: int = PIECE) -> Iterator[np.ndarray]:
    """The buckets of all features of a UTF-8 text, piece by piece."""
    last = None
    for words in word_lists(text, TERMS, piece):
        if not words:
            continue
        single = [crc32(w) for w in words]
        before = [crc32(b" ", c) for c in ([last] if last is not None else []) + single]
        found = single + [crc32(w, c) for w, c in zip(words[last is None:], before, strict=False)]
        yield (np.array(found, np.uint32) % np.uint32(BUCKETS)).astype(np.int64)
        last = single[-1]


def bucket_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(bucket, n): all features of all texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                for found in buckets(text or b""):
                    total += np.bincount(found, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    return texts.select(F.col(text_col).alias("text")).mapInArrow(scan, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text") -> list[int]:
    """The gain of each bucket; the driver gets `BUCKETS` rows, whatever the tables hold."""
    sides = bucket_counts(docs, text_col).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(
        bucket_counts(target, target_col).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t")))
    rows = sides.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    held = {r.bucket: (r.s, r.t) for r in rows}
    all_s, all_t = (float(sum(x[i] for x in held.values()) + BUCKETS) for i in (0, 1))
    pairs = [held.get(b, (0, 0)) for b in range(BUCKETS)]
    ratio = [float(t + 1) * all_s / (float(s + 1) * all_t) for s, t in pairs]
    return [int(x) for x in np.floor(1000 * np.log(ratio))]


def weights(docs: DataFrame, gain: list[int], id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    array = np.array(gain, np.int64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                size = total = 0
                for found in buckets(text or b""):
                    size += len(found)
                    total += int(array[found].sum())
                sizes.append(size)
                sums.append(total // size if size else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                                             names=["id", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scan, f"id {kind}, n_features long, weight long")
    return out.withColumn("n_words", F.floor((F.col("n_features") + 1) / 2).cast("long"))  # n words and n - 1 pairs


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, the same for an id whenever it is asked."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def kth_key(rows: DataFrame, order: list[str], k: int, pivots: int = PIVOTS) -> tuple:
    """The k-th least (from 1) of the keys `order` of all rows, which have no nulls; k is at most the number of rows."""
    kinds = [rows.schema[c].dataType for c in order]
    key = F.struct(*order)

    def literal(found: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(found, kinds, order, strict=True)])

    inside, left = rows.select(*order), k
    for turn in count():
        chosen = sorted({tuple(r) for r in inside.orderBy(F.xxhash64(*order, F.lit(turn)), *order).limit(pivots).collect()})
        held = F.array(*map(literal, chosen))
        place = 2 * F.size(F.filter(held, lambda p: p < key)) + F.array_contains(held, key).cast("int")
        sizes = {r.place: r["count"] for r in inside.groupBy(place.alias("place")).count().collect()}
        for at in range(2 * len(chosen) + 1):  # even: between two pivots, odd: on one
            if left <= sizes.get(at, 0):
                break
            left -= sizes.get(at, 0)
        else:
            raise ValueError("fewer rows than k")
        if at % 2:
            return chosen[at // 2]
        low, high = at // 2 - 1, at // 2
        inside = inside.where(key > literal(chosen[low])) if low >= 0 else inside
        inside = inside.where(key < literal(chosen[high])) if high < len(chosen) else inside


def ranked(winners: DataFrame, order: list[str], rows: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """`winners` with `rank` from 1 in the order of their keys; no task gets more than a range."""
    dealt = written(winners.repartitionByRange(rows // range_rows + 1, *order).withColumn("part", F.spark_partition_id()),
                    "resample-ranges")
    sizes = dealt.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + place).drop("part", "start")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = 25, least_words: int = 20, seed: int = 7, pivots: int = PIVOTS,
             range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every row of `docs`: `id_col`, `n_features`, `weight`, `score`, and `rank` of the drawn `percent` of those that have
    `least_words` words."""
    bound_batches(docs.sparkSession)
    gain = gains(docs, target, text_col, target_col)
    scored = weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = written(scored.withColumn("below", -F.col("score")).withColumn("row", F.monotonically_increasing_id()),
                     "resample-scores")
    eligible = F.coalesce((F.col("n_words") >= least_words) & F.col("id").isNotNull(), F.lit(False))
    k = percent * scored.where(eligible).count() // 100
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    order = ["below", "id", "row"]
    last = kth_key(scored.where(eligible), order, k, pivots)
    limit = F.struct(*[F.lit(v).cast(scored.schema[c].dataType).alias(c) for v, c in zip(last, order, strict=True)])
    drawn = eligible & F.coalesce(F.struct(*order) <= limit, F.lit(False))
    winners = ranked(scored.where(drawn), order, k, range_rows)
    return scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")).unionByName(
        winners.select(*columns, "rank"))

"""Near-duplicate documents by b-bit MinHash over word shingles.

1. Each text becomes its set of distinct shingles of `SHINGLE` words. One permutation of the shingles deals them into
   `BANDS` x `ROWS` bins; each bin keeps its least hash, and an empty bin borrows from a bin that a fixed probing order
   of its own names. Of each minimum only the low 8 bits stay. Eight of them are packed into one long: the signature is
   an array of `BANDS` longs, and each long is one band.
2. Documents with equal sets are one class; its smallest id stands for it. So groups of copies cost one row each.
3. Classes that share a band are candidates. In each bucket of a band all members meet the one member that meets most
   others (its hub), not each other. Two signatures give the number of equal low bytes by bit counts; corrected for
   chance agreement (1/256) it estimates the similarity, and pairs clearly below the wanted one go.
4. Remaining candidates are confirmed on their full sets, and confirmed links form components.
5. In buckets that still hold members of different components these meet too, block by block: a pair counts at the
   first band it shares, if its estimate is high enough and neither is the bucket's hub. Members that meet anyone send
   their text once for each pair of blocks; the pairs are confirmed there and never leave it. Only links that join two
   components do, so a block gives fewer rows than it has members. Members that are linked already meet no more.

A link of similarity 0.85 is missed by all bands with a chance of (1 - 0.85^8)^48 = 2.4e-7, and dropped by the estimate,
five standard errors below, more rarely still.

Defined results: null and empty texts have an empty set and stay alone; fewer words than a shingle are one shingle; rows
without id link with nothing and are kept; rows with equal ids are linked, whatever their texts, if they have words; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefolio.llm.bpe import bounded
from tablefolio.llm.common import bound_batches
from tablefolio.session import written

SHINGLE, BANDS, ROWS, BITS = 5, 48, 8, 8
BINS = BANDS * ROWS
SIGMAS = 5
BLOCK = 4096
SET_BLOCK = 1 << 20
HOT = 1000
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text; ASCII letters in lower case."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = _mixed(out * np.uint64(MIX[0]) + h[k:k + n])
    return np.unique(out)


def probes(count: int = BINS, seed: int = 6) -> np.ndarray:
    """For each bin the order in which it looks for a bin to borrow from."""
    rng = np.random.default_rng(seed)
    return np.argsort(rng.random((count, count)), axis=1).astype(np.int16)


def signature(hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """`BANDS` longs with the low 8 bits of `BINS` minima."""
    x = _mixed(hashes)
    bins = ((x >> np.uint64(32)) % np.uint64(BINS)).astype(np.int64)
    least = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bins, x)
    full = np.zeros(BINS, bool)
    full[bins] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        looked = order[empty]
        least[empty] = least[looked[np.arange(len(empty)), np.argmax(full[looked], axis=1)]]
    low = (_mixed(least) & np.uint64(0xFF)).astype(np.uint8)
    return low.view("<i8")


def features(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Per row: id, a hash of the text, size of the set, a 128-bit digest of the set in two longs, the signature (null for
    empty sets)."""
    names = ["id", "h", "n", "fp1", "fp2", "sig"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = probes()
        for batch in batches:
            raw = batch.column(2).cast(pa.binary()).to_pylist()
            for part in bounded(raw, 8_000_000):
                found = []
                for t in raw[part]:
                    s = shingles(t or b"", size)
                    if len(s) == 0:
                        found.append((0, None, None, None))
                        continue
                    fp = np.frombuffer(hashlib.md5(s.tobytes()).digest(), "<i8")
                    found.append((len(s), int(fp[0]), int(fp[1]), signature(s, order)))
                n, fp1, fp2, sig = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], batch.column(1)[part], pa.array(n, pa.int64()), pa.array(fp1, pa.int64()),
                     pa.array(fp2, pa.int64()), pa.array(sig, pa.list_(pa.int64()))], names=names)

    return keyed_texts(docs, id_col, text_col).mapInArrow(scan, "id long, h long, n long, fp1 long, fp2 long, sig array<long>")


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of signatures (last axis: `BANDS` longs): equal low bytes by bit counts, less those equal by chance."""
    x = a ^ b
    for shift in (4, 2, 1):  # the lowest bit of each byte tells whether any bit of it differs
        x = x | (x >> np.uint64(shift))
    differing = np.bitwise_count(x & np.uint64(0x0101010101010101)).sum(axis=-1, dtype=np.int64)
    chance = 2.0 ** -BITS
    return ((BINS - differing) / BINS - chance) / (1 - chance)


def _signatures(column: pa.Array) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, BANDS)


def least_estimate(similarity: float) -> float:
    """Below this estimate a pair is not of the wanted similarity, by `SIGMAS` standard errors."""
    chance = 2.0 ** -BITS
    agree = chance + (1 - chance) * similarity
    return similarity - SIGMAS * sqrt(agree * (1 - agree) / BINS) / (1 - chance)


def components(spark: SparkSession, nodes_of_links: DataFrame) -> DataFrame:
    """(id, comp) for the nodes of `a`, `b` links: comp is the smallest id reachable.

    Each round every node takes the least label around it and then the label of its label, so the number of rounds
    grows with the logarithm of the longest path. Minima are taken before the shuffle, so a node with very many links
    sends few rows.
    """
    both = written(nodes_of_links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(
        nodes_of_links.select("b", "a")).distinct(), "minhash-links")
    labels = written(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("comp"))
                     .withColumnRenamed("x", "id"), "minhash-labels")
    while True:
        around = both.join(labels, both.y == labels.id).groupBy("x").agg(F.min("comp").alias("least"))
        near = labels.join(around, labels.id == around.x).select(
            "id", F.col("comp").alias("old"), F.least("comp", "least").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        new = written(near.join(jump, "comp", "left").select(
            "id", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp")), "minhash-labels")
        if new.where("old <> comp").limit(1).count() == 0:
            return new.select("id", "comp")
        labels = new.select("id", "comp")


def texts_of(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """One row (id, h, text) for each of the wanted (id, h)."""
    return keyed_texts(docs, id_col, text_col).join(wanted.select("id", "h"), ["id", "h"], "left_semi").dropDuplicates(["id", "h"])


def confirmed(pairs: DataFrame, keys: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough: 100 * common >= percent * union. `keys` (node, id, h)
    tells which of the `texts` (id, h, text) stands for a class."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hubs, others = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
            keep = np.zeros(len(a), bool)
            for i in range(len(a)):
                if a[i] != last:
                    last, hub = a[i], shingles(hubs[i].as_py(), size)
                other = shingles(others[i].as_py(), size)
                common = len(np.intersect1d(hub, other, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(hub) + len(other) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    both = pairs
    for side in "ab":  # by the columns that the texts are dealt by already
        both = both.join(keys.select(F.col("node").alias(side), F.col("id").alias(f"i{side}"), F.col("h").alias(f"h{side}")), side)
    for side in "ab":
        key = [f"i{side}", f"h{side}"]
        both = both.join(texts.select(F.col("id").alias(key[0]), F.col("h").alias(key[1]), F.col("text").alias(f"t{side}")), key)
    return both.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def candidates(i: int, ids: np.ndarray, own: np.ndarray, sig: np.ndarray, hub: int, band: int, two_blocks: bool,
               least: float) -> np.ndarray:
    """The members after the i-th one (by id) that it meets in this bucket: at their first common band, in the other block
    if there are two, with a high estimate. The hub meets nobody, as it has met all."""
    if ids[i] == hub:
        return np.zeros(0, np.int64)
    other = (ids > ids[i]) & (ids != hub)
    if two_blocks:
        other &= own != own[i]
    j = np.flatnonzero(other)
    if band and len(j):
        j = j[~(sig[j, :band] == sig[i, :band]).any(axis=1)]
    return j[estimate(sig[j], sig[i]) >= least] if len(j) else j


def meeting(members: DataFrame, least: float, block: int, set_block: int) -> DataFrame:
    """Those of the members (band, key, hub, m, shingles, id, comp, sig) that meet one of another component, with the pair
    of blocks `lo`, `hi` in which they do.

    A bucket is dealt into blocks of about `block` members and `set_block` shingles (`m` and `shingles` are those of the
    bucket), and each pair of blocks is a group of its own, so no task holds more than two blocks of a bucket.
    """
    blocks = F.ceil(F.greatest(F.col("m") / block, F.col("shingles") / set_block)).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = members.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        "band", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "hub", "id", "comp",
        "sig")

    def met(table: pa.Table) -> pa.Table:
        ids, comp, own = (table[c].to_numpy() for c in ("id", "comp", "own"))
        band, lo, hi, hub = (table[c][0].as_py() for c in ("band", "lo", "hi", "hub"))
        sig, keep = _signatures(table["sig"]), np.zeros(len(ids), bool)
        for i in range(len(ids)):
            j = candidates(i, ids, own, sig, hub, band, lo != hi, least)
            j = j[comp[j] != comp[i]]
            keep[j] = True
            keep[i] |= len(j) > 0
        return table.filter(pa.array(keep))

    return dealt.groupBy("band", "key", "lo", "hi").applyInArrow(met, dealt.schema)


def linked(met: DataFrame, least: float, percent: int, size: int) -> DataFrame:
    """Links (a, b) between the members that `meeting` gives, with their texts: full sets decide, and of the links of a
    group those that join components not joined yet."""

    def links(table: pa.Table) -> pa.Table:
        ids, comp, own = (table[c].to_numpy() for c in ("id", "comp", "own"))
        band, lo, hi, hub = (table[c][0].as_py() for c in ("band", "lo", "hi", "hub"))
        sig = _signatures(table["sig"])
        sets = [shingles(t.as_py(), size) for t in table["text"].cast(pa.binary())]
        n = np.array([len(x) for x in sets])
        vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
        sets = np.split(flat, np.cumsum(n)[:-1])
        here = np.zeros(len(vocabulary), bool)
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out = []
        for i in range(len(ids)):
            here[sets[i]] = True
            for j in candidates(i, ids, own, sig, hub, band, lo != hi, least).tolist():
                x, y = find(int(comp[i])), find(int(comp[j]))
                if x != y and 100 * min(n[i], n[j]) >= percent * max(n[i], n[j]):
                    common = int(np.count_nonzero(here[sets[j]]))
                    if 100 * common >= percent * (n[i] + n[j] - common):
                        root[y] = x
                        out.append((int(ids[i]), int(ids[j])))
            here[sets[i]] = False
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.groupBy("band", "key", "lo", "hi").applyInArrow(links, "a long, b long")


def same_id(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of rows with one id and different sets."""
    several = known.groupBy("id").agg(F.min("fp1").alias("lo"), F.max("fp1").alias("hi")).where("lo <> hi").select("id")
    of_id = known.select("id", "fp1", "fp2").join(several, "id").distinct().join(
        classes.select("fp1", "fp2", "node"), ["fp1", "fp2"]).select("id", "node")
    first = of_id.groupBy("id").agg(F.min("node").alias("a"))
    return of_id.join(first, "id").where("node <> a").select("a", F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                    size: int = SHINGLE) -> DataFrame:
    """Per row: `id_col`, `n_shingles`, `component_id`, `kept`."""
    spark = docs.sparkSession
    bound_batches(spark)
    least = least_estimate(percent / 100)
    found = written(features(docs, id_col, text_col, size), "minhash-features")
    known = found.where("n > 0 AND id IS NOT NULL")
    # one class for each set; from here on a class is its `node`, as several may have the same smallest id
    smallest = known.groupBy("fp1", "fp2").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    reps = written(known.join(smallest, ["fp1", "fp2", "id"]).dropDuplicates(["fp1", "fp2", "id"]).select(
        F.monotonically_increasing_id().alias("node"), F.col("id").alias("rep"), "h", "n", "fp1", "fp2", "copies", "sig"),
        "minhash-classes")
    sets = reps.select(F.col("node").alias("id"), "n", "sig")

    buckets = sets.select("id", F.posexplode("sig").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1")
    rows = written(buckets.join(shared, ["band", "key"]), "minhash-buckets")
    weight = rows.groupBy("id").agg(F.sum("members").alias("weight"))
    hubs = rows.join(weight, "id").groupBy("band", "key").agg(
        F.max(F.struct("weight", -F.col("id"))).alias("hub")).select("band", "key", (-F.col("hub.col2")).alias("hub"))
    hubs = written(hubs, "minhash-hubs")
    star = rows.join(hubs, ["band", "key"]).where("id <> hub").select(
        F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    sigs = sets.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    sigs_b = sets.select(F.col("id").alias("b"), F.col("sig").alias("sb"))

    def plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = estimate(_signatures(batch.column(2)), _signatures(batch.column(3))) >= least
            yield batch.select(["a", "b"]).filter(pa.array(near))

    likely = written(star.join(sigs, "a").join(sigs_b, "b").select("a", "b", "sa", "sb").mapInArrow(
        plausible, "a long, b long"), "minhash-likely")
    keys = reps.select("node", F.col("rep").alias("id"), "h")
    asked = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    texts = texts_of(docs, id_col, text_col, keys.join(asked, "node"))
    links = written(confirmed(likely, keys, texts, percent, size).unionByName(same_id(known, reps)), "minhash-star")

    # members of one bucket that are not linked yet; the hub has met them all
    comps = components(spark, links)
    placed = rows.join(comps, "id", "left").select("band", "key", "id", F.coalesce("comp", "id").alias("comp"))
    mixed = placed.join(sets.select("id", "n"), "id").groupBy("band", "key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("shingles")).where(
        "lo <> hi AND m > 2").select("band", "key", "m", "shingles")
    members = placed.join(mixed, ["band", "key"]).join(hubs, ["band", "key"]).join(sets.select("id", "sig"), "id")
    met = written(meeting(members, least, BLOCK, SET_BLOCK), "minhash-met")
    keys = keys.join(met.select(F.col("id").alias("node")).distinct(), "node")
    texts = texts_of(docs, id_col, text_col, keys)
    full = met.join(keys.select(F.col("node").alias("id"), F.col("id").alias("rep"), "h"), "id").join(
        texts.withColumnRenamed("id", "rep"), ["rep", "h"])
    more = written(linked(full, least, percent, size), "minhash-rest")
    comps = components(spark, links.unionByName(more)) if more.limit(1).count() else comps

    labelled = reps.join(comps, reps.node == comps.id, "left").select(
        "fp1", "fp2", "rep", "copies", F.coalesce("comp", "node").alias("comp"))
    lowest = labelled.groupBy("comp").agg(F.min("rep").alias("component"))
    classes = written(labelled.join(lowest, "comp").select("fp1", "fp2", "copies", "component"), "minhash-components")
    # classes of more than one in `HOT` rows are fewer than that and go to the rows; the others have few rows each
    total = found.count()
    hot = F.broadcast(classes.where(F.col("copies") * HOT > total))
    fp = ["fp1", "fp2"]
    common = found.join(hot, fp).select("id", "n", "component")
    others = found.join(hot.select(*fp), fp, "left_anti").join(classes, fp, "left").select("id", "n", "component")
    return common.unionByName(others).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))

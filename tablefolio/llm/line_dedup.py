"""Blocks of lines that later documents share with earlier ones: found by rare line hashes, aligned, deleted from the later.

1. Every line that is not blank is hashed (128 bits of its stripped text), and so are the shortest runs of two or more
   lines that begin, and that end, at each line and have `MIN_WORDS` words. Lines and runs of `MIN_WORDS` words are rare
   enough to tell where a text comes from: they link a document to the first one that holds them. A line that a million
   documents hold costs each of them one link and never makes pairs among them.
2. A pair of documents so linked asks for the lines both have: the one with fewer lines asks the other, so a digest
   of many sources costs what its sources hold, and a source of many copies what the copies hold.
3. Patience diff aligns each pair: lines that occur once in both are anchors, a longest run of them in the same order
   stays, and the stretches between them are aligned in the same way, where other lines now occur once; where only
   repeated lines are left the k-th is held against the k-th. Lines without neighbours to make up a block of `MIN_WORDS`
   words with are left out before.
4. Neighbouring lines that are aligned to neighbours are a block; blocks of `MIN_WORDS` words are deleted from the later
   document. What is left is aligned again with the whole earlier document, for blocks that were moved or repeated, until
   nothing more aligns. Nothing is deleted by its hash alone.

Without repeated lines in a document this deletes exactly the lines of all blocks of `MIN_WORDS` words that stand in an
earlier document as they are: each such block is covered by runs of step 1, whose first holders hold them too.

Documents are ordered by id, then by a hash of the text. Defined results: null and empty texts stay as they are; rows
without id come first; rows with equal id and text are one document and get the same result; blank lines stay and do not
part neighbours; all other columns pass through, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefolio.llm.bpe import bounded
from tablefolio.llm.common import NO_ID, bound_batches, unused
from tablefolio.session import written

MIN_WORDS = 10
HOT_SHARE = 4096  # keys with more than this part of all rows are joined by broadcast: at most so many


def least_runs(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """(first, end) of the shortest runs of two or more lines that begin, and that end, at each line with `min_words`."""
    found, begin, size = set(), 0, 0
    for end, n in enumerate(words, 1):
        size += n
        while size - words[begin] >= min_words and begin < end - 1:
            size -= words[begin]
            begin += 1
        if size >= min_words:
            found.add((begin, end))
    end, size = 0, 0
    for begin, n in enumerate(words):
        while end < len(words) and size < min_words:
            size += words[end]
            end += 1
        if size >= min_words:
            found.add((begin, end))
        size -= n
    return {(a, b) for a, b in found if b - a > 1}


def line_rows(docs: DataFrame, run_words: int) -> DataFrame:
    """(id, h, m, words, at, a, b) for each different line of a document that is not blank, `at` its places among these lines
    from 0, and for each different least run of `run_words` words, with `at` null; `m` counts a document's different lines."""
    names = ["id", "h", "m", "words", "at", "a", "b"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raw = batch.column(2).cast(pa.binary()).to_pylist()
            for part in bounded(raw, 8_000_000):
                row, size, words, places, digests = [], [], [], [], []
                for i, text in enumerate(raw[part], part.start):
                    lines = [line for line in (x.strip() for x in text.split(b"\n")) if line]
                    at: dict[bytes, list[int]] = defaultdict(list)
                    for p, line in enumerate(lines):
                        at[line].append(p)
                    counts = [line.count(b" ") + 1 for line in lines]
                    runs = {b"\n".join(lines[x:y]) + b"\n\n": sum(counts[x:y]) for x, y in least_runs(counts, run_words)}
                    row += [i] * (len(at) + len(runs))
                    size += [len(at)] * (len(at) + len(runs))
                    words += [counts[p[0]] for p in at.values()] + list(runs.values())
                    places += [*at.values(), *[None] * len(runs)]
                    digests += [hashlib.md5(x).digest() for x in (*at, *runs)]
                key = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(hs[row]), pa.array(size, pa.int32()), pa.array(words, pa.int32()),
                     pa.array(places, pa.list_(pa.int32())), pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy())], names=names)

    return docs.mapInArrow(scan, "id long, h long, m int, words int, at array<int>, a long, b long")


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest increasing run of `places`, by patience sorting."""
    tops, top_at, before = [], [], []
    for i, place in enumerate(places):
        pile = bisect_left(tops, place)
        before.append(top_at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(place)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = place, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _once(keys: list[int], start: int, end: int) -> dict[int, int]:
    """Where each key stands that occurs once between `start` and `end`, and -1 for those that occur more often."""
    found: dict[int, int] = {}
    for i in range(start, end):
        found[keys[i]] = -1 if keys[i] in found else i
    return found


def _numbered(keys: list[int], start: int, end: int) -> dict[tuple[int, int], int]:
    """Where the k-th occurrence of each key between `start` and `end` stands."""
    seen: dict[int, int] = defaultdict(int)
    found = {}
    for i in range(start, end):
        found[keys[i], seen[keys[i]]] = i
        seen[keys[i]] += 1
    return found


def patience(mine: list[int], theirs: list[int]) -> list[tuple[int, int]]:
    """Pairs of indices of equal keys that increase in both lists, by patience diff."""
    out, todo = [], [(0, len(mine), 0, len(theirs))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        here, there = _once(mine, i0, i1), _once(theirs, j0, j1)
        anchors = [(i, there[k]) for k, i in here.items() if i >= 0 and there.get(k, -1) >= 0]
        last = not anchors
        if last:
            here, there = _numbered(mine, i0, i1), _numbered(theirs, j0, j1)
            anchors = [(i, there[k]) for k, i in here.items() if k in there]
        kept = [anchors[x] for x in increasing([j for _, j in anchors])]
        out += kept
        if kept and not last:
            ends = [(i0 - 1, j0 - 1), *kept, (i1, j1)]
            todo += [(a + 1, c, b + 1, d) for (a, b), (c, d) in zip(ends, ends[1:]) if c > a + 1 and d > b + 1]
    return sorted(out)


def _stretches(n: int, joined: Callable[[int], bool], words: list[int], min_words: int) -> list[int]:
    """Of the indices below `n`, those in stretches of `min_words` words; `joined(i)` says if i goes on from i - 1."""
    out, start, size = [], 0, 0
    for i in range(n + 1):
        if i == n or (i and not joined(i)):
            if size >= min_words:
                out += range(start, i)
            start, size = i, 0
        if i < n:
            size += words[i]
    return out


def block_lines(common: list, min_words: int) -> list[int]:
    """Lines of a document in blocks aligned with an earlier one, from the (words, places, places there) of each line that
    both have."""
    rest = sorted((p, k, x["words"]) for k, x in enumerate(common) for p in x["at"])
    there = sorted((p, k) for k, x in enumerate(common) for p in x["there"])
    theirs = [k for _, k in there]
    following = {(k, m) for (p, k), (q, m) in zip(there, there[1:]) if q == p + 1}
    gone: list[int] = []
    while True:
        able = _stretches(len(rest), lambda i: rest[i][0] == rest[i - 1][0] + 1 and (rest[i - 1][1], rest[i][1]) in following,
                          [x[2] for x in rest], min_words)
        rest = [rest[i] for i in able]
        pairs = patience([k for _, k, _ in rest], theirs)
        if not pairs:
            return sorted(gone)
        at = [(rest[i][0], there[j][0]) for i, j in pairs]
        block = _stretches(len(at), lambda i: at[i][0] == at[i - 1][0] + 1 and at[i][1] == at[i - 1][1] + 1,
                           [rest[i][2] for i, _ in pairs], min_words)
        gone += [at[x][0] for x in block]
        done = {pairs[x][0] for x in block} or {i for i, _ in pairs}
        rest = [x for i, x in enumerate(rest) if i not in done]


def without_lines(text: str, gone: set[int]) -> str:
    """The text without some of its lines, counted as in `line_rows`: blank is what holds ASCII white space only."""
    kept, p = [], 0
    for line in text.encode().split(b"\n"):
        if line.strip():
            if p not in gone:
                kept.append(line)
            p += 1
        else:
            kept.append(line)
    return b"\n".join(kept).decode() if any(x.strip() for x in kept) else ""


def _with_first(lines: DataFrame) -> DataFrame:
    """The lines and runs that several documents hold, with (oid, oh, om) of the first holder.

    Keys with more than a 4096th of these rows, so at most 4096 of them, meet their holder by broadcast; their rows get
    keys of their own in the join of the others, so no task gets all rows of a hot key.
    """
    first = written(lines.groupBy("a", "b").agg(F.min(F.struct("id", "h", "m")).alias("o"), F.count("*").alias("n")).where("n > 1"),
                    "first-holders").withColumn("often", F.lit(False))
    share = first.agg((F.coalesce(F.sum("n"), F.lit(0)) / HOT_SHARE).alias("least"))
    hot = first.join(F.broadcast(share), F.col("n") > F.col("least")).select("a", "b", F.col("o").alias("hot"))
    rows = lines.join(F.broadcast(hot), ["a", "b"], "left").withColumn("often", F.col("hot").isNotNull())
    rows = rows.withColumn("c", F.when(F.col("often"), F.xxhash64("id", "h", "a")).otherwise(F.col("a")))
    out = rows.join(first.select(F.col("a").alias("c"), "b", "often", "o"), ["c", "b", "often"], "left")
    holder = F.coalesce("hot", "o")
    return out.where(holder.isNotNull()).select("id", "h", "m", "words", "at", "a", "b", holder["id"].alias("oid"),
                                               holder["h"].alias("oh"), holder["m"].alias("om"))


def _common_lines(shared: DataFrame, min_words: int) -> DataFrame:
    """(id, h, oid, oh, common) for each document and each first holder of one of its rare lines or runs."""
    later = (F.col("id") != F.col("oid")) | (F.col("h") != F.col("oh"))
    pairs = shared.where(later & (F.col("words") >= min_words)).select("id", "h", "m", "oid", "oh", "om").distinct()
    held = shared.where(F.col("at").isNotNull()).select("id", "h", "a", "b", "words", "at")
    own = F.col("m") <= F.col("om")
    asked = pairs.select("id", "h", "oid", "oh", own.alias("own"), *[
        F.when(own, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in
        (("id", "oid", "sid"), ("h", "oh", "sh"), ("oid", "id", "bid"), ("oh", "h", "bh"))])
    small = held.select(F.col("id").alias("sid"), F.col("h").alias("sh"), "a", "b", "words", F.col("at").alias("sat"))
    large = held.select(F.col("id").alias("bid"), F.col("h").alias("bh"), "a", "b", F.col("at").alias("bat"))
    both = asked.join(small, ["sid", "sh"]).join(large, ["bid", "bh", "a", "b"])
    line = F.struct("words", F.when(F.col("own"), F.col("sat")).otherwise(F.col("bat")).alias("at"),
                    F.when(F.col("own"), F.col("bat")).otherwise(F.col("sat")).alias("there"))
    return both.groupBy("id", "h", "oid", "oh").agg(F.collect_set(line).alias("common"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of `docs` with shared blocks deleted from `text_col`, and `deleted_lines` (their places among
    the lines that are not blank) and `shared_with` (ids of the earlier documents they were aligned with), both null where
    none are. Columns that have these two names already are replaced."""
    bound_batches(docs.sparkSession)
    key = [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text_col).alias("h")]
    texts = docs.where(F.col(text_col).isNotNull()).select(*key, F.col(text_col).alias("text"))
    shared = written(_with_first(line_rows(texts, min_words)), "shared-lines")

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def gone(many: pd.Series) -> pd.Series:
        return many.map(lambda x: block_lines(list(x), min_words))

    @F.pandas_udf(T.StringType())
    def rest(text: pd.Series, lines: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else without_lines(t, set(x.tolist())) for t, x in zip(text, lines, strict=True)])

    own_id, own_h, lines_gone, with_ids, new_text = unused(docs, "__id", "__h", "__gone", "__with", "__new")
    deleted = _common_lines(shared, min_words).select("id", "h", "oid", F.explode(gone("common")).alias("pos"))
    per_doc = deleted.groupBy("id", "h").agg(F.collect_set("pos").alias("pos"), F.collect_set("oid").alias("with")).select(
        F.col("id").alias(own_id), F.col("h").alias(own_h), F.array_sort("pos").alias(lines_gone),
        F.array_sort(F.filter("with", lambda i: i != NO_ID)).alias(with_ids))
    joined = docs.join(per_doc, (key[0] == F.col(own_id)) & (key[1] == F.col(own_h)), "left")
    new = rest(F.when(F.col(lines_gone).isNotNull(), F.col(text_col)), F.col(lines_gone))
    kept = [c for c in docs.columns if c not in ("deleted_lines", "shared_with")]
    return joined.withColumn(new_text, new).select(
        *[F.coalesce(new_text, F.col(c)).alias(c) if c == text_col else F.col(c) for c in kept],
        F.col(lines_gone).alias("deleted_lines"), F.col(with_ids).alias("shared_with"))

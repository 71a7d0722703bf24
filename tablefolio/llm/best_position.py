"""Ranked lexical search by the Best Position Algorithm over impact lists.

1. One scan of the documents gives each its length and the frequencies of those of its terms that an item may ask for.
   A filter of `FILTER` bytes, whatever the items hold, lets all their terms pass and few others. Number and length of
   all documents and document frequencies are counted over all rows; a term's weight follows.
2. Documents are dealt to shards of about `SHARD_POSTINGS` frequencies, items to blocks of about `BLOCK_TERMS` terms. A
   task has one shard and one block. It makes an impact list for each term: documents by falling impact, and the same
   documents by number, with their positions, for direct access.
3. For each item all its lists are read from the top, some positions at a time. A document seen for the first time is
   looked up in all lists: its score is complete, and its positions count as seen in each of them. The best position of
   a list is the last before the first unseen one. The weighted impacts at the best positions add up to the threshold:
   no unseen document scores more, and where a list is seen to its end it adds nothing. The item is done as soon as the
   threshold is strictly below the k-th score, so equal scores are all seen and smaller ids win.
4. The best `k` of all shards are merged for each item.

Defined results: null and empty texts have no terms and do not count; null or empty items have no result; rows without id
are found, after others of equal score; repeated rows are found one by one; items that share an id are ranked apart;
other columns are ignored; empty tables give an empty table. Ids are integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.llm.common import bound_batches
from tablefolio.llm.wordlists import TERMS, word_lists
from tablefolio.session import written

FILTER = 1 << 20
SHARD_POSTINGS = 2_000_000
BLOCK_TERMS = 400_000
FIRST_READ = 8
COUNTED = "id long, length long, terms array<string>, tfs array<long>"
FOUND = "item long, item_id long, row long, id long, score long"


def counted_terms(texts: DataFrame, id_col: str, text_col: str, wanted: bytes | None = None) -> DataFrame:
    """(id, length, terms, tfs): the number of terms of each text with repeats; its distinct terms, those that `wanted`
    lets pass, and how often each occurs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found: Counter[bytes] = Counter()
                for words in word_lists(text or b"", TERMS):
                    found.update(words)
                lengths.append(found.total())
                kept = found if wanted is None else [w for w in found if wanted[crc32(w) % FILTER]]
                terms.extend(kept)
                tfs.extend(found[w] for w in kept)
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], names=["id", "length", "terms", "tfs"])

    out = texts.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, COUNTED)
    return out.withColumn("row", F.monotonically_increasing_id())


class ImpactLists:
    """The impact lists of a shard: for each term the span [a, b) of its documents, by impact and by number."""

    def __init__(self, terms: pa.Array, sizes: np.ndarray, tfs: np.ndarray, norms: np.ndarray):
        coded = terms.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        docs = np.repeat(np.arange(len(sizes)), sizes)
        impacts = (1_000_000_000 * tfs) // (1000 * tfs + 8 * norms[docs])
        by_impact = np.lexsort((docs, -impacts, codes))
        codes, self.docs, self.impacts = codes[by_impact], docs[by_impact], impacts[by_impact]
        ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
        self.spans = {t: (int(e - n), int(e)) for t, e, n in
                      zip(coded.dictionary.to_pylist(), ends, np.diff(ends, prepend=0), strict=True)}
        direct = np.lexsort((self.docs, codes))
        self.ordered = self.docs[direct]
        self.places = direct - np.repeat(ends - np.diff(ends, prepend=0), np.diff(ends, prepend=0))
        self.n_docs = len(sizes)

    def look_up(self, span: tuple[int, int], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: which of `docs` are in the list, and their positions there."""
        ordered = self.ordered[span[0]:span[1]]
        at = np.minimum(np.searchsorted(ordered, docs), len(ordered) - 1)
        held = ordered[at] == docs
        return held, self.places[span[0]:span[1]][at[held]]

    def search(self, query: list[tuple[str, int]], k: int, first: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, positions read): all documents that score at least the k-th score, and some others."""
        lists = [(self.spans[t], w) for t, w in query if t in self.spans and w > 0]
        seen = [np.zeros(b - a, bool) for (a, b), _ in lists]
        best = [0] * len(lists)
        known = np.zeros(self.n_docs, bool)
        scores = np.zeros(self.n_docs, np.int64)
        longest = max((len(s) for s in seen), default=0)
        depth, step, read = 0, first, 0
        while depth < longest:
            tops = [self.docs[a + depth:min(b, a + depth + step)] for (a, b), _ in lists]
            read += sum(map(len, tops))
            docs = np.unique(np.concatenate(tops))
            docs = docs[~known[docs]]
            known[docs] = True
            threshold = 0
            for i, (span, weight) in enumerate(lists):
                if len(docs):
                    held, places = self.look_up(span, docs)
                    scores[docs[held]] += weight * self.impacts[span[0] + places]
                    seen[i][places] = True
                unseen = int(np.argmin(seen[i][best[i]:])) if best[i] < len(seen[i]) else 0
                if best[i] < len(seen[i]) and seen[i][best[i] + unseen]:
                    unseen = len(seen[i]) - best[i]
                best[i] += unseen
                if best[i] < len(seen[i]):
                    threshold += weight * int(self.impacts[span[0] + max(best[i] - 1, 0)])
            depth += step
            step *= 2
            found = scores[known]
            if len(found) >= k and threshold < np.partition(found, len(found) - k)[len(found) - k]:
                break
        docs = np.flatnonzero(known & (scores > 0))
        return docs, scores[docs], read


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", shard_postings: int = SHARD_POSTINGS,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The `k` best documents of each item: `item_col`, `rank`, `id_col`, `score`."""
    spark = docs.sparkSession
    bound_batches(spark)
    asked = written(counted_terms(items, item_col, item_text_col), "search-items")
    slots = asked.select(F.explode("terms").alias("term")).select(
        F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(FILTER)).alias("slot")).distinct().collect()  # at most FILTER
    wanted = bytearray(FILTER)
    for r in slots:
        wanted[r.slot] = 1
    held = written(counted_terms(docs, id_col, text_col, bytes(wanted)), "search-terms")
    size = held.agg(F.count(F.when(F.col("length") > 0, 1)).alias("n"), F.sum("length").alias("l"),
                    F.sum(F.size("terms")).alias("postings")).first()
    schema = f"{item_col} long, rank int, {id_col} long, score long"
    if not size.postings:
        return spark.createDataFrame([], schema)

    df = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * size.n + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weights = df.select("term", weight.alias("weight")).where("weight > 0")
    queries = asked.select("row", "id", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select(
        F.col("row").alias("item"), F.col("id").alias("item_id"), F.col("x.terms").alias("term"), F.col("x.tfs").alias("times"))
    queries = written(queries.join(weights, "term").withColumn("weight", F.col("weight") * F.col("times")), "search-queries")

    n_blocks = -(-queries.count() // block_terms) or 1
    n_shards = -(-size.postings // shard_postings)
    norm = F.expr(f"25 + cast(cast(75 * length AS decimal(20, 0)) * {size.n} div {size.l} AS long)")
    shards = held.where(F.size("terms") > 0).select(
        F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int").alias("shard"), "row", "id", norm.alias("norm"), "terms", "tfs")
    shards = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    blocks = queries.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int"))
    blocks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))

    def best(part: pa.Table, block: pa.Table) -> pa.Table:
        rows = []
        if len(part) and len(block):
            part, block = part.combine_chunks(), block.sort_by("item")
            lists = part["terms"].chunk(0)
            sizes = np.diff(lists.offsets.to_numpy())
            impact = ImpactLists(lists.flatten(), sizes, part["tfs"].chunk(0).flatten().to_numpy(), part["norm"].to_numpy())
            numbers = part["row"].to_numpy()
            ids = part["id"].to_pylist()
            item = block["item"].to_numpy()
            terms, weighed = block["term"].to_pylist(), block["weight"].to_pylist()
            cuts = [0, *(np.flatnonzero(np.diff(item)) + 1).tolist(), len(item)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                found, scores, _ = impact.search(list(zip(terms[a:b], weighed[a:b], strict=True)), k)
                if len(found) > k:
                    least = np.partition(scores, len(scores) - k)[len(scores) - k]
                    found, scores = found[scores >= least], scores[scores >= least]
                order = sorted(range(len(found)), key=lambda i: (
                    -scores[i], ids[found[i]] is None, ids[found[i]] or 0, numbers[found[i]]))[:k]
                rows += [(int(item[a]), block["item_id"][a].as_py(), int(numbers[found[i]]), ids[found[i]], int(scores[i]))
                         for i in order]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["item", "item_id", "row", "id", "score"])

    # as many tasks as groups: the shuffle grows with the data, not the part one task reads
    shards, blocks = (side.repartition(n_shards * n_blocks, "shard", "block") for side in (shards, blocks))
    found = shards.groupBy("shard", "block").cogroup(blocks.groupBy("shard", "block")).applyInArrow(best, FOUND)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")

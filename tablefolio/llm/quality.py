"""Text quality by the perplexity of an interpolated modified Kneser-Ney model of character 5-grams.

The model learns from trusted text only. A symbol is a character folded to 12 bits (itself below U+0F00, a hash above),
so a 5-gram with its order is one long and its context and suffixes are shifts and masks. Counts are taken inside tasks
and added up by shuffle; lower orders count distinct left neighbours; discounts come from counts of counts.

Scoring never sends a row per document and n-gram. Each task packs its documents into chunks of about `CHUNK_BYTES`; a
chunk asks each shard once for its distinct 5-grams there. The distinct 5-grams of a shard are looked up in the model by
one join (ten keys each: five n-grams, five contexts), the shard answers its requests, and a chunk is scored where the
answers meet its text. The most frequent 5-grams of the trusted text, `FREQUENT` at most, would be asked for by nearly
every chunk: each task has their answers, and no chunk asks. What moves grows with the rarer distinct n-grams of the
chunks, not with the text times the order.

A document has two scores. Its excess is (bits a character - median of its language) * sqrt(characters), as short texts
vary more. Its worst word is the largest (bits of the word - its letters * bits a character of the document) /
sqrt(letters) of all runs of letters, so that a few words that trusted text does not have count however long the text
is; runs of more than `WORD_CHARS` letters are scored in pieces. The largest of many words is larger, so the worst word
is taken less slope * log2(characters), the slope (0 or more) being that of all held-out documents. Each score's limit
is the quantile of its language at 1 - `CLEAN_LOSS` among trusted documents that were held out of training (`HELD_OUT`
of them, by a hash of the id). Documents above one of the limits are rejected.

Defined results: null and empty texts have no perplexity and are kept; texts without letters have no worst word; a null language is a language of its own; a
language with fewer than `LEAST_HELD_OUT` held-out documents takes the limit of all languages together; without trusted
text nothing is rejected; rows with equal ids are scored one by one; labels that name a document twice must agree that it
is trusted; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.llm.bpe import codec
from tablefolio.llm.common import bound_batches, count_at_most, unused
from tablefolio.session import written

ORDER, SYMBOL_BITS = 5, 12
START = (1 << SYMBOL_BITS) - 1
CHUNK_BYTES, SLICE_CHARS = 8_000_000, 500_000
FREQUENT, BANDS = 1 << 18, 16  # bands of counts for each power of two
CLEAN_LOSS, HELD_OUT, LEAST_HELD_OUT = 0.01, 0.2, 20
WORD_CHARS = 24
BROADCAST_LABELS = 2_000_000


def grams(text: str) -> Iterator[np.ndarray]:
    """The 5-grams that end at each character, as longs, slice by slice."""
    before = np.full(ORDER - 1, START, np.uint64)
    for begin in range(0, len(text), SLICE_CHARS):
        points = np.frombuffer(text[begin:begin + SLICE_CHARS].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        folded = np.uint64(0xF00) + ((points * np.uint64(2654435761)) >> np.uint64(7)) % np.uint64(0xFE)
        symbols = np.concatenate([before, np.where(points < 0xF00, points, folded)])
        out = np.zeros(len(points), np.uint64)
        for k in range(ORDER):
            out = (out << np.uint64(SYMBOL_BITS)) | symbols[k:k + len(points)]
        before = symbols[-(ORDER - 1):]
        yield out.astype(np.int64)


@cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)


class Words:
    """The largest sum of bits of the words of a text, for each length; texts come slice by slice."""

    def __init__(self) -> None:
        self.best = np.full(WORD_CHARS + 1, -np.inf)
        self.length, self.sum = 0, 0.0  # of the word that the last slice left open

    def add(self, text: str, bits: np.ndarray) -> None:
        letter = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        places = np.arange(len(letter))
        # letters since the word began, in an earlier slice perhaps
        offset = places - np.maximum.accumulate(np.where(letter, -1, places)) - 1
        offset += np.where(np.logical_and.accumulate(letter), self.length, 0)
        starts = np.flatnonzero(letter & (offset % WORD_CHARS == 0))
        starts = np.concatenate([[0], starts[starts > 0]])
        lengths = np.add.reduceat(letter.astype(np.int64), starts)
        sums = np.add.reduceat(np.where(letter, bits, 0.0), starts)
        if letter[0] and self.length < WORD_CHARS:
            lengths[0] += self.length
            sums[0] += self.sum
        else:
            self.close()
        self.length, self.sum = 0, 0.0
        if letter[-1]:
            self.length, self.sum = int(lengths[-1]), float(sums[-1])
            lengths, sums = lengths[:-1], sums[:-1]
        np.maximum.at(self.best, lengths[lengths > 0], sums[lengths > 0])

    def close(self) -> None:
        if self.length:
            self.best[self.length] = max(self.best[self.length], self.sum)
        self.length, self.sum = 0, 0.0

    def worst(self, mean: float) -> float | None:
        self.close()
        sizes = np.flatnonzero(self.best > -np.inf)
        return float(((self.best[sizes] - mean * sizes) / np.sqrt(sizes)).max()) if len(sizes) else None


class Counter:
    """Distinct n-grams and their counts in bounded memory."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.open: list[np.ndarray] = []
        self.size = 0

    def add(self, found: np.ndarray) -> None:
        self.open.append(found)
        self.size += len(found)
        if self.size > 2 * SLICE_CHARS:
            self.settle()

    def settle(self) -> None:
        if self.open:
            keys, counts = np.unique(np.concatenate(self.open), return_counts=True)
            both, place = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
            self.counts = np.bincount(place, np.concatenate([self.counts, counts]), len(both)).astype(np.int64)
            self.keys, self.open, self.size = both, [], 0


def count_grams(texts: DataFrame) -> DataFrame:
    """(g, c): 5-grams of the column `text`, counted inside each task first."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Counter()
        for batch in batches:
            for text in batch.column(0):
                for found in grams(text.as_py() or ""):
                    c.add(found)
        c.settle()
        yield pa.RecordBatch.from_arrays([pa.array(c.keys), pa.array(c.counts)], names=["g", "c"])

    return texts.select("text").mapInArrow(scan, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def keyed(order: int, g: Column) -> Column:
    """The last `order` symbols of an n-gram as a key that no other order has."""
    return g.bitwiseAND(F.lit((1 << (SYMBOL_BITS * order)) - 1)).bitwiseOR(F.lit(order << (SYMBOL_BITS * ORDER)))


def context(order: int, g: Column) -> Column:
    """The symbols before the last one of the last `order`, as a key; contexts have keys of their own."""
    inner = F.shiftright(g.bitwiseAND(F.lit((1 << (SYMBOL_BITS * order)) - 1)), SYMBOL_BITS)
    return -inner - F.lit((order << (SYMBOL_BITS * ORDER)) + 1)


class Model:
    """`lookup`: key -> discounted share of an n-gram, or back-off weight of a context; `floor`: share of a new symbol;
    `counted`: 5-grams of the trusted text and their counts."""

    def __init__(self, lookup: DataFrame, floor: float, counted: DataFrame):
        self.lookup, self.floor, self.counted = lookup, floor, counted

    @classmethod
    def train(cls, texts: DataFrame) -> Model | None:
        counted = written(count_grams(texts), "quality-counts")
        # the parts of a union share the partitions of one shuffle, so a table has not a small file for each of all of theirs
        most = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        orders, below = [], counted
        for order in range(ORDER, 0, -1):
            orders.append(below.select(F.lit(order).alias("k"), "g", "c").coalesce(max(1, most // ORDER)))
            if order > 1:
                below = below.groupBy(F.col("g").bitwiseAND(F.lit((1 << (SYMBOL_BITS * (order - 1))) - 1)).alias("g")).agg(
                    F.count("*").alias("c"))
        types = orders[0]
        for o in orders[1:]:
            types = types.unionByName(o)
        types = written(types, "quality-types")
        numbers = {r.k: r for r in types.groupBy("k").agg(
            *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)], F.count("*").alias("n")).collect()}
        if not numbers:
            return None
        discount = F.lit(0.0)
        for order, r in numbers.items():
            d = discounts(r.n1, r.n2, r.n3, r.n4)
            discount = F.when(F.col("k") == order, F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
                              ).otherwise(discount)
        by_context = F.coalesce(*[F.when(F.col("k") == k, context(k, F.col("g"))) for k in range(1, ORDER + 1)])
        by_gram = F.coalesce(*[F.when(F.col("k") == k, keyed(k, F.col("g"))) for k in range(1, ORDER + 1)])
        cut = types.select("c", by_context.alias("context"), by_gram.alias("key"), discount.alias("d"))
        contexts = cut.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("spared"))
        shares = cut.join(contexts, "context").select("key", ((F.col("c") - F.col("d")) / F.col("total")).alias("value"))
        weights = contexts.select(F.col("context").alias("key"), (F.col("spared") / F.col("total")).alias("value"))
        shares, weights = (x.coalesce(max(1, most // 2)) for x in (shares, weights))
        return cls(written(shares.unionByName(weights), "quality-model"), 1.0 / (numbers[1].n + 1), counted)

    def frequent(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The most frequent 5-grams of the trusted text, `most` at most and whole bands of counts, with their bits."""
        band = F.floor(F.log2("c") * BANDS)
        least, left = None, most
        for r in sorted(self.counted.groupBy(band.alias("band")).count().collect(), reverse=True):
            left -= r["count"]
            if left < 0:
                break
            least = r.band
        if least is None:
            return np.zeros(0, np.int64), np.zeros(0, np.float64)
        return _ordered(self.probabilities(self.counted.where(band >= least)).toArrow())

    def probabilities(self, wanted: DataFrame) -> DataFrame:
        """(g, p) for each distinct 5-gram `g`."""
        g = F.col("g")
        slots = [F.struct(F.lit(k).alias("slot"), keyed(k, g).alias("key")) for k in range(1, ORDER + 1)]
        slots += [F.struct(F.lit(-k).alias("slot"), context(k, g).alias("key")) for k in range(1, ORDER + 1)]
        asked = wanted.select("g", F.inline(F.array(*slots)))
        answered = asked.join(self.lookup, "key").groupBy("g").agg(
            *[F.max(F.when(F.col("slot") == k, F.col("value"))).alias(f"s{k}") for k in range(1, ORDER + 1)],
            *[F.max(F.when(F.col("slot") == -k, F.col("value"))).alias(f"w{k}") for k in range(1, ORDER + 1)])
        p = F.lit(self.floor)
        for k in range(1, ORDER + 1):  # an unseen context leaves all to the order below
            p = F.coalesce(F.col(f"s{k}"), F.lit(0.0)) + F.coalesce(F.col(f"w{k}"), F.lit(1.0)) * p
        return answered.select("g", p.alias("p"))


def _ordered(types: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """5-grams in ascending order, and the bits of each."""
    order = np.argsort(types["g"].to_numpy())
    return types["g"].to_numpy()[order], -np.log2(types["p"].to_numpy()[order])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; plain ones where counts of counts are missing."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.1), k) for k, d in enumerate(found, 1))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, pa.Table]]:
    """(name, packed rows, rows) of about CHUNK_BYTES of text; the name is a hash of the content."""
    def close(rows: list[pa.RecordBatch]) -> tuple[int, bytes, pa.Table]:
        table = pa.Table.from_batches(rows).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        packed = zstandard.compress(sink.getvalue(), 6)
        return int.from_bytes(hashlib.blake2b(packed, digest_size=8).digest(), "little", signed=True), packed, table

    codec.cache_clear()  # a worker that has encoded texts before gives that memory back
    rows, size = [], 0
    for batch in batches:
        step = max(1, int(batch.num_rows * CHUNK_BYTES / max(batch.nbytes, 1)))
        for begin in range(0, batch.num_rows, step):
            part = batch.slice(begin, step)
            bytes_here = part.nbytes
            if rows and size + bytes_here > CHUNK_BYTES:
                yield close(rows)
                rows, size = [], 0
            rows.append(part)
            size += bytes_here
    if rows:
        yield close(rows)


def _pack(values: np.ndarray) -> bytes:
    """64-bit values as bytes: first bytes of all, then second bytes, and so on, which compresses well."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def _unpack(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


def _prime(least: int) -> int:
    """The first odd prime from `least` on: 5-grams modulo it depend on all their symbols."""
    n = max(least, 3) | 1
    while any(n % k == 0 for k in range(3, int(n ** 0.5) + 1, 2)):
        n += 2
    return n


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, h, lang, n, bits, worst): characters, mean bits a character and worst word of each row with text.

    The distinct 5-grams of a chunk go to the shards they belong to, packed: one row for each chunk and shard. A shard
    finds its distinct 5-grams, the model answers those, and each request is answered where it is.
    """
    shards = _prime(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    frequent = docs.sparkSession.sparkContext.broadcast(model.frequent(FREQUENT))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, table in _chunks(batches):
            c = Counter()
            for text in table["text"]:
                for found in grams(text.as_py()):
                    c.add(found)
            c.settle()
            rare = np.setdiff1d(c.keys, frequent.value[0], assume_unique=True)
            home = rare % shards
            order = np.argsort(home, kind="stable")
            keys, ends = rare[order], np.searchsorted(home[order], np.arange(shards + 1))
            parts = [(s, _pack(np.diff(keys[a:b], prepend=0))) for s, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in parts], pa.int32()), pa.array([name] * len(parts), pa.int64()),
                 pa.array([x for _, x in parts], pa.binary())], names=["shard", "chunk", "grams"])

    def requested(blob: pa.Scalar) -> np.ndarray:
        return np.cumsum(_unpack(blob.as_py(), np.int64))

    def distinct(requests: pa.Table) -> pa.Table:
        keys = np.zeros(0, np.int64)
        for blob in requests["grams"]:
            keys = np.union1d(keys, requested(blob))
        return pa.table({"g": pa.array(keys)})

    def answer(types: pa.Table, requests: pa.Table) -> pa.Table:
        keys, bits = _ordered(types)
        out = []
        for blob in requests["grams"]:
            wanted = requested(blob)
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            _check(keys[place], wanted)
            out.append(_pack(bits[place]))
        return pa.table({"chunk": requests["chunk"], "grams": requests["grams"], "bits": pa.array(out, pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, packed, _ in _chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([packed], pa.binary())], names=["chunk", "packed"])

    def meet(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        keys = np.concatenate([frequent.value[0], *(requested(x) for x in answers["grams"])])
        bits = np.concatenate([frequent.value[1], *(_unpack(x.as_py(), np.float64) for x in answers["bits"])])
        order = np.argsort(keys)
        keys, bits = keys[order], bits[order]
        out = []
        for packed in chunks["packed"]:
            table = pa.ipc.open_stream(pa.py_buffer(zstandard.decompress(packed.as_py()))).read_all()
            n, total, worst = [], [], []
            for scalar in table["text"]:
                text, count, sum_bits, words = scalar.as_py(), 0, 0.0, Words()
                for found in grams(text):
                    place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                    _check(keys[place], found)
                    words.add(text[count:count + len(found)], bits[place])
                    count, sum_bits = count + len(found), sum_bits + float(bits[place].sum())
                n.append(count)
                total.append(sum_bits / count)
                worst.append(words.worst(sum_bits / count))
            out.append(table.drop_columns("text").append_column("n", pa.array(n, pa.int64())).append_column(
                "bits", pa.array(total)).append_column("worst", pa.array(worst, pa.float64())))
        kinds = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("bits", pa.float64()),
                           ("worst", pa.float64())])
        return pa.concat_tables(out).cast(kinds) if out else kinds.empty_table()

    texts = docs.select("id", "h", "lang", "text").where(F.length("text") > 0)
    asked = texts.mapInArrow(ask, "shard int, chunk long, grams binary").repartition("shard")
    types = model.probabilities(asked.groupBy("shard").applyInArrow(distinct, "g long")).withColumn(
        "shard", F.pmod("g", F.lit(shards)).cast("int"))
    requests = asked.select(*[F.col(c).alias(c) for c in asked.columns])
    answers = types.groupBy("shard").cogroup(requests.groupBy("shard")).applyInArrow(
        answer, "chunk long, grams binary, bits binary")
    packed = texts.mapInArrow(pack, "chunk long, packed binary")
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        meet, "id long, h long, lang string, n long, bits double, worst double")


def _check(have: np.ndarray, wanted: np.ndarray) -> None:
    """Chunks are made in two scans of the documents; a difference between these must not pass unseen."""
    if not np.array_equal(have, wanted):
        raise RuntimeError("the documents changed between two scans of them")


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents that all their labels call good and not toxic, and whether each is held out."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.min(F.coalesce(good, F.lit(False))).alias("good")).where("good").select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(1000)) < int(1000 * HELD_OUT)).alias("held_out"))


def limits(scores: DataFrame, loss: float = CLEAN_LOSS) -> DataFrame:
    """(lang, median, limit, slope, word_limit) from held-out trusted documents; the row with `every` set is for all other
    languages."""
    slope = scores.agg(F.greatest(F.lit(0.0), F.round(F.regr_slope("worst", F.log2("n")), 3)).alias("slope"))
    known = scores.crossJoin(F.broadcast(slope)).select(
        F.explode(F.array(F.struct(F.col("lang"), F.lit(False).alias("every")),
                          F.struct(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("every")))).alias("of"),
        "n", "bits", "slope", (F.col("worst") - F.col("slope") * F.log2("n")).alias("local")).select("of.*", "n", "bits", "slope", "local")
    # values on a grid, so that exact percentiles keep few of them
    middle = known.groupBy("lang", "every").agg(F.percentile(F.round("bits", 3), 0.5).alias("median"), F.count("*").alias("docs"))
    middle = middle.where(F.col("every") | (F.col("docs") >= LEAST_HELD_OUT))
    middle = middle.select(F.col("lang").alias("of"), F.col("every").alias("of_every"), "median")
    excess = known.join(middle, F.col("lang").eqNullSafe(F.col("of")) & (F.col("every") == F.col("of_every"))).select(
        "lang", "every", "median", "slope", "local", ((F.col("bits") - F.col("median")) * F.sqrt("n")).alias("excess"))
    return excess.groupBy("lang", "every", "median", "slope").agg(
        F.percentile(F.round("excess", 2), 1 - loss).alias("limit"), F.percentile(F.round("local", 2), 1 - loss).alias("word_limit"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             loss: float = CLEAN_LOSS) -> DataFrame:
    """Per row: `id_col`, `lang_col`, `h` (hash of the text), `n_scored`, `perplexity`, `excess`, `limit`, `worst_word`,
    `word_limit`, `kept`."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    trusted = trusted_ids(labels, id_col)
    if count_at_most(trusted, BROADCAST_LABELS) is not None:
        trusted = F.broadcast(trusted)
    model = Model.train(rows.join(trusted.where("NOT held_out"), "id", "left_semi"))
    names = [F.col("id").alias(id_col), F.col("lang").alias(lang_col), "h"]
    unknown = [F.lit(None).cast("double").alias(c) for c in ("perplexity", "excess", "limit", "worst_word", "word_limit")]
    if model is None:
        return rows.select(*names, F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_scored"), *unknown, F.lit(True).alias("kept"))
    scores = written(score(rows, model), "quality-scores")
    bounds = limits(scores.join(trusted.where("held_out"), "id", "left_semi"), loss)
    bounds = written(bounds, "quality-limits")  # a row per language
    every = bounds.where("every").first()
    named = ("median", "limit", "slope", "word_limit")
    own = bounds.where("NOT every").select(F.col("lang").alias("of"), *[F.col(c).alias(f"own_{c}") for c in named])
    judged = scores.join(own, F.col("lang").eqNullSafe(F.col("of")), "left")
    median, limit, slope, word_limit = [
        F.coalesce(f"own_{c}", F.lit(every[c] if every else None).cast("double")) for c in named]
    excess = (F.col("bits") - median) * F.sqrt("n")
    local = F.col("worst") - slope * F.log2("n")
    judged = judged.select(F.col("id").alias(id_col), F.col("lang").alias(lang_col), "h", F.col("n").alias("n_scored"),
                           F.pow(F.lit(2.0), "bits").alias("perplexity"), excess.alias("excess"), limit.alias("limit"),
                           local.alias("worst_word"), word_limit.alias("word_limit"),
                           (F.coalesce(excess <= limit, F.lit(True)) & F.coalesce(local <= word_limit, F.lit(True))).alias("kept"))
    empty = rows.where(F.coalesce(F.length("text"), F.lit(0)) == 0).select(
        *names, F.lit(0).cast("long").alias("n_scored"), *unknown, F.lit(True).alias("kept"))
    return judged.unionByName(empty)


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    own_id, own_h, own_lang = unused(docs, "__id", "__h", "__lang")
    bad = classify(docs, labels, id_col, text_col, lang_col).where("NOT kept").select(
        F.col(id_col).alias(own_id), F.col("h").alias(own_h), F.col(lang_col).alias(own_lang)).distinct()
    same = (docs[id_col].cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(docs[text_col]) == F.col(own_h))
            & docs[lang_col].cast("string").eqNullSafe(F.col(own_lang)))
    return docs.join(bad, same, "left_anti")

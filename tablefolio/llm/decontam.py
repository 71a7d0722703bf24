"""Benchmark items inside training documents, found by spaced seeds and tolerant of substitutions.

A mask names a few word positions of a short span; the words between them are ignored, so a substituted word there does
no harm. Every position of every benchmark item and of every document gives one hash per mask. Equal hashes are hits.
Around a hit, words are compared position by position along the same diagonal: a window of `WINDOW` words (or the whole
item, if it is shorter) that contains the seed counts as a leak if `PERCENT` of its words are equal. With the masks below
four random substitutions in twenty words leave a seed intact in all of 4,000 trials.

Items of fewer than `WHOLE_UNDER` words follow the same rule whole: an item in which k words may differ is cut into k + 1
blocks, one of which every copy holds unchanged, and these blocks are its seeds. So items of any length are found, those
of up to four words word by word. An item of few common words is in many documents; `item_shares` tells in how many.

All of it is column expressions. Document positions are made by a generator and looked up in the benchmark's seeds at
once; only hits leave the scan. The seeds are broadcast if there are at most `BROADCAST_SEEDS` of them, else the join
shuffles both sides; the result is the same.

Words are runs of letters and digits in lower case. Defined results: null and empty texts have no words and no leaks;
items with equal words are one, under the smallest id; rows with equal document ids are one document; a null document id
is an id of its own; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.llm.common import count_at_most, unused

# offsets of the words that count, one mask a line, all of one span
MASKS = (
    (0, 6, 7, 8, 9),
    (0, 2, 4, 6, 9),
    (0, 1, 4, 5, 9),
)
SPAN = 10
WINDOW, PERCENT = 20, 80
# items from here on lose no seed by the substitutions allowed
WHOLE_UNDER = 12
BROADCAST_SEEDS = 500_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def seeds(tokens: Column, p: Column, short: list[int]) -> Column:
    """Hashes of all masks at position `p`; a mask that reaches beyond the end gives null."""
    n = F.size(tokens)

    def at(mask: tuple[int, ...], number: int) -> Column:
        return F.when(p + mask[-1] < n, F.xxhash64(F.lit(number), *[F.get(tokens, p + o) for o in mask]))

    return F.array(*[at(m, k) for k, m in enumerate(MASKS)], *[at(tuple(range(k)), -k) for k in short])


def blocks(n: int) -> list[tuple[int, int]]:
    """(first word, words) of the seeds of an item of `n` words that is looked for as a whole."""
    parts = n * (100 - PERCENT) // 100 + 1
    cuts = [k * n // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def benchmark_items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct items: (item_id, item, n), n words each."""
    tokens = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("item"))
    return tokens.where(F.size("item") > 0).groupBy("item").agg(F.min("item_id").alias("item_id")).select(
        "item_id", "item", F.size("item").alias("n"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and item it holds: `id_col`, `item_col`, the best window's first word in the document
    (`first_word`), its words (`n_words`) and how many of them are equal (`n_equal`)."""
    items = benchmark_items(benchmark, item_col, item_text_col)
    # at most WHOLE_UNDER numbers
    lengths = sorted(r.n for r in items.where(F.col("n") < WHOLE_UNDER).select("n").distinct().collect())
    whole_seeds = [(n, q, size) for n in lengths for q, size in blocks(n)]
    short = sorted({size for _, _, size in whole_seeds})
    placed = items.select("item_id", "n", "item", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("q"))
    marked = placed.select("item_id", "n", F.col("q"), F.posexplode(seeds(F.col("item"), F.col("q"), short)).alias("mask", "seed"))
    # a short item has the seeds of its blocks
    whole = F.lit(False)
    for n, q, size in whole_seeds:
        whole = whole | ((F.col("n") == n) & (F.col("q") == q) & (F.col("mask") == len(MASKS) + short.index(size)))
    wanted = marked.where(F.col("seed").isNotNull() & F.when(F.col("mask") >= len(MASKS), whole).otherwise(F.col("n") >= WHOLE_UNDER)).select(
        "item_id", "n", "q", "seed")
    if count_at_most(wanted, BROADCAST_SEEDS) is not None:
        wanted = F.broadcast(wanted)

    tokens = docs.select(F.col(id_col).alias("doc"), words(F.col(text_col)).alias("tokens"))
    positions = tokens.where(F.size("tokens") > 0).select("doc", "tokens", F.explode(F.sequence(F.lit(0), F.size("tokens") - 1)).alias("p"))
    tried = positions.select("doc", "tokens", "p", F.explode(seeds(F.col("tokens"), F.col("p"), short)).alias("seed"))
    back = F.least(F.col("q"), F.lit(WINDOW), F.col("p"))
    ahead = F.least(F.col("n") - F.col("q"), F.lit(WINDOW + SPAN), F.size("tokens") - F.col("p"))
    hits = tried.join(wanted, "seed").select(
        "doc", "item_id", "n", "q", "p", back.alias("back"), F.slice("tokens", F.col("p") - back + 1, back + ahead).alias("part"))

    # words compared along the diagonal, then all windows that contain the seed
    item = F.slice("item", F.col("q") - F.col("back") + 1, F.size("part"))
    equal = F.zip_with("part", item, lambda a, b: F.when(a == b, 1).otherwise(0))
    compared = hits.join(items.select("item_id", "item"), "item_id").select(
        "doc", "item_id", "p", "back", F.least(F.col("n"), F.lit(WINDOW)).alias("size"),
        F.when(F.col("n") < WHOLE_UNDER, 1).otherwise(SPAN).alias("span"), equal.alias("equal"))
    first, last = F.greatest(F.lit(0), F.col("back") + F.col("span") - F.col("size")), F.least("back", F.size("equal") - F.col("size"))
    # none if the document ends too early
    windows = F.when(first <= last, F.transform(F.sequence(first, last), lambda s: F.struct(
        F.aggregate(F.slice("equal", s + 1, F.col("size")), F.lit(0), lambda a, x: a + x).alias("n_equal"),
        (F.col("back") - F.col("p") - s).alias("place"), F.col("size").alias("n_words"))))
    best = compared.select("doc", "item_id", F.array_max(windows).alias("best"))
    good = best.where(F.col("best.n_equal") * 100 >= F.col("best.n_words") * PERCENT)
    return good.groupBy("doc", "item_id").agg(F.max("best").alias("best")).select(
        F.col("doc").alias(id_col), F.col("item_id").alias(item_col), (-F.col("best.place")).cast("long").alias("first_word"),
        F.col("best.n_words").cast("long").alias("n_words"), F.col("best.n_equal").cast("long").alias("n_equal"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    (leaked,) = unused(docs, "leaked")
    found = leaks(docs, benchmark, id_col, text_col).select(F.col(id_col).alias(leaked)).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found[leaked]), "left_anti")


def item_shares(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each item that is found: `item_col`, its words, the documents that hold it and their share of all."""
    all_ids = docs.select(F.col(id_col).alias("id")).distinct().agg(F.count("*").alias("total"))  # a row
    found = leaks(docs, benchmark, id_col, text_col, item_col, item_text_col).groupBy(item_col).agg(F.count("*").alias("n_docs"))
    items = benchmark_items(benchmark, item_col, item_text_col).select(F.col("item_id").alias(item_col), F.col("n").cast("long").alias("n_words"))
    return found.join(items, item_col).crossJoin(F.broadcast(all_ids)).select(
        item_col, "n_words", "n_docs", (F.col("n_docs") / F.col("total")).alias("share"))


_MASK_SQL = ", ".join(f"[{', '.join(map(str, m))}]" for m in MASKS)
LEAKS_SQL = f"""
WITH masks AS (SELECT unnest([{_MASK_SQL}]) AS m),
i0 AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS item FROM benchmark),
items AS (SELECT min(item_id) AS item_id, item, len(item) AS n FROM i0 WHERE len(item) > 0 GROUP BY item),
short AS (SELECT *, n * (100 - {PERCENT}) // 100 + 1 AS parts, unnest(range(0, n * (100 - {PERCENT}) // 100 + 1)) AS k
          FROM items WHERE n < {WHOLE_UNDER}),
spelled AS (
  SELECT item_id, n, m, unnest(range(0, n - {SPAN} + 1)) AS q, item FROM items, masks WHERE n >= {WHOLE_UNDER}
  UNION ALL SELECT item_id, n, range(0, (k + 1) * n // parts - k * n // parts) AS m, k * n // parts AS q, item FROM short),
wanted AS (SELECT item_id, n, q, m, item, list_transform(m, lambda o: item[q + o + 1]) AS seed FROM spelled),
shapes AS (SELECT DISTINCT m FROM spelled),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS tokens FROM documents),
pos AS (SELECT doc_id, tokens, unnest(range(0, len(tokens))) AS p FROM d),
tried AS (SELECT doc_id, tokens, p, m, list_transform(m, lambda o: tokens[p + o + 1]) AS seed FROM pos, shapes
          WHERE p + m[-1] < len(tokens)),
hits AS (SELECT doc_id, item_id, n, q, p, item, tokens, least(n, {WINDOW}) AS size, CASE WHEN n < {WHOLE_UNDER} THEN 1 ELSE {SPAN} END AS span
         FROM tried JOIN wanted USING (m, seed)),
wins AS (SELECT DISTINCT doc_id, item_id, p - q AS diag, size, item, tokens,
                unnest(range(greatest(0, q + span - size), least(q, n - size) + 1)) AS w FROM hits),
fit AS (SELECT doc_id, item_id, diag + w AS first_word, size,
               list_sum(list_transform(range(0, size), lambda k: CASE WHEN tokens[diag + w + k + 1] = item[w + k + 1] THEN 1 ELSE 0 END)) AS n_equal
        FROM wins WHERE diag + w >= 0 AND diag + w + size <= len(tokens)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, first_word) AS r
         FROM fit WHERE n_equal * 100 >= size * {PERCENT})
SELECT doc_id, item_id, CAST(first_word AS BIGINT) AS first_word, CAST(size AS BIGINT) AS n_words,
       CAST(n_equal AS BIGINT) AS n_equal FROM best WHERE r = 1
"""

"""Similar texts of one group by an inverted index of letter pairs, without comparing all with all.

Two texts whose insert/delete ratio reaches a limit share many pairs of neighbouring letters, repeats numbered and both
ends marked: with C common letters of S in both, at least 3 C - S + 1. So if the pairs of each text are put in one
order, rarest first, and a text needs T shared pairs with any partner, some shared pair is among its first
(number of pairs - T + 1): only these are indexed and looked up. Lengths rule out more, and the rest is scored.
The result is exact. A pair that very many texts of a group have in front is dealt into parts, each a join key of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.functions.fuzzy import bound, known_ratio, places

LEAST_LIMIT = 70  # below, shared pairs are no longer certain
PART_SIZE = 4096


def letter_pairs(text: Column) -> Column:
    """Pairs of neighbouring letters with the ends marked; the k-th equal pair carries its number."""
    marked = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    plain = F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(marked, i, F.lit(2)))
    return bound(plain, lambda pairs: F.transform(pairs, lambda p, i: F.concat(
        p, F.size(F.filter(F.slice(pairs, F.lit(1), i + 1), lambda q: q == p)).cast("string"))))


def prefix_size(length: Column, limit: int) -> Column:
    """How many of its rarest pairs a text must show to be found by any partner whose rounded ratio reaches `limit`.

    With r = (limit - 1/2) / 200, C >= r S, and C <= the partner's length gives S >= length / (1 - r): at least
    (3 r - 1) / (1 - r) * length + 1 pairs are shared. In whole numbers, as rounding must not lose any.
    """
    twice = 2 * limit - 1
    up, down = 3 * twice - 400, 400 - twice
    shared = F.floor((up * length + down - 1) / down) + 1
    return length + 2 - shared


def possible(a: Column, b: Column, limit: int) -> Column:
    """Whether texts of these lengths can reach the limit: all of the shorter one would be common."""
    return (a + b == 0) | (F.bround(200.0 * F.least(a, b) / F.greatest(a + b, F.lit(1)), 0) >= limit)


def rare_first(texts: DataFrame, group: str, frequency: DataFrame) -> DataFrame:
    """(group, text, pairs): the letter pairs of each text, those that fewest indexed texts of its group have first."""
    pairs = texts.select(group, "text", F.explode(letter_pairs(F.col("text"))).alias("pair"))
    counted = pairs.join(frequency, [group, "pair"], "left").select(
        group, "text", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "pair", F.coalesce("parts", F.lit(1)).alias("parts")).alias("x"))
    return counted.groupBy(group, "text").agg(F.array_sort(F.collect_list("x")).alias("pairs"))


def letter_index(asked: DataFrame, indexed: DataFrame, group: str, cut: Callable[[DataFrame], DataFrame],
                 part_size: int = PART_SIZE) -> tuple[DataFrame, DataFrame]:
    """The distinct texts `text` of both tables as `similar_texts` takes them, for any limit."""
    asked, indexed = (df.select(group, "text").distinct() for df in (asked, indexed))
    listed = indexed.select(group, F.explode(letter_pairs(F.col("text"))).alias("pair"))
    frequency = cut(listed.groupBy(group, "pair").agg(F.count("*").alias("n")).withColumn(
        "parts", F.ceil(F.col("n") / part_size).cast("int")))
    return (cut(rare_first(asked, group, frequency).withColumn("known", places(F.col("text")))),
            cut(rare_first(indexed, group, frequency)))


def _front(texts: DataFrame, group: str, limit: int) -> DataFrame:
    """(group, text, pair, parts): the pairs each text must show."""
    front = F.slice("pairs", F.lit(1), prefix_size(F.length("text"), limit).cast("int"))
    return texts.select(group, "text", F.explode(front).alias("x")).select(group, "text", "x.pair", "x.parts")


def similar_texts(asked: DataFrame, indexed: DataFrame, group: str, limit: int) -> DataFrame:
    """(group, text, other, score): all pairs of texts of `asked` and `indexed` (from `letter_index`) in one group whose
    insert/delete ratio is at least `limit`."""
    if not LEAST_LIMIT <= limit <= 100:
        raise ValueError(f"the limit must be from {LEAST_LIMIT} to 100")
    part = F.pmod(F.xxhash64("other"), F.col("parts")).cast("int")
    posts = _front(indexed, group, limit).withColumnRenamed("text", "other").select(group, "pair", part.alias("part"), "other")
    turns = _front(asked, group, limit).select(
        group, "text", "pair", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = turns.join(posts, [group, "pair", "part"]).where(possible(F.length("text"), F.length("other"), limit))
    pairs = met.select(group, "text", "other").distinct().join(asked.select(group, "text", "known"), [group, "text"])
    return pairs.select(group, "text", "other", known_ratio(F.col("known"), F.col("other")).alias("score")).where(
        F.col("score") >= limit)

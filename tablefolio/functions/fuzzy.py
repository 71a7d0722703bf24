"""Name similarity on a 0-100 scale as column expressions: no Python worker is involved.

The longest common subsequence comes from bit arithmetic: a text is turned once into a map from each of its characters
to the places it has, as bits in words of `WORD` bits, and each character of the other text costs a few operations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 60  # bits of a word: sums of two words and a carry stay within a long
FULL = (1 << WORD) - 1


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once: Spark would copy the definition into every use of it."""
    return F.transform(F.array(value), body)[0]


def letters(text: Column) -> Column:
    """The characters of a text."""
    places = F.sequence(F.lit(1), F.length(text))
    return F.when(F.length(text) > 0, F.transform(places, lambda i: F.substring(text, i, F.lit(1)))).otherwise(
        F.array().cast("array<string>"))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def _word_places(chars: Column, ch: Column, word: Column) -> Column:
    """The places of `ch` in one word of the characters, as bits."""
    last = F.least(F.lit(WORD), F.size(chars) - word * WORD) - 1
    return F.aggregate(F.sequence(F.lit(0), last), F.lit(0).cast("long"), lambda bits, i: bits + F.when(
        F.get(chars, word * WORD + i) == ch, _bit(i)).otherwise(F.lit(0).cast("long")))


def places(text: Column) -> Column:
    """A struct of a text: `size`, `full` (a word of ones for each of its places), `at` (places of each character)."""

    def described(chars: Column) -> Column:
        words = F.sequence(F.lit(0), F.floor((F.size(chars) - 1) / WORD).cast("int"))
        some = F.size(chars) > 0
        full = F.transform(words, lambda w: _bit(F.least(F.lit(WORD), F.size(chars) - w * WORD)) - 1)
        at = F.map_from_entries(F.transform(F.array_distinct(chars), lambda ch: F.struct(
            ch, F.transform(words, lambda w: _word_places(chars, ch, w)))))
        return F.struct(F.size(chars).alias("size"), F.when(some, full).otherwise(F.array().cast("array<long>")).alias("full"),
                        F.when(some, at).otherwise(F.create_map().cast("map<string,array<long>>")).alias("at"))

    return bound(letters(text), described)


def _step_one(row: Column, bits: Column) -> tuple[Column, Column]:
    return row + row.bitwiseAND(bits), row.bitwiseAND(F.bitwise_not(bits))


def _one_word(known: Column, other: Column) -> Column:
    full = known["full"][0]

    def step(row: Column, bits: Column) -> Column:
        added, kept = _step_one(row, bits)
        return added.bitwiseOR(kept).bitwiseAND(full)

    hits = F.transform(letters(other), lambda ch: F.coalesce(F.try_element_at(known["at"], ch)[0], F.lit(0).cast("long")))
    return known["size"] - F.bit_count(F.aggregate(hits, full, step))


def _many_words(known: Column, other: Column) -> Column:
    def step(row: Column, bits: Column) -> Column:
        start = F.struct(F.array().cast("array<long>").alias("row"), F.lit(0).cast("long").alias("carry"))

        def word(done: Column, w: Column) -> Column:
            added, kept = _step_one(F.get(row, w), F.get(bits, w))
            new = (added + done["carry"]).bitwiseOR(kept).bitwiseAND(F.get(known["full"], w))
            return F.struct(F.array_append(done["row"], new).alias("row"),
                            F.shiftright(added + done["carry"], WORD).alias("carry"))

        return F.aggregate(F.sequence(F.lit(0), F.size(row) - 1), start, word)["row"]

    hits = F.filter(F.transform(letters(other), lambda ch: F.try_element_at(known["at"], ch)), lambda x: x.isNotNull())
    ones = F.aggregate(F.aggregate(hits, known["full"], step), F.lit(0), lambda n, w: n + F.bit_count(w))
    return known["size"] - ones


def common_length(known: Column, other: Column) -> Column:
    """Length of the longest common subsequence of `other` and the text behind `known` (see `places`)."""
    return F.when(known["size"] == 0, F.lit(0)).when(known["size"] <= WORD, _one_word(known, other)).otherwise(
        _many_words(known, other))


def known_ratio(known: Column, other: Column) -> Column:
    """Insert/delete ratio of two texts: 100 * 2 * common / (sum of the lengths), rounded half to even."""
    total = known["size"] + F.length(other)
    return F.when(total == 0, F.lit(100)).otherwise(
        F.bround(200.0 * common_length(known, other) / F.greatest(total, F.lit(1)), 0).cast("int"))


def known_window_ratio(short: Column, long: Column) -> Column:
    """Best ratio of the text behind `short` against any window of its size of `long`, edge windows included."""
    m, n = short["size"], F.length(long)
    starts = F.sequence(1 - m, F.greatest(n - 1, 1 - m))
    windows = F.array_distinct(F.transform(starts, lambda s: F.substring(
        long, F.greatest(s, F.lit(0)) + 1, F.least(s + m, n) - F.greatest(s, F.lit(0)))))
    best = F.array_max(F.transform(windows, lambda w: known_ratio(short, w)))
    return F.when(m == 0, F.when(n == 0, F.lit(100)).otherwise(F.lit(0))).otherwise(best)


def indel_ratio(a: Column, b: Column) -> Column:
    return bound(places(a), lambda known: known_ratio(known, b))


def ratio_to_each(name: Column, others: Column) -> Column:
    """Insert/delete ratio of one comparable name to each element of an array of comparable names."""
    return bound(places(name), lambda known: F.transform(others, lambda other: known_ratio(known, other)))


def best_window_ratio(a: Column, b: Column) -> Column:
    """Best ratio of the shorter text against any window of the longer one."""
    longer = F.length(a) > F.length(b)
    short, long = F.when(longer, b).otherwise(a), F.when(longer, a).otherwise(b)
    return bound(places(short), lambda known: known_window_ratio(known, long))


def window_ratio_to_each(name: Column, others: Column) -> Column:
    """Best-window ratio of one comparable name to each element of an array."""
    return F.transform(others, lambda other: best_window_ratio(name, other))


def edit_to_each(name: Column, others: Column) -> Column:
    """The same scale from Spark's own edit distance."""

    def one(other: Column) -> Column:
        longest = F.greatest(F.length(name), F.length(other), F.lit(1))
        return F.floor(100 - 100 * F.levenshtein(name, other) / longest).cast("int")

    return F.transform(others, one)


SCORERS = {"ratio": ratio_to_each, "window_ratio": window_ratio_to_each, "edit": edit_to_each}

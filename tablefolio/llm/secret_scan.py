"""Secrets in whole texts: three kinds of known form, and strings of high entropy, all as column expressions.

Entropy: candidate strings are runs of one character class. A window of fixed width slides over each; the sum of
c * log2(c) over the counts c of its characters is kept as a whole number and changes only by the two characters that
leave and enter. A window is suspicious if its Shannon entropy log2(width) - sum / width reaches the limit of its class.
Suspicious windows that touch become one span. Candidates that an allow-list pattern matches are suppressed, and so are
spans inside a span of known form.

Defined results: a null text is an empty text without spans; repeated rows give repeated rows; null ids pass through;
other columns are ignored. Positions are code points from 0, ends are exclusive. No shuffle; work grows with the text:
candidates are scanned in blocks, and running positions in chunks, so long texts do not cost more than their length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# the look-ahead only spares the regex engine work at most places
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = rf"(?=[pPsStTaA])(?i:({KEYWORDS}))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a run of hexadecimal characters is taken whole, so asking for 32 at once drops the short ones
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

SCALE = 1 << 20
CHUNK, BLOCK = 256, 512


@dataclass(frozen=True)
class EntropyClass:
    """Runs of one character class, the width of the window and the least entropy in bits a character."""

    kind: str
    candidate: str
    width: int
    bits: float

    @property
    def most(self) -> int:
        """The largest scaled sum of c * log2(c) at which a window is suspicious."""
        return int(self.width * (log2(self.width) - self.bits) * SCALE)

    def terms(self) -> list[int]:
        return [round(c * log2(c) * SCALE) if c else 0 for c in range(self.width + 2)]


CLASSES = (
    EntropyClass("entropy_hex", "[0-9A-Fa-f]{24,}", 24, 3.0),
    EntropyClass("entropy_base64", "[A-Za-z0-9+/_=-]{24,}", 24, 4.0),
)
ALLOW = (
    "^[0-9]+$",  # long numbers
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    "(?i)example|placeholder|changeme|dummy",
    "(?i)abcdefgh|01234567|12345678",  # alphabets and counting
    "^[a-z0-9_-]+(/[a-z0-9_-]+)+/?$",  # paths
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once for all its uses in `body`."""
    return F.transform(F.array(value), body)[0]


def running_sums(values: Column) -> Column:
    """Running sums of an array of longs: sums inside chunks, after the sums of the chunks before."""

    def sums(xs: Column, base: Column) -> Column:
        grown = F.aggregate(xs, F.array(base), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return let(grown, lambda g: F.slice(g, F.lit(2), F.size(g) - 1))

    def whole(xs: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int")),
                             lambda c: F.slice(xs, c * CHUNK + 1, F.lit(CHUNK)))
        zero = F.lit(0).cast("long")
        return let(chunks, lambda cs: let(
            F.concat(F.array(zero), sums(F.transform(cs, lambda c: F.aggregate(c, zero, lambda a, x: a + x)), zero)),
            lambda bases: F.flatten(F.transform(cs, lambda c, i: sums(c, F.get(bases, i))))))

    return let(values, lambda xs: F.when(F.size(xs) > 0, whole(xs)).otherwise(F.array().cast("array<long>")))


def matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Leftmost matches that do not overlap: array of (start, found, value), `value` being the given group."""
    kind = "array<struct<start:long,found:string,value:string>>"

    def place(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
        steps = let(gaps, lambda g: F.transform(
            found, lambda f, i: F.get(g, i) + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0)))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
        return let(running_sums(steps), lambda starts: let(values, lambda v: F.transform(
            found, lambda f, i: F.struct(F.get(starts, i).alias("start"), f.alias("found"), F.get(v, i).alias("value")))))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda found: F.when(F.size(found) > 0, place(found)).otherwise(F.array().cast(kind)))


def span(start: Column, end: Column, rank: int, kind: str) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(rank).alias("rank"), end.cast("long").alias("end"),
                    F.lit(kind).alias("kind"))


def known_spans(text: Column) -> Column:
    """Spans of the three known forms."""
    def of(rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
        long_enough = F.filter(matches(text, pattern, group), lambda m: F.length(m["value"]) >= least)
        return F.transform(long_enough, lambda m: span(m["start"], m["start"] + F.length(m["found"]), rank, kind))

    return F.concat(of(0, "assign", ASSIGN, 2, ASSIGN_LEAST), of(1, "access", ACCESS, 0, ACCESS_LEAST),
                    of(2, "hex", HEX, 0, 32))


def suspicious_windows(candidate: Column, cls: EntropyClass) -> Column:
    """Parts of one candidate that suspicious windows cover: array of (from, to)."""
    w, table = cls.width, F.array(*[F.lit(t).cast("long") for t in cls.terms()])
    ranges = "array<struct<a:long,b:long>>"

    def count(ch: Column, inside: Column) -> Column:
        return F.length(inside) - F.length(F.replace(inside, ch, F.lit("")))

    def joined(have: Column, a: Column, b: Column) -> Column:
        """Append a range, or make the last one longer if they touch."""
        last = F.element_at(have, -1)
        new = F.array(F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")))
        longer = F.array(F.struct(last["a"].alias("a"), b.cast("long").alias("b")))
        return (F.when(F.size(have) == 0, new).when(last["b"] >= a, F.concat(F.slice(have, 1, F.size(have) - 1), longer))
                .otherwise(F.concat(have, new)))

    def block(s: Column, offset: Column) -> Column:
        """All windows that begin in one block of the candidate."""
        first = F.substring(s, 1, w)
        total = F.aggregate(F.array_distinct(F.split(first, "")), F.lit(0).cast("long"),
                            lambda acc, ch: acc + F.get(table, count(ch, first)))

        def hit(total: Column, have: Column, i: Column) -> Column:
            return F.when(total <= cls.most, joined(have, offset + i, offset + i + w)).otherwise(have)

        def slide(state: Column, i: Column) -> Column:
            left, entered = F.substr(s, i, F.lit(1)), F.substr(s, i + w, F.lit(1))
            kept = F.substr(s, i + 1, F.lit(w - 1))
            n_left, n_entered = count(left, kept), count(entered, kept)
            moved = (state["total"] - F.get(table, n_left + 1) + F.get(table, n_left)
                     - F.get(table, n_entered) + F.get(table, n_entered + 1))
            return let(moved, lambda t: F.struct(t.alias("total"), hit(t, state["have"], i).alias("have")))

        start = let(total, lambda t: F.struct(t.alias("total"), hit(t, F.array().cast(ranges), F.lit(0)).cast(ranges).alias("have")))
        steps = F.when(F.length(s) > w, F.sequence(F.lit(1), F.length(s) - w)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, start, slide, lambda state: state["have"])

    offsets = F.sequence(F.lit(0), F.length(candidate) - w, F.lit(BLOCK))
    found = F.flatten(F.transform(offsets, lambda o: let(
        F.substr(candidate, o + 1, F.lit(BLOCK + w - 1)), lambda s: block(s, o))))
    return F.aggregate(found, F.array().cast(ranges), lambda acc, r: joined(acc, r["a"], r["b"]))


def entropy_spans(text: Column, classes: tuple[EntropyClass, ...], allow: tuple[str, ...], first_rank: int) -> Column:
    def of(rank: int, cls: EntropyClass) -> Column:
        open_to = F.filter(matches(text, cls.candidate), lambda m: ~F.coalesce(
            *[F.when(m["found"].rlike(a), F.lit(True)) for a in allow], F.lit(False)))
        return F.flatten(F.transform(open_to, lambda m: F.transform(
            suspicious_windows(m["found"], cls),
            lambda r: span(m["start"] + r["a"], m["start"] + r["b"], rank, cls.kind))))

    return F.concat(*[of(first_rank + k, c) for k, c in enumerate(classes)])


def listed(spans: Column) -> Column:
    """`kind:start:end` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat(
        s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 classes: tuple[EntropyClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Per row: `id_col` and `spans`, an array of (start, rank, end, kind) by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def all_spans(known: Column) -> Column:
        new = F.filter(entropy_spans(text, classes, allow, 3), lambda s: ~F.exists(
            known, lambda k: (k["start"] <= s["start"]) & (s["end"] <= k["end"])))
        return F.array_sort(F.concat(known, new))

    return docs.select(F.col(id_col), let(known_spans(text), all_spans).alias("spans"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the spans of every row."""
    known = F.filter("spans", lambda s: s["rank"] < 3)

    def n(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    return find_secrets(docs, id_col, text_col).select(
        id_col, n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(listed(known), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

"""Page selection: which report pages hold a portfolio table.

A page is one row: doc_id, page (0-based), text, height, and `spans`, the array of its text spans
(text, size, dir_x, block_y0, x0, y0, x1, y1). All span work is array functions inside that row, so no span is
ever shuffled; only the page chain of a document needs ordered neighbours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.functions.numbers import is_amount_text
from tablefolio.functions.texts import contains_any
from tablefolio.operators.ordered import SEGMENT, SEGMENT_ROWS, RowOrder, settled
from tablefolio.rules import CARRY_METRICS, DEFAULT_RULES, HEADER_METRICS, RuleSet
from tablefolio.session import durable

# Title phrases of the two table kinds, words of watermarks and of valuation stamps, documents kept
# in their own layout, and the numeric limits of page selection.
SIT_PHRASES = ("schedule of investments", "schedule of portfolio investments", "investment schedule")
PST_PHRASES = (
    "portfolio summary", "active portfolio", "investments currently in the portfolio", "investments as of",
    "investment multiple and gross irr", "portfolio company summary", "investment performance",
    "portfolio company summaries", "portfolio valuations by company", "portfolio highlights", "core investments",
    "summary of investments",
)
WATERMARK_TERMS = ("confidential",)
STAMP_TEXTS = ("CURRENT FAIR VALUE", "CURRENT FAIR VALUE")
MIN_PAGE_CHARS = 200
MAX_SPAN_SIZE = 20
EDGE_SPANS = 32
MIN_ALIGNED = 5
ALIGN_WITHIN = 1
TOP_SHARE = 0.25
MIN_TOP_METRICS = 3
HEADER_GAP = 12
ROTATED_ABOVE = 1.9

SPAN = ("struct<text:string,size:double,dir_x:double,block_y0:double,"
        "x0:double,y0:double,x1:double,y1:double>")


def normal_text(text: Column) -> Column:
    """Lower case without line breaks."""
    return F.replace(F.lower(text), F.lit("\n"), F.lit(""))


def _upright(s: Column) -> Column:
    return (F.abs(s["dir_x"]) < 0.01) | (F.abs(F.abs(s["dir_x"]) - 1) < 0.01)


def _not_watermark(s: Column, terms: tuple[str, ...]) -> Column:
    return ~contains_any(F.lower(s["text"]), terms) & (s["size"] < MAX_SPAN_SIZE)


def kept_spans(spans: Column, terms: tuple[str, ...] = WATERMARK_TERMS) -> Column:
    """Spans that are upright, small, and neither watermark nor valuation stamp."""
    return F.filter(spans, lambda s: _upright(s) & _not_watermark(s, terms) & ~contains_any(s["text"], STAMP_TEXTS))


def keyword_type(text: Column, sit: tuple[str, ...] = SIT_PHRASES, pst: tuple[str, ...] = PST_PHRASES) -> Column:
    """`SIT`, else `PST`, else null, by title phrases in the normal page text."""
    return F.when(contains_any(text, sit), "SIT").when(contains_any(text, pst), "PST")


def top_text(spans: Column, height: Column, terms: tuple[str, ...] = WATERMARK_TERMS) -> Column:
    """Joined lower-case text of the blocks that start in the top quarter of the page."""
    top = F.filter(spans, lambda s: (s["block_y0"] <= height * TOP_SHARE) & _upright(s) & _not_watermark(s, terms))
    return F.lower(F.array_join(F.transform(top, lambda s: s["text"]), ""))


def top_metric_hits(text: Column, rules: RuleSet = DEFAULT_RULES,
                    targets: tuple[str, ...] = HEADER_METRICS) -> Column:
    """Number of target metrics with a phrase of several words in the text.

    A target also takes the phrases of metrics whose name is part of its own name (`total` in `total_cost`).
    """
    hits = F.lit(0)
    for target in targets:
        phrases = rules.phrases(tuple(n for n in rules.names() if n in target), several_words=True)
        hits = hits + contains_any(text, [p for _, p in phrases]).cast("int")
    return hits


def first_phrase_hit(text: Column, rules: RuleSet, targets: tuple[str, ...], several_words: bool) -> Column:
    """First (metric, phrase) of the rules that occurs in the text, as a struct, or null."""
    listed = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(p).alias("phrase"))
                       for m, p in rules.phrases(targets, several_words)])
    return F.get(F.filter(listed, lambda r: F.contains(F.lower(text), r["phrase"])), F.lit(0))


def left_edges(spans: Column) -> Column:
    """Distinct left positions in ascending order."""
    return F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["x0"])))


def aligned_count(a: Column, b: Column) -> Column:
    """Pairs of positions closer than one unit, each position used once, both arrays ascending.

    One pass over `a` that remembers how much of `b` is used up.
    """

    def step(acc: Column, x: Column) -> Column:
        at = F.greatest(acc["used"], F.size(F.filter(b, lambda y: y <= x - ALIGN_WITHIN)))
        hit = F.coalesce(F.get(b, at) - x < ALIGN_WITHIN, F.lit(False))
        return F.struct(F.when(hit, at + 1).otherwise(at).alias("used"),
                        F.when(hit, acc["pairs"] + 1).otherwise(acc["pairs"]).alias("pairs"))

    start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("pairs"))
    return F.aggregate(a, start, step, lambda acc: acc["pairs"])


def page_features(pages: DataFrame, rules: RuleSet = DEFAULT_RULES, sit: tuple[str, ...] = SIT_PHRASES,
                  pst: tuple[str, ...] = PST_PHRASES, terms: tuple[str, ...] = WATERMARK_TERMS) -> DataFrame:
    """Per page: own table type, long enough, and the first and last kept spans. No shuffle."""
    out = settled(pages.select(
        "doc_id", "page", normal_text(F.col("text")).alias("norm_text"), kept_spans(F.col("spans"), terms).alias("kept"),
        top_text(F.col("spans"), F.col("height"), terms).alias("top")))
    named = keyword_type(F.col("norm_text"), sit, pst)
    top_hits = top_metric_hits(F.col("top"), rules)
    return out.select(
        "doc_id", "page",
        F.when(named.isNotNull(), named).when(top_hits >= MIN_TOP_METRICS, "PST").alias("own_type"),
        (F.length("norm_text") >= MIN_PAGE_CHARS).alias("long_enough"),
        F.slice("kept", 1, EDGE_SPANS).alias("top_spans"),
        F.reverse(F.slice(F.reverse("kept"), 1, EDGE_SPANS)).alias("tail_spans"),
    )


def chain_pages(features: DataFrame, keep_layout: Column | None = None,
                segment_rows: int | None = SEGMENT_ROWS,
                cut: Callable[[DataFrame], DataFrame] = durable) -> DataFrame:
    """Pages that hold a table: found by themselves or continuing the kept page before them.

    The features are read more than once and cost the whole page text, so they are cut off first.
    A page is kept when, going back over linked pages, a page found by itself is reached before the chain breaks:
    the last such page must not lie before the last break. Both are running maxima.
    """
    order = RowOrder(("doc_id",), "page", segment_rows)
    features = cut(features)
    own = F.col("own_type").isNotNull() & F.col("long_enough")
    lookback = order.neighbours(features.withColumn("top_x", left_edges(F.col("top_spans"))), {
        "prev_tail_x": (left_edges(F.col("tail_spans")), -1),
        "prev_top": (F.col("top_spans"), -1),
    }, keep_segment=True)
    link = F.col("long_enough") & F.coalesce(
        aligned_count(F.col("top_x"), F.col("prev_tail_x")) >= MIN_ALIGNED, F.lit(False))
    if keep_layout is not None:
        link = link & ~keep_layout
    segment = [c for c in (SEGMENT,) if c in lookback.columns]
    marked = lookback.select("doc_id", "page", *segment, "own_type", "long_enough", "top_spans", "prev_top",
                             own.alias("own"), link.alias("link"))
    chained = order.running(marked, maxima={
        "last_own": F.when(F.col("own"), F.col("page")),
        "last_break": F.when(~F.col("link"), F.col("page")),
    })
    kept = F.col("last_own").isNotNull() & (
        F.col("last_break").isNull() | (F.col("last_own") >= F.col("last_break")))
    return chained.where(kept).select(
        "doc_id", "page", F.when(F.col("own"), F.col("own_type")).otherwise("PST").alias("table_type"),
        (~F.col("own")).alias("is_continuation"), "top_spans", "prev_top")


def carried_header(top: Column, prev_top: Column, rules: RuleSet = DEFAULT_RULES,
                   targets: tuple[str, ...] = CARRY_METRICS) -> Column:
    """Header spans of the page before, moved to just above the first number of this page; empty if none.

    The header region spans from the page corner to the far corner of all spans with a rule phrase.
    """
    phrases = [p for _, p in rules.phrases(targets)]
    first = F.get(F.filter(top, lambda s: is_amount_text(s["text"])), F.lit(0))
    y = F.floor(first["y0"]).cast("double")
    named = F.filter(prev_top, lambda s: contains_any(F.lower(s["text"]), phrases))

    def edge(name: str, low: bool) -> Column:
        pick = F.array_min if low else F.array_max
        both = F.concat(F.array(F.lit(0.0)), F.transform(named, lambda s: s[name]))
        return pick(both)

    box = F.struct(edge("x0", True).alias("x0"), edge("y0", True).alias("y0"),
                   edge("x1", False).alias("x1"), edge("y1", False).alias("y1"), y.alias("y"))

    def place(b: Column) -> Column:
        inside = F.filter(prev_top, lambda s: (s["x0"] >= b["x0"]) & (s["x1"] <= b["x1"])
                          & (s["y0"] >= b["y0"]) & (s["y1"] <= b["y1"]))
        usable = (b["y"] > 0) & (b["x0"] < b["x1"]) & (b["y0"] < b["y1"])
        return F.when(usable, F.transform(inside, lambda s: output_span(s, s["y0"] - b["y1"] + b["y"] - HEADER_GAP,
                                                                        b["y"] - HEADER_GAP, 2)))

    placed = F.get(F.transform(F.array(box), place), F.lit(0))
    return F.coalesce(placed, F.array().cast("array<struct<text:string,x:double,y:double,size:double,rotated:boolean>>"))


def output_span(s: Column, y: Column, y_rotated: Column, inset: float) -> Column:
    """Text without `$`, its place and size on the output page, and whether it stands upright."""
    rotated = (s["y1"] - s["y0"]) > (s["x1"] - s["x0"]) * ROTATED_ABOVE
    return F.struct(
        F.replace(s["text"], F.lit("$"), F.lit("")).alias("text"),
        F.when(rotated, s["x1"] - inset).otherwise(s["x0"]).alias("x"),
        F.when(rotated, y_rotated).otherwise(y).alias("y"),
        (s["size"] - 0.5).alias("size"), rotated.alias("rotated"))


def output_spans(kept: Column) -> Column:
    """Every kept span as it is written to the output page."""
    return F.transform(kept, lambda s: output_span(s, s["y0"], s["y1"] - 8, 2))


def keeps_layout(path: Column, names: tuple[str, ...]) -> Column:
    """Documents of these funds keep their pages as they are."""
    return F.rlike(path, F.lit("(?i)" + "|".join(names)))


def number_pages(docs: DataFrame, pages: DataFrame, cut: Callable[[DataFrame], DataFrame] = durable) -> DataFrame:
    """Registry of kept pages in document order, numbered over all documents; documents without any stay in.

    docs: doc_ord, report_path, page_count. pages: doc_ord, page, table_type. The global number is the page's
    place in its document plus the pages of all earlier documents: only one count per document is put in order,
    so no task ever sorts all pages.
    """
    order = RowOrder(("doc_ord",), "page")
    pages = cut(pages.select("doc_ord", "page", "table_type"))
    local = order.dense(pages, "place")
    counts = pages.groupBy("doc_ord").agg(F.count("*").alias("n"))
    offsets = _offsets(counts)
    found = local.join(offsets, "doc_ord").join(docs, "doc_ord").select(
        "doc_ord", "report_path", F.element_at(F.split("report_path", "/"), -1).alias("report_name"), "page_count",
        (F.col("page") + 1).alias("page_ori"), (F.col("offset") + F.col("place") + 1).cast("long").alias("page_new"),
        "table_type", F.lit(True).alias("is_processed"))
    empty = docs.join(counts, "doc_ord", "left_anti").select(
        "doc_ord", "report_path", F.element_at(F.split("report_path", "/"), -1).alias("report_name"), "page_count",
        F.lit(None).cast("int").alias("page_ori"), F.lit(None).cast("long").alias("page_new"),
        F.lit(None).cast("string").alias("table_type"), F.lit(False).alias("is_processed"))
    return found.unionByName(empty)


def _offsets(counts: DataFrame, block: int = SEGMENT_ROWS) -> DataFrame:
    """Pages before each document: block totals first, then inside each block of documents."""
    blocked = counts.withColumn("all", F.lit(0))
    running = RowOrder(("all",), "doc_ord", block).running(blocked, sums={"offset": F.col("n")}, inclusive=False)
    return running.select("doc_ord", "offset")


def batch_id(paths: Column) -> Column:
    """First four hex digits of the SHA-256 of an array of report paths joined by commas."""
    return F.substring(F.sha2(F.array_join(paths, ","), 256), 1, 4)

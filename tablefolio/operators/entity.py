"""Matching extracted company names to the master list.

Names that share an identifier (their front part) are candidates. The pairs are never written out: master names
of one identifier are packed into small lists, each extracted name meets whole lists, and only its best few
candidates per list go on. A very common identifier gives many lists, each a join key of its own.

With the default scorer names do not meet whole lists either: an index of letter pairs (`similar.py`) gives all
candidates above a high score, and only names that find too few there ask for lower scores, at last for whole lists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.functions.fuzzy import SCORERS
from tablefolio.functions.names import block_identifier, clean_company_name, comparable, has_letter
from tablefolio.operators.ordered import settled
from tablefolio.operators.similar import LEAST_LIMIT, letter_index, possible, similar_texts
from tablefolio.session import durable

# Score a candidate must exceed, number of candidates kept, and the names of the two run modes.
ACCEPT_ABOVE = 85
TOP_CANDIDATES = 5
MODES = ("full", "partial")
LIST_SIZE = 256
SURE_BELOW = 99
FEW = 16  # an identifier with no more candidates than this needs no index
FIRST_LIMIT = 96  # names first look for candidates of at least this score
EQUAL_WINS = ("ratio", "edit")  # scorers that give 100 to equal names alone


def table_for_mode(mode: str, tables: dict[str, str]) -> str:
    """The table of a run mode; which tables these are is the caller's to say."""
    if mode not in MODES:
        raise ValueError("mode is either full or partial")
    return tables[mode]


def complete_rows(companies: DataFrame) -> DataFrame:
    """Rows without any null whose name has a letter."""
    return companies.dropna("any").where(has_letter(F.col("company_name")))


def clean_extracted(companies: DataFrame) -> DataFrame:
    """Complete rows with the cleaned name."""
    complete = complete_rows(companies)
    return settled(complete.withColumn("company_name", clean_company_name(F.col("company_name"))))


def clean_master(master: DataFrame) -> DataFrame:
    """company_id, company_name_master (cleaned), identifier."""
    cleaned = settled(master.withColumn("company_name_master", clean_company_name(F.col("company_name_master"))))
    return cleaned.withColumn("identifier", block_identifier(F.col("company_name_master")))


def master_entries(master: DataFrame, list_size: int = LIST_SIZE,
                   cut: Callable[[DataFrame], DataFrame] = durable) -> tuple[DataFrame, DataFrame]:
    """(entries, blocks) of the cleaned master names.

    entries: one row per cleaned name with its copies, smallest id and list number. blocks: one row per
    identifier with its candidates, number of lists and smallest id. The list of an entry is its hash modulo the
    number of lists its identifier needs. The cleaned names are used several times, so they are cut off first.
    """
    names = cut(master.groupBy("identifier", "company_name_master").agg(
        F.count("*").alias("copies"), F.min("company_id").alias("company_id")))
    blocks = names.groupBy("identifier").agg(
        F.sum("copies").alias("n_candidates"), F.ceil(F.count("*") / list_size).alias("lists"),
        F.min("company_id").alias("only_id"))
    entries = names.join(blocks.select("identifier", "lists"), "identifier").withColumns({
        "list": F.pmod(F.xxhash64("company_name_master"), F.col("lists")),
        "scored": comparable(F.col("company_name_master"))}).drop("lists")
    return entries, blocks


def named_blocks(names: DataFrame, blocks: DataFrame) -> DataFrame:
    """Distinct names with the block of their identifier; names without candidates are absent."""
    distinct = names.select("company_name").distinct().withColumns({
        "identifier": block_identifier(F.col("company_name")), "scored": comparable(F.col("company_name"))})
    return distinct.join(blocks, "identifier")


def _rank(blocked: DataFrame, entries: DataFrame, scorer: str, top: int, above: int | None = None) -> DataFrame:
    """The best `top` entries of each name: the best of every list first, then the best of those.

    With `above` only scores above it count, and for `ratio` entries whose length rules that out are not scored.
    """
    entry = F.struct("company_name_master", "copies", "company_id", "scored")
    lists = entries.groupBy("identifier", "list").agg(F.collect_list(entry).alias("entries"))
    turns = blocked.withColumn("list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lists") - 1)))
    met = turns.join(lists, ["identifier", "list"])
    if above is not None and scorer == "ratio":
        met = met.withColumn("entries", F.filter("entries", lambda e: possible(F.length("scored"), F.length(e["scored"]), above + 1)))
        met = met.where(F.size("entries") > 0)
    scored = met.withColumn("scores", SCORERS[scorer](F.col("scored"), F.transform("entries", lambda e: e["scored"])))
    ranked = F.array_sort(F.zip_with("entries", "scores", lambda e, s: F.struct(
        (-s).alias("minus"), e["company_name_master"].alias("candidate"), e["company_id"].alias("company_id"),
        e["copies"].alias("copies"))))
    few = scored.select("company_name", "n_candidates", F.inline(F.slice(ranked, 1, top)))
    order = Window.partitionBy("company_name").orderBy("minus", "candidate", "company_id")
    return few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).select(
        "company_name", "n_candidates", "candidate", "copies", "company_id", (-F.col("minus")).alias("score"), "place")


def _similar(blocked: DataFrame, entries: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """The best `top` entries of each name among the scored `pairs`, in the columns of `_rank`."""
    named = blocked.select("identifier", F.col("scored").alias("text"), "company_name", "n_candidates")
    listed = entries.select("identifier", F.col("scored").alias("other"), F.col("company_name_master").alias("candidate"),
                            "copies", "company_id")
    met = pairs.join(named, ["identifier", "text"]).join(listed, ["identifier", "other"])
    order = Window.partitionBy("company_name").orderBy(F.col("score").desc(), "candidate", "company_id")
    return met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).select(
        "company_name", "n_candidates", "candidate", "copies", "company_id", "score", "place")


def _rank_by_ratio(blocked: DataFrame, entries: DataFrame, top: int, above: int | None,
                   cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """As `_rank` with `ratio`; identifiers with more than `FEW` candidates by index. All entries of at least a limit are
    found at once, so a name with `top` of them is done; the others go on to the next limit, and to whole lists only
    without `above`."""
    wanted = ACCEPT_ABOVE + 1 if above is None else max(above + 1, LEAST_LIMIT)
    few = F.col("n_candidates") <= FEW
    left, done = cut(blocked.where(~few)), [_rank(blocked.where(few), entries, "ratio", top, above)]
    many = cut(entries.join(left.select("identifier").distinct(), "identifier", "left_semi"))
    asked, indexed = letter_index(left.withColumnRenamed("scored", "text"), many.withColumnRenamed("scored", "text"),
                                  "identifier", cut)
    for limit in sorted({max(FIRST_LIMIT, wanted), wanted}, reverse=True):
        texts = left.select("identifier", F.col("scored").alias("text")).distinct()
        pairs = similar_texts(asked.join(texts, ["identifier", "text"], "left_semi"), indexed, "identifier", limit)
        found = cut(_similar(left, many, pairs, top))
        if above is not None and limit == above + 1:
            return _all(done + [found])
        full = found.where(F.col("place") == top).select("company_name")
        done.append(found.join(full, "company_name", "left_semi"))
        left = left.join(full, "company_name", "left_anti")
    return _all(done + [_rank(left, many, "ratio", top, above)])


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _best(blocked: DataFrame, entries: DataFrame, scorer: str, top: int, above: int | None,
          cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    if scorer == "ratio":
        return _rank_by_ratio(blocked, entries, top, above, cut)
    return _rank(blocked, entries, scorer, top, above)


def best_candidates(names: DataFrame, master: DataFrame, scorer: str = "ratio", top: int = TOP_CANDIDATES,
                    list_size: int = LIST_SIZE, cut: Callable[[DataFrame], DataFrame] = durable) -> DataFrame:
    """Up to `top` best candidates of each distinct name, best first, equal scores in name order.

    Result: company_name, n_candidates, candidate, copies, company_id, score, place.
    """
    entries, blocks = master_entries(master, list_size, cut)
    blocked = named_blocks(names, blocks)
    return _best(cut(blocked) if scorer == "ratio" else blocked, entries, scorer, top, None, cut)


def decide(best: DataFrame, accept_above: int = ACCEPT_ABOVE) -> DataFrame:
    """company_name, n_candidates, best_score, company_id.

    A single candidate is taken at any score; of several the best must exceed the limit and beat the second.
    A master name that occurs several times ties with itself.
    """
    first, second = F.col("place") == 1, F.col("place") == 2
    per_name = best.groupBy("company_name").agg(
        F.max("n_candidates").alias("n_candidates"), F.max(F.when(first, F.col("score"))).alias("best_score"),
        F.max(F.when(first, F.col("copies"))).alias("copies"), F.max(F.when(second, F.col("score"))).alias("next"),
        F.max(F.when(first, F.col("company_id"))).alias("id"))
    alone = F.col("n_candidates") == 1
    clear = (F.col("copies") == 1) & (F.col("best_score") > F.coalesce(F.col("next"), F.lit(-1)))
    return per_name.select(
        "company_name", "n_candidates", "best_score",
        F.when(alone | ((F.col("best_score") > accept_above) & clear), F.col("id")).alias("company_id"))


def name_ids(names: DataFrame, master: DataFrame, scorer: str = "ratio", accept_above: int = ACCEPT_ABOVE,
             list_size: int = LIST_SIZE, cut: Callable[[DataFrame], DataFrame] = durable) -> DataFrame:
    """company_name, company_id of the distinct names that match.

    Most names are settled by equi joins: a single candidate is taken, and with a scorer of `EQUAL_WINS` an equal name
    scores 100, which no other candidate reaches as long as names are short of 100 characters, so one equal entry is
    taken and two tie. Only the remaining names are scored against lists.
    """
    entries, blocks = master_entries(master, list_size, cut)
    blocked = named_blocks(names, blocks)
    equal = entries.groupBy("identifier", "scored").agg(
        F.sum("copies").alias("equal_copies"), F.min("company_id").alias("equal_id"))
    seen = cut(blocked.join(equal, ["identifier", "scored"], "left"))
    alone = F.col("n_candidates") == 1
    sure = F.lit(scorer in EQUAL_WINS and accept_above < 100) & (F.length("scored") < SURE_BELOW)
    settled = alone | (F.col("equal_copies").isNotNull() & sure)
    easy = seen.where(settled).select("company_name", F.when(alone, F.col("only_id")).when(
        F.col("equal_copies") == 1, F.col("equal_id")).alias("company_id"))
    hard = _best(seen.where(~settled).select(*blocked.columns), entries, scorer, 2, accept_above, cut)
    return easy.unionByName(decide(hard, accept_above).select("company_name", "company_id")).where(
        "company_id IS NOT NULL")


def match_companies(extracted: DataFrame, master: DataFrame, scorer: str = "ratio",
                    accept_above: int = ACCEPT_ABOVE, list_size: int = LIST_SIZE,
                    cut: Callable[[DataFrame], DataFrame] = durable) -> DataFrame:
    """Cleaned extracted companies with the matched `company_id` (null without a match).

    Each distinct spelling is cleaned once and matched once; the rows only look up their spelling. No fan-out.
    """
    complete = complete_rows(extracted.drop("company_id"))
    spellings = complete.select("company_name").distinct()
    spellings = cut(spellings.withColumn("clean_name", clean_company_name(F.col("company_name"))))
    ids = name_ids(spellings.select(F.col("clean_name").alias("company_name")), clean_master(master), scorer,
                   accept_above, list_size, cut)
    known = spellings.join(ids.withColumnRenamed("company_name", "clean_name"), "clean_name", "left")
    return complete.join(known, "company_name").withColumn("company_name", F.col("clean_name")).drop("clean_name")


def coverage(matched: DataFrame) -> DataFrame:
    """Distinct matched ids and distinct names."""
    return matched.agg(F.countDistinct("company_id").alias("matched_ids"),
                       F.countDistinct("company_name").alias("names"))


def matched_only(matched: DataFrame) -> DataFrame:
    return matched.dropna(subset=["company_id"]).withColumn("company_id", F.col("company_id").cast("bigint"))


def only_in_new(old: DataFrame, new: DataFrame, key: str = "company_id") -> DataFrame:
    """Rows of the new run whose key the old run does not have."""
    return new.join(old.select(key).distinct(), key, "left_anti")

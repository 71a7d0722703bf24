"""Table admission and header repair, decided once per table from a small profile.

Tables are rows (`table_id`, `row_idx` from 0, `values`) and headers (`table_id`, `header`); every row is as wide
as its header. One pass over the cells, aggregated before the shuffle, gives each column's counts split by row 0,
row 1 and the rest, because header repair may take rows 0 and 1 away. All later decisions work on that one record
per table; the rows are not touched again until the columns are known.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.functions.numbers import is_number, parse_money
from tablefolio.operators.ordered import settled
from tablefolio.rules import DEFAULT_RULES, HEADER_METRICS, RuleSet

# Limits of table admission, marks of check boxes, and the security words of layered tables.
MIN_ROWS = 4
MIN_COLUMNS = 3
MIN_HEADER_METRICS = 2
SELECTION_MARKS = (":unselected:", ":selected:")
LAYERED = r"(?i)Series [A-Z](?:-\d+)?|Class [A-Z]|Common Stock|Preferred Stock"
LAYERED_WIDE = r"(?i)Series [A-Z](?:-\d+)?|Class [A-Z]|Common Stock|Preferred"
INVALID_TABLE = "WRN-ID2002"

ROWS, FILLED, NUMBER, MONEY, MONEY_SUM, LAYER, LAYER_WIDE, PAIRED, VALUE_RULES = range(9)


def drop_marks(value: Column) -> Column:
    """Remove check-box marks from a cell."""
    for mark in SELECTION_MARKS:
        value = F.replace(value, F.lit(mark), F.lit(""))
    return value


def clean_header(name: Column, trim: bool = True) -> Column:
    """Drop `*`, squeeze blanks; trimming can be switched off to follow the original rule to the letter."""
    out = F.regexp_replace(F.replace(name, F.lit("*"), F.lit("")), r"\s+", " ")
    return F.trim(out) if trim else out


def is_layered(value: Column, wide: bool = False) -> Column:
    """The cell names a share class."""
    return F.coalesce(value.rlike(LAYERED_WIDE if wide else LAYERED), F.lit(False))


def blank_header(name: Column) -> Column:
    return F.coalesce(F.contains(name, F.lit("Unnamed")) | (name == ""), F.lit(True))


def unique_names(header: Column) -> Column:
    """Repeated names get `.1`, `.2`, … as CSV readers do; blanks stay blank."""
    def one(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(header, F.lit(1), i), lambda other: other == name))
        return F.when((before > 0) & (name != ""), F.concat(name, F.lit("."), before.cast("string"))).otherwise(name)

    return F.transform(header, one)


def header_metric_count(text: Column, rules: RuleSet = DEFAULT_RULES,
                        targets: tuple[str, ...] = HEADER_METRICS) -> Column:
    """Number of target metrics named in a text, each phrase being removed once it was found.

    The removal keeps `realized` from being found inside `unrealized`.
    """
    known = [n for n in rules.names() if n in targets]
    phrases = F.array(*[F.struct(F.lit(p).alias("phrase"), F.lit(1 << known.index(m)).alias("bit"))
                        for m, p in rules.phrases(targets)])
    start = F.struct(F.lower(text).alias("left"), F.lit(0).alias("seen"))

    def step(acc: Column, r: Column) -> Column:
        hit = F.contains(acc["left"], r["phrase"])
        return F.struct(F.replace(acc["left"], r["phrase"], F.lit("")).alias("left"),
                        F.when(hit, acc["seen"].bitwiseOR(r["bit"])).otherwise(acc["seen"]).alias("seen"))

    return F.aggregate(phrases, start, step, lambda acc: F.bit_count(acc["seen"]))


def mostly_unnamed(header: Column) -> Column:
    """More than half of the names are blank: row 0 is the real header (inventory variant)."""
    return F.size(F.filter(header, blank_header)) > F.floor(F.size(header) / 2)


def promote_if(header: Column, first_row: Column, test: Column) -> Column:
    """Row 0 as header where the test holds."""
    return F.when(test, F.transform(first_row, lambda v: F.coalesce(v, F.lit("")))).otherwise(header)


def _value_rules(rules: RuleSet) -> list[str]:
    return ["(?i)" + "|".join(r.patterns) for m in rules.metrics for r in m.rules if r.on_values]


def table_profiles(headers: DataFrame, rows: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """table_id, header, cells: array of (zone, col_idx, text, stats); zone 0 and 1 are rows 0 and 1, 2 the rest."""
    pairs = F.arrays_zip(F.col("values").alias("v"), F.slice("values", F.lit(2), F.size("values")).alias("next"))
    cell = rows.select("table_id", F.least("row_idx", F.lit(2)).alias("zone"),
                       F.posexplode(pairs).alias("col_idx", "cell"))
    v = F.col("v")
    cell = cell.select("table_id", "zone", "col_idx", drop_marks(F.col("cell.v")).alias("v"),
                       F.col("cell.next").isNotNull().alias("next"))
    cell = cell.withColumn("money", parse_money(v))
    # each test is asked only where the one before it holds: a number is money, a share class never is
    cell = cell.withColumns({"number": F.col("money").isNotNull() & is_number(v),
                             "wide": F.col("money").isNull() & is_layered(v, wide=True)})

    def number_of(test: Column | str) -> Column:
        return F.count_if(test).cast("double")

    # the text is a key and all counts have a fixed size: the cells are hashed as they come, never sorted
    text = F.when(F.col("zone") < 2, v)
    counted = cell.groupBy("table_id", "zone", "col_idx", text.alias("text")).agg(
        F.array(
            F.count("*").cast("double"), F.count(v).cast("double"), number_of(F.col("number")),
            F.count("money").cast("double"), F.coalesce(F.sum("money"), F.lit(0.0)),
            number_of(F.col("wide") & is_layered(v)), number_of("wide"),
            number_of(v.isNotNull() & F.col("next")),
            *[number_of(v.rlike(p)) for p in _value_rules(rules)],
        ).alias("stats"),
    )
    tables = counted.groupBy("table_id").agg(
        F.array_sort(F.collect_list(F.struct("zone", "col_idx", "text", "stats"))).alias("cells"))
    return headers.join(tables.withColumn("cells", _one_per_place("cells")), "table_id", "left")


def _one_per_place(cells: str) -> Column:
    """Sorted cells with one entry per place. Only a repeated row 0 or 1 gives a place two texts: the greater one stays."""
    def place(c: Column) -> Column:
        return F.struct(c["zone"], c["col_idx"])

    def united(at: Column) -> Column:
        here = F.filter(cells, lambda c: place(c) == at)
        last = F.element_at(here, -1)
        first = F.transform(last["stats"], lambda _: F.lit(0.0))
        stats = F.aggregate(here, first, lambda acc, c: F.zip_with(acc, c["stats"], lambda a, b: a + b))
        return F.struct(last["zone"].alias("zone"), last["col_idx"].alias("col_idx"), last["text"].alias("text"), stats.alias("stats"))

    places = F.array_distinct(F.transform(cells, place))
    return F.when(F.size(places) == F.size(cells), F.col(cells)).otherwise(F.transform(places, united))


def _zone_texts(zone: int) -> Column:
    return F.transform(F.filter("cells", lambda c: c["zone"] == zone), lambda c: c["text"])


def _column_stats(skip: Column, n_stats: int) -> Column:
    """Per column, the stats added up over the rows that stay."""
    def one(i: Column) -> Column:
        mine = F.filter("cells", lambda c: (c["col_idx"] == i) & (c["zone"] >= skip))
        zero = F.array(*[F.lit(0.0)] * n_stats)
        return F.aggregate(mine, zero, lambda acc, c: F.zip_with(acc, c["stats"], lambda a, b: a + b))

    return F.transform(F.sequence(F.lit(0), F.size("header") - 1), one)


@lru_cache(maxsize=16)
def _repair_steps(rules: RuleSet, trim: bool) -> tuple[list[dict[str, Column]], list[Column]]:
    """The decisions as column definitions, each step on top of the one before; built once per rule set."""
    n_stats = VALUE_RULES + len(_value_rules(rules))
    col, get = F.col, F.get

    def is_company(i: Column) -> Column:
        return F.contains(F.lower(get("names", i)), F.lit("company"))

    def strips(i: int) -> Column:
        s = get("stats", F.lit(i))
        missing = col("n_data") - s[FILLED]
        mostly_empty = (missing / col("n_data") > 0.5) & (missing > 3)
        return F.coalesce(
            (s[NUMBER] > 2) | (~col("layered") & mostly_empty & ~is_company(F.lit(i))), F.lit(False))

    def column(i: Column, place: Column) -> Column:
        name = get("names", i)
        own, after = get("stats", i), get("stats", i + 1)
        folded = (place == 0) & col("merged")
        return F.struct(
            i.alias("col_idx"),
            F.when(name == "", F.concat(F.lit("Unnamed: "), place.cast("string"))).otherwise(name).alias("name"),
            F.when(folded, F.zip_with(own, after, lambda a, b: a + b)).otherwise(own).alias("stats"))

    steps = [{
        "blank": F.transform("header", blank_header),
        "whole": _column_stats(F.lit(0), n_stats),
        "row0": _zone_texts(0), "row1": _zone_texts(1),
    }, {
        "n_rows": F.coalesce(get("whole", F.lit(0))[ROWS], F.lit(0.0)),
        "promoted": F.forall("blank", lambda b: b),
        "digit_name": F.exists("header", lambda h: h.rlike(r"^\p{Nd}+$")),
    }, {
        "names": F.when(col("promoted"), F.transform("row0", lambda v: F.coalesce(v, F.lit("")))).otherwise(
            F.transform("header", lambda h: F.when(blank_header(h), F.lit("")).otherwise(h))),
        "first_texts": F.transform(
            F.when(col("promoted"), col("row1")).otherwise(col("row0")),
            lambda v, i: F.when(get("whole", i)[NUMBER] < get("whole", i)[FILLED], v)),
    }, {
        "misplaced": header_metric_count(F.array_join("first_texts", " "), rules) >= MIN_HEADER_METRICS,
    }, {
        "skip": col("promoted").cast("int") + col("misplaced").cast("int"),
        "names": F.when(col("misplaced"), F.transform("names", lambda h, i: F.trim(
            F.concat(h, F.coalesce(F.concat(F.lit(" "), get("first_texts", i)), F.lit("")))))
        ).otherwise(col("names")),
    }, {
        "repeated": F.size("names") - F.size(F.array_distinct("names")),
        "names": F.transform("names", lambda h: clean_header(h, trim)),
        "stats": _column_stats(col("skip"), n_stats),
        "n_data": col("n_rows") - col("skip"),
    }, {
        "layered": F.exists("stats", lambda s: s[LAYER] > 0),
    }, {
        "first_col": F.when(strips(0) & strips(1), 2).when(strips(0), 1).otherwise(0),
    }, {
        "too_narrow": F.size("header") - col("first_col") < MIN_COLUMNS,
        "merged": F.coalesce(
            (get("stats", col("first_col"))[PAIRED] == 0)
            & ~F.coalesce(is_company(F.least("first_col", F.lit(1))), F.lit(False)), F.lit(False)),
    }, {
        "kept": F.concat(F.array("first_col"), F.filter(
            F.sequence(F.lit(0), F.size("header") - 1), lambda i: i > col("first_col") + col("merged").cast("int"))),
    }, {
        "columns": F.transform("kept", column),
    }]
    summary = F.contains(F.lower(get("columns", F.lit(0))["name"]), F.lit("summary of"))
    invalid = ((col("n_rows") < MIN_ROWS) | col("digit_name") | (col("repeated") > 1) | col("too_narrow") | summary)
    result = [
        col("table_id"), F.when(F.coalesce(invalid, F.lit(True)), F.lit(INVALID_TABLE)).alias("code"),
        col("n_rows").cast("long").alias("n_rows"),
        *[col(c) for c in ("promoted", "misplaced", "skip", "first_col", "merged", "layered", "columns")]]
    return steps, result


def repair_headers(profiles: DataFrame, rules: RuleSet = DEFAULT_RULES, trim: bool = True) -> DataFrame:
    """Decide per table which rows are header, the final column names, and which columns stay.

    Adds: `code` (null when admitted), `skip` (rows that belong to the header), `first_col`, `merged` (the second
    kept column was folded into the first) and `columns`: array of (col_idx, name, stats).
    """
    steps, result = _repair_steps(rules, trim)
    for step in steps:
        profiles = profiles.withColumns(step)
    return settled(profiles.select(*result))

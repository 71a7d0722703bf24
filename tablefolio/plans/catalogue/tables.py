"""Tables of many layouts made from orders, and every table, column and row operator over them.

Forty orders make one table; the table number picks one of twelve layouts: security column, hidden share classes,
split headers, blank headers, competing columns, numbers that cannot be read, and the ways in which a table is rejected.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefolio.operators import grid as G
from tablefolio.operators import headers as H
from tablefolio.operators import matching as M
from tablefolio.operators import rows as R
from tablefolio.operators.analytics import metric_sums
from tablefolio.operators.ordered import RowOrder
from tablefolio.plans import portfolio as P
from tablefolio.plans.catalogue import Catalogue, heavy, table
from tablefolio.plans.catalogue.tables_sql import (
    DECIDED, FACTS, LINEAGE, METRIC_ROWS, PROFILE, ROW_STEPS, fill_sql, header_metrics_sql, hidden_sql,
    rule_tests_sql, subtotal_sql,
)
from tablefolio.rules import DEFAULT_RULES, HEADER_METRICS, NUMBER_METRICS
from tablefolio.session import durable, written
from tablefolio.sources.csv_tables import from_grid

QUERIES = Catalogue()

HEADERS = (
    ("Company", "Security Type", "Investment Date", "Total Cost ", "Fair Value", "Realized Proceeds", "Total Value*",
     "Current  Ownership"),
    ("Portfolio Company", "Shares", "Cost", "Fair Value", "Change in Fair Value", "Gross IRR", "Gross Multiple",
     "Realized Proceeds"),
    ("Unnamed: 0", "", "Unrealized", "Unnamed: 3", "Realized", "Total", "", "Notes"),
    ("Unnamed: 0", "Unnamed: 1", "", "", "", "", "", "Unnamed: 7"),
    ("Name", "Cost Basis", "Invested Amount", "Market Value", "FMV", "Realized", "Total", "Own"),
    ("Name", "Proceeds A", "Proceeds B", "Cost", "Fair Value", "Total", "Date", "Shares"),
    ("Company", "2020", "Cost", "Fair Value", "Total", "a", "b", "c"),
    ("Investments", "", "Cost", "Unrealized", "Realized", "Total Value", "Gross MOIC", "Gross IRR"),
    ("Summary of Investments", "Cost", "Fair Value", "Realized", "Total", "MOIC", "IRR", "Date"),
    ("Company", "MOIC net", "Multiple x", "Cost", "Fair Value", "Total", "Shares", "Date"),
    ("Company", "Gain", "Gain", "Gain", "Cost", "Fair Value", "Total", "Date"),
    ("No", "Issuer", "Cost", "Carrying Value", "Proceeds", "Total", "Ownership", "IRR"),
)
_CASES = " ".join(
    f"WHEN {v} THEN {{A}}(" + ", ".join(f"'{h}'" for h in names) + ")" for v, names in enumerate(HEADERS))
HEADER_ROWS = f"""SELECT concat('t', CAST(k AS {{S}})) AS table_id, CASE k % 12 {_CASES} END AS header
FROM (SELECT DISTINCT CAST(floor(o_orderkey / 40) AS BIGINT) AS k FROM {{T}})"""

BODY_ROWS = """SELECT concat('t', CAST(k AS {S})) AS table_id, r AS row_idx, CASE k % 12
  WHEN 0 THEN {A}(CASE WHEN r = 39 THEN 'Total' WHEN r % 5 IN (0, 4) THEN co ELSE NULL END,
    CASE WHEN r = 39 OR r % 5 = 3 THEN NULL WHEN r % 5 = 0 THEN 'Series A Preferred' WHEN r % 5 = 4 THEN 'Common' ELSE 'Series B' END,
    CASE WHEN r % 5 = 3 THEN NULL ELSE '2020-01-01' END, m1, m2, m3, m4, CASE WHEN r % 5 = 3 THEN pc ELSE NULL END)
  WHEN 1 THEN {A}(CASE r % 5 WHEN 0 THEN co WHEN 1 THEN 'Series A-1' WHEN 2 THEN 'Common Stock' WHEN 3 THEN NULL ELSE concat('Total ', co) END,
    CASE WHEN r % 5 = 0 THEN NULL ELSE m1 END, CASE WHEN r % 5 = 0 THEN NULL ELSE m2 END, CASE WHEN r % 5 = 0 THEN NULL ELSE m3 END,
    CASE WHEN r % 5 = 0 THEN NULL ELSE m4 END, CASE WHEN r % 5 = 0 THEN NULL ELSE pc END, CASE WHEN r % 5 = 0 THEN NULL ELSE mx END,
    CASE WHEN r % 5 = 0 THEN NULL ELSE m1 END)
  WHEN 2 THEN CASE WHEN r = 0 THEN {A}(NULL, 'Basis', 'Fair Value', 'Gain', 'Proceeds', 'Value ', 'MOIC', NULL)
    ELSE {A}(CASE WHEN r = 39 THEN NULL ELSE co END, m1, m2, m3, m4, m1, mx, 'note') END
  WHEN 3 THEN CASE WHEN r = 0 THEN {A}('Investment', 'Total Invested', 'Valuation', 'Realized', 'Total', 'Investment Multiple', 'IRR', 'Units')
    ELSE {A}(CASE WHEN r = 38 THEN 'Total Fund A' ELSE co END, m1, m2, m3, CASE WHEN r % 4 = 0 THEN NULL ELSE m4 END, mx, pc, 'u') END
  WHEN 4 THEN {A}(CASE WHEN r % 9 = 0 THEN 'Unrealized positions' ELSE co END, CASE WHEN k % 24 = 4 AND r % 3 = 0 THEN NULL ELSE m1 END, m2, m3, m4,
    CASE WHEN r % 6 = 0 THEN NULL ELSE m1 END, m2, pc)
  WHEN 7 THEN {A}(CASE WHEN r % 5 < 3 THEN co ELSE NULL END, CASE WHEN r % 5 < 3 THEN NULL ELSE co END, m1, m2, m3, m4, mx, pc)
  WHEN 11 THEN CASE WHEN k % 36 = 11 THEN {A}(CAST(r AS {S}), co, 'n/m', 'tbd', 'see', 'n/m', 'n/a%', 'n/m')
    ELSE {A}(CAST(r AS {S}), CASE WHEN r = 39 THEN 'TOTALS ' ELSE co END, m1, m2, CASE WHEN r % 7 = 0 THEN '-' ELSE m3 END, m4, pc, pc) END
  ELSE {A}(co, m1, m2, m3, m4, m1, m2, m3) END AS vals
FROM (SELECT CAST(floor(o_orderkey / 40) AS BIGINT) AS k, CAST(o_orderkey % 40 AS INT) AS r,
    concat('Firm ', CAST(o_custkey AS {S}), CASE WHEN o_custkey % 17 = 0 THEN ' :unselected:' ELSE '' END) AS co,
    concat('$', CAST(CAST(floor(o_totalprice) AS BIGINT) % 9000 + 1000 AS {S}), '  ') AS m1,
    concat('(', CAST(o_custkey % 500 AS {S}), ',100)') AS m2, CAST(o_custkey % 800 AS {S}) AS m3,
    concat('$ ', CAST(o_orderkey % 999 + 1 AS {S}), ',000') AS m4, concat(CAST(o_custkey % 50 AS {S}), '.5x') AS mx,
    concat(CAST(o_custkey % 100 AS {S}), '.5%') AS pc FROM {T})"""

_DUCK = {"S": "VARCHAR", "A": "list_value", "T": "orders"}
SQL_INPUT = f"hdr AS ({HEADER_ROWS.format(**_DUCK)}), raw AS ({BODY_ROWS.format(**_DUCK)})"


def table_input(spark, sf):
    # the rows of a table lie together, so that its counts are added up before they move
    heavy(spark, sf, "orders", F.expr("floor(o_orderkey / 40)")).createOrReplaceTempView("tablefolio_orders")
    words = {"S": "STRING", "A": "array", "T": "tablefolio_orders"}
    rows = spark.sql(BODY_ROWS.format(**words)).withColumnRenamed("vals", "values")
    return spark.sql(HEADER_ROWS.format(**words)), rows


_input = table_input  # its name before the reports used it too


@QUERIES.add(f"WITH {SQL_INPUT}, {PROFILE} SELECT table_id, col_idx, n_rows, filled, number, money, money_sum, layered FROM profile")
def table_profile(spark, sf):
    cells = H.table_profiles(*table_input(spark, sf)).select("table_id", F.inline("cells"))

    def total(place):
        return F.floor(F.sum(F.col("stats")[place])).cast("bigint")

    return cells.groupBy("table_id", "col_idx").agg(
        total(H.ROWS).alias("n_rows"), total(H.FILLED).alias("filled"), total(H.NUMBER).alias("number"),
        total(H.MONEY).alias("money"), total(H.MONEY_SUM).alias("money_sum"), total(H.LAYER).alias("layered"))


@QUERIES.add(f"""WITH {SQL_INPUT}, {PROFILE}, {DECIDED}
SELECT table_id, CASE WHEN invalid THEN 'WRN-ID2002' ELSE 'ok' END AS state, promoted, misplaced, skip, first_col, merged, layered FROM tab""")
def table_admission(spark, sf):
    done = H.repair_headers(H.table_profiles(*table_input(spark, sf)))
    return done.select("table_id", F.coalesce("code", F.lit("ok")).alias("state"), "promoted", "misplaced", "skip",
                       "first_col", "merged", "layered")


@QUERIES.add(f"""WITH {SQL_INPUT}, {PROFILE}, {DECIDED} SELECT table_id, place, col_idx, name FROM cols""")
def repaired_headers(spark, sf):
    done = H.repair_headers(H.table_profiles(*table_input(spark, sf))).where("code IS NULL")
    return done.select("table_id", F.posexplode("columns").alias("place", "c")).select(
        "table_id", "place", "c.col_idx", "c.name")


@QUERIES.add(f"""WITH {SQL_INPUT}, {PROFILE}, {DECIDED}, {LINEAGE} SELECT table_id, target, src, rule FROM lineage""")
def column_match(spark, sf):
    return M.lineage(P.decide_tables(*table_input(spark, sf)))


@QUERIES.add(f"""WITH {SQL_INPUT}, {PROFILE}, {DECIDED}, {LINEAGE}, {METRIC_ROWS}, {ROW_STEPS}, {FACTS},
coded AS (SELECT table_id, CASE WHEN code IS NULL AND table_id NOT IN (SELECT table_id FROM facts) THEN 'WRN-ID2002' ELSE code END AS code, detail FROM verdict)
SELECT table_id, code, CASE WHEN starts_with(code, 'ERR') THEN 'Error' ELSE 'Warning' END AS level,
  CASE code WHEN 'ERR-ID1002' THEN 'P1 rule ' || detail || ' has multi-matches' WHEN 'WRN-ID2003' THEN 'P2 rule ' || detail || ' has multi-matches'
  ELSE 'Less than 3 columns identified, table is invalid' END AS description FROM coded WHERE code IS NOT NULL""")
def table_errors(spark, sf):
    return P.build_portfolio(*table_input(spark, sf)).errors


_TEXTS = ", ".join(DEFAULT_RULES.names())


@QUERIES.add(f"""WITH {SQL_INPUT}, {PROFILE}, {DECIDED}, {LINEAGE}, {METRIC_ROWS} SELECT table_id, row_idx, {_TEXTS} FROM metric_rows""")
def metric_rows(spark, sf):
    headers, rows = table_input(spark, sf)
    return P.metric_rows(rows, P.decide_tables(headers, rows)).select("table_id", "row_idx", *DEFAULT_RULES.names())


_FACT_COLUMNS = ["table_id", "row_idx", "company_name", "security_type", "investment_date", *NUMBER_METRICS, "is_total"]


def _rounded(df):
    return df.withColumns({m: F.round(m, 6) for m in NUMBER_METRICS})


_ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in NUMBER_METRICS)


@QUERIES.add(f"""WITH {SQL_INPUT}, {PROFILE}, {DECIDED}, {LINEAGE}, {METRIC_ROWS}, {ROW_STEPS}, {FACTS}
SELECT table_id, row_idx, company_name, security_type, investment_date, {_ROUNDED}, is_total,
  coalesce(CAST(is_validated AS VARCHAR), 'unknown') AS validated, filled FROM facts""")
def portfolio_facts(spark, sf):
    facts = P.build_portfolio(*table_input(spark, sf)).facts
    return _rounded(facts).select(
        *_FACT_COLUMNS, F.coalesce(F.col("is_validated").cast("string"), F.lit("unknown")).alias("validated"),
        F.array_join("filled_metrics", ",").alias("filled"))


@QUERIES.add(f"""WITH {SQL_INPUT}, {PROFILE}, {DECIDED}, {LINEAGE}, {METRIC_ROWS}, {ROW_STEPS}, {FACTS}
SELECT table_id, target, src, rule FROM lineage JOIN (SELECT DISTINCT table_id FROM facts) USING (table_id)
UNION ALL SELECT DISTINCT table_id, unnest(string_split(filled, ',')) AS target, NULL, 'VA' FROM facts WHERE filled <> ''""")
def portfolio_lineage(spark, sf):
    return P.build_portfolio(*table_input(spark, sf)).lineage


@QUERIES.add(f"""WITH {SQL_INPUT}, {PROFILE}, {DECIDED}, {LINEAGE}, {METRIC_ROWS}, {ROW_STEPS}, {FACTS}
SELECT table_id, {', '.join(f'round(sum({m}), 4) AS {m}' for m in HEADER_METRICS)} FROM facts WHERE NOT is_total GROUP BY table_id""")
def portfolio_sums(spark, sf):
    sums = metric_sums(P.build_portfolio(*table_input(spark, sf)).facts, list(HEADER_METRICS))
    return sums.select("table_id", *[F.round(m, 4).alias(m) for m in HEADER_METRICS])


# The same tables as recognised layout cells. A header cell of the two-row layout spans two columns, so its text comes to
# the row below; every eighth row has no cells, and one row has a single blank one. Repeated names are told apart.
SQL_SPANNED = SQL_INPUT.replace("'Unrealized', 'Unnamed: 3'", "'', 'Unnamed: 3'").replace(
    "'Basis', 'Fair Value', 'Gain'", "'Basis', 'Unrealized Fair Value', 'Unrealized Gain'").replace(
    "'Gain', 'Gain', 'Gain'", "'Gain', 'Gain.1', 'Gain.2'")


def _as_cells(headers, rows):
    head = headers.select("table_id", F.lit(0).alias("row_index"), F.posexplode("header").alias("column_index", "content"))
    place = (F.col("row_idx") + F.floor(F.col("row_idx") / 7) + 1).cast("int")
    body = rows.select("table_id", place.alias("row_index"), F.posexplode("values").alias("column_index", "content"))
    blank = headers.select("table_id", F.lit(8).alias("row_index"), F.lit(0).alias("column_index"), F.lit("").alias("content"))
    cells = head.where("content <> ''").unionByName(body.where("content IS NOT NULL")).unionByName(blank)
    spans = (F.col("row_index") == 0) & (F.col("column_index") == 2) & (F.col("content") == "Unrealized")
    return cells.select(
        "table_id", (F.col("row_index") * 100 + F.col("column_index")).alias("cell_ord"), F.lit(1).alias("page"), "row_index",
        "column_index", F.when(spans, 2).alias("column_span"), "content", F.lit(60).alias("row_count"),
        F.lit(len(HEADERS[0])).alias("column_count"))


@QUERIES.add(f"""WITH {SQL_SPANNED}, {PROFILE}, {DECIDED}, {LINEAGE}, {METRIC_ROWS}, {ROW_STEPS}, {FACTS}
SELECT table_id, row_idx, company_name, security_type, investment_date, {_ROUNDED}, is_total FROM facts""")
def cells_to_facts(spark, sf):
    grid = written(G.table_rows(_as_cells(*table_input(spark, sf))), "grid-rows")  # headers, rows and gaps all read it
    headers, rows = from_grid(*G.header_and_rows(grid), cut=durable)
    return _rounded(P.build_portfolio(headers, rows).facts).select(*_FACT_COLUMNS)


# Row operators over large tables: 5,000 orders each, cut into segments of 512 rows.
SEGMENTED = RowOrder(("table_id",), "row_idx", 512)
LAYERS = """SELECT CAST(floor(o_orderkey / 5000) AS BIGINT) AS table_id, CAST(o_orderkey % 5000 AS INT) AS row_idx,
    CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 11 < 3 THEN concat('Firm ', CAST(o_custkey AS {S}))
      WHEN o_custkey % 11 = 3 THEN 'Total holding' WHEN o_custkey % 11 < 7 THEN 'Series A' ELSE 'Common' END AS company_name,
    CASE WHEN o_custkey % 11 < 3 AND o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS {S}) END AS total_cost,
    CASE WHEN o_custkey % 11 < 3 AND o_orderkey % 3 < 2 THEN NULL ELSE CAST(o_custkey % 100 AS {S}) END AS unrealized_value FROM {T}"""
SECURITIES = """SELECT CAST(floor(o_orderkey / 5000) AS BIGINT) AS table_id, CAST(o_orderkey % 5000 AS INT) AS row_idx,
    CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 7 < 3 THEN '' WHEN o_custkey % 7 = 3 THEN 'x'
      WHEN o_custkey % 7 = 4 THEN 'Total ' WHEN o_custkey % 7 = 5 THEN concat('Firm ', CAST(o_custkey AS {S}), ' ') ELSE concat(' Fir', CAST(o_custkey AS {S})) END AS company_name,
    CASE WHEN o_orderkey % 13 < 5 THEN NULL WHEN o_orderkey % 13 = 5 THEN '' ELSE 'Common' END AS security_type,
    CASE WHEN o_custkey % 3 = 0 THEN NULL WHEN o_custkey % 3 = 1 THEN '' ELSE '5%' END AS ownership FROM {T}"""


def _rows(spark, sf, sql):
    table(spark, sf, "orders").createOrReplaceTempView("tablefolio_orders")
    return spark.sql(sql.format(S="STRING", T="tablefolio_orders"))


_LAYERS = LAYERS.format(**_DUCK)
_SECURITIES = SECURITIES.format(**_DUCK)


@QUERIES.add(f"""WITH input AS (SELECT *, NULL AS security_type, true AS apply, company_name AS first FROM ({_LAYERS})),
{hidden_sql('input', ('company_name', 'total_cost', 'unrealized_value'), 'done')}
SELECT table_id, row_idx, company_name, security_type, total_cost, unrealized_value FROM done""")
def hidden_security(spark, sf):
    done = R.hidden_security(_rows(spark, sf, LAYERS), ["company_name", "total_cost", "unrealized_value"], SEGMENTED)
    return done.select("table_id", "row_idx", "company_name", "security_type", "total_cost", "unrealized_value")


@QUERIES.add(f"""WITH input AS (SELECT *, true AS apply FROM ({_SECURITIES})), {fill_sql('input', 'done')}
SELECT table_id, row_idx, company_name, security_type, ownership FROM done""")
def fill_company(spark, sf):
    done = R.fill_company(_rows(spark, sf, SECURITIES), SEGMENTED)
    return done.select("table_id", "row_idx", "company_name", "security_type", "ownership")


_NAMED = f"(SELECT table_id, row_idx, coalesce(company_name, '') AS company_name, security_type, ownership FROM ({_SECURITIES}))"


def _named(spark, sf):
    return _rows(spark, sf, SECURITIES).withColumn("company_name", F.coalesce("company_name", F.lit("")))


@QUERIES.add(f"""WITH input AS (SELECT *, true AS apply FROM {_NAMED}), {subtotal_sql('input', 'done')}
SELECT table_id, row_idx, company_name, security_type, ownership, is_total FROM done""")
def subtotal_flags(spark, sf):
    done = R.subtotal_flags(_named(spark, sf), SEGMENTED)
    return done.select("table_id", "row_idx", "company_name", "security_type", "ownership", "is_total")


@QUERIES.add(f"""SELECT table_id, row_idx, company_name, security_type, ownership,
  nullif(security_type, '') IS NULL AND nullif(ownership, '') IS NOT NULL AS is_total FROM {_NAMED}""")
def ownership_subtotals(spark, sf):
    return R.ownership_subtotals(_named(spark, sf).withColumn("is_total", F.lit(False)))


@QUERIES.add(f"""WITH e AS (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY row_idx DESC) AS from_end,
  company_name IS NULL OR trim(lower(company_name)) IN ('total', '', 'totals') AS t FROM ({_SECURITIES}))
SELECT table_id, row_idx, company_name, coalesce(t AND (from_end = 1 OR (from_end = 2 AND NOT lag(t) OVER (PARTITION BY table_id ORDER BY from_end))), false) AS is_total FROM e""")
def bottom_total(spark, sf):
    done = R.bottom_total(_rows(spark, sf, SECURITIES).withColumn("is_total", F.lit(False)), SEGMENTED)
    return done.select("table_id", "row_idx", "company_name", "is_total")


@QUERIES.add(f"""SELECT table_id, row_idx, company_name, is_total FROM (SELECT *, row_idx % 4 = 0 AS is_total FROM ({_SECURITIES}))
WHERE is_total OR NOT (company_name IS NULL OR regexp_matches(company_name, '(?i)Total|Realized'))""")
def drop_non_company(spark, sf):
    flagged = _rows(spark, sf, SECURITIES).withColumn("is_total", F.col("row_idx") % 4 == 0)
    return R.drop_non_company(flagged).select("table_id", "row_idx", "company_name", "is_total")


# Header texts from part: a rule phrase of each kind set into the part's own words.
TITLES = """SELECT p_partkey, concat(CASE p_partkey % 9 WHEN 0 THEN 'Unrealized' WHEN 1 THEN 'Total Cost' WHEN 2 THEN 'Fair Value* ' WHEN 3 THEN 'Realized  Proceeds'
    WHEN 4 THEN 'Gross MOIC' WHEN 5 THEN 'Total' WHEN 6 THEN 'Change in FMV' WHEN 7 THEN 'Cost' ELSE 'Unknown' END,
    CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN ' Total Value' WHEN 2 THEN ' Invested' WHEN 3 THEN ' Realized' ELSE concat(' ', p_name) END,
    CASE WHEN p_size % 3 = 0 THEN ' IRR' WHEN p_size % 3 = 1 THEN ' Multiple ' ELSE '' END) AS title, p_name, p_type FROM {T}"""
_TITLES = TITLES.format(T="part")


def _titles(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("tablefolio_part")
    return spark.sql(TITLES.format(T="tablefolio_part"))


@QUERIES.add(f"""SELECT p_partkey, trim(regexp_replace(replace(title, '*', ''), '\\s+', ' ', 'g')) AS name,
  regexp_replace(replace(title, '*', ''), '\\s+', ' ', 'g') AS untrimmed FROM ({_TITLES})""")
def clean_headers(spark, sf):
    title = F.col("title")
    return _titles(spark, sf).select("p_partkey", H.clean_header(title).alias("name"),
                                     H.clean_header(title, trim=False).alias("untrimmed"))


@QUERIES.add(header_metrics_sql(f"({_TITLES})"))
def header_metric_counts(spark, sf):
    n = H.header_metric_count(F.col("title"))
    return _titles(spark, sf).select("p_partkey", n.alias("metrics"), (n >= H.MIN_HEADER_METRICS).alias("misplaced"))


@QUERIES.add(rule_tests_sql(f"({_TITLES})"))
def rule_hits(spark, sf):
    rules = [(f"{m.name}_{i}", r) for m in DEFAULT_RULES.metrics for i, r in enumerate(m.rules) if not r.on_values]
    titles = _titles(spark, sf).withColumn("title", H.clean_header(F.col("title")))
    return titles.select("p_partkey", *[M.name_matches(F.col("title"), r).alias(n) for n, r in rules])


@QUERIES.add(f"""SELECT p_partkey, list_extract(list_filter([title, p_name, p_type], lambda x: regexp_matches(x, '(?i)total|red')), -1) AS last_hit,
  len(list_filter([title, '', p_name, 'Unnamed: 3', CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_type END], lambda x: x = '' OR contains(x, 'Unnamed'))) > 2 AS mostly_unnamed,
  concat(p_name, '|', p_type, '|', CASE WHEN p_type = p_name THEN concat(p_name, '.2') ELSE concat(p_name, '.1') END) AS unique_names FROM ({_TITLES})""")
def header_lists(spark, sf):
    last = F.when(F.col("p_partkey") % 2 == 0, F.lit("")).otherwise(F.col("p_type"))
    names = F.array(F.col("title"), F.lit(""), F.col("p_name"), F.lit("Unnamed: 3"), last)
    return _titles(spark, sf).select(
        "p_partkey", M.last_containing(F.array("title", "p_name", "p_type"), ("total", "red")).alias("last_hit"),
        H.mostly_unnamed(names).alias("mostly_unnamed"),
        F.array_join(H.unique_names(F.array("p_name", "p_type", "p_name")), "|").alias("unique_names"))

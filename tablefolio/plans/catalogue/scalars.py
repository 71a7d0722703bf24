"""Scalar functions, validation and numeric parsing over lineitem, orders and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefolio.functions import dates, names, numbers, texts
from tablefolio.operators import errors, inventory
from tablefolio.operators.analytics import numeric_profile, share_of_total, value_counts
from tablefolio.operators.validate import failed_rows, filled_lineage, validate_metrics
from tablefolio.plans.catalogue import Catalogue, heavy, table

QUERIES = Catalogue()

# Text forms of numbers as reports print them, by line number; the same expression in both engines.
MONEY_TEXT = """CASE l_linenumber % 5
    WHEN 0 THEN concat('$', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS {s}))
    WHEN 1 THEN concat('($', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS {s}), ')  ')
    WHEN 2 THEN concat(CAST(CAST(l_quantity AS BIGINT) AS {s}), ',', '500')
    WHEN 3 THEN concat(CAST(CAST(l_quantity AS BIGINT) AS {s}), '.5x ')
    ELSE '-  ' END"""
PERCENT_TEXT = """CASE l_linenumber % 4
    WHEN 0 THEN concat(CAST(CAST(round(l_discount * 100) AS BIGINT) AS {s}), '%')
    WHEN 1 THEN concat('(', CAST(CAST(round(l_tax * 100) AS BIGINT) AS {s}), '.5)% ')
    WHEN 2 THEN concat('[', CAST(CAST(l_quantity AS BIGINT) AS {s}), ']%')
    ELSE CAST(CAST(l_quantity AS BIGINT) AS {s}) END"""
SQL_MONEY = r"""TRY_CAST(nullif(regexp_extract(regexp_replace(regexp_replace({t}, '[$,x]', '', 'g'), '\((.+?)\)', '-\1', 'g'),
    '^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$', 1), '') AS DOUBLE)"""
SQL_PERCENT = r"""CASE WHEN contains({t}, '%') THEN TRY_CAST(nullif(regexp_extract(regexp_replace(
    regexp_replace({t}, '[%\[\]·]', '', 'g'), '\((.+?)\)', '-\1', 'g'),
    '^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$', 1), '') AS DOUBLE) / 100 END"""


@QUERIES.add(f"""
SELECT l_returnflag, raw_tail, count(*) AS n, count(v) AS n_numbers, round(sum(v), 2) AS total FROM (
  SELECT l_returnflag, right(trim(t), 1) AS raw_tail, {SQL_MONEY.format(t='t')} AS v
  FROM (SELECT *, {MONEY_TEXT.format(s='VARCHAR')} AS t FROM lineitem))
GROUP BY l_returnflag, raw_tail""")
def parse_money(spark, sf):
    text = heavy(spark, sf, "lineitem", "l_orderkey").select("l_returnflag", F.expr(MONEY_TEXT.format(s="STRING")).alias("t"))
    parsed = text.select("l_returnflag", F.expr("right(trim(t), 1)").alias("raw_tail"),
                         numbers.parse_money(F.col("t")).alias("v"))
    return parsed.groupBy("l_returnflag", "raw_tail").agg(
        F.count("*").alias("n"), F.count("v").alias("n_numbers"), F.round(F.sum("v"), 2).alias("total"))


@QUERIES.add(f"""
SELECT l_orderkey, l_partkey, l_linenumber, t AS percent_text, round(v, 6) AS fraction FROM (
  SELECT *, {SQL_PERCENT.format(t='t')} AS v FROM (
    SELECT l_orderkey, l_partkey, l_linenumber, {PERCENT_TEXT.format(s='VARCHAR')} AS t FROM lineitem))""")
def parse_percent(spark, sf):
    text = heavy(spark, sf, "lineitem", "l_orderkey").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.expr(PERCENT_TEXT.format(s="STRING")).alias("percent_text"))
    return text.withColumn("fraction", F.round(numbers.parse_percent(F.col("percent_text")), 6))


@QUERIES.add(r"""
SELECT lang, count(*) AS words, CAST(count_if(regexp_matches(regexp_replace(w, '[$,]', '', 'g'),
    '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')) AS BIGINT) AS amounts
FROM (SELECT lang, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM documents) GROUP BY lang""")
def amount_words(spark, sf):
    words = table(spark, sf, "documents").select(
        "lang", F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    return words.groupBy("lang").agg(F.count("*").alias("words"),
                                     F.count_if(numbers.is_amount_text(F.col("w"))).alias("amounts"))


# Metrics of a line item with one or more values taken away, by order and line number.
METRICS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_orderkey % 5 = 1 THEN NULL
         WHEN l_orderkey % 11 = 2 THEN CAST(l_quantity AS BIGINT) * 2 + 1.0 ELSE CAST(l_quantity AS BIGINT) * 2.0 + l_linenumber END AS total,
    CASE WHEN l_orderkey % 5 = 2 THEN NULL ELSE CAST(l_quantity AS BIGINT) + 0.0 END AS realized_value,
    CASE WHEN l_orderkey % 5 = 3 THEN NULL ELSE CAST(l_quantity AS BIGINT) + l_linenumber + 0.0 END AS unrealized_value,
    CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN 0.0 ELSE 4.0 END AS total_cost,
    CASE WHEN l_linenumber IN (1, 5) THEN NULL ELSE (CAST(l_quantity AS BIGINT) * 2 + l_linenumber) / 4.0 END AS gross_moic
FROM lineitem"""
SQL_VALIDATED = f"""
raw AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(total AS DOUBLE) AS total,
    CAST(realized_value AS DOUBLE) AS realized_value, CAST(unrealized_value AS DOUBLE) AS unrealized_value,
    CAST(total_cost AS DOUBLE) AS total_cost, CAST(gross_moic AS DOUBLE) AS gross_moic FROM ({METRICS})),
one AS (SELECT *, (total IS NULL)::INT + (realized_value IS NULL)::INT + (unrealized_value IS NULL)::INT AS n1 FROM raw),
filled AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN n1 = 1 AND total IS NULL THEN 'total' WHEN n1 = 1 AND realized_value IS NULL THEN 'realized_value'
         WHEN n1 = 1 THEN 'unrealized_value' END AS fill1,
    CASE WHEN n1 = 0 THEN total = realized_value + unrealized_value END AS ok1,
    CASE WHEN n1 = 1 AND total IS NULL THEN realized_value + unrealized_value ELSE total END AS total,
    CASE WHEN n1 = 1 AND realized_value IS NULL THEN total - unrealized_value ELSE realized_value END AS realized_value,
    CASE WHEN n1 = 1 AND unrealized_value IS NULL THEN total - realized_value ELSE unrealized_value END AS unrealized_value,
    total_cost, gross_moic FROM one),
two AS (SELECT *, (total IS NULL)::INT + (total_cost IS NULL)::INT + (gross_moic IS NULL)::INT AS n2 FROM filled),
validated AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fill1,
    CASE WHEN n2 = 1 AND total IS NULL THEN 'total' WHEN n2 = 1 AND total_cost IS NULL THEN 'total_cost'
         WHEN n2 = 1 THEN 'gross_moic' END AS fill2,
    CASE WHEN n2 = 0 THEN coalesce(ok1, false) AND coalesce(gross_moic = total / nullif(total_cost, 0), false)
         ELSE ok1 END AS is_validated,
    CASE WHEN n2 = 1 AND total IS NULL THEN gross_moic * total_cost ELSE total END AS total, realized_value, unrealized_value,
    CASE WHEN n2 = 1 AND total_cost IS NULL THEN total / nullif(gross_moic, 0) ELSE total_cost END AS total_cost,
    CASE WHEN n2 = 1 AND gross_moic IS NULL THEN total / nullif(total_cost, 0) ELSE gross_moic END AS gross_moic
  FROM two)"""
KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
VALUES = ("total", "realized_value", "unrealized_value", "total_cost", "gross_moic")


def _metrics(spark, sf):
    heavy(spark, sf, "lineitem", "l_orderkey").createOrReplaceTempView("tablefolio_lineitem")
    raw = spark.sql(METRICS.replace("FROM lineitem", "FROM tablefolio_lineitem"))
    return raw.select(*KEYS, *[F.col(c).cast("double").alias(c) for c in VALUES])


@QUERIES.add(f"""WITH {SQL_VALIDATED}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN is_validated THEN 'yes' WHEN NOT is_validated THEN 'no' ELSE 'unknown' END AS validated,
    round(total, 6) AS total, round(realized_value, 6) AS realized_value, round(unrealized_value, 6) AS unrealized_value,
    round(total_cost, 6) AS total_cost, round(gross_moic, 6) AS gross_moic FROM validated""")
def validate_and_fill(spark, sf):
    done = validate_metrics(_metrics(spark, sf))
    state = F.when(F.col("is_validated"), "yes").when(~F.col("is_validated"), "no").otherwise("unknown")
    return done.select(*KEYS, state.alias("validated"), *[F.round(c, 6).alias(c) for c in VALUES])


@QUERIES.add(f"""WITH {SQL_VALIDATED}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fill1 AS target, 'VA' AS rule FROM validated WHERE fill1 IS NOT NULL
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fill2, 'VA' FROM validated WHERE fill2 IS NOT NULL""")
def filled_metrics(spark, sf):
    return filled_lineage(validate_metrics(_metrics(spark, sf)), *KEYS)


@QUERIES.add(f"""WITH {SQL_VALIDATED}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'WRN-VA2001' AS code, 'Warning' AS level,
  'Table validation failed, ''UnrealizeValue'' + ''RealizedValue'' = ''Total'' NOT Passed' AS description
FROM validated WHERE NOT is_validated""")
def validation_errors(spark, sf):
    return failed_rows(validate_metrics(_metrics(spark, sf)), *KEYS)


# Reports with a size and a page count, from orders.
REPORTS = """SELECT concat('/funds/', o_orderpriority, '/report_', CAST(o_orderkey AS {s}), '.pdf') AS report_path,
    CAST(floor(o_totalprice) AS BIGINT) * 200 AS file_bytes, CAST(o_custkey % 250 AS INT) AS page_count FROM {t}"""
_CODED = f"""SELECT *, CASE WHEN file_bytes > 52428800 THEN 'ERR-EX1001' WHEN page_count > 200 THEN 'ERR-EX1002' END AS code
  FROM ({REPORTS.format(s='VARCHAR', t='orders')})"""


@QUERIES.add(f"""
SELECT report_path, '[' || code || '] Error: ' || CASE code WHEN 'ERR-EX1001' THEN 'File size is larger than 50MB'
  ELSE 'Page count is more than 200' END AS message FROM ({_CODED}) WHERE code IS NOT NULL
UNION ALL SELECT report_path, 'admitted' FROM ({_CODED}) WHERE code IS NULL""")
def report_admission(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("tablefolio_orders")
    admitted, failed = errors.admit_reports(spark.sql(REPORTS.format(s="STRING", t="tablefolio_orders")))
    said = errors.message(F.col("code"), F.col("level"), F.col("description"))
    return failed.select("report_path", said.alias("message")).unionByName(
        admitted.select("report_path", F.lit("admitted").alias("message")))


# Report names and inventory rows from orders; the order year is moved so that it falls into 2010-2029.
INVENTORY = """SELECT o_orderkey,
    CASE WHEN o_custkey % 7 = 0 THEN 'team/Portfolio/Funds'
         ELSE concat('team/Portfolio/Funds/Fund ', CAST(o_custkey % 100 AS {s}), '/Books/Quarterly') END AS Path,
    CASE WHEN o_custkey % 7 = 0 THEN concat('Fund ', CAST(o_custkey % 100 AS {s}))
         WHEN o_orderkey % 6 = 0 THEN concat('http://host/x', {nl}, 'Report ', CAST(year(o_orderdate) + 15 AS {s}), ' Q', CAST(quarter(o_orderdate) AS {s}), '.pdf')
         WHEN o_orderkey % 6 = 1 THEN concat('Letter 06.', CAST(year(o_orderdate) + 15 AS {s}), '.pdf')
         WHEN o_orderkey % 6 = 2 THEN concat('Annual ', CAST(year(o_orderdate) + 15 AS {s}), ' to ', CAST(year(o_orderdate) + 16 AS {s}), '.pdf')
         WHEN o_orderkey % 6 = 3 THEN concat('Notes ', CAST(o_orderkey AS {s}), '.docx')
         ELSE concat('Q1 and Q', CAST(quarter(o_orderdate) AS {s}), ' review.pdf') END AS Name,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('GP ', CAST(o_custkey % 9 AS {s})) END AS GP,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Rejected' ELSE 'Active' END AS Stage,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(year(o_orderdate) + 15 AS {s}) END AS Year,
    CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS Geo,
    concat(CAST(year(o_orderdate) + 24 AS {s}), '-01-02') AS Modified,
    o_orderstatus AS `Modified By`, 'Report' AS `Doc Type` FROM {t}"""
_INV = INVENTORY.format(s="VARCHAR", t="orders", nl="chr(10)").replace("`", '"')
# A fund folder may be listed several times; the smallest attributes stand for it, so that no report is doubled.
SQL_INVENTORY = f"""inv AS ({_INV}),
fund AS (SELECT Name, min(GP) AS GP, min(Stage) AS Stage, min(Year) AS Year, min(Geo) AS Geo FROM inv
  WHERE Path = 'team/Portfolio/Funds' GROUP BY Name),
rep AS (SELECT o_orderkey, CASE WHEN starts_with(Name, 'http') THEN regexp_replace(Name, 'http.*\\n', '') ELSE Name END AS ReportName,
  nullif(regexp_extract(Path, '/Funds/(.*?)/Books', 1), '') AS FundName, Path, GP, Stage, Year, Geo, Modified, "Modified By", "Doc Type"
  FROM inv WHERE contains(Path, 'Books/Quarterly') AND ends_with(Name, '.pdf')),
enriched AS (SELECT o_orderkey, ReportName AS report_name, f.Name AS fund_name, coalesce(r.GP, f.GP) AS gp,
  coalesce(r.Stage, f.Stage) AS stage, coalesce(r.Year, f.Year) AS year, coalesce(r.Geo, f.Geo) AS geo,
  Modified AS modified, "Modified By" AS modified_by, "Doc Type" AS report_type, Path AS path
  FROM rep r LEFT JOIN fund f ON r.FundName = f.Name),
current_reports AS (SELECT * FROM enriched WHERE (stage IS NULL OR stage <> 'Rejected') AND modified > '2022-01-01'),
period AS (SELECT * EXCLUDE (year), list_extract(regexp_extract_all(report_name, '(20[1-2][0-9])', 1), -1) AS year,
  coalesce(list_extract(regexp_extract_all(report_name, '(Q[1-4])', 1), -1),
    CASE WHEN regexp_matches(report_name, '06.') THEN 'Q2' END) AS quarter FROM current_reports)"""


def _inventory(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("tablefolio_orders")
    return spark.sql(INVENTORY.format(s="STRING", t="tablefolio_orders", nl="chr(10)"))


def _enriched(spark, sf):
    inv = _inventory(spark, sf)
    funds = inventory.funds(inv, "team/Portfolio/Funds").groupBy("Name").agg(*[F.min(a).alias(a) for a in inventory.ATTRIBUTES])
    return inventory.enrich(inventory.reports(inv, "Books/Quarterly", "/Funds/(.*?)/Books"), funds)


@QUERIES.add(f"""WITH {SQL_INVENTORY} SELECT * EXCLUDE (o_orderkey) FROM enriched""")
def inventory_enrich(spark, sf):
    return _enriched(spark, sf)


@QUERIES.add(f"""WITH {SQL_INVENTORY} SELECT * EXCLUDE (o_orderkey) FROM current_reports""")
def inventory_current(spark, sf):
    return inventory.current(_enriched(spark, sf))


@QUERIES.add(f"""WITH {SQL_INVENTORY} SELECT * EXCLUDE (o_orderkey) FROM period""")
def report_period(spark, sf):
    return inventory.with_period(inventory.current(_enriched(spark, sf)))


@QUERIES.add(f"""WITH {SQL_INVENTORY} SELECT report_name, count(*) AS n FROM period
WHERE year IS NULL OR quarter IS NULL GROUP BY report_name""")
def missing_period(spark, sf):
    missing = inventory.without_period(inventory.with_period(inventory.current(_enriched(spark, sf))))
    return missing.groupBy("report_name").agg(F.count("*").alias("n"))


@QUERIES.add("""SELECT page_id, list_extract(regexp_extract_all(url, '[a-z]+\\.example', 0), -1) AS host_part,
  nullif(regexp_extract(url, '//(.*?)/', 1), '') AS host, starts_with(url, 'https') AS secure,
  regexp_replace(url, '\\s+', ' ', 'g') AS squeezed FROM pages""")
def path_extract(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", texts.last_match(url, r"([a-z]+\.example)").alias("host_part"),
        texts.path_part(url, "//(.*?)/").alias("host"), F.startswith(url, F.lit("https")).alias("secure"),
        names.squeeze(url).alias("squeezed"))


AS_OF = "2001-12-31"
SQL_RECENCY = """CASE WHEN days <= 0 THEN NULL WHEN days <= 90 THEN 'Last 3 months' WHEN days <= 180 THEN 'Last 6 months'
  WHEN days <= 365 THEN 'Last 1 year' WHEN days <= 730 THEN 'Last 2 years' ELSE '2+ years' END"""


@QUERIES.add(f"""SELECT band, count(*) AS n FROM (SELECT {SQL_RECENCY} AS band FROM (
  SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS days FROM orders)) WHERE band IS NOT NULL GROUP BY band""")
def recency_bands(spark, sf):
    band = dates.recency_band(F.to_date("o_orderdate"), F.lit(AS_OF).cast("date"))
    return value_counts(table(spark, sf, "orders").select(band.alias("band")), "band")


SQL_REVENUE = """CASE WHEN r <= 50 THEN 'Small Business (less than 50M)' WHEN r <= 200 THEN 'Mid-Small Business (less than 200M)'
  WHEN r <= 1000 THEN 'Mid-market company (less than 1B)' WHEN r IS NOT NULL THEN 'Large company (1B+)' END"""


@QUERIES.add(f"""SELECT band, n, round(100.0 * n / sum(n) OVER (), 1) AS percent FROM (
  SELECT band, count(*) AS n FROM (SELECT {SQL_REVENUE} AS band FROM (
    SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal / 5 END AS r FROM customer)) WHERE band IS NOT NULL GROUP BY band)""")
def revenue_shares(spark, sf):
    revenue = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 5)
    bands = table(spark, sf, "customer").select(dates.revenue_band(revenue).alias("band"))
    return share_of_total(value_counts(bands, "band"))


@QUERIES.add("""SELECT sector, count(*) AS n FROM (SELECT replace(concat(c_mktsegment, ' / Consumer / Retail'), 'Consumer / Retail', 'Consumer') AS sector
  FROM customer) GROUP BY sector""")
def sector_counts(spark, sf):
    sector = texts.relabel(F.concat("c_mktsegment", F.lit(" / Consumer / Retail")))
    return value_counts(table(spark, sf, "customer").select(sector.alias("sector")), "sector")


@QUERIES.add("""SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
  round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
  round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75, max(l_extendedprice) AS max
FROM lineitem""")
def price_profile(spark, sf):
    done = numeric_profile(table(spark, sf, "lineitem"), "l_extendedprice")
    return done.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})

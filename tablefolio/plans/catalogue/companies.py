"""Company names, matching, providers and incremental runs over customer, supplier, part and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefolio.functions import names
from tablefolio.functions.fuzzy import ratio_to_each, window_ratio_to_each
from tablefolio.operators import analytics, entity, inventory
from tablefolio.operators.ordered import settled
from tablefolio.plans.catalogue import Catalogue, heavy, table
from tablefolio.sources.sinks import not_yet_done

QUERIES = Catalogue()

# Customer names with the decorations found in reports; the same expression in both engines.
DIRTY = """CASE c_custkey % 10
    WHEN 0 THEN concat(c_mktsegment, ' Holdings ', replace(c_name, '#', ' '), ', Inc.')
    WHEN 1 THEN concat('Old Name Ltd. (dba ', c_mktsegment, ' Labs)')
    WHEN 2 THEN concat(c_mktsegment, ' Systems GmbH (fka "Zed")')
    WHEN 3 THEN concat('* ', c_mktsegment, ' Foods B.V.  ')
    WHEN 4 THEN concat(c_mktsegment, ' ', CAST(c_nationkey AS {s}))
    WHEN 5 THEN concat('Brand  ', lower(c_mktsegment), '   Software Limited')
    WHEN 6 THEN concat('12 ', CAST(c_custkey AS {s}))
    WHEN 7 THEN concat(lower(c_mktsegment), ' aka Second ', CAST(c_nationkey AS {s}), ' Co.')
    WHEN 8 THEN concat('NATION ', CAST(c_nationkey AS {s}), ' CAPITAL CORP')
    ELSE concat('"', c_mktsegment, '" Group & Co. KG') END"""
_SUFFIX = names.legal_form_pattern().replace("'", "''")


def sql_clean(t: str) -> str:
    """The name cleaning as one DuckDB expression over a text column."""
    a = rf"coalesce(nullif(trim(regexp_extract({t}, '(?i)(?:dba|aka)\s+([^)]+)', 1)), ''), {t})"
    b = rf"regexp_replace(regexp_replace({a}, ',.*', '', 'g'), '\(.*', '', 'g')"
    c = rf"regexp_replace(regexp_replace({b}, ' \d+$', ''), '^\* ', '')"
    words = rf"string_split(trim(regexp_replace(u, '\s+', ' ', 'g')), ' ')"
    camel = (f"array_to_string(list_transform({words}, lambda w: "
             "concat(upper(substr(w, 1, 1)), lower(substr(w, 2)))), ' ')")
    d = f"(SELECT CASE WHEN u = upper(u) THEN {camel} ELSE u END FROM (SELECT {c} AS u))"
    tail = r"'[^.\p{L}\p{N}_]+$', ''"
    e = rf"regexp_replace(trim(regexp_replace({d}, '\s+', ' ', 'g')), {tail})"
    return f"replace(regexp_replace(regexp_replace({e}, '(?i){_SUFFIX}', ''), {tail}), '\"', '')"


def sql_comparable(t: str) -> str:
    return rf"trim(regexp_replace(lower({t}), '[^\p{{L}}\p{{N}}_]', ' ', 'g'))"


def sql_identifier(t: str) -> str:
    words = rf"regexp_split_to_array(trim({t}), '\s+')"
    front = f"list_slice({words}, 1, len({words}) - 1)"
    return (f"lower(CASE WHEN len({words}) > 1 AND length(array_to_string({front}, '')) >= 4 "
            f"THEN array_to_string({front}, ' ') ELSE {t} END)")


@QUERIES.add(f"""SELECT c_custkey, raw_name, clean, {sql_identifier('clean')} AS identifier, regexp_matches(raw_name, '[A-Za-z]') AS has_letter
FROM (SELECT c_custkey, raw_name, {sql_clean('raw_name')} AS clean FROM (SELECT c_custkey, {DIRTY.format(s='VARCHAR')} AS raw_name FROM customer))""")
def clean_names(spark, sf):
    raw = table(spark, sf, "customer").select("c_custkey", F.expr(DIRTY.format(s="STRING")).alias("raw_name"))
    done = raw.withColumn("clean", names.clean_company_name(F.col("raw_name")))
    return done.withColumns({"identifier": names.block_identifier(F.col("clean")),
                             "has_letter": names.has_letter(F.col("raw_name"))})


@QUERIES.add(r"""SELECT p_partkey, array_to_string(list_transform(string_split(trim(regexp_replace(concat(p_name, '  ', p_type), '\s+', ' ', 'g')), ' '),
  lambda w: concat(upper(substr(w, 1, 1)), lower(substr(w, 2)))), ' ') AS camel,
  replace(regexp_replace(regexp_replace(concat(p_name, ' (', p_type, ') 7 Inc'), '\(.*\)', '', 'g'), '\s+', ' ', 'g'), ' Inc', '') AS older
FROM part""")
def name_variants(spark, sf):
    older = names.clean_company_name(
        F.concat("p_name", F.lit(" ("), "p_type", F.lit(") 7 Inc")), drop_after_comma=False,
        drop_open_bracket_tail=False, drop_number_and_bullet=False, fix_upper_case=False)
    return table(spark, sf, "part").select(
        "p_partkey", names.camel_case(F.concat("p_name", F.lit("  "), "p_type")).alias("camel"), older.alias("older"))


# Extracted names come from orders, master names from suppliers and customers: many names share a front part.
EXTRACTED = """SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 0 THEN concat('Harbor Point ', CAST(o_custkey AS {s}), 'x Capital Inc.')
    WHEN 1 THEN concat('Customer Partners Fund', CAST(o_custkey % 40 AS {s}))
    WHEN 2 THEN concat('Vega ', CAST(o_custkey AS {s}), 'q Workshops LLC')
    WHEN 3 THEN concat('Solo', CAST(o_custkey AS {s}))
    ELSE CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS {s}) END END AS company_name FROM {t}"""
MASTER = """SELECT c_custkey AS company_id, CASE c_custkey % 6
    WHEN 0 THEN concat('Harbor Point ', CAST(c_custkey + 1 AS {s}), 'x Capital')
    WHEN 1 THEN concat('Customer Partners Fund', CAST(c_custkey % 30 AS {s}))
    WHEN 2 THEN concat('VEGA ', CAST(c_custkey + 3 AS {s}), 'Q STUDIO')
    WHEN 3 THEN concat('Solo', CAST(c_custkey - c_custkey % 2 AS {s}))
    WHEN 4 THEN concat('Harbor Point ', CAST(c_custkey + 3 AS {s}), 'x Finance')
    ELSE concat('Vega ', CAST(c_custkey AS {s}), 'q Workshop, Inc.') END AS company_name_master FROM {t}"""


def _extracted(spark, sf):
    heavy(spark, sf, "orders", "o_orderkey").createOrReplaceTempView("tablefolio_orders")
    return spark.sql(EXTRACTED.format(s="STRING", t="tablefolio_orders"))


def _master(spark, sf):
    heavy(spark, sf, "customer", "c_custkey").createOrReplaceTempView("tablefolio_customer")
    return spark.sql(MASTER.format(s="STRING", t="tablefolio_customer"))


SQL_PAIRS = rf"""ext AS (SELECT o_orderkey, {sql_clean('company_name')} AS company_name FROM ({EXTRACTED.format(s='VARCHAR', t='orders')})
  WHERE company_name IS NOT NULL AND regexp_matches(company_name, '[A-Za-z]')),
mas AS (SELECT company_id, {sql_clean('company_name_master')} AS cm FROM ({MASTER.format(s='VARCHAR', t='customer')})),
masi AS (SELECT *, {sql_identifier('cm')} AS identifier FROM mas),
dis AS (SELECT DISTINCT company_name, {sql_identifier('company_name')} AS identifier FROM ext),
pair AS (SELECT company_name, cm, company_id, count(*) OVER (PARTITION BY company_name) AS n_candidates,
  regexp_replace(lower(company_name), '[^\p{{L}}\p{{N}}_]', ' ', 'g') AS a, regexp_replace(lower(cm), '[^\p{{L}}\p{{N}}_]', ' ', 'g') AS b
  FROM dis JOIN masi USING (identifier))"""
SQL_EDIT = """scored AS (SELECT company_name, cm, n_candidates, count(*) AS copies, min(company_id) AS company_id,
  CAST(floor(100 - 100 * levenshtein(trim(any_value(a)), trim(any_value(b))) / greatest(length(trim(any_value(a))), length(trim(any_value(b))), 1)) AS INT) AS score
  FROM pair GROUP BY company_name, cm, n_candidates)"""
SQL_DECIDED = """ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY company_name ORDER BY score DESC, cm, company_id) AS INT) AS place FROM scored),
picked AS (SELECT company_name, max(n_candidates) AS n_candidates, max(score) FILTER (place = 1) AS best_score, max(copies) FILTER (place = 1) AS copies,
  max(score) FILTER (place = 2) AS second, max(company_id) FILTER (place = 1) AS id FROM ranked GROUP BY company_name),
decided AS (SELECT company_name, n_candidates, best_score, CASE WHEN n_candidates = 1 OR
  (best_score > 85 AND copies = 1 AND best_score > coalesce(second, -1)) THEN id END AS company_id FROM picked),
matched AS (SELECT o_orderkey, company_name, company_id FROM ext LEFT JOIN decided USING (company_name))"""
SQL_MATCH = f"{SQL_PAIRS}, {SQL_EDIT}, {SQL_DECIDED}"


def sql_common(pairs: str) -> str:
    """Longest common subsequences of the texts a and b of `pairs`, row by row of the usual table: row[j + 1] belongs to
    the first j characters of a, and each step takes one more character of b."""
    return f"""steps AS (SELECT a, b, 0 AS i, list_transform(range(0, length(a) + 1), lambda j: 0) AS row FROM (SELECT DISTINCT a, b FROM {pairs})
  UNION ALL SELECT a, b, i + 1, list_transform(range(0, length(a) + 1), lambda j: CASE WHEN j = 0 THEN 0 ELSE list_max(list_transform(range(1, j + 1),
    lambda k: CASE WHEN substr(a, k, 1) = substr(b, i + 1, 1) THEN row[k] + 1 ELSE row[k + 1] END)) END) FROM steps WHERE i < length(b)),
common AS (SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 100 ELSE
  CAST(round_even(200::DOUBLE * row[length(a) + 1] / (length(a) + length(b)), 0) AS INT) END AS ratio FROM steps WHERE i = length(b))"""


SQL_RATIO = f"""RECURSIVE {SQL_PAIRS}, grouped AS (SELECT company_name, cm, n_candidates, count(*) AS copies, min(company_id) AS company_id,
  trim(any_value(a)) AS a, trim(any_value(b)) AS b FROM pair GROUP BY company_name, cm, n_candidates),
{sql_common('grouped')},
scored AS (SELECT company_name, cm, n_candidates, copies, company_id, ratio AS score FROM grouped JOIN common USING (a, b)), {SQL_DECIDED}"""


def _cleaned(spark, sf):
    return entity.clean_extracted(_extracted(spark, sf))


@QUERIES.add(f"""WITH {SQL_MATCH} SELECT company_name, n_candidates, cm AS candidate, copies, company_id, score, place FROM ranked WHERE place <= 5""")
def best_candidates(spark, sf):
    return entity.best_candidates(_cleaned(spark, sf), entity.clean_master(_master(spark, sf)), "edit")


@QUERIES.add(f"""WITH {SQL_MATCH} SELECT company_name, n_candidates, best_score, CAST(company_id AS VARCHAR) AS company_id FROM decided""")
def match_decision(spark, sf):
    best = entity.best_candidates(_cleaned(spark, sf), entity.clean_master(_master(spark, sf)), "edit")
    return entity.decide(best).withColumn("company_id", F.col("company_id").cast("string"))


@QUERIES.add(f"""WITH {SQL_MATCH} SELECT o_orderkey, company_name, CAST(company_id AS VARCHAR) AS company_id FROM matched""")
def entity_match(spark, sf):
    return entity.match_companies(_extracted(spark, sf), _master(spark, sf), "edit").select(
        "o_orderkey", "company_name", F.col("company_id").cast("string").alias("company_id"))


@QUERIES.add(f"""WITH {SQL_RATIO} SELECT o_orderkey, company_name, CAST(company_id AS VARCHAR) AS company_id FROM matched""")
def entity_match_ratio(spark, sf):
    return entity.match_companies(_extracted(spark, sf), _master(spark, sf), "ratio").select(
        "o_orderkey", "company_name", F.col("company_id").cast("string").alias("company_id"))


@QUERIES.add(f"""WITH {SQL_RATIO} SELECT company_name, n_candidates, cm AS candidate, copies, company_id, score, place FROM ranked WHERE place <= 5""")
def candidate_ratio(spark, sf):
    return entity.best_candidates(_cleaned(spark, sf), entity.clean_master(_master(spark, sf)), "ratio")


@QUERIES.add(f"""WITH {SQL_MATCH} SELECT count(DISTINCT company_id) AS matched_ids, count(DISTINCT company_name) AS names FROM matched""")
def match_coverage(spark, sf):
    return entity.coverage(entity.match_companies(_extracted(spark, sf), _master(spark, sf), "edit"))


@QUERIES.add(f"""WITH {SQL_MATCH} SELECT * FROM matched WHERE company_id IS NOT NULL""")
def matched_only(spark, sf):
    done = entity.match_companies(_extracted(spark, sf), _master(spark, sf), "edit")
    return entity.matched_only(done).select("o_orderkey", "company_name", "company_id")


@QUERIES.add(f"""WITH {SQL_MATCH} SELECT * FROM matched WHERE company_id IS NOT NULL AND company_id NOT IN (
  SELECT company_id FROM picked JOIN ranked USING (company_name) WHERE picked.n_candidates = 1)""")
def match_diff(spark, sf):
    ext, master = _extracted(spark, sf), _master(spark, sf)
    best = entity.best_candidates(_cleaned(spark, sf), entity.clean_master(master), "edit")
    old = entity.decide(best, 100).where("company_id IS NOT NULL")
    new = entity.matched_only(entity.match_companies(ext, master, "edit"))
    return entity.only_in_new(old, new).select("o_orderkey", "company_name", "company_id")


@QUERIES.add(rf"""WITH RECURSIVE names AS (SELECT DISTINCT p_name, p_type, {{own}} AS own, [{{type}}, {{both}}] AS others FROM part),
ordered AS (SELECT own, other, CASE WHEN length(own) > length(other) THEN other ELSE own END AS short,
  CASE WHEN length(own) > length(other) THEN own ELSE other END AS long FROM (SELECT DISTINCT own, unnest(others) AS other FROM names)),
windows AS (SELECT own, other, short, unnest(list_transform(range(1 - length(short), greatest(length(long), 2 - length(short))),
  lambda s: substr(long, greatest(s, 0) + 1, least(s + length(short), length(long)) - greatest(s, 0)))) AS piece FROM ordered),
asked AS (SELECT own AS a, other AS b FROM ordered UNION SELECT short, piece FROM windows),
{sql_common('asked')},
best AS (SELECT own, other, max(ratio) AS window_ratio FROM windows JOIN common ON short = a AND piece = b GROUP BY own, other),
told AS (SELECT p_name, p_type, list(ratio ORDER BY place) AS ratios, list(window_ratio ORDER BY place) AS window_ratios
  FROM (SELECT p_name, p_type, own, unnest(others) AS other, unnest([1, 2]) AS place FROM names) n
  JOIN common ON own = a AND other = b JOIN best USING (own, other) GROUP BY p_name, p_type)
SELECT p_partkey, ratios, window_ratios FROM part JOIN told USING (p_name, p_type)""".format(
    own=sql_comparable("p_name"), type=sql_comparable("p_type"), both=sql_comparable("concat(p_type, ' ', p_name)")))
def name_similarity(spark, sf):
    """Both ratios of each part name to its brand and type texts; equal names are scored once."""
    others = F.array(names.comparable(F.col("p_type")), names.comparable(F.concat("p_type", F.lit(" "), "p_name")))
    own = names.comparable(F.col("p_name"))
    parts = table(spark, sf, "part")
    told = settled(parts.select("p_name", "p_type").distinct().withColumns({"own": own, "others": others})).select(
        "p_name", "p_type", ratio_to_each(F.col("own"), F.col("others")).alias("ratios"),
        window_ratio_to_each(F.col("own"), F.col("others")).alias("window_ratios"))
    return parts.join(told, ["p_name", "p_type"]).select("p_partkey", "ratios", "window_ratios")


@QUERIES.add("""WITH n AS (SELECT c_mktsegment || c_nationkey AS name, bool_or(c_custkey % 3 = 0) AS a, bool_or(c_acctbal > 9000) AS b
  FROM customer GROUP BY 1)
SELECT CAST(count_if(a AND NOT b) AS BIGINT) AS only_a, CAST(count_if(b AND NOT a) AS BIGINT) AS only_b, CAST(count_if(a AND b) AS BIGINT) AS both FROM n""")
def provider_overlap(spark, sf):
    companies = table(spark, sf, "customer").select(
        F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey")).alias("key_a"),
        F.when(F.col("c_acctbal") > 9000, F.col("c_custkey")).alias("key_b"))
    return analytics.provider_overlap(companies, "name", "key_a", "key_b")


@QUERIES.add("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def in_list_semi(spark, sf):
    wanted = table(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return inventory.in_list(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), wanted, "c_custkey")


@QUERIES.add("""SELECT d.doc_id, lang, source, n_chars, CAST(quality AS VARCHAR) AS quality FROM documents d LEFT JOIN labels USING (doc_id)""")
def label_left_join(spark, sf):
    joined = inventory.with_labels(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", ("text",), ("toxic",))
    return joined.withColumn("quality", F.col("quality").cast("string"))


@QUERIES.add("""SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def incremental_skip(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return not_yet_done(table(spark, sf, "customer").select("c_custkey", "c_name"), done, "c_custkey")

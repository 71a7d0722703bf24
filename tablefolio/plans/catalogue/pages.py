"""Pages and spans made from documents, layout cells made from parts, and the operators over them.

Ten documents in a row are the pages of one report. Each word is a span whose place follows from its line and its
place in the line; some pages get table titles, metric headings, numbers and watermark words.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefolio.operators import grid as G
from tablefolio.operators import pages as PG
from tablefolio.operators.errors import without_pages
from tablefolio.operators.ordered import RowOrder, settled
from tablefolio.plans.catalogue import Catalogue, heavy, table
from tablefolio.rules import CARRY_METRICS, DEFAULT_RULES, HEADER_METRICS
from tablefolio.sources.csv_tables import fields, fit_width, missing_to_null
from tablefolio.sources.records import pages_of_spans, table_file_id

QUERIES = Catalogue()
KEPT_LAYOUTS = ("fund 7 ", "FUND 13 ")

PAGE_TEXT = """SELECT CAST(floor(doc_id / 10) AS BIGINT) AS doc_id, CAST(doc_id % 10 AS INT) AS page, doc_id AS page_key,
  concat(CASE doc_id % 11 WHEN 3 THEN 'Schedule of Investments\\n' WHEN 5 THEN 'Portfolio Summary\\n' ELSE '' END, text) AS text FROM {T}"""


def _word(word, line, place, key):
    """The span text: a few places of some pages hold headings, amounts or a watermark word."""
    at = [(f"{line} = 1 AND {place} = {i} AND {key} % 6 = 0", f"'{t}'") for i, t in
          enumerate(("Total Cost", "Fair Value", "Realized Value", "Gross MOIC", "Current Ownership"))]
    at += [(f"{line} = 2 AND {place} = 3", "'$1,234'"), (f"{place} = 7 AND {line} % 4 = 0", "'Confidential'"),
           (f"{place} = 8 AND {line} = 3", "'CURRENT FAIR VALUE'")]
    return "CASE " + " ".join(f"WHEN {c} THEN {t}" for c, t in at) + f" ELSE {word} END"


# One span from its word w, line l and place p (both from 0); the same numbers in both engines.
_X0 = "(30.0 + CASE WHEN {k} % 5 = 0 THEN 1.5 ELSE 0.0 END) * ({p} % 14) + ({k} % 4) * 0.75"
_SIZE = "8.0 + {l} % 15"
_DIR = "CASE WHEN {p} % 50 = 49 THEN 0.5 WHEN {p} % 3 = 0 THEN -1.0 ELSE 1.0 END"


def _page_counts(spark, sf):
    """Pages of each document, counted before any span is built: the scan reads the ids alone."""
    table(spark, sf, "documents").createOrReplaceTempView("tablefolio_page_ids")
    pages = spark.sql(PAGE_TEXT.format(T="tablefolio_page_ids"))
    docs = pages.groupBy(F.col("doc_id").alias("doc_ord")).agg(F.count("*").cast("int").alias("page_count"))
    return docs.withColumn("report_path", F.expr(_PATH.format(d="string(doc_ord)")))


def _pages(spark, sf):
    heavy(spark, sf, "documents", "doc_id").createOrReplaceTempView("tablefolio_documents")
    raw = spark.sql(PAGE_TEXT.format(T="tablefolio_documents"))
    # what a page's spans share comes first, and once; in binary fractions doubles give what decimals do
    pages = settled(raw.select(
        "doc_id", "page", "page_key", "text", F.split("text", "\n").alias("lines"),
        F.expr("30.0D + CASE WHEN page_key % 5 = 0 THEN 1.5D ELSE 0.0D END").alias("step"),
        F.expr("(page_key % 4) * 0.75D").alias("indent")))
    word = f"CASE WHEN p > 8 OR (l > 3 AND p <> 7) THEN w ELSE {_word('w', 'l', 'p', 'page_key')} END"
    span = (f"named_struct('text', {word}, 'size', 8.0D + l % 15, 'dir_x', {_DIR.format(p='p').replace('.5', '.5D').replace('.0', '.0D')}, "
            "'block_y0', 12.0D * l, 'x0', step * (p % 14) + indent, 'y0', 12.0D * l, "
            "'x1', step * (p % 14) + indent + 5.0D * length(w), 'y1', 12.0D * l + 10.0D)")
    spans = f"flatten(transform(lines, (line, l) -> transform(split(line, ' '), (w, p) -> {span})))"
    return settled(pages.select("doc_id", "page", "text", F.expr("12.0D * size(lines)").alias("height"), F.expr(spans).alias("spans")))


_T = PAGE_TEXT.replace("\\n", "' || chr(10) || '").format(T="documents")
SQL_SPANS = f"""pg AS MATERIALIZED ({_T}),
ln AS (SELECT doc_id, page, page_key, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS l FROM pg),
wd AS (SELECT doc_id, page, page_key, l, unnest(string_split(line, ' ')) AS w, generate_subscripts(string_split(line, ' '), 1) - 1 AS p FROM ln),
spans AS MATERIALIZED (SELECT doc_id, page, row_number() OVER (PARTITION BY doc_id, page ORDER BY l, p) AS ord, {_word('w', 'l', 'p', 'page_key')} AS text, CAST({_SIZE.format(l='l')} AS DOUBLE) AS size,
  CAST({_DIR.format(p='p')} AS DOUBLE) AS dir_x, CAST(12.0 * l AS DOUBLE) AS y0, CAST({_X0.format(k='page_key', p='p')} AS DOUBLE) AS x0,
  CAST({_X0.format(k='page_key', p='p')} AS DOUBLE) + 5.0 * length(w) AS x1, 12.0 * l + 10.0 AS y1 FROM wd),
hts AS (SELECT doc_id, page, 12.0 * len(string_split(text, chr(10))) AS height, lower(replace(text, chr(10), '')) AS norm FROM pg),
plain AS (SELECT * FROM spans WHERE (abs(dir_x) < 0.01 OR abs(abs(dir_x) - 1) < 0.01) AND size < 20 AND NOT contains(lower(text), 'confidential')),
kept AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY ord) AS rn, row_number() OVER (PARTITION BY doc_id, page ORDER BY ord DESC) AS rd
  FROM plain WHERE NOT contains(text, 'CURRENT FAIR VALUE'))"""


@QUERIES.add(f"""WITH {SQL_SPANS}, out AS (SELECT *, (y1 - y0) > (x1 - x0) * 1.9 AS rotated FROM kept)
SELECT h.doc_id, h.page, count(ord) AS n_kept, CAST(coalesce(count_if(rotated), 0) AS BIGINT) AS n_rotated, md5(coalesce(string_agg(replace(text, '$', ''), ' ' ORDER BY ord), '')) AS text_hash,
  CAST(coalesce(sum(CAST(round(100 * CASE WHEN rotated THEN x1 - 2 ELSE x0 END) AS BIGINT)), 0) AS BIGINT) AS sum_x,
  CAST(coalesce(sum(CAST(round(100 * CASE WHEN rotated THEN y1 - 8 ELSE y0 END) AS BIGINT)), 0) AS BIGINT) AS sum_y
FROM hts h LEFT JOIN out o ON h.doc_id = o.doc_id AND h.page = o.page GROUP BY ALL""")
def page_output(spark, sf):
    out = _pages(spark, sf).select("doc_id", "page", PG.output_spans(PG.kept_spans(F.col("spans"))).alias("o"))

    def total(name):
        cents = F.transform("o", lambda s: F.round(s[name] * 100).cast("bigint"))
        return F.aggregate(cents, F.lit(0).cast("bigint"), lambda a, b: a + b)

    return out.select(
        "doc_id", "page", F.size("o").cast("bigint").alias("n_kept"),
        F.size(F.filter("o", lambda s: s["rotated"])).cast("bigint").alias("n_rotated"),
        F.md5(F.array_join(F.transform("o", lambda s: s["text"]), " ")).alias("text_hash"),
        total("x").alias("sum_x"), total("y").alias("sum_y"))


def _hits(text: str) -> str:
    names = DEFAULT_RULES.names()
    parts = []
    for target in HEADER_METRICS:
        phrases = DEFAULT_RULES.phrases(tuple(n for n in names if n in target), several_words=True)
        parts.append("CAST(" + " OR ".join(f"contains({text}, '{p}')" for _, p in phrases) + " AS INT)")
    return " + ".join(parts)


def _any(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in phrases) + ")"


SQL_FEATURES = f"""{SQL_SPANS},
tops AS (SELECT h.doc_id, h.page, norm, coalesce(lower(string_agg(s.text, '' ORDER BY s.ord)), '') AS top
  FROM hts h LEFT JOIN plain s ON s.doc_id = h.doc_id AND s.page = h.page AND s.y0 <= height / 4 GROUP BY ALL),
feat AS MATERIALIZED (SELECT doc_id, page, top, {_hits('top')} AS top_hits, length(norm) >= 200 AS long_enough,
  CASE WHEN {_any('norm', PG.SIT_PHRASES)} THEN 'SIT' WHEN {_any('norm', PG.PST_PHRASES)} THEN 'PST' WHEN {_hits('top')} >= 3 THEN 'PST' END AS own_type FROM tops)"""


@QUERIES.add(f"""WITH {SQL_FEATURES} SELECT doc_id, page, coalesce(own_type, 'none') AS own_type, long_enough FROM feat""")
def page_classify(spark, sf):
    return PG.page_features(_pages(spark, sf)).select(
        "doc_id", "page", F.coalesce("own_type", F.lit("none")).alias("own_type"), "long_enough")


def _first(text: str, several: bool) -> str:
    listed = DEFAULT_RULES.phrases(CARRY_METRICS, several)
    return "CASE " + " ".join(f"WHEN contains({text}, '{p}') THEN '{m}: {p}'" for m, p in listed) + " ELSE '' END"


@QUERIES.add(f"""WITH {SQL_FEATURES} SELECT doc_id, page, top_hits, {_first('top', True)} AS first_long, {_first('top', False)} AS first_any FROM feat""")
def top_region_hits(spark, sf):
    top = settled(_pages(spark, sf).select(
        "doc_id", "page", PG.top_text(F.col("spans"), F.col("height")).alias("top")))

    def first(several):
        hit = PG.first_phrase_hit(F.col("top"), DEFAULT_RULES, CARRY_METRICS, several)
        return F.coalesce(F.concat(hit["metric"], F.lit(": "), hit["phrase"]), F.lit(""))

    return top.select("doc_id", "page", PG.top_metric_hits(F.col("top")).alias("top_hits"),
                      first(True).alias("first_long"), first(False).alias("first_any"))


# Two-pointer walk over the ascending edges of a page's end and of the next page's start, one step per recursion.
SQL_ALIGNED = """ends AS (SELECT doc_id, page + 1 AS page, list_sort(list(DISTINCT x0)) AS b FROM kept WHERE rd <= 32 GROUP BY ALL),
starts AS (SELECT doc_id, page, list_sort(list(DISTINCT x0)) AS a FROM kept WHERE rn <= 32 GROUP BY ALL),
walk AS (SELECT doc_id, page, a, b, 1 AS i, 1 AS j, 0 AS pairs FROM starts JOIN ends USING (doc_id, page)
  UNION ALL SELECT doc_id, page, a, b,
    CASE WHEN abs(a[i] - b[j]) < 1 OR a[i] <= b[j] THEN i + 1 ELSE i END, CASE WHEN abs(a[i] - b[j]) < 1 OR a[i] > b[j] THEN j + 1 ELSE j END,
    CASE WHEN abs(a[i] - b[j]) < 1 THEN pairs + 1 ELSE pairs END FROM walk WHERE i <= len(a) AND j <= len(b)),
aligned AS (SELECT doc_id, page, max(pairs) AS pairs FROM walk GROUP BY ALL)"""


@QUERIES.add(f"""WITH RECURSIVE {SQL_SPANS}, {SQL_ALIGNED} SELECT doc_id, page, pairs FROM aligned""")
def page_alignment(spark, sf):
    pages = PG.page_features(_pages(spark, sf)).select(
        "doc_id", "page", PG.left_edges(F.col("top_spans")).alias("a"), PG.left_edges(F.col("tail_spans")).alias("ends"))
    both = RowOrder(("doc_id",), "page").neighbours(pages, {"b": (F.col("ends"), -1)})
    return both.where((F.size("a") > 0) & (F.size("b") > 0)).select(
        "doc_id", "page", PG.aligned_count(F.col("a"), F.col("b")).alias("pairs"))


# A fold over the pages of a report, page by page.
SQL_CHAIN = f"""{SQL_FEATURES}, {SQL_ALIGNED},
lay AS (SELECT f.*, coalesce(pairs, 0) >= 5 AND long_enough AND NOT regexp_matches(concat('/reports/Fund ', doc_id, ' LP/q.pdf'), '(?i)fund 7 |FUND 13 ') AS link,
  own_type IS NOT NULL AND long_enough AS own FROM feat f LEFT JOIN aligned USING (doc_id, page)),
fold AS (SELECT doc_id, page, own AS keep FROM lay WHERE page = 0
  UNION ALL SELECT l.doc_id, l.page, l.own OR (f.keep AND l.link) FROM fold f JOIN lay l ON l.doc_id = f.doc_id AND l.page = f.page + 1),
chained AS MATERIALIZED (SELECT l.doc_id, l.page, CASE WHEN own THEN own_type ELSE 'PST' END AS table_type, NOT own AS is_continuation FROM fold JOIN lay l USING (doc_id, page) WHERE keep)"""


def _chain(spark, sf):
    path = F.concat(F.lit("/reports/Fund "), F.col("doc_id").cast("string"), F.lit(" LP/q.pdf"))
    return PG.chain_pages(PG.page_features(_pages(spark, sf)), PG.keeps_layout(path, KEPT_LAYOUTS))


@QUERIES.add(f"""WITH RECURSIVE {SQL_CHAIN} SELECT * FROM chained""")
def page_chain(spark, sf):
    return _chain(spark, sf).select("doc_id", "page", "table_type", "is_continuation")


@QUERIES.add(f"""WITH RECURSIVE {SQL_CHAIN},
anchor AS (SELECT doc_id, page, floor(min_by(y0, rn)) AS y FROM kept WHERE rn <= 32 AND regexp_matches(regexp_replace(text, '[$,]', '', 'g'),
    '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') GROUP BY ALL),
prev AS (SELECT doc_id, page + 1 AS page, rn, text, x0, y0, x1, y1 FROM kept WHERE rn <= 32),
box AS (SELECT doc_id, page, least(0, min(x0)) AS bx0, least(0, min(y0)) AS by0, greatest(0, max(x1)) AS bx1, greatest(0, max(y1)) AS by1 FROM prev
  WHERE {_any('lower(text)', [p for _, p in DEFAULT_RULES.phrases(CARRY_METRICS)])} GROUP BY ALL),
moved AS (SELECT p.doc_id, p.page, rn, replace(text, '$', '') AS text, (y1 - y0) > (x1 - x0) * 1.9 AS rotated, x0, x1, y0, y, by1
  FROM prev p JOIN box b ON b.doc_id = p.doc_id AND b.page = p.page JOIN anchor a ON a.doc_id = p.doc_id AND a.page = p.page
  WHERE y > 0 AND bx0 < bx1 AND by0 < by1 AND x0 >= bx0 AND x1 <= bx1 AND y0 >= by0 AND y1 <= by1)
SELECT c.doc_id, c.page, count(rn) AS n_header, coalesce(string_agg(text, '|' ORDER BY rn), '') AS header_text,
  CAST(coalesce(sum(CAST(round(100 * CASE WHEN rotated THEN x1 - 2 ELSE x0 END) AS BIGINT)), 0) AS BIGINT) AS sum_x,
  CAST(coalesce(sum(CAST(round(100 * CASE WHEN rotated THEN y - 12 ELSE y0 - by1 + y - 12 END) AS BIGINT)), 0) AS BIGINT) AS sum_y
FROM chained c LEFT JOIN moved m ON m.doc_id = c.doc_id AND m.page = c.page WHERE is_continuation GROUP BY ALL""")
def carried_headers(spark, sf):
    more = _chain(spark, sf).where("is_continuation")
    out = more.select("doc_id", "page", PG.carried_header(F.col("top_spans"), F.col("prev_top")).alias("h"))

    def total(name):
        cents = F.transform("h", lambda s: F.round(s[name] * 100).cast("bigint"))
        return F.aggregate(cents, F.lit(0).cast("bigint"), lambda a, b: a + b)

    return out.select("doc_id", "page", F.size("h").cast("bigint").alias("n_header"),
                      F.array_join(F.transform("h", lambda s: s["text"]), "|").alias("header_text"),
                      total("x").alias("sum_x"), total("y").alias("sum_y"))


_PATH = "concat('/reports/Fund ', {d}, ' LP/q', {d}, '.pdf')"


@QUERIES.add(f"""WITH RECURSIVE {SQL_CHAIN}, docs AS (SELECT doc_id, CAST(count(*) AS INT) AS page_count FROM pg GROUP BY 1)
SELECT {_PATH.format(d='doc_id')} AS report_path, concat('q', doc_id, '.pdf') AS report_name, page_count, CAST(page + 1 AS VARCHAR) AS page_ori,
  CAST(CASE WHEN page IS NOT NULL THEN row_number() OVER (ORDER BY CASE WHEN page IS NULL THEN 1 ELSE 0 END, doc_id, page) END AS VARCHAR) AS page_new,
  table_type, page IS NOT NULL AS is_processed FROM docs LEFT JOIN chained USING (doc_id)""")
def page_registry(spark, sf):
    done = PG.number_pages(_page_counts(spark, sf), _chain(spark, sf).withColumnRenamed("doc_id", "doc_ord"))
    return done.drop("doc_ord").withColumns({c: F.col(c).cast("string") for c in ("page_ori", "page_new")})


@QUERIES.add(f"""WITH RECURSIVE {SQL_CHAIN}
SELECT {_PATH.format(d='doc_id')} AS report_path, 'WRN-EX1009' AS code, 'Warning' AS level,
  'Cannot find page containing SIT or PST from the given report: ' || {_PATH.format(d='doc_id')} AS description
FROM (SELECT DISTINCT doc_id FROM pg) WHERE doc_id NOT IN (SELECT doc_id FROM chained)""")
def reports_without_pages(spark, sf):
    found = PG.number_pages(_page_counts(spark, sf), _chain(spark, sf).withColumnRenamed("doc_id", "doc_ord"))
    return without_pages(found)


@QUERIES.add(f"""WITH RECURSIVE {SQL_CHAIN}, docs AS (SELECT doc_id, CAST(count(*) AS INT) AS page_count FROM pg GROUP BY 1),
own_sit AS (SELECT doc_id, page FROM chained WHERE table_type = 'SIT')
SELECT {_PATH.format(d='doc_id')} AS report_path, page_count, count(page) AS n_pages, count(page) > 0 AS is_processed
FROM docs LEFT JOIN own_sit USING (doc_id) GROUP BY ALL""")
def schedule_registry(spark, sf):
    """Documents without a schedule page stay in the registry as one row without a page."""
    schedules = _chain(spark, sf).where("table_type = 'SIT'").withColumnRenamed("doc_id", "doc_ord")
    return PG.number_pages(_page_counts(spark, sf), schedules).groupBy("report_path", "page_count").agg(
        F.count("page_new").alias("n_pages"), F.max("is_processed").alias("is_processed"))


@QUERIES.add(f"""WITH {SQL_SPANS} SELECT doc_id, page, count(*) AS n_spans, md5(string_agg(text, chr(10) ORDER BY ord)) AS text_hash FROM spans GROUP BY ALL""")
def spans_to_pages(spark, sf):
    flat = _pages(spark, sf).select("doc_id", "page", F.col("height").alias("page_height"),
                                    F.posexplode("spans").alias("span_ord", "s")).select(
        "doc_id", "page", "page_height", "span_ord", "s.*")
    return pages_of_spans(flat).select("doc_id", "page", F.size("spans").cast("bigint").alias("n_spans"),
                                       F.md5("text").alias("text_hash"))


@QUERIES.add("""SELECT c_custkey, substr(sha256(concat('/a/', c_name, '.pdf,/b/', c_mktsegment, '.pdf')), 1, 4) AS batch_id FROM customer""")
def batch_ids(spark, sf):
    paths = F.array(F.concat(F.lit("/a/"), "c_name", F.lit(".pdf")), F.concat(F.lit("/b/"), "c_mktsegment", F.lit(".pdf")))
    return table(spark, sf, "customer").select("c_custkey", PG.batch_id(paths).alias("batch_id"))


# Layout cells from parts: thirty parts make a grid of five used columns and one empty one. Two first-row cells
# span several columns; the cells they cover add to row 1; some rows and some whole tables are empty.
CELLS = """SELECT concat('g', CAST(k AS {S})) AS table_id, i AS cell_ord, CAST(floor(k / 3) + 1 AS INT) AS page,
    CASE WHEN i IN (1, 3, 4) THEN 1 ELSE CAST(floor(i / 5) AS INT) END AS row_index, CAST(i % 5 AS INT) AS column_index,
    CASE i WHEN 0 THEN 2 WHEN 2 THEN 3 END AS column_span,
    CASE WHEN (k % 3 = 0 AND i >= 15 AND i < 20) OR (k % 10 = 9 AND i > 0 AND i <> 2) THEN '' ELSE concat(p_name, {NL}, CAST(p_size AS {S})) END AS content,
    CAST(6 AS INT) AS row_count, CAST(6 AS INT) AS column_count
  FROM (SELECT CAST(floor(p_partkey / 30) AS BIGINT) AS k, CAST(p_partkey % 30 AS INT) AS i, p_name, p_size FROM {T})"""
SQL_CELLS = f"""cell AS ({CELLS.format(S='VARCHAR', T='part', NL='chr(10)')}),
placed AS (SELECT table_id, 1 AS row_idx, column_index + o AS col_idx, 0 AS turn, cell_ord, replace(content, chr(10), ' ') || ' ' AS part
    FROM cell, (SELECT unnest(range(0, 3)) AS o) WHERE row_index = 0 AND column_span IS NOT NULL AND o < column_span
  UNION ALL SELECT table_id, row_index, column_index, 1, cell_ord, replace(content, chr(10), ' ') FROM cell WHERE NOT (row_index = 0 AND column_span IS NOT NULL)),
texts AS (SELECT table_id, CAST(row_idx AS INT) AS row_idx, CAST(col_idx AS INT) AS col_idx, string_agg(part, '' ORDER BY turn, cell_ord) AS value FROM placed GROUP BY ALL),
wide AS (SELECT table_id, row_idx, {" || '|' || ".join(f"coalesce(max(value) FILTER (col_idx = {c}), '')" for c in range(6))} AS line FROM texts GROUP BY ALL)"""


def _cells(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("tablefolio_part")
    return spark.sql(CELLS.format(S="STRING", T="tablefolio_part", NL="chr(10)"))


@QUERIES.add(f"WITH {SQL_CELLS} SELECT * FROM texts")
def spanning_cells(spark, sf):
    return G.cell_texts(_cells(spark, sf))


@QUERIES.add(f"""WITH {SQL_CELLS}, body AS (SELECT * FROM wide WHERE row_idx > 0 AND replace(line, '|', '') <> '')
SELECT table_id, CAST(0 AS INT) AS row_idx, coalesce(w.line, '|||||') AS line FROM (SELECT DISTINCT table_id FROM body) JOIN wide w USING (table_id) WHERE w.row_idx = 0
UNION ALL SELECT * FROM body""")
def grid_rows(spark, sf):
    heads, body = G.header_and_rows(G.table_rows(_cells(spark, sf)))
    return heads.select("table_id", F.lit(0).alias("row_idx"), F.array_join("header", "|").alias("line")).unionByName(
        body.select("table_id", "row_idx", F.array_join("values", "|").alias("line")))


@QUERIES.add(f"""WITH {SQL_CELLS}, t AS (SELECT DISTINCT table_id, page, CAST(substr(table_id, 2) AS BIGINT) AS ord FROM cell),
n AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY ord) - 1 AS q FROM t)
SELECT table_id, concat('/gp/Fund ', page % 7, '/r', page, '.pdf') AS report_path, concat('r', page, '.pdf') AS report_name,
  CASE WHEN page % 2 = 0 THEN 'SIT' ELSE 'PST' END AS table_type, page + 2 AS page_ori, concat('Fund ', page % 7) AS fund_name,
  concat('Fund ', page % 7, '/', CASE WHEN page < 10 THEN '0' ELSE '' END, page, '_r', page, '.pdf_', CASE WHEN page % 2 = 0 THEN 'SIT' ELSE 'PST' END, '_', page + 2,
    CASE WHEN q > 0 THEN concat('(', q, ')') ELSE '' END, '.csv') AS csv_path FROM n""")
def table_registry(spark, sf):
    cells = _cells(spark, sf)
    tables = cells.groupBy("table_id", F.col("page").alias("page_new")).agg(
        F.lit("batch.pdf").alias("processed_report_path"),
        F.substring("table_id", 2, 20).cast("bigint").alias("table_ord"))
    page = F.col("page").cast("string")
    pages = cells.select(
        F.lit("batch.pdf").alias("processed_report_path"), F.col("page").alias("page_new"),
        F.concat(F.lit("/gp/Fund "), (F.col("page") % 7).cast("string"), F.lit("/r"), page, F.lit(".pdf")).alias("report_path"),
        F.concat(F.lit("r"), page, F.lit(".pdf")).alias("report_name"),
        F.when(F.col("page") % 2 == 0, "SIT").otherwise("PST").alias("table_type"), (F.col("page") + 2).alias("page_ori"))
    return G.registry_for_tables(tables, pages)


@QUERIES.add("""SELECT p_partkey, CAST(p_partkey AS INT) AS file_id, concat(p_name, ', "x"|', p_type, '||', coalesce(CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END::VARCHAR, 'null'), '|null') AS cells FROM part""")
def csv_fields(spark, sf):
    size = F.when(F.col("p_size") % 5 == 0, F.lit("NA")).otherwise(F.col("p_size").cast("string"))
    record = F.concat(F.lit('"'), "p_name", F.lit(', ""x""",'), "p_type", F.lit(',"",'), size)
    values = fields(record)
    shown = F.transform(fit_width(values, F.lit(5)), lambda v: v)
    kept = F.zip_with(shown, missing_to_null(shown), lambda a, b: F.when(a == "", a).otherwise(F.coalesce(b, F.lit("null"))))
    name = F.concat(F.lit("part"), F.col("p_partkey").cast("string"), F.lit("_v2.csv"))
    return table(spark, sf, "part").select("p_partkey", table_file_id(name).alias("file_id"),
                                           F.array_join(kept, "|").alias("cells"))

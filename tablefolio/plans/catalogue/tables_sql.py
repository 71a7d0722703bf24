"""The table operators said once more in SQL, relation by relation, for comparison with the Spark results."""

from __future__ import annotations

from tablefolio.operators.headers import LAYERED, LAYERED_WIDE
from tablefolio.rules import DEFAULT_RULES, HEADER_METRICS, NUMBER_METRICS, PERCENT_METRICS

_NUMBER = r"'^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$'"


def _number(t: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({t}, {_NUMBER}, 1), '') AS DOUBLE)"


def money(t: str) -> str:
    return _number(rf"regexp_replace(regexp_replace({t}, '[$,x]', '', 'g'), '\((.+?)\)', '-\1', 'g')")


def percent(t: str) -> str:
    inner = _number(rf"regexp_replace(regexp_replace({t}, '[%\[\]·]', '', 'g'), '\((.+?)\)', '-\1', 'g')")
    return f"CASE WHEN contains({t}, '%') THEN {inner} / 100 END"


_LAY = f"regexp_matches(v, '{LAYERED}')"
_LAY_WIDE = f"regexp_matches(v, '{LAYERED_WIDE}')"

PROFILE = f"""
cells AS MATERIALIZED (SELECT table_id, row_idx, CAST(i - 1 AS INT) AS col_idx, replace(replace(vals[i], ':unselected:', ''), ':selected:', '') AS v,
    replace(replace(vals[i + 1], ':unselected:', ''), ':selected:', '') AS nxt
  FROM (SELECT table_id, row_idx, vals, unnest(range(1, len(vals) + 1)) AS i FROM raw)),
facts0 AS MATERIALIZED (SELECT *, regexp_matches(v, {_NUMBER}) AS is_num, {money('v')} AS mny FROM cells),
profile AS (SELECT table_id, col_idx, count(*) AS n_rows, count(v) AS filled, CAST(count_if(is_num) AS BIGINT) AS number, count(mny) AS money,
  CAST(floor(coalesce(sum(mny), 0)) AS BIGINT) AS money_sum, CAST(count_if({_LAY}) AS BIGINT) AS layered FROM facts0 GROUP BY ALL)"""


def _chain(text: str, targets=HEADER_METRICS) -> tuple[str, str]:
    """Chained replacements of the rule phrases and the number of metrics found on the way."""
    steps, hits, last = [], {}, text
    for i, (metric, phrase) in enumerate(DEFAULT_RULES.phrases(targets)):
        hits.setdefault(metric, []).append(f"contains({last}, '{phrase}')")
        steps.append(f"replace({last}, '{phrase}', '') AS s{i}")
        last = f"s{i}"
    count = " + ".join(f"CAST(({' OR '.join(h)}) AS INT)" for h in hits.values())
    return ", ".join(steps), count


_STEPS, _COUNT = _chain("lower(sub)")

DECIDED = f"""
hcol AS (SELECT table_id, CAST(i - 1 AS INT) AS col_idx, header[i] AS h FROM (SELECT *, unnest(range(1, len(header) + 1)) AS i FROM hdr)),
h1 AS (SELECT table_id, bool_and(h = '' OR contains(h, 'Unnamed')) AS promoted, bool_or(regexp_matches(h, '^[0-9]+$')) AS digits, count(*) AS width FROM hcol GROUP BY 1),
n0 AS (SELECT hcol.table_id, hcol.col_idx, promoted, CASE WHEN promoted THEN coalesce(c.v, '') WHEN h = '' OR contains(h, 'Unnamed') THEN '' ELSE h END AS name
  FROM hcol JOIN h1 USING (table_id) LEFT JOIN cells c ON c.table_id = hcol.table_id AND c.col_idx = hcol.col_idx AND c.row_idx = 0),
firsts AS (SELECT n0.table_id, n0.col_idx, name, promoted, CASE WHEN p.number < p.filled THEN c.v END AS txt
  FROM n0 JOIN profile p USING (table_id, col_idx) LEFT JOIN cells c ON c.table_id = n0.table_id AND c.col_idx = n0.col_idx AND c.row_idx = CAST(promoted AS INT)),
subs AS (SELECT table_id, coalesce(string_agg(txt, ' ' ORDER BY col_idx), '') AS sub FROM firsts GROUP BY 1),
mis AS (SELECT table_id, {_COUNT} >= 2 AS misplaced FROM (SELECT *, {_STEPS} FROM subs)),
n1 AS (SELECT f.table_id, col_idx, promoted, misplaced, CAST(promoted AS INT) + CAST(misplaced AS INT) AS skip,
  CASE WHEN misplaced THEN trim(name || coalesce(' ' || txt, '')) ELSE name END AS raw_name FROM firsts f JOIN mis USING (table_id)),
n2 AS (SELECT *, trim(regexp_replace(replace(raw_name, '*', ''), '\\s+', ' ', 'g')) AS name FROM n1),
st AS (SELECT f.table_id, f.col_idx, count(*) AS n, count(v) AS filled, count_if(is_num) AS num, count(mny) AS mon, coalesce(sum(mny), 0) AS msum,
  count_if({_LAY}) AS lay, count_if({_LAY_WIDE}) AS layw, count_if(v IS NOT NULL AND nxt IS NOT NULL) AS both_filled,
  count_if(regexp_matches(v, '(?i)Preferred|Common|Series')) AS sec
  FROM facts0 f JOIN (SELECT DISTINCT table_id, skip FROM n2) USING (table_id) WHERE row_idx >= skip GROUP BY ALL),
full_cols AS (SELECT n2.*, st.n, st.filled, st.num, st.mon, st.msum, st.lay, st.layw, st.both_filled, st.sec FROM n2 JOIN st USING (table_id, col_idx)),
t1 AS (SELECT table_id, any_value(promoted) AS promoted, any_value(misplaced) AS misplaced, any_value(skip) AS skip, max(n) + any_value(skip) AS n_rows,
  count(*) AS width, count(*) - count(DISTINCT raw_name) AS repeated, bool_or(lay > 0) AS layered,
  bool_or(col_idx = 0 AND num > 2) AS num0, bool_or(col_idx = 1 AND num > 2) AS num1,
  bool_or(col_idx = 0 AND (n - filled) / n > 0.5 AND n - filled > 3) AS empty0, bool_or(col_idx = 1 AND (n - filled) / n > 0.5 AND n - filled > 3) AS empty1,
  bool_or(col_idx = 0 AND contains(lower(name), 'company')) AS comp0, bool_or(col_idx = 1 AND contains(lower(name), 'company')) AS comp1
  FROM full_cols GROUP BY 1),
t2 AS (SELECT *, num0 OR (NOT layered AND empty0 AND NOT comp0) AS strip0, num1 OR (NOT layered AND empty1 AND NOT comp1) AS strip1 FROM t1),
t3 AS (SELECT *, CASE WHEN strip0 AND strip1 THEN 2 WHEN strip0 THEN 1 ELSE 0 END AS first_col, CASE WHEN strip0 THEN comp1 ELSE comp0 END AS comp FROM t2),
t4 AS (SELECT t3.*, both_filled = 0 AND NOT comp AS merged FROM t3 JOIN full_cols f ON f.table_id = t3.table_id AND f.col_idx = first_col),
k1 AS (SELECT f.table_id, col_idx, CAST(row_number() OVER (PARTITION BY f.table_id ORDER BY col_idx) - 1 AS INT) AS place, name, filled, num, mon, msum, layw, sec, merged
  FROM full_cols f JOIN t4 USING (table_id) WHERE col_idx = first_col OR col_idx > first_col + CAST(merged AS INT)),
all_cols AS (SELECT k1.table_id, k1.col_idx, place, CASE WHEN k1.name = '' THEN 'Unnamed: ' || place ELSE k1.name END AS name,
  k1.filled + CASE WHEN fold THEN o.filled ELSE 0 END AS filled, k1.num + CASE WHEN fold THEN o.num ELSE 0 END AS num, k1.mon + CASE WHEN fold THEN o.mon ELSE 0 END AS mon,
  k1.msum + CASE WHEN fold THEN o.msum ELSE 0 END AS msum, k1.layw + CASE WHEN fold THEN o.layw ELSE 0 END AS layw, k1.sec + CASE WHEN fold THEN o.sec ELSE 0 END AS sec
  FROM (SELECT *, merged AND place = 0 AS fold FROM k1) k1 LEFT JOIN full_cols o ON o.table_id = k1.table_id AND o.col_idx = k1.col_idx + 1),
tab AS (SELECT t4.*, n_rows < 4 OR digits OR repeated > 1 OR t4.width - first_col < 3 OR contains(lower(c.name), 'summary of') AS invalid
  FROM t4 JOIN h1 USING (table_id) JOIN all_cols c ON c.table_id = t4.table_id AND c.place = 0),
cols AS (SELECT a.* FROM all_cols a JOIN tab USING (table_id) WHERE NOT invalid)"""


def name_test(rule, name: str = "name") -> str:
    low = [p.lower().replace("'", "''") for p in rule.patterns]
    if rule.method == "Contain":
        test = f"regexp_matches(lower({name}), '{'|'.join(low)}')"
    elif rule.regex:
        return f"regexp_full_match(lower({name}), '{'|'.join(low)}')"
    else:
        test = f"lower({name}) IN (" + ", ".join(f"'{p}'" for p in low) + ")"
    if rule.exclude and not rule.regex:
        test += f" AND NOT regexp_matches(lower({name}), '{'|'.join(e.lower() for e in rule.exclude)}')"
    return f"({test})"


def _greedy() -> str:
    """One relation of remaining columns per metric; matches are settled per rule and the first rule wins."""
    parts = ["left_0 AS (SELECT * FROM cols)"]
    for i, m in enumerate(DEFAULT_RULES.metrics):
        if m.position is not None:
            parts.append(f"ch_{i} AS (SELECT table_id, col_idx, name, 'P1' AS rule, 1 AS n FROM (SELECT *, row_number() OVER "
                         f"(PARTITION BY table_id ORDER BY place) AS q FROM left_{i}) WHERE q = {m.position + 1})")
        else:
            turns = ([(r, "P1") for r in m.rules if not r.on_values and r.priority == 1]
                     + [(r, "P1") for r in m.rules if r.on_values]
                     + [(r, "P2") for r in m.rules if not r.on_values and r.priority == 2])
            hits = []
            for t, (r, label) in enumerate(turns):
                test = f"sec >= {r.threshold}" if r.on_values else name_test(r)
                found = (f"SELECT *, count(*) OVER w AS c, max(place) OVER w AS last_place, max(mon) OVER w AS top, max(msum) OVER w AS best, "
                         f"'{label}' AS rule, {t} AS turn FROM left_{i} WHERE {test} WINDOW w AS (PARTITION BY table_id)")
                if r.on_values:
                    keep = "c = 1"
                elif r.conflict == "KeepLast":
                    keep = "place = last_place"
                elif r.conflict == "KeepMost":
                    found = f"SELECT *, count(*) FILTER (mon = top) OVER (PARTITION BY table_id) AS tops, min(CASE WHEN msum = best THEN place END) OVER (PARTITION BY table_id) AS by_sum FROM ({found})"
                    keep = "CASE WHEN tops = 1 THEN mon = top ELSE place = by_sum END"
                else:
                    keep = "true"
                hits.append(f"SELECT table_id, col_idx, name, rule, turn FROM ({found}) WHERE {keep}")
            parts.append(f"ch_{i} AS (SELECT table_id, col_idx, name, rule, (SELECT count(*) FROM left_{i} l WHERE l.table_id = x.table_id AND l.name = x.name) "
                         f"+ count(*) OVER (PARTITION BY table_id) - 1 AS n FROM (SELECT *, min(turn) OVER (PARTITION BY table_id) AS first_turn FROM ("
                         + " UNION ALL ".join(hits) + ")) x WHERE turn = first_turn)")
        parts.append(f"er_{i} AS (SELECT DISTINCT table_id, CASE rule WHEN 'P1' THEN 'ERR-ID1002' ELSE 'WRN-ID2003' END AS code, '{m.name}' AS detail FROM ch_{i} WHERE n > 1)")
        parts.append(f"left_{i + 1} AS (SELECT * FROM left_{i} l WHERE table_id NOT IN (SELECT table_id FROM er_{i}) "
                     f"AND NOT EXISTS (SELECT 1 FROM ch_{i} c WHERE c.table_id = l.table_id AND c.name = l.name))")
    n = len(DEFAULT_RULES.metrics)
    taken = " UNION ALL ".join(f"SELECT table_id, {i} AS ord, '{m.name}' AS target, col_idx, name AS src, rule FROM ch_{i} WHERE n = 1"
                               for i, m in enumerate(DEFAULT_RULES.metrics))
    failed = " UNION ALL ".join(f"SELECT * FROM er_{i}" for i in range(n))
    return ",\n".join([*parts, f"taken AS ({taken})", f"clash AS ({failed})"])


LINEAGE = f"""{_greedy()},
verdict0 AS (SELECT tab.*, CASE WHEN invalid THEN 'WRN-ID2002' ELSE clash.code END AS code0, clash.detail,
  (SELECT count(*) FROM taken k WHERE k.table_id = tab.table_id) AS n_taken,
  EXISTS (SELECT 1 FROM taken k WHERE k.table_id = tab.table_id AND target = 'security_type') AS has_security,
  EXISTS (SELECT 1 FROM taken k WHERE k.table_id = tab.table_id AND target = 'ownership') AS has_ownership,
  EXISTS (SELECT 1 FROM taken k JOIN cols c USING (table_id, col_idx) WHERE k.table_id = tab.table_id AND layw > 0) AS wide,
  (SELECT max(CAST(num < filled AS INT)) FROM taken k JOIN cols c USING (table_id, col_idx) WHERE k.table_id = tab.table_id AND target = 'company_name') = 1 AS company_text
  FROM tab LEFT JOIN clash USING (table_id)),
verdict AS (SELECT * EXCLUDE (code0), CASE WHEN code0 IS NOT NULL THEN code0 WHEN n_taken < 3 THEN 'WRN-ID2002'
  WHEN NOT has_security AND NOT coalesce(company_text, false) THEN 'WRN-ID2002' END AS code, wide AND NOT has_security AS hidden FROM verdict0),
lineage AS (SELECT k.table_id, target, col_idx, src, rule FROM taken k JOIN verdict USING (table_id) WHERE code IS NULL)"""

METRICS = DEFAULT_RULES.names()
METRIC_ROWS = f"""
picked AS (SELECT c.table_id, c.row_idx - skip AS row_idx, target, CASE WHEN merged AND l.col_idx = first_col THEN coalesce(c.nxt, c.v) ELSE c.v END AS v
  FROM lineage l JOIN verdict USING (table_id) JOIN cells c ON c.table_id = l.table_id AND c.col_idx = l.col_idx WHERE c.row_idx >= skip),
metric_rows AS (SELECT table_id, CAST(row_idx AS INT) AS row_idx, {', '.join(f"max(CASE WHEN target = '{m}' THEN v END) AS {m}" for m in METRICS)}
  FROM picked GROUP BY ALL)"""


def hidden_sql(source: str, metrics: tuple[str, ...], out: str) -> str:
    filled = " + ".join(f"CAST({m} IS NOT NULL AS INT)" for m in metrics)
    return f"""{out}_a AS (SELECT *, {filled} AS n_filled FROM {source}),
{out}_b AS (SELECT *, coalesce(last_value(CASE WHEN n_filled = 1 THEN first WHEN company_name IS NULL THEN '' END IGNORE NULLS)
  OVER (PARTITION BY table_id ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent FROM {out}_a),
{out} AS (SELECT * REPLACE (CASE WHEN NOT apply THEN security_type WHEN NOT contains(lower(coalesce(company_name, '')), 'total') THEN coalesce(company_name, '') END AS security_type,
  CASE WHEN NOT apply THEN company_name WHEN contains(lower(coalesce(company_name, '')), 'total') THEN company_name WHEN company_name IS NULL THEN '' ELSE parent END AS company_name)
  FROM {out}_b WHERE NOT apply OR (n_filled <> 1 AND parent <> ''))"""


def fill_sql(source: str, out: str) -> str:
    return f"""{out}_a AS (SELECT *, coalesce(company_name, '') AS nm, coalesce(security_type, '') AS sc FROM {source}),
{out}_b AS (SELECT *, sum(CASE WHEN sc <> '' AND length(nm) < 2 THEN 0 ELSE 1 END) OVER (PARTITION BY table_id ORDER BY row_idx ROWS UNBOUNDED PRECEDING) AS grp FROM {out}_a),
{out}_g AS (SELECT table_id, grp, max(row_idx) AS lst, min(row_idx) AS fst FROM {out}_b GROUP BY ALL),
{out}_n AS (SELECT b.table_id, b.grp, any_value(fst) AS fst, any_value(lst) AS lst,
  coalesce(string_agg(nm, '' ORDER BY row_idx) FILTER (row_idx < lst), '') || ' ' || max(CASE WHEN row_idx = lst THEN nm END) AS joined
  FROM {out}_b b JOIN {out}_g g ON b.table_id = g.table_id AND b.grp = g.grp GROUP BY ALL),
{out}_e AS (SELECT table_id, max(row_idx) AS eot FROM {out}_b GROUP BY 1),
{out} AS (SELECT b.* REPLACE (CASE WHEN NOT apply THEN company_name WHEN fst = lst AND lst = eot THEN nm ELSE trim(joined) END AS company_name,
  CASE WHEN apply THEN sc ELSE security_type END AS security_type)
  FROM {out}_b b JOIN {out}_n n ON b.table_id = n.table_id AND b.grp = n.grp JOIN {out}_e e ON e.table_id = b.table_id)"""


def subtotal_sql(source: str, out: str) -> str:
    return f"""{out}_a AS (SELECT *, coalesce(security_type, '') AS s0, coalesce(lag(coalesce(security_type, ''), 1) OVER w, '') AS s1, coalesce(lag(coalesce(security_type, ''), 2) OVER w, '') AS s2,
  lag(company_name) OVER w AS before_name, lead(company_name) OVER w AS next_name, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY table_id) AS total_rows
  FROM {source} WINDOW w AS (PARTITION BY table_id ORDER BY row_idx)),
{out}_b AS (SELECT *, coalesce(apply AND company_name = '' AND length(next_name) > 4 AND NOT contains(lower(next_name), 'total')
  AND ((i <= total_rows - 4 AND s0 = '') OR (i = total_rows - 3 AND (s1 <> '' OR s0 = '')) OR (i = total_rows - 2 AND s1 <> '' AND s2 <> '')), false) AS is_total FROM {out}_a),
{out} AS (SELECT * REPLACE (CASE WHEN is_total THEN CASE WHEN s1 <> '' THEN before_name ELSE '' END ELSE company_name END AS company_name) FROM {out}_b)"""


_FIRST = "CASE WHEN has_ownership THEN ownership ELSE company_name END"
_PARSED = ", ".join(f"{percent(m) if m in PERCENT_METRICS else money(m)} AS {m}" for m in NUMBER_METRICS)
ROW_STEPS = f"""
step0 AS (SELECT m.*, has_security, has_ownership, hidden AS apply, {_FIRST} AS first, has_security OR hidden AS with_security FROM metric_rows m JOIN verdict USING (table_id)),
{hidden_sql('step0', tuple(METRICS), 'step1')},
step1x AS (SELECT * EXCLUDE (n_filled, parent) REPLACE (has_security AS apply) FROM step1),
{fill_sql('step1x', 'step2')},
step2x AS (SELECT * EXCLUDE (nm, sc, grp) REPLACE (with_security AS apply) FROM step2),
{subtotal_sql('step2x', 'step3')},
step4 AS (SELECT * REPLACE (is_total OR (with_security AND has_ownership AND nullif(security_type, '') IS NULL AND nullif(ownership, '') IS NOT NULL) AS is_total) FROM step3),
step5 AS (SELECT table_id, row_idx, nullif(company_name, '') AS company_name, nullif(security_type, '') AS security_type, nullif(investment_date, '') AS investment_date, {_PARSED}, is_total FROM step4),
step6 AS (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY row_idx DESC) AS from_end,
  company_name IS NULL OR trim(lower(company_name)) IN ('total', '', 'totals') OR regexp_matches(lower(company_name), 'total investments|total portfolio investments|total portfolio|total unrealized \\+|total fund') AS tn
  FROM step5 WHERE coalesce({', '.join(NUMBER_METRICS)}) IS NOT NULL),
step7 AS (SELECT * REPLACE (is_total OR coalesce(tn AND (from_end = 1 OR (from_end = 2 AND NOT lag(tn) OVER (PARTITION BY table_id ORDER BY from_end))), false) AS is_total) FROM step6),
step8 AS (SELECT * FROM step7 WHERE is_total OR NOT (company_name IS NULL OR regexp_matches(company_name, '(?i)Total|Realized')))"""

FACTS = """
v1 AS (SELECT * EXCLUDE (from_end, tn), (total IS NULL)::INT + (realized_value IS NULL)::INT + (unrealized_value IS NULL)::INT AS n1 FROM step8),
v2 AS (SELECT * REPLACE (CASE WHEN n1 = 1 AND total IS NULL THEN realized_value + unrealized_value ELSE total END AS total,
    CASE WHEN n1 = 1 AND realized_value IS NULL THEN total - unrealized_value ELSE realized_value END AS realized_value,
    CASE WHEN n1 = 1 AND unrealized_value IS NULL THEN total - realized_value ELSE unrealized_value END AS unrealized_value),
  CASE WHEN n1 = 0 THEN total = realized_value + unrealized_value END AS ok1,
  CASE WHEN n1 = 1 AND total IS NULL THEN 'total' WHEN n1 = 1 AND realized_value IS NULL THEN 'realized_value' WHEN n1 = 1 THEN 'unrealized_value' END AS f1 FROM v1),
v3 AS (SELECT *, (total IS NULL)::INT + (total_cost IS NULL)::INT + (gross_moic IS NULL)::INT AS n2 FROM v2),
facts AS (SELECT * REPLACE (CASE WHEN n2 = 1 AND total IS NULL THEN gross_moic * total_cost ELSE total END AS total,
    CASE WHEN n2 = 1 AND total_cost IS NULL THEN total / nullif(gross_moic, 0) ELSE total_cost END AS total_cost,
    CASE WHEN n2 = 1 AND gross_moic IS NULL THEN total / nullif(total_cost, 0) ELSE gross_moic END AS gross_moic),
  CASE WHEN n2 = 0 THEN coalesce(ok1, false) AND coalesce(gross_moic = total / nullif(total_cost, 0), false) ELSE ok1 END AS is_validated,
  concat_ws(',', f1, CASE WHEN n2 = 1 AND total IS NULL THEN 'total' WHEN n2 = 1 AND total_cost IS NULL THEN 'total_cost' WHEN n2 = 1 THEN 'gross_moic' END) AS filled FROM v3)"""


def header_metrics_sql(source: str) -> str:
    steps, count = _chain("lower(title)")
    return f"SELECT p_partkey, metrics, metrics >= 2 AS misplaced FROM (SELECT p_partkey, {count} AS metrics FROM (SELECT *, {steps} FROM {source}))"


def rule_tests_sql(source: str) -> str:
    tests = ", ".join(f"{name_test(r, 'title')} AS {m.name}_{i}" for m in DEFAULT_RULES.metrics
                      for i, r in enumerate(m.rules) if not r.on_values)
    return f"SELECT p_partkey, {tests} FROM (SELECT p_partkey, trim(regexp_replace(replace(title, '*', ''), '\\s+', ' ', 'g')) AS title FROM {source})"

"""SQL counterparts of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

VISITS = """
visits AS (
  SELECT CAST(o_orderdate AS DATE) AS d,
    lpad(CAST(CASE WHEN c_acctbal < 0 THEN c_nationkey + 100 ELSE c_nationkey END AS VARCHAR), 5, '0') AS up,
    o_orderstatus AS place, c_mktsegment AS situation, o_orderpriority AS service,
    upper(coalesce(nullif(trim(CASE o_custkey % 8 WHEN 0 THEN 'C9C' WHEN 1 THEN ' c9r' WHEN 2 THEN 'CALTRE'
      WHEN 3 THEN 'D9D' WHEN 4 THEN 'dalTre ' WHEN 5 THEN '9T' WHEN 6 THEN '' END), ''), 'NA')) AS class
  FROM orders JOIN customer ON o_custkey = c_custkey),
classed AS (
  SELECT *, CASE WHEN class IN ('C9C', 'C9R', 'CALTRE') THEN 'PRESENCIAL'
    WHEN class IN ('D9D', 'DALTRE') THEN 'DOMICILIARIA' WHEN class = '9T' THEN 'TELEFONICA' ELSE 'NA' END AS grp
  FROM visits),
lk AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS lup, upper(r_name) AS rs
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

NAMES = """
named AS (
  SELECT d, up, 'DEMAND__VISI_LLOC_VISITA__' || place AS name FROM classed
  UNION ALL SELECT d, up, 'DEMAND__VISI_SITUACIO_VISITA__' || situation FROM classed
  UNION ALL SELECT d, up, 'DEMAND__SERVEI_CODI__' || service FROM classed
  UNION ALL SELECT d, up, 'DEMAND__TIPUS_CLASS__' || class FROM classed
  UNION ALL SELECT d, up, 'DEMAND__TIPUS_VISITA_AGRUPAT__' || grp FROM classed
  UNION ALL SELECT d, up, 'DEMAND__TOTAL' FROM classed),
vregion AS (
  SELECT d, name || '__RS__' || coalesce(rs, 'RS:SENSEESPECIFICAR_SE') AS name
  FROM named LEFT JOIN lk ON up = lup),
vplace AS (SELECT d, name || '__UP__' || up AS name FROM named),
vregion_chosen AS (
  SELECT d, name || '__RS__RS_' || r_regionkey AS name
  FROM named JOIN lk ON up = lup JOIN region ON rs = upper(r_name) WHERE r_name LIKE 'A%'),
vplace_chosen AS (
  SELECT d, name || '__UP__MICRO_' || n_nationkey AS name
  FROM named JOIN nation ON up = lpad(CAST(n_nationkey AS VARCHAR), 5, '0') WHERE n_regionkey = 0)"""

CODED = """
coded AS (
  SELECT CAST(l_shipdate AS DATE) AS d,
    lpad(CAST(CASE WHEN s_acctbal < 0 THEN s_nationkey + 100 ELSE s_nationkey END AS VARCHAR), 5, '0') AS up,
    chr(CAST(65 + l_partkey % 26 AS INTEGER)) || lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') AS code
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
groups(lo, hi, alias) AS (VALUES
  ('J00', 'J06', 'G01'), ('J09', 'J18', 'G_01'), ('A00', 'A09', 'G03'), ('F30', 'F49', 'G04'),
  ('M00', 'N99', 'G05'), ('J00', 'J00', 'D01'), ('A09', 'A09', 'D04'), ('U07', 'U07', 'U07'))"""

CODED_NAMES = """
cnamed AS (
  SELECT d, up, 'DIAGNOSIS__TOTAL' AS name FROM coded
  UNION ALL SELECT d, up, 'DIAGNOSIS__ICD10_3__' || alias FROM coded JOIN groups ON code BETWEEN lo AND hi),
cregion AS (
  SELECT d, name || '__RS__' || coalesce(rs, 'UNKNOWN') AS name FROM cnamed LEFT JOIN lk ON up = lup),
cplace AS (SELECT d, name || '__UP__' || up AS name FROM cnamed),
cregion_chosen AS (
  SELECT d, name || '__RS__RS_' || r_regionkey AS name
  FROM cnamed JOIN lk ON up = lup JOIN region ON rs = upper(r_name) WHERE r_name LIKE 'A%'),
cplace_chosen AS (
  SELECT d, name || '__UP__MICRO_' || n_nationkey AS name
  FROM cnamed JOIN nation ON up = lpad(CAST(n_nationkey AS VARCHAR), 5, '0') WHERE n_regionkey = 0)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _counts(*sources: str, where: str = "TRUE") -> str:
    """Daily counts of named rows."""
    union = " UNION ALL ".join(f"SELECT d, name FROM {s}" for s in sources)
    return (
        f"SELECT CAST(d AS VARCHAR) AS day, name AS feature, CAST(count(*) AS BIGINT) AS value "
        f"FROM ({union}) AS u WHERE {where} GROUP BY d, name"
    )


def _long(name: str, *sources: str) -> str:
    union = " UNION ALL ".join(f"SELECT d, name FROM {s}" for s in sources)
    return (
        f"{name} AS (SELECT d, name, CAST(count(*) AS DOUBLE) AS v FROM ({union}) AS u GROUP BY d, name)"
    )


def _estimates(long: str, out: str, last: str, target: str) -> str:
    """Observed days up to ``last`` and estimates up to ``target``, dense."""
    return f"""
{out}_real AS (SELECT * FROM {long} WHERE d <= {last}),
{out}_obs AS (SELECT DISTINCT d FROM {out}_real),
{out}_miss AS (
  SELECT d FROM (SELECT CAST(unnest(generate_series(
      (SELECT min(d) FROM {out}_obs), CAST({target} AS DATE), INTERVAL 1 DAY)) AS DATE) AS d) AS c
  WHERE d NOT IN (SELECT d FROM {out}_obs)),
{out}_hist AS (
  SELECT m.d AS d, o.d AS past FROM {out}_miss AS m JOIN {out}_obs AS o
  ON month(m.d) = month(o.d) AND day(m.d) = day(o.d) AND o.d < m.d),
{out}_k AS (
  SELECT m.d AS d, count(past) AS k FROM {out}_miss AS m LEFT JOIN {out}_hist AS h ON m.d = h.d GROUP BY m.d),
{out}_fb AS (
  SELECT name, sum(v) / (SELECT count(*) FROM {out}_obs) AS v FROM {out}_real GROUP BY name),
{out}_hs AS (
  SELECT h.d AS d, name, sum(v) AS v FROM {out}_hist AS h JOIN {out}_real AS r ON h.past = r.d GROUP BY h.d, name),
{out} AS (
  SELECT d, name, v FROM {out}_real
  UNION ALL
  SELECT k.d, f.name, CASE WHEN k.k > 0 THEN coalesce(hs.v, 0) / k.k ELSE f.v END
  FROM {out}_k AS k CROSS JOIN {out}_fb AS f LEFT JOIN {out}_hs AS hs ON hs.d = k.d AND hs.name = f.name
  WHERE CASE WHEN k.k > 0 THEN coalesce(hs.v, 0) / k.k ELSE f.v END <> 0)"""


VISIT_LEVELS = _long("vlong", "named", "vregion")
CODED_LEVELS = _long("clong", "cnamed", "cregion")
BASE_V = (VISITS, NAMES, VISIT_LEVELS)
BASE_VC = (VISITS, NAMES, VISIT_LEVELS, CODED, CODED_NAMES, CODED_LEVELS)
IMPUTED = _estimates("vlong", "vimp", "DATE '9999-12-31'", "DATE '2001-12-31'")
DAY_TABLE = """
vdays AS (SELECT d, FALSE AS imp FROM vimp_obs UNION ALL SELECT d, TRUE FROM vimp_miss),
cdays AS (SELECT DISTINCT d FROM clong)"""


def _values(source: str, where: str = "TRUE") -> str:
    return (
        f"SELECT CAST(d AS VARCHAR) AS day, name AS feature, round(v, 6) AS value FROM {source} WHERE {where}"
    )


def _fill(long: str, out: str, method: str) -> str:
    """Days of ``long`` filled over ``alldays``, one dense series per feature."""
    dense = f"""
{out}_days AS (SELECT DISTINCT d AS pd FROM {long}),
{out}_grid AS (
  SELECT a.d AS d, f.name AS name, a.pos AS pos,
    CASE WHEN p.pd IS NOT NULL THEN coalesce(l.v, 0) END AS v
  FROM alldays AS a CROSS JOIN (SELECT DISTINCT name FROM {long}) AS f
  LEFT JOIN {out}_days AS p ON p.pd = a.d LEFT JOIN {long} AS l ON l.d = a.d AND l.name = f.name)"""
    before = "OVER (PARTITION BY name ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = "OVER (PARTITION BY name ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    if method == "ffill":
        value = f"last_value(v IGNORE NULLS) {before}"
    elif method == "bfill":
        value = f"first_value(v IGNORE NULLS) {after}"
    elif method == "none":
        value = "v"
    else:
        return dense + f""",
{out}_ends AS (
  SELECT d, name, pos, v,
    last_value(v IGNORE NULLS) {before} AS lv,
    last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) {before} AS lp,
    first_value(v IGNORE NULLS) {after} AS rv,
    first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) {after} AS rp
  FROM {out}_grid),
{out} AS (
  SELECT d, name, CASE WHEN v IS NOT NULL THEN v WHEN rp IS NULL THEN lv
    ELSE lv + (rv - lv) * (pos - lp) / (rp - lp) END AS v FROM {out}_ends)"""
    return dense + f",\n{out} AS (SELECT d, name, {value} AS v FROM {out}_grid)"


ALL_DAYS = """
alldays AS (
  SELECT d, row_number() OVER (ORDER BY d) AS pos
  FROM (SELECT d FROM vlong UNION SELECT d FROM clong) AS u)"""


def _joined(method: str, until: str = "DATE '2002-01-01'") -> str:
    return (
        _with(*BASE_VC, ALL_DAYS, _fill("vlong", "vf", method), _fill("clong", "cf", method))
        + "SELECT CAST(d AS VARCHAR) AS day, name AS feature, round(v, 6) AS value FROM "
        + f"(SELECT * FROM vf UNION ALL SELECT * FROM cf) AS u WHERE v <> 0 AND d <= {until}"
    )


SPECS = """
specs AS (
  SELECT p_partkey, p_brand,
    chr(CAST(65 + p_partkey % 26 AS INTEGER)) || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') AS low,
    p_partkey % 5 AS kind,
    ascii(chr(CAST(65 + p_partkey % 26 AS INTEGER))) * 100 + p_partkey % 100 AS lo,
    ascii(chr(CAST(65 + (p_partkey * 7) % 26 AS INTEGER))) * 100
      + CASE WHEN p_size % 30 < 10 THEN (p_size % 30) * 10 + 9 ELSE p_size % 30 END AS hi
  FROM part),
codes AS (
  SELECT p_partkey, p_brand, low AS code, low AS first FROM specs WHERE kind IN (0, 1)
  UNION ALL
  SELECT p_partkey, p_brand, chr(CAST(p // 100 AS INTEGER)) || lpad(CAST(p % 100 AS VARCHAR), 2, '0'), low
  FROM (SELECT *, unnest(generate_series(lo, hi)) AS p FROM specs WHERE kind > 1 AND lo <= hi) AS s)"""

GAPPY = """
series AS (
  SELECT l_linenumber, d, CASE WHEN n % 3 <> 0 THEN CAST(n AS DOUBLE) END AS v,
    row_number() OVER (PARTITION BY l_linenumber ORDER BY d) AS pos
  FROM (SELECT l_linenumber, CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY ALL) AS q)"""
BEFORE = "OVER (PARTITION BY l_linenumber ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
AFTER = "OVER (PARTITION BY l_linenumber ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _gappy(value: str) -> str:
    return (
        f"WITH {GAPPY}, s AS (SELECT *, last_value(v IGNORE NULLS) {BEFORE} AS lv, "
        f"first_value(v IGNORE NULLS) {AFTER} AS rv, "
        f"last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) {BEFORE} AS lp, "
        f"first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) {AFTER} AS rp FROM series) "
        f"SELECT l_linenumber, CAST(d AS VARCHAR) AS day, round(coalesce({value}, -1), 6) AS value FROM s"
    )


CONTIGUOUS = """
days AS (SELECT DISTINCT d FROM visits),
contig AS (SELECT min(d) AS last FROM days WHERE d + 1 NOT IN (SELECT d FROM days))"""

IDENTIFIED = """
counted AS (SELECT d, up, code, CAST(count(*) AS BIGINT) AS n FROM coded GROUP BY d, up, code)"""

TOTALS = """
SELECT CAST(d AS VARCHAR) AS day, 'DEMAND__TOTAL' AS feature, CAST(count(*) AS DOUBLE) AS value FROM visits GROUP BY d"""

#: Every category of the visit tables and the column of ``classed`` that holds it.
CATEGORIES = {
    ("VISI_LLOC_VISITA", "place"): ("F", "O", "P"),
    ("VISI_SITUACIO_VISITA", "situation"): ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    ("SERVEI_CODI", "service"): ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    ("TIPUS_CLASS", "class"): ("C9C", "C9R", "CALTRE", "D9D", "DALTRE", "9T", "NA"),
    ("TIPUS_VISITA_AGRUPAT", "grp"): ("PRESENCIAL", "DOMICILIARIA", "TELEFONICA", "NA"),
}


def _wide(kind: str, day: str) -> str:
    """One row per day with a column per visit category."""
    cells = [
        f"CAST(count(CASE WHEN {column} = '{c}' THEN 1 END) AS {kind}) AS \"DEMAND__{variable}__{c}\""
        for (variable, column), values in CATEGORIES.items()
        for c in values
    ]
    total = f"CAST(count(*) AS {kind}) AS DEMAND__TOTAL"
    return f"SELECT CAST(d AS VARCHAR) AS {day}, {', '.join([total, *cells])} FROM classed GROUP BY d"


ORACLES: dict[str, str] = {
    "source_range_scan": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01' AND o_orderdate > DATE '1996-03-01'""",
    "source_date_bounds": """
SELECT CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS min_date, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS max_date
FROM lineitem WHERE l_shipdate >= DATE '1995-03-01' AND l_shipdate < DATE '2001-07-01'""",
    "source_day_code_counts": _with(CODED)
    + "SELECT CAST(d AS VARCHAR) AS day, up, code, CAST(count(*) AS BIGINT) AS n FROM coded GROUP BY d, up, code",
    "prepared_fact": _with(VISITS)
    + """SELECT CAST(d AS VARCHAR) AS day, up, place AS VISI_LLOC_VISITA, situation AS VISI_SITUACIO_VISITA,
  service AS SERVEI_CODI, class AS TIPUS_CLASS, grp AS TIPUS_VISITA_AGRUPAT, CAST(1 AS BIGINT) AS counts,
  coalesce(rs, 'RS:SENSEESPECIFICAR_SE') AS rs FROM classed LEFT JOIN lk ON up = lup""",
    "class_grouping": _with(VISITS)
    + """SELECT class AS TIPUS_CLASS, grp AS TIPUS_VISITA_AGRUPAT, CAST(count(*) AS BIGINT) AS num_rows
FROM classed GROUP BY class, grp""",
    "lenient_dates": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS num_rows,
  sum(TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE)) AS amount
FROM events WHERE event_type <> 'error' GROUP BY CAST(ts AS DATE)""",
    "unknown_facility_counts": _with(VISITS)
    + """SELECT up, CAST(count(*) AS BIGINT) AS num_rows FROM visits
WHERE up NOT IN (SELECT lup FROM lk) GROUP BY up""",
    "unknown_facility_summary": _with(VISITS)
    + """SELECT CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(CASE WHEN up NOT IN (SELECT lup FROM lk) THEN 1 END) AS BIGINT) AS unknown_rows,
  CAST(count(DISTINCT CASE WHEN up NOT IN (SELECT lup FROM lk) THEN up END) AS BIGINT) AS unknown_facilities,
  (SELECT string_agg(up, ',' ORDER BY up) FROM (SELECT DISTINCT up FROM visits
    WHERE up NOT IN (SELECT lup FROM lk) ORDER BY up LIMIT 10) AS t) AS examples
FROM visits""",
    "region_totals": _with(VISITS)
    + """SELECT coalesce(rs, 'UNKNOWN') AS rs, CAST(count(*) AS BIGINT) AS num_rows
FROM visits LEFT JOIN lk ON up = lup GROUP BY coalesce(rs, 'UNKNOWN')""",
    "duplicate_lookup_rows": """
SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS up, CAST(count(*) AS BIGINT) AS n
FROM supplier GROUP BY s_nationkey HAVING count(*) > 1""",
    "geo_labels": """
SELECT CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE c_mktsegment END AS region_label,
  CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' WHEN c_custkey > 99999 THEN CAST(c_custkey AS VARCHAR)
    ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS facility_label,
  CAST(count(*) AS BIGINT) AS num_rows FROM customer GROUP BY ALL""",
    "daily_total": _with(VISITS, NAMES) + _counts("named", where="name = 'DEMAND__TOTAL'"),
    "daily_features_global": _with(VISITS, NAMES) + _counts("named", where="name <> 'DEMAND__TOTAL'"),
    "daily_features_by_region": _with(VISITS, NAMES) + _counts("vregion"),
    "daily_features_by_facility": _with(VISITS, NAMES) + _counts("vplace"),
    "daily_features_selected": _with(VISITS, NAMES)
    + _counts("named", "vregion_chosen", "vplace_chosen"),
    "rows_of_selected_regions": _with(VISITS)
    + """SELECT 'RS_' || r_regionkey AS rs, up, CAST(count(*) AS BIGINT) AS num_rows
FROM visits JOIN lk ON up = lup JOIN region ON rs = upper(r_name) WHERE r_name LIKE 'A%' GROUP BY ALL""",
    "code_range_expansion": _with(SPECS)
    + """SELECT p_partkey, CAST(count(*) AS BIGINT) AS num_codes, min(code) AS first_code, max(code) AS last_code
FROM codes GROUP BY p_partkey""",
    "code_alias_map": _with(SPECS)
    + "SELECT DISTINCT code, trim(upper(regexp_replace(p_brand, '[^0-9A-Za-z]+', '_', 'g')), '_') AS alias FROM codes",
    "coded_total": _with(VISITS, CODED, CODED_NAMES)
    + _counts("cnamed", where="name = 'DIAGNOSIS__TOTAL'"),
    "coded_total_by_geo": _with(VISITS, CODED, CODED_NAMES)
    + _counts("cregion_chosen", "cplace", where="name LIKE 'DIAGNOSIS!_!_TOTAL%' ESCAPE '!'"),
    "coded_alias_counts": _with(CODED)
    + """SELECT CAST(d AS VARCHAR) AS day, alias AS code, CAST(count(*) AS BIGINT) AS n
FROM coded JOIN groups ON code BETWEEN lo AND hi GROUP BY d, alias""",
    "coded_alias_features": _with(VISITS, CODED, CODED_NAMES)
    + _counts("cnamed", "cregion", "cplace", where="name LIKE 'DIAGNOSIS!_!_ICD10%' ESCAPE '!'"),
    "coded_selected_features": _with(VISITS, CODED, CODED_NAMES)
    + _counts("cnamed", "cregion_chosen", "cplace_chosen"),
    "coded_counts_by_region": _with(VISITS, CODED)
    + """SELECT CAST(d AS VARCHAR) AS day, coalesce(rs, 'UNKNOWN') AS rs, code, CAST(count(*) AS BIGINT) AS n
FROM coded LEFT JOIN lk ON up = lup GROUP BY ALL""",
    "wide_matrix": _with(VISITS) + _wide("BIGINT", "day"),
    "wide_to_long": _with(VISITS, NAMES, _long("glong", "named")) + _values("glong"),
    "feature_days": _with(VISITS, NAMES)
    + """SELECT name AS feature, CAST(count(DISTINCT d) AS BIGINT) AS num_days,
  (SELECT CAST(count(DISTINCT name) AS INTEGER) FROM named) AS num_features, TRUE AS refused FROM named GROUP BY name""",
    "combine_partials": _with(VISITS, CODED)
    + """, pieces AS (
  SELECT d, count(*) AS t, count(CASE WHEN place = 'F' THEN 1 END) AS f, 0 AS r FROM visits GROUP BY d
  UNION ALL SELECT d, sum(n), 0, count(CASE WHEN n > 1 THEN 1 END)
    FROM (SELECT d, up, code, count(*) AS n FROM coded GROUP BY d, up, code) AS q GROUP BY d
  UNION ALL SELECT d, count(*), 0, 0 FROM visits GROUP BY d)
SELECT CAST(d AS VARCHAR) AS day, CAST(sum(t) AS BIGINT) AS TOTAL, CAST(sum(f) AS BIGINT) AS F,
  CAST(sum(r) AS BIGINT) AS REPEATED FROM pieces GROUP BY d""",
    "assemble_pieces": _with(VISITS, CODED)
    + """SELECT CAST(d AS VARCHAR) AS day, 'ALL__TOTAL' AS feature, CAST(count(*) AS BIGINT) AS value
FROM (SELECT d FROM visits UNION ALL SELECT d FROM coded) AS u GROUP BY d""",
    "mixed_to_final": _with(VISITS, CODED)
    + """, m AS (
  SELECT d, 'DIAGNOSIS__TOTAL' AS name FROM coded
  UNION ALL SELECT d, 'DIAGNOSIS__ICD10_3__' || code FROM coded
  UNION ALL SELECT d, 'DIAGNOSIS__ICD10_3__' || code || '__RS__' || coalesce(rs, 'UNKNOWN')
    FROM coded LEFT JOIN lk ON up = lup
  UNION ALL SELECT d, 'DIAGNOSIS__ICD10_3__' || code || '__UP__' || up FROM coded)
SELECT CAST(d AS VARCHAR) AS day, name AS feature, CAST(count(*) AS DOUBLE) AS value FROM m GROUP BY d, name""",
    "canonical_names": _with(VISITS)
    + """, m AS (
  SELECT d, 'DEMAND__TOTAL' AS name FROM visits
  UNION ALL SELECT d, 'DEMAND__SERVEI_CODI__' || service FROM visits
  UNION ALL SELECT d, 'DEMAND__SERVEI_CODI__' || service || '__UP__' || CASE WHEN up = '00000' THEN 'UNKNOWN' ELSE up END FROM visits
  UNION ALL SELECT d, CASE WHEN rs = 'MIDDLE EAST' THEN 'DEMAND__SERVEI_CODI__' || service || '__RS__MIDDLE EAST'
    ELSE 'DEMAND__SERVEI_CODI__' || service || '__RS__' || coalesce(rs, 'UNKNOWN') END FROM visits LEFT JOIN lk ON up = lup
  UNION ALL SELECT d, 'DEMAND__TOTAL__RS__' || coalesce(rs, 'UNKNOWN') FROM visits LEFT JOIN lk ON up = lup)
SELECT CAST(d AS VARCHAR) AS day, name AS feature, CAST(count(*) AS BIGINT) AS value FROM m GROUP BY d, name""",
    "daily_grid": _with(VISITS)
    + """SELECT CAST(c.d AS VARCHAR) AS day, CAST(count(v.d) AS BIGINT) AS value
FROM (SELECT CAST(unnest(generate_series(DATE '1995-02-01', DATE '2001-09-30', INTERVAL 1 DAY)) AS DATE) AS d) AS c
LEFT JOIN visits AS v ON v.d = c.d GROUP BY c.d""",
    "last_contiguous_day": _with(VISITS, CONTIGUOUS)
    + "SELECT CAST(last AS VARCHAR) AS last_contiguous_day FROM contig",
    "last_observed_day": _with(VISITS)
    + "SELECT CAST(max(d) AS VARCHAR) AS last_observed_day FROM visits WHERE d <= DATE '2001-06-30'",
    "gap_days": _with(VISITS)
    + """SELECT CAST(d AS VARCHAR) AS day FROM
(SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d) AS c
WHERE d NOT IN (SELECT d FROM visits)""",
    "impute_missing_days": _with(*BASE_V, IMPUTED) + _values("vimp"),
    "impute_after_cut": _with(
        *BASE_V, _estimates("vlong", "vimp", "DATE '2000-06-30'", "DATE '2001-03-31'")
    )
    + _values("vimp"),
    "imputed_day_table": _with(*BASE_VC, IMPUTED, DAY_TABLE)
    + """SELECT CAST(d AS VARCHAR) AS day, imp AS __is_imputed,
  CASE WHEN imp THEN 'same_month_day_mean' ELSE '' END AS __imputation_method,
  CASE WHEN imp THEN CAST((SELECT max(d) FROM vimp_obs) AS VARCHAR) ELSE '' END AS __imputation_source_last_date,
  CASE WHEN imp THEN '2002-01-01T06:00:00' ELSE '' END AS __imputation_created_at FROM vdays""",
    "observed_part": _with(*BASE_V) + _values("vlong"),
    "drop_imputed_text_flags": _with(VISITS)
    + """SELECT CAST(d AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS value FROM visits GROUP BY d
HAVING NOT (count(*) > 1 AND day(d) % 6 IN (0, 2, 3))""",
    "imputation_summary": _with(*BASE_VC, IMPUTED, DAY_TABLE)
    + """, alld AS (SELECT d, imp FROM vdays UNION ALL SELECT d, FALSE FROM cdays WHERE d NOT IN (SELECT d FROM vdays))
SELECT 'DEMAND' AS dataset, 'DEMAND___is_imputed' AS imputed_column,
  CAST(count(CASE WHEN imp THEN 1 END) AS BIGINT) AS num_imputed_rows,
  CAST(count(CASE WHEN NOT imp THEN 1 END) AS BIGINT) AS num_observed_rows,
  CAST(min(CASE WHEN imp THEN d END) AS VARCHAR) AS first_imputed_date,
  CAST(max(CASE WHEN imp THEN d END) AS VARCHAR) AS last_imputed_date,
  coalesce(string_agg(CASE WHEN imp THEN CAST(d AS VARCHAR) END, ',' ORDER BY d), '') AS imputed_dates FROM alld
UNION ALL SELECT 'DIAGNOSIS', 'DIAGNOSIS___is_imputed', CAST(0 AS BIGINT), CAST(count(*) AS BIGINT), NULL, NULL, '' FROM alld""",
    "imputed_rows": _with(*BASE_VC, IMPUTED, DAY_TABLE)
    + """SELECT 'DEMAND' AS dataset, CAST(d AS VARCHAR) AS timestamp, TRUE AS is_imputed,
  'same_month_day_mean' AS imputation_method, CAST((SELECT max(d) FROM vimp_obs) AS VARCHAR) AS imputation_source_last_date,
  '2002-01-01T06:00:00' AS imputation_created_at FROM vdays WHERE imp""",
    "quality_report": _with(*BASE_VC, IMPUTED, DAY_TABLE)
    + """, alld AS (SELECT d, imp FROM vdays UNION ALL SELECT d, FALSE FROM cdays WHERE d NOT IN (SELECT d FROM vdays)),
late AS (SELECT CAST(count(*) AS BIGINT) AS n FROM alld WHERE d > DATE '2001-06-30')
SELECT 'DEMAND' AS dataset, CAST(count(CASE WHEN NOT imp THEN 1 END) AS BIGINT) AS observed_rows,
  CAST(count(CASE WHEN imp THEN 1 END) AS BIGINT) AS imputed_rows,
  CAST(max(CASE WHEN NOT imp THEN d END) AS VARCHAR) AS last_observed,
  CAST(min(CASE WHEN imp THEN d END) AS VARCHAR) AS first_imputed,
  CAST(max(CASE WHEN imp THEN d END) AS VARCHAR) AS last_imputed,
  CAST(0 AS BIGINT) AS empty_method, CAST(0 AS BIGINT) AS empty_source, CAST(0 AS BIGINT) AS empty_created,
  '' AS missing_columns, CAST(0 AS BIGINT) AS duplicate_days, (SELECT n FROM late) AS future_rows,
  (SELECT n FROM late) = 0 AS ok FROM alld
UNION ALL SELECT 'DIAGNOSIS', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT), CAST(max(d) AS VARCHAR), NULL, NULL,
  CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), '', CAST(0 AS BIGINT), (SELECT n FROM late),
  (SELECT n FROM late) = 0 FROM alld""",
    "join_ffill": _joined("ffill"),
    "join_bfill": _joined("bfill"),
    "join_interpolate": _joined("interpolate"),
    "join_without_fill": _joined("none", "DATE '2001-09-30'"),
    "joined_day_table": _with(*BASE_VC, IMPUTED, DAY_TABLE)
    + """, alld AS (SELECT d FROM vdays UNION SELECT d FROM cdays)
SELECT CAST(alld.d AS VARCHAR) AS day,
  CASE WHEN imp THEN 'true' ELSE 'false' END AS DEMAND___is_imputed,
  CASE WHEN imp THEN 'same_month_day_mean' ELSE '' END AS DEMAND___imputation_method,
  CASE WHEN imp THEN CAST((SELECT max(d) FROM vimp_obs) AS VARCHAR) ELSE '' END AS DEMAND___imputation_source_last_date,
  CASE WHEN imp THEN '2002-01-01T06:00:00' ELSE '' END AS DEMAND___imputation_created_at,
  CASE WHEN alld.d < (SELECT min(d) FROM cdays) THEN '' ELSE 'false' END AS DIAGNOSIS___is_imputed,
  '' AS DIAGNOSIS___imputation_method, '' AS DIAGNOSIS___imputation_source_last_date,
  '' AS DIAGNOSIS___imputation_created_at FROM alld LEFT JOIN vdays ON vdays.d = alld.d""",
    "fill_ffill": _gappy("lv"),
    "fill_bfill": _gappy("rv"),
    "fill_interpolate": _gappy(
        "CASE WHEN v IS NOT NULL THEN v WHEN rp IS NULL THEN lv ELSE lv + (rv - lv) * (pos - lp) / (rp - lp) END"
    ),
    "keep_last_rows": """
SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS e WHERE rn = 1""",
    "join_incremental_dedup": """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY p DESC) AS rn FROM (
    SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p, count(*) AS n, max(o_orderkey) AS k
    FROM orders GROUP BY ALL) AS a),
r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY p DESC) AS rn FROM (
    SELECT CAST(l_shipdate AS DATE) AS d, CAST(l_linenumber AS VARCHAR) AS p, count(*) AS n, max(l_orderkey) AS k
    FROM lineitem GROUP BY ALL) AS b)
SELECT CAST(coalesce(a.d, b.d) AS VARCHAR) AS timestamp, coalesce(a.n, -1) AS DEMAND__TOTAL,
  coalesce(a.k, -1) AS DEMAND_last_key, coalesce(b.n, -1) AS DIAGNOSIS__TOTAL, coalesce(b.k, -1) AS DIAGNOSIS_last_key
FROM (SELECT * FROM l WHERE rn = 1) AS a FULL JOIN (SELECT * FROM r WHERE rn = 1) AS b ON a.d = b.d""",
    "merge_pieces_on_keys": _with(VISITS, CODED)
    + """, a AS (SELECT d, CAST(up AS INTEGER) AS place,
    CASE WHEN count(CASE WHEN place = 'F' THEN 1 END) > 0 THEN count(CASE WHEN place = 'F' THEN 1 END) ELSE count(*) END AS n
  FROM visits GROUP BY d, up),
b AS (SELECT d, CAST(up AS INTEGER) AS place, count(*) AS n FROM coded GROUP BY d, up)
SELECT CAST(coalesce(a.d, b.d) AS VARCHAR) AS timestamp, coalesce(a.place, b.place) AS place,
  coalesce(a.n, -1) AS n, coalesce(b.n, -1) AS DIAG_n
FROM a FULL JOIN b ON a.d = b.d AND a.place = b.place WHERE coalesce(a.d, b.d) <= DATE '2001-06-30'""",
    "replace_recomputed_days": _with(VISITS)
    + """, again AS (SELECT d, count(*) AS n FROM visits
  WHERE d >= DATE '1997-01-01' AND d < DATE '1999-01-01' AND service = '1-URGENT' GROUP BY d)
SELECT CAST(v.d AS VARCHAR) AS day, 'DEMAND__TOTAL' AS feature, CAST(coalesce(max(again.n), count(*)) AS DOUBLE) AS value
FROM visits AS v LEFT JOIN again ON again.d = v.d GROUP BY v.d""",
    "future_rows_dropped": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderdate < DATE '2000-01-01'""",
    "date_range_rows": """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderkey, o_orderpriority,
  CAST(count(*) OVER () AS INTEGER) AS matched, CAST((SELECT count(*) FROM orders) AS INTEGER) AS total
FROM orders WHERE o_orderdate >= DATE '1996-02-01' AND o_orderdate < DATE '1996-05-01'""",
    "rows_outside_range": """
SELECT event_type, CAST(count(*) AS BIGINT) AS num_rows FROM events
WHERE event_type = 'error' OR ts < DATE '2024-01-05' OR ts >= DATE '2024-01-21' GROUP BY event_type""",
    "stored_matrix": _with(*BASE_V) + _values("vlong"),
    "delete_range": _with(*BASE_V, IMPUTED)
    + _values("vimp", "d < DATE '1997-03-01' OR d > DATE '1999-06-30'"),
    "cursor_after_delete": _with(VISITS)
    + """SELECT '2002-01-01 06:00:00' AS last_update, CAST(min(d) AS VARCHAR) AS min_timestamp,
  CAST(max(d) AS VARCHAR) AS max_timestamp, CAST(count(DISTINCT d) AS BIGINT) AS num_rows
FROM visits WHERE d < DATE '1997-03-01'""",
    "cursor_of_observed_days": _with(VISITS)
    + """SELECT '2002-01-01 06:00:00' AS last_update, CAST(min(d) AS VARCHAR) AS min_timestamp,
  CAST(max(d) AS VARCHAR) AS max_timestamp, CAST(count(DISTINCT d) AS BIGINT) AS num_rows FROM visits""",
    "window_after_gap": _with(VISITS, CONTIGUOUS)
    + """SELECT CAST(d AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS num_rows FROM visits
WHERE d > (SELECT last FROM contig) AND d <= DATE '2001-07-01' GROUP BY d""",
    "incremental_runs": _with(
        VISITS, NAMES, _long("ilong", "named", "vregion_chosen", "vplace_chosen")
    )
    + _values("ilong"),
    "staged_rows": _with(CODED, IDENTIFIED)
    + """SELECT CAST(d AS VARCHAR) AS timestamp, up AS UP, code AS DIAG_CODE, CASE WHEN up < '00100' THEN n * 10 ELSE n END AS n,
  CAST(d AS VARCHAR) || '_' || code || '_' || up AS data_id, CASE WHEN up < '00100' THEN '2' ELSE '1' END AS last_run,
  CASE WHEN up < '00100' THEN n * 10 ELSE n END AS kept_n FROM counted""",
    "row_identity": _with(CODED, IDENTIFIED)
    + """SELECT CAST(d AS VARCHAR) AS timestamp, up AS UP, code AS DIAG_CODE, n,
  CAST(d AS VARCHAR) || '_' || code || '_' || up AS data_id FROM counted""",
    "publish_range": _with(VISITS)
    + """SELECT CAST(d AS VARCHAR) AS day, 'DEMAND__TOTAL' AS feature, CAST(count(*) AS DOUBLE) AS value,
  CASE WHEN year(d) IN (1996, 1997) THEN 'stored' ELSE 'staged' END AS place FROM visits GROUP BY d""",
    "retention_after_publish": _with(VISITS) + TOTALS,
    "delete_days_keeps_later": _with(VISITS)
    + f"SELECT * FROM ({TOTALS}) AS t WHERE day < '1997-03-01' OR day > '1997-06-30'",
    "stream_publication": _with(VISITS)
    + f"""SELECT day, feature, CASE WHEN day LIKE '1998%' THEN value * 10 ELSE value END AS value
FROM ({TOTALS}) AS t WHERE day NOT LIKE '1999%'""",
    "incremental_coded_runs": _with(
        VISITS, CODED, CODED_NAMES, _long("ilong", "cnamed", "cregion_chosen", "cplace_chosen")
    )
    + _values("ilong", "d <= DATE '2001-12-31'"),
    "resumed_run": _with(
        VISITS, CODED, CODED_NAMES, _long("ilong", "cnamed", "cregion_chosen", "cplace_chosen")
    )
    + _values("ilong", "d <= DATE '2001-12-31'")
    + f" UNION ALL SELECT * FROM ({TOTALS}) AS t WHERE day NOT IN (SELECT CAST(d AS VARCHAR) FROM coded WHERE d <= DATE '2001-12-31')",
    "refreshed_estimates": _with(*BASE_V, IMPUTED) + _values("vimp"),
    "staging_after_clear": _with(VISITS)
    + f"SELECT '2' AS run, day, feature, value FROM ({TOTALS}) AS t WHERE day >= '1998-01-01'",
    "partitioned_rows_deleted": _with(VISITS)
    + f"""SELECT day, value, substr(day, 1, 4) AS folder,
  (SELECT CAST(max(d) AS VARCHAR) FROM visits WHERE d < DATE '1997-03-01') AS resume_after
FROM ({TOTALS}) AS t WHERE day < '1997-03-01' OR day > '1999-06-30'""",
    "stored_estimates": _with(*BASE_V, IMPUTED)
    + """SELECT 'base' AS dataset, CAST(d AS VARCHAR) AS timestamp, 'true' AS is_imputed,
  'same_month_day_mean' AS imputation_method, CAST((SELECT max(d) FROM vimp_obs) AS VARCHAR) AS imputation_source_last_date,
  '2002-01-01T06:00:00' AS imputation_created_at FROM vimp_miss""",
    "stored_range": _with(*BASE_V, IMPUTED) + _values("vimp", "d BETWEEN DATE '1996-11-15' AND DATE '1997-02-10'"),
    "increment_rewrites_one_year": _with(VISITS)
    + """SELECT kind, CAST(folder AS INTEGER) AS folder, first_day, last_day, value
FROM (VALUES ('observed', 2000), ('sums', 6)) AS f(kind, folder), (
  SELECT CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day, CAST(count(*) AS DOUBLE) AS value
  FROM visits WHERE d >= DATE '2000-01-01' AND d < DATE '2000-07-01') AS e""",
    "estimates_from_stored_sums": _with(
        VISITS,
        """slong AS (SELECT d, 'DEMAND__TOTAL' AS name, CAST(count(*) * CASE WHEN year(d) = 1996 THEN 2 ELSE 1 END AS DOUBLE) AS v
  FROM visits WHERE d < DATE '2000-06-01' GROUP BY d)""",
        _estimates("slong", "simp", "DATE '9999-12-31'", "DATE '2000-12-31'"),
    )
    + _values("simp"),
    "stream_retention": _with(VISITS)
    + """SELECT CAST(year(d) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS value, 'stored' AS place FROM visits GROUP BY year(d)
UNION ALL SELECT CAST(year(d) AS INTEGER), CAST(count(*) AS DOUBLE), 'staged' FROM visits WHERE d >= DATE '1998-01-01' GROUP BY year(d)""",
    "appended_without_time": "SELECT s_suppkey, s_nationkey, '1999-09-09' AS timestamp FROM supplier",
    "estimates_as_json": _with(*BASE_V, IMPUTED)
    + """SELECT '2002-01-01T06:00:00' AS generated_at, 'day' AS timestamp_column, o.n + m.n AS total_rows, m.n AS total_imputed_rows,
  'base' AS dataset, '__is_imputed' AS imputed_column, m.n AS num_imputed_rows, o.n AS num_observed_rows,
  first AS first_imputed_date, last AS last_imputed_date, dates
FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM vimp_obs) AS o, (
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(min(d) AS VARCHAR) AS first, CAST(max(d) AS VARCHAR) AS last,
    string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates FROM vimp_miss) AS m""",
    "year_slices_of_source": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS num_rows,
  CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_day
FROM lineitem WHERE l_shipdate >= DATE '1995-06-15' AND l_shipdate < DATE '1999-02-01' GROUP BY year(l_shipdate)""",
    "dates_in_several_formats": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS seen FROM orders WHERE o_orderkey % 7 < 4""",
    "rejected_dates": """
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 4 THEN '31/02/1997' WHEN 5 THEN ' ' ELSE 'none' END AS seen,
  CASE o_orderkey % 7 WHEN 4 THEN 'unreadable' WHEN 5 THEN 'blank' ELSE 'missing' END AS reason
FROM orders WHERE o_orderkey % 7 >= 4""",
    "column_contract": """
SELECT 'orders' AS table_name, column_name, stored_as, present, (SELECT CAST(count(*) AS BIGINT) FROM orders) AS num_rows
FROM (VALUES ('O_ORDERKEY', 'o_orderkey', TRUE), ('o_orderdate', 'o_orderdate', TRUE), ('o_place', 'none', FALSE),
  ('O_Clerk_Code', 'none', FALSE)) AS c(column_name, stored_as, present)""",
    "matrix_from_wide": _with(VISITS, NAMES, _long("glong", "named")) + _values("glong"),
    "first_rows_of_range": _with(VISITS)
    + """SELECT CAST(d AS VARCHAR) AS day, CAST(count(*) AS DOUBLE) AS value, CAST(count(*) OVER () AS INTEGER) AS matched
FROM visits WHERE d >= DATE '1996-02-01' AND d <= DATE '1997-04-30' GROUP BY d ORDER BY d LIMIT 10""",
    "row_identity_by_columns": _with(VISITS)
    + """SELECT CAST(d AS VARCHAR) AS timestamp, CAST(count(*) AS DOUBLE) AS n,
  CAST(d AS VARCHAR) || '_' || substr(md5('n'), 1, 8) AS data_id FROM visits GROUP BY d""",
    "table_as_csv": _with(VISITS)
    + """SELECT CAST(d AS VARCHAR) AS day, 'DEMAND__TOTAL' AS feature, CAST(count(*) AS VARCHAR) AS value
FROM visits GROUP BY d""",
    "lookup_last_wins": """
SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS up, arg_max(c_mktsegment, c_custkey) AS rs
FROM customer GROUP BY c_nationkey""",
    "selection_last_wins": """
SELECT c_mktsegment AS source, 'C_' || CAST(max(c_custkey) AS VARCHAR) AS alias FROM customer GROUP BY c_mktsegment""",
    "full_with_empty_selection": _with(VISITS, NAMES, _long("flong", "named", "vregion", "vplace"))
    + _values("flong", "d <= DATE '2002-01-01'"),
    "canonical_diagnosis_names": _with(VISITS, CODED)
    + """, m AS (
  SELECT d, 'DIAGNOSIS__TOTAL' AS name FROM coded
  UNION ALL SELECT d, 'DIAGNOSIS__TOTAL__RS__' || coalesce(rs, 'UNKNOWN') FROM coded LEFT JOIN lk ON up = lup
  UNION ALL SELECT d, 'DIAGNOSIS__TOTAL__UP__' || up FROM coded
  UNION ALL SELECT d, 'DIAGNOSIS__ICD10_3__' || code || '__RS__' || coalesce(rs, 'UNKNOWN')
    FROM coded LEFT JOIN lk ON up = lup
  UNION ALL SELECT d, 'DIAGNOSIS__ICD10_3__' || code FROM coded)
SELECT CAST(d AS VARCHAR) AS day, name AS feature, CAST(count(*) AS BIGINT) AS value FROM m GROUP BY d, name""",
    "files_past_retention": _with(VISITS)
    + """SELECT CAST(year(d) AS INTEGER) AS year, CAST(max(d) AS VARCHAR) AS last_day FROM visits
WHERE d < DATE '1999-01-01' GROUP BY year(d)""",
    "matrix_as_csv": _with(VISITS) + _wide("DOUBLE", "Timestamp"),
    "codes_from_csv": """
SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS UP, c_mktsegment, CAST(count(*) AS BIGINT) AS num_rows
FROM customer GROUP BY ALL""",
    "freshness_audit": """
SELECT 'orders' AS table_name, 'created_at' AS column_name, 'timestamp_ntz' AS data_type,
  strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS max_upload_candidate, 'ok' AS status FROM orders
UNION ALL SELECT 'orders', 'last_update_text', 'string',
  strftime(max(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END), '%Y-%m-%d %H:%M:%S'), 'ok' FROM orders
UNION ALL SELECT 'orders', 'load_id', 'bigint', 'none', 'could not cast to datetime'""",
    "duplicate_days": _with(VISITS)
    + "SELECT CAST(count(d) - count(DISTINCT d) AS BIGINT) AS duplicate_rows FROM visits",
    "narrowed_types": """
SELECT l_linenumber, CAST(count(*) AS BIGINT) AS num_rows, max(l_orderkey) AS max_key, sum(l_quantity) AS quantity,
  (SELECT CASE WHEN max(l_orderkey) < 128 THEN 'tinyint' WHEN max(l_orderkey) < 32768 THEN 'smallint'
    ELSE 'int' END FROM lineitem) AS l_orderkey_type, 'tinyint' AS l_linenumber_type, 'float' AS l_quantity_type
FROM lineitem GROUP BY l_linenumber""",
    "full_matrix": _with(
        VISITS,
        NAMES,
        CODED,
        CODED_NAMES,
        _long("vlong", "named", "vregion_chosen", "vplace_chosen"),
        _long("clong", "cnamed", "cregion_chosen", "cplace_chosen"),
        IMPUTED,
        _estimates("clong", "cimp", "DATE '9999-12-31'", "DATE '2001-12-31'"),
    )
    + _values("(SELECT * FROM vimp UNION ALL SELECT * FROM cimp) AS u"),
}

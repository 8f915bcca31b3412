"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark operators, directly from the operator
definitions, as chains of CTEs over the driver's tables.  Every integer
output is BIGINT and every double is rounded to 4 places, like the Spark
side (see ``registry.comparable``).
"""

from __future__ import annotations

import re

from ..functions import constants as K
from ..sources import bindings as B


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case_map(expr: str, mapping: dict, quote_keys: bool = True) -> str:
    parts = " ".join(
        f"WHEN {q(k) if quote_keys else k} THEN {q(v)}" for k, v in mapping.items()
    )
    return f"CASE {expr} {parts} END"


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    bodies = {}
    for name, body in ctes:
        bodies.setdefault(name, body)
    whole = "\n".join([*bodies.values(), final])
    parts = []
    for name, body in bodies.items():
        # a table used more than once is computed once
        used = len(re.findall(rf"(?:FROM|JOIN|,)\s+{name}\b", whole))
        parts.append(f"{name} AS {'MATERIALIZED ' if used > 1 else ''}(\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + final


AS_OF = f"DATE '{B.AS_OF.isoformat()}'"
GRID_START = f"DATE '{B.GRID_START.isoformat()}'"
P0 = B.FIRST_YEAR * 2
P1 = B.AS_OF.year * 2 + 1


def clean_sql(x: str) -> str:
    s = x
    for a, b in K.CLEAN_NAME_REPLACEMENTS:
        s = f"replace({s}, {q(a)}, {q(b)})"
    s = f"strip_accents({s})"
    s = f"regexp_replace({s}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')"
    s = f"lower({s})"
    s = f"regexp_replace({s}, '[^a-z0-9]+', '_', 'g')"
    s = f"regexp_replace({s}, '^_+|_+$', '', 'g')"
    return (
        f"(CASE WHEN {s} = '' THEN 'x' WHEN regexp_matches({s}, '^[0-9]') "
        f"THEN 'x' || {s} ELSE {s} END)"
    )


# ---- B1 -> roll-up -> lookup -> recode ------------------------------------------
def b1_ctes():
    taxa = "lower(p.p_type)"
    cm = case_map("l.l_linenumber", B.B1_CONTROL, quote_keys=False)
    st = case_map("l.l_returnflag", B.B1_STATUS)
    return [
        ("b1", f"""
SELECT n.n_name AS country_iso3c,
       CAST(year(l.l_shipdate) AS INTEGER) AS report_year,
       CASE WHEN month(l.l_shipdate) < 7 THEN 1 ELSE 2 END AS report_semester,
       p.p_brand AS disease,
       l.l_linestatus AS disease_population,
       CASE WHEN l.l_linenumber = {B.B1_TAXA_SUFFIX_LINE} THEN {taxa} || ' (mixed herd)' ELSE {taxa} END AS taxa,
       CAST(l.l_linenumber AS VARCHAR) AS serotype,
       {cm} AS control_measures,
       {st} AS disease_status,
       CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS cases
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey""")
    ]


KEY = "country_iso3c, report_year, report_semester, disease, disease_population, taxa"


def taxa_norm_sql(col: str) -> str:
    t = col
    for s in K.TAXA_SUFFIXES:
        t = f"replace({t}, {q(s)}, '')"
    if B.B1_TAXA_MERGE:
        return f"coalesce({case_map(t, B.B1_TAXA_MERGE)}, {t})"
    return t


def rollup_ctes():
    return b1_ctes() + [
        ("b1f", f"""
SELECT * FROM (
  SELECT upper(country_iso3c) AS country_iso3c, report_year, report_semester, disease,
         disease_population, {taxa_norm_sql('taxa')} AS taxa, serotype,
         nullif(control_measures, 'na') AS control_measures, disease_status,
         CAST(trunc(TRY_CAST(cases AS DOUBLE)) AS INTEGER) AS cases_i
  FROM b1) t
WHERE taxa IN {in_list(B.B1_TAXA_LIST)} AND country_iso3c IS NOT NULL"""),
        ("roll_main", f"""
SELECT {KEY}, CAST(sum(cases_i) AS BIGINT) AS cases,
       bool_or(disease_status = 'present') AS sp, bool_or(disease_status = 'absent') AS sa,
       bool_or(disease_status = 'unreported') AS su
FROM b1f GROUP BY {KEY}"""),
        ("roll_cm", f"""
SELECT {KEY}, list_sort(list_distinct(list(m))) AS cm FROM (
  SELECT {KEY}, unnest(string_split(control_measures, '; ')) AS m FROM b1f) t
WHERE m <> '' GROUP BY {KEY}"""),
        ("rolled", f"""
SELECT r.country_iso3c, r.report_year, r.report_semester, r.disease, r.disease_population, r.taxa,
       r.cases,
       CASE WHEN sp THEN 'present' WHEN sa THEN 'absent' WHEN su THEN 'unreported' END AS disease_status,
       coalesce(array_to_string(c.cm, '; '), 'none') AS control_measures
FROM roll_main r LEFT JOIN roll_cm c USING ({KEY})"""),
    ]


def lookup_ctes():
    return rollup_ctes() + [
        ("name_counts", "SELECT disease, count(*) AS n FROM rolled GROUP BY disease"),
        ("name_ranked", f"""
SELECT disease, n, clean, row_number() OVER (PARTITION BY clean ORDER BY n DESC, disease) AS rn
FROM (SELECT disease, n, {clean_sql('disease')} AS clean FROM name_counts) t"""),
        ("name_thr", "SELECT quantile_cont(n, 0.15) AS thr FROM name_counts"),
        ("lookup", f"""
SELECT disease,
       CASE WHEN rn = 1 THEN clean ELSE clean || '_' || CAST(rn AS VARCHAR) END AS disease_recode,
       CASE WHEN n <= thr THEN {q(K.RARE_DISEASE_LABEL)}
            WHEN rn = 1 THEN clean ELSE clean || '_' || CAST(rn AS VARCHAR) END AS disease_recode_rare,
       CAST(n AS BIGINT) AS n
FROM name_ranked, name_thr"""),
        ("recoded", """
SELECT r.country_iso3c, r.report_year, r.report_semester, lk.disease_recode AS disease,
       r.disease AS disease_name_uncleaned, r.disease_population, r.taxa, r.cases,
       r.disease_status, r.control_measures
FROM rolled r LEFT JOIN lookup lk ON r.disease = lk.disease"""),
    ]


SERIES = "country_iso3c, disease, disease_population, taxa"


def grid_ctes():
    return lookup_ctes() + [
        ("facts", """
SELECT country_iso3c, disease, disease_population, taxa,
       report_year * 2 + report_semester - 1 AS period, cases, disease_status, control_measures,
       TRUE AS obs
FROM recoded"""),
        ("grid", f"""
SELECT e.disease, e.disease_population, e.taxa, r.country_iso3c, p.period
FROM (SELECT DISTINCT disease, disease_population, taxa FROM facts) e
CROSS JOIN (SELECT DISTINCT country_iso3c FROM facts) r
CROSS JOIN (SELECT unnest(range({P0}, {P1 + 1})) AS period) p"""),
        ("dense", f"""
SELECT g.country_iso3c, g.disease, g.disease_population, g.taxa, g.period,
       CAST(floor(g.period / 2) AS INTEGER) AS report_year,
       CAST(g.period % 2 + 1 AS INTEGER) AS report_semester,
       f.cases,
       CASE WHEN f.obs IS NULL THEN 'unreported' ELSE f.disease_status END AS disease_status,
       f.control_measures
FROM grid g LEFT JOIN facts f USING (country_iso3c, disease, disease_population, taxa, period)"""),
    ]


def lag_ctes(n: int = 3, name: str = "lagged"):
    w = f"OVER (PARTITION BY {SERIES} ORDER BY period)"
    cols = ",\n       ".join(
        f"lag({c}, {i}) {w} AS {c}_lag{i}"
        for i in range(1, n + 1)
        for c in ("cases", "disease_status", "control_measures")
    )
    return grid_ctes() + [(name, f"SELECT *,\n       {cols}\nFROM dense")]


def status_int(c: str) -> str:
    return (
        f"CAST(CASE WHEN {c} = 'present' THEN 1 WHEN {c} IN ('absent', 'unreported') THEN 0 END AS INTEGER)"
    )


def baseline_ctes():
    return lag_ctes(1, "lagged1") + [
        ("baseline", f"""
SELECT {KEY}, period, {status_int('disease_status')} AS disease_status, cases, cases_lag1,
       {status_int('disease_status_lag1')} AS disease_status_lag1,
       CAST(disease_status = 'unreported' AS INTEGER) AS disease_status_unreported,
       CAST(disease_status_lag1 = 'unreported' AS INTEGER) AS disease_status_lag1_unreported
FROM lagged1"""),
        ("forecast", """
SELECT *, coalesce(disease_status_lag1, 0) AS disease_status_predicted,
       CASE WHEN coalesce(disease_status_lag1, 0) = 1 THEN CAST(cases_lag1 AS DOUBLE) ELSE 0.0 END
         AS cases_predicted
FROM baseline"""),
    ]


def direction_sql(d: str, up: str, down: str) -> str:
    return f"CASE WHEN {d} > 0 THEN {q(up)} WHEN {d} < 0 THEN {q(down)} WHEN {d} = 0 THEN 'no change' END"


def countries_cte():
    return ("countries", """
SELECT n.n_name AS country, n.n_name AS country_iso3c,
       CASE WHEN n.n_nationkey = 24 THEN NULL ELSE r.r_name END AS continent
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")


def scored_ctes():
    return baseline_ctes() + [
        countries_cte(),
        ("scored", f"""
SELECT s.*, c.continent, 'baseline' AS model FROM (
SELECT {KEY},
       disease_status AS disease_status_actual,
       CAST(cases AS DOUBLE) AS cases_actual,
       CAST(cases_lag1 AS DOUBLE) AS cases_lag1,
       disease_status_lag1,
       disease_status_predicted,
       cases_predicted,
       CAST(abs(cases - cases_predicted) AS DOUBLE) AS cases_error,
       {direction_sql('cases - cases_lag1', 'increase', 'decrease')} AS cases_dirchange_actual,
       {direction_sql('cases_predicted - cases_lag1', 'increase', 'decrease')} AS cases_dirchange_predicted,
       {direction_sql('disease_status - disease_status_lag1', 'outbreak starts', 'outbreak ends')}
         AS disease_status_dirchange_actual,
       {direction_sql('disease_status_predicted - disease_status_lag1', 'outbreak starts', 'outbreak ends')}
         AS disease_status_dirchange_predicted,
       disease_status = disease_status_predicted AS disease_status_match
FROM forecast) s LEFT JOIN countries c USING (country_iso3c)"""),
    ]

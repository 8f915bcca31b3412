"""DuckDB oracle SQL fragments for the network-side queries."""

from __future__ import annotations

from ..sources import bindings as B
from . import oracle as O
from .oracle import AS_OF, GRID_START, q

SCALED = [v for v in B.PREDICTOR_VARS if v != "continent"]
LINK_VARS = [
    "shared_borders_from_outbreaks", "n_migratory_wildlife_from_outbreaks",
    "ots_trade_dollars_from_outbreaks", "fao_livestock_heads_from_outbreaks",
]
PREV_YEAR = f"CAST(date_trunc('month', {AS_OF} - 365) AS DATE)"
FAR = f"CAST(date_trunc('month', {AS_OF} + 36500) AS DATE)"
CURRENT_PERIOD = B.AS_OF.year * 2 + (0 if B.AS_OF.month < 7 else 1)


def months_series(lo: str, hi: str) -> str:
    return f"unnest(generate_series(CAST({lo} AS TIMESTAMP), CAST({hi} AS TIMESTAMP), INTERVAL 1 MONTH))"


def events_ctes():
    return [
        ("b2", """
SELECT CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS report_id,
       o.o_orderkey AS outbreak_thread_id, n.n_name AS country_iso3c,
       CASE WHEN o.o_orderkey % 53 = 0 THEN 'local_' || lower(n.n_name)
            ELSE 'brand_number_' || CAST((o.o_custkey * 5 + o.o_orderkey) % 25 + 1 AS VARCHAR) END AS disease,
       (o.o_orderkey % 13 = 0) AS is_aquatic,
       CAST(o.o_orderdate AS DATE) + CAST(10 * l.l_linenumber AS INTEGER) AS report_date,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS start_d,
       CASE WHEN o.o_orderstatus = 'O' THEN NULL
            ELSE CAST(CAST(o.o_orderdate AS DATE) + to_months(CAST(o.o_orderkey % 5 AS INTEGER)) AS DATE) END
         AS resolved_d
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN lineitem l ON o.o_orderkey = l.l_orderkey"""),
        ("ev", """
SELECT coalesce(CAST(outbreak_thread_id AS VARCHAR), 'report:' || report_id) AS th,
       report_id, outbreak_thread_id, country_iso3c, disease,
       CAST(date_trunc('month', report_date) AS DATE) AS rm,
       CAST(date_trunc('month', start_d) AS DATE) AS sm,
       CAST(date_trunc('month', resolved_d) AS DATE) AS vm
FROM b2 WHERE country_iso3c IS NOT NULL AND country_iso3c <> 'NA' AND NOT is_aquatic"""),
        ("thr", """
SELECT th, min(CASE WHEN sm IS NULL OR rm <= sm THEN rm ELSE sm END) AS s,
       max(coalesce(vm, rm)) AS e, bool_and(vm IS NULL) AS open
FROM ev GROUP BY th"""),
        ("bounds", f"""
SELECT DISTINCT e.outbreak_thread_id, e.country_iso3c, e.disease, t.s AS outbreak_start_month,
       CASE WHEN t.e >= {PREV_YEAR} AND t.open THEN {FAR} ELSE t.e END AS outbreak_end_month
FROM ev e JOIN thr t USING (th)"""),
        ("act", f"""
SELECT country_iso3c, disease, outbreak_start_month AS s, outbreak_end_month AS e,
       CAST({months_series(f"greatest(outbreak_start_month, {GRID_START})", f"least(greatest(outbreak_end_month, outbreak_start_month), {AS_OF})")} AS DATE) AS month
FROM bounds
WHERE greatest(outbreak_start_month, {GRID_START}) <= least(greatest(outbreak_end_month, outbreak_start_month), {AS_OF})"""),
        ("cells", """
SELECT country_iso3c, disease, month, bool_or(month = s) AS st, bool_or(month > s AND month <= e) AS sub
FROM act GROUP BY country_iso3c, disease, month"""),
    ]


def endemic_ctes(restrict: bool = True):
    where = (
        "AND EXISTS (SELECT 1 FROM ev WHERE ev.country_iso3c = f.country_iso3c AND ev.disease = f.disease)"
        if restrict else ""
    )
    name = "endemic" if restrict else "endemic_all"
    return O.baseline_ctes() + [
        (f"pos_{name}", f"""
SELECT f.country_iso3c, f.disease, f.period FROM forecast f
WHERE coalesce(f.cases, f.cases_predicted) > 0 {where}"""),
        (f"per_{name}", f"""
SELECT country_iso3c, disease, period FROM pos_{name}
UNION ALL
SELECT country_iso3c, disease, unnest(range(period + 1, {CURRENT_PERIOD} + 1)) AS period FROM (
  SELECT DISTINCT country_iso3c, disease, period FROM pos_{name}
  WHERE period = (SELECT max(period) FROM pos_{name}) AND period < {CURRENT_PERIOD}) t"""),
        (name, f"""
SELECT DISTINCT country_iso3c, disease,
       CAST({months_series("make_date(CAST(floor(period / 2) AS INTEGER), CAST((period % 2) * 6 + 1 AS INTEGER), 1)",
                           "make_date(CAST(floor(period / 2) AS INTEGER), CAST((period % 2) * 6 + 6 AS INTEGER), 1)")} AS DATE) AS month,
       TRUE AS endemic
FROM per_{name}"""),
    ]


def monthly_ctes():
    return events_ctes() + endemic_ctes(True) + [
        ("single", """
SELECT disease FROM ev GROUP BY disease HAVING count(DISTINCT country_iso3c) = 1"""),
        ("mgrid", f"""
SELECT d.disease, c.country_iso3c, CAST({months_series(GRID_START, AS_OF)} AS DATE) AS month
FROM (SELECT DISTINCT disease FROM ev) d CROSS JOIN (SELECT DISTINCT country_iso3c FROM ev) c"""),
        ("monthly", """
SELECT g.country_iso3c, g.disease, g.month,
       coalesce(c.st, false) AND NOT (coalesce(c.st, false) AND (coalesce(c.sub, false) OR coalesce(en.endemic, false)))
         AS outbreak_start,
       coalesce(c.sub, false) AS outbreak_subsequent_month,
       coalesce(en.endemic, false) AS endemic,
       p.country_iso3c IS NULL AS disease_country_combo_unreported,
       coalesce(c.st, false) OR coalesce(c.sub, false) AS outbreak_ongoing,
       coalesce(c.st, false) AND (coalesce(c.sub, false) OR coalesce(en.endemic, false))
         AS outbreak_start_while_ongoing_or_endemic,
       s.disease IS NOT NULL AS disease_in_single_country
FROM mgrid g
LEFT JOIN cells c ON g.country_iso3c = c.country_iso3c AND g.disease = c.disease AND g.month = c.month
LEFT JOIN (SELECT DISTINCT country_iso3c, disease FROM ev) p
  ON g.country_iso3c = p.country_iso3c AND g.disease = p.disease
LEFT JOIN endemic en ON g.country_iso3c = en.country_iso3c AND g.disease = en.disease AND g.month = en.month
LEFT JOIN single s ON g.disease = s.disease"""),
    ]


def taxa_merge_sql(x: str) -> str:
    if not B.B1_TAXA_MERGE:
        return x
    return f"coalesce({O.case_map(x, B.B1_TAXA_MERGE)}, {x})"


def covariate_ctes():
    return [
        O.countries_cte(),
        ("gdp", """
SELECT n.n_name AS country_iso3c, year(o.o_orderdate) AS year, round(sum(o.o_totalprice), 2) AS gdp_dollars
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE NOT (n.n_nationkey % 9 = 0 AND year(o.o_orderdate) % 2 = 0)
GROUP BY n.n_name, year(o.o_orderdate)"""),
        ("hpop", """
SELECT n.n_name AS country_iso3c, year(o.o_orderdate) AS year,
       CAST(count(DISTINCT o.o_custkey) * 1000 AS DOUBLE) AS human_population
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, year(o.o_orderdate)"""),
        ("vets", """
SELECT n.n_name AS country_iso3c, year(o.o_orderdate) AS year,
       CAST(count(DISTINCT l.l_suppkey) AS DOUBLE) AS veterinarian_count
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name, year(o.o_orderdate)"""),
        ("taxa_pop", f"""
SELECT n.n_name AS country_iso3c, year(o.o_orderdate) AS year, {taxa_merge_sql('lower(p.p_type)')} AS taxa,
       sum(l.l_quantity) AS population
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY ALL"""),
    ]


def points_cte():
    return ("b9", """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS report_id,
       lower(p.p_type) AS species_name,
       CAST(l.l_quantity AS INTEGER) AS cases,
       CASE WHEN l.l_linenumber = 2 THEN NULL ELSE CAST(l.l_quantity AS INTEGER) % 4 END AS deaths,
       CAST(l.l_quantity AS INTEGER) % 3 AS killed_and_disposed,
       CASE WHEN l.l_linenumber % 2 = 0 THEN NULL ELSE 1 END AS slaughtered_for_commercial_use,
       CAST(l.l_shipdate AS DATE) AS outbreak_start_date,
       CAST((l.l_orderkey * 37) % 120 - 60 + (l.l_linenumber * 7) % 5 * 0.1 AS DOUBLE) AS latitude,
       CAST((l.l_orderkey * 53) % 340 - 170 + (l.l_linenumber * 3) % 7 * 0.1 AS DOUBLE) AS longitude,
       l.l_orderkey AS orderkey
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")


def primary_taxa_ctes():
    return events_ctes() + [
        points_cte(),
        ("primary_taxa", f"""
SELECT e.disease, t.taxa, count(*) AS n_reports
FROM (SELECT DISTINCT report_id, {taxa_merge_sql('species_name')} AS taxa FROM b9) t
JOIN (SELECT report_id, disease FROM ev) e ON t.report_id = e.report_id
GROUP BY e.disease, t.taxa"""),
    ]


def prep_sql(x: str, src: str) -> str:
    """prepvar(x, log10) with the auto NA fill computed over ``src``."""
    t = f"(CASE WHEN {x} > 0 THEN log10({x}) WHEN {x} = 0 THEN CAST('-inf' AS DOUBLE) END)"
    bad = f"({x} IS NULL OR isnan({x}) OR isinf({x}))"
    fill = (
        f"(SELECT min({t}) - 6 * stddev_samp({t}) FROM {src} WHERE NOT {bad})"
    )
    return f"(CASE WHEN {bad} THEN {fill} ELSE {t} END)"


FLAGS = [
    "outbreak_start", "outbreak_subsequent_month", "outbreak_ongoing",
    "outbreak_start_while_ongoing_or_endemic", "endemic", "disease_country_combo_unreported",
]


def network_cov_ctes():
    return monthly_ctes() + covariate_ctes() + primary_taxa_ctes() + [
        ("target_pop", """
SELECT tp.country_iso3c, tp.year, pt.disease, sum(tp.population) AS target_taxa_population
FROM taxa_pop tp JOIN (SELECT disease, taxa FROM primary_taxa) pt ON tp.taxa = pt.taxa
GROUP BY ALL"""),
        ("ncov0", """
SELECT m.*, year(m.month) AS year, co.continent, g.gdp_dollars, h.human_population,
       tp.target_taxa_population, v.veterinarian_count
FROM monthly m
LEFT JOIN countries co ON m.country_iso3c = co.country_iso3c
LEFT JOIN gdp g ON m.country_iso3c = g.country_iso3c AND year(m.month) = g.year
LEFT JOIN hpop h ON m.country_iso3c = h.country_iso3c AND year(m.month) = h.year
LEFT JOIN target_pop tp ON m.country_iso3c = tp.country_iso3c AND year(m.month) = tp.year
  AND m.disease = tp.disease
LEFT JOIN vets v ON m.country_iso3c = v.country_iso3c AND year(m.month) = v.year"""),
        ("ncov", f"""
SELECT country_iso3c, continent, disease, month, {', '.join(FLAGS)}, disease_in_single_country, year,
       {prep_sql('gdp_dollars', 'ncov0')} AS log_gdp_dollars,
       {prep_sql('human_population', 'ncov0')} AS log_human_population,
       {prep_sql('(target_taxa_population + 1)', 'ncov0')} AS log_target_taxa_population,
       {prep_sql('(veterinarian_count + 1)', 'ncov0')} AS log_veterinarians
FROM ncov0"""),
    ]


def links_ctes():
    return [
        ("b4", """
SELECT a.n_name AS country_origin, b.n_name AS country_destination,
       CASE WHEN abs(a.n_nationkey - b.n_nationkey) <= 10 THEN 'TRUE' ELSE 'FALSE' END AS shared_border,
       CAST((a.n_nationkey * 7 + b.n_nationkey * 3) % 5 AS INTEGER) AS n_migratory_wildlife
FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey"""),
        ("b3", """
SELECT ns.n_name AS country_origin, nc.n_name AS country_destination, year(o.o_orderdate) AS year,
       round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS ots_trade_dollars,
       sum(l.l_quantity) AS fao_livestock_heads
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation ns ON s.s_nationkey = ns.n_nationkey JOIN nation nc ON c.c_nationkey = nc.n_nationkey
GROUP BY ALL"""),
        ("presence", """
SELECT country_iso3c AS country_origin, disease, month FROM monthly
WHERE outbreak_start OR outbreak_subsequent_month OR endemic"""),
        ("pairs_s", """
SELECT s.country_destination, p.disease, p.month, p.country_origin,
       CAST(upper(s.shared_border) = 'TRUE' AS DOUBLE) AS shared_borders_from_outbreaks,
       CAST(s.n_migratory_wildlife AS DOUBLE) AS n_migratory_wildlife_from_outbreaks
FROM presence p JOIN b4 s ON p.country_origin = s.country_origin
WHERE s.country_origin <> s.country_destination"""),
        ("pairs_y", """
SELECT y.country_destination, p.disease, p.month, p.country_origin,
       CAST(y.ots_trade_dollars AS DOUBLE) AS ots_trade_dollars_from_outbreaks,
       CAST(y.fao_livestock_heads AS DOUBLE) AS fao_livestock_heads_from_outbreaks
FROM presence p JOIN b3 y ON p.country_origin = y.country_origin AND year(p.month) = y.year
WHERE y.country_origin <> y.country_destination"""),
        ("pressure", """
SELECT country_destination AS country_iso3c, disease, month,
       sum(shared_borders_from_outbreaks) AS shared_borders_from_outbreaks,
       sum(n_migratory_wildlife_from_outbreaks) AS n_migratory_wildlife_from_outbreaks,
       sum(ots_trade_dollars_from_outbreaks) AS ots_trade_dollars_from_outbreaks,
       sum(fao_livestock_heads_from_outbreaks) AS fao_livestock_heads_from_outbreaks
FROM (
  SELECT country_destination, disease, month, shared_borders_from_outbreaks,
         n_migratory_wildlife_from_outbreaks, NULL AS ots_trade_dollars_from_outbreaks,
         NULL AS fao_livestock_heads_from_outbreaks FROM pairs_s
  UNION ALL
  SELECT country_destination, disease, month, NULL, NULL, ots_trade_dollars_from_outbreaks,
         fao_livestock_heads_from_outbreaks FROM pairs_y
) u GROUP BY ALL"""),
        ("pairs", """
SELECT coalesce(s.country_destination, y.country_destination) AS country_destination,
       coalesce(s.disease, y.disease) AS disease, coalesce(s.month, y.month) AS month,
       coalesce(s.country_origin, y.country_origin) AS country_origin,
       s.shared_borders_from_outbreaks, s.n_migratory_wildlife_from_outbreaks,
       y.ots_trade_dollars_from_outbreaks, y.fao_livestock_heads_from_outbreaks
FROM pairs_s s FULL OUTER JOIN pairs_y y
  ON s.country_destination = y.country_destination AND s.disease = y.disease AND s.month = y.month
  AND s.country_origin = y.country_origin"""),
        ("anywhere", "SELECT DISTINCT disease, month, TRUE AS disease_present_anywhere FROM presence"),
    ]


BASE = ("country_iso3c, continent, disease, month, log_gdp_dollars, log_human_population, "
        "log_target_taxa_population, log_veterinarians, " + ", ".join(FLAGS))


def features_ctes():
    return network_cov_ctes() + links_ctes() + [
        ("feats", f"""
SELECT c.country_iso3c, c.continent, c.disease, c.month, c.log_gdp_dollars, c.log_human_population,
       c.log_target_taxa_population, c.log_veterinarians, {', '.join('c.' + f for f in FLAGS)},
       {', '.join(f'coalesce(p.{v}, 0.0) AS {v}' for v in LINK_VARS)},
       coalesce(a.disease_present_anywhere, false) AS disease_present_anywhere
FROM ncov c
LEFT JOIN pressure p ON c.country_iso3c = p.country_iso3c AND c.disease = p.disease AND c.month = p.month
LEFT JOIN anywhere a ON c.disease = a.disease AND c.month = a.month"""),
        ("feats_o", f"""
SELECT c.country_iso3c, c.continent, c.disease, c.month, c.log_gdp_dollars, c.log_human_population,
       c.log_target_taxa_population, c.log_veterinarians, {', '.join('c.' + f for f in FLAGS)},
       p.country_origin, {', '.join(f'p.{v}' for v in LINK_VARS)},
       coalesce(a.disease_present_anywhere, false) AS disease_present_anywhere
FROM ncov c
LEFT JOIN pairs p ON c.country_iso3c = p.country_destination AND c.disease = p.disease AND c.month = p.month
LEFT JOIN anywhere a ON c.disease = a.disease AND c.month = a.month"""),
    ]


ALL_FEAT_COLS = BASE.split(", ") + LINK_VARS + ["disease_present_anywhere"]


def model_ctes():
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in ALL_FEAT_COLS)
    scaling = "\nUNION ALL\n".join(
        f"SELECT '{v}' AS key, avg(CAST({v} AS DOUBLE)) AS mean, stddev_samp(CAST({v} AS DOUBLE)) AS sd FROM fitrows"
        for v in SCALED
    )
    names = "\nUNION ALL\n".join(f"SELECT '{v}' AS variable" for v in SCALED)
    piv = ", ".join(f"max(CASE WHEN variable = '{v}' THEN coef END) AS c_{v}" for v in SCALED)
    from .network import INTERCEPT

    eta = f"CAST({INTERCEPT} AS DOUBLE) + cc.coef"
    for v in SCALED:
        eta += f" + cw.c_{v} * {zsql('f.' + v, v)}"
    complete = " AND ".join(["f.continent IS NOT NULL"] + [f"f.{v} IS NOT NULL" for v in SCALED])
    return features_ctes() + [
        ("fitrows", f"SELECT * FROM feats WHERE {notnull} AND NOT endemic AND NOT outbreak_subsequent_month"),
        ("scaling", scaling),
        ("coefs", f"""
SELECT d.disease, v.variable,
       CAST(((ascii(d.disease) + length(v.variable)) % 7 - 3) / 10.0 AS DOUBLE) AS coef,
       replace(regexp_replace(v.variable, '_from_outbreaks$', ''), '_', ' ') AS variable_clean,
       {initcap_sql("replace(replace(d.disease, '/', '_'), '_', ' ')")} AS disease_clean
FROM (SELECT DISTINCT disease FROM feats) d CROSS JOIN (
  {names}
  UNION ALL
  SELECT DISTINCT 'continent' || continent FROM countries WHERE continent IS NOT NULL) v"""),
        ("coef_wide", f"SELECT disease, {piv} FROM coefs GROUP BY disease"),
        ("coef_cont", """
SELECT disease, substr(variable, 10) AS continent, coef FROM coefs WHERE starts_with(variable, 'continent')"""),
        ("pred", f"""
SELECT f.country_iso3c, f.disease, f.month,
       CASE WHEN {complete} THEN round(1.0 / (1.0 + exp(-({eta}))), 9) END AS predicted_outbreak_probability
FROM feats f LEFT JOIN coef_wide cw ON f.disease = cw.disease
LEFT JOIN coef_cont cc ON f.disease = cc.disease AND f.continent = cc.continent"""),
        ("npred", """
SELECT f.*, p.predicted_outbreak_probability FROM feats f
JOIN pred p ON f.country_iso3c = p.country_iso3c AND f.disease = p.disease AND f.month = p.month"""),
        ("npred_o", """
SELECT f.*, p.predicted_outbreak_probability FROM feats_o f
JOIN pred p ON f.country_iso3c = p.country_iso3c AND f.disease = p.disease AND f.month = p.month"""),
    ]


def zsql(col: str, v: str) -> str:
    """(x - mean) / sd with the stored scaling; a constant predictor gives 0."""
    return (
        f"(CASE WHEN {col} IS NULL THEN NULL "
        f"WHEN coalesce((SELECT sd FROM scaling WHERE key = '{v}'), 0) = 0 THEN 0.0 ELSE "
        f"(CAST({col} AS DOUBLE) - (SELECT mean FROM scaling WHERE key = '{v}')) / "
        f"(SELECT sd FROM scaling WHERE key = '{v}') END)"
    )


def initcap_sql(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({x}, ' '), "
        f"lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


def dbl(cols) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in cols)


__all__ = ["q"]

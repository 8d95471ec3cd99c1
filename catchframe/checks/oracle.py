"""The registered queries as SQL for DuckDB, over the same tables.

Each statement states the result directly; it shares the fixed code lists with
the library and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from catchframe import codes
from catchframe.checks import standins as data

ORACLE: dict[str, str] = {}


def r(x: str, name: str) -> str:
    """Rounded double under a name."""
    return f"round(({x})::DOUBLE, 6) + 0.0 AS {name}"


def psum(x: str, where: str = "true") -> str:
    """Sum that one missing value makes missing."""
    return f"(CASE WHEN bool_and(({x}) IS NOT NULL) FILTER ({where}) THEN sum({x}) FILTER ({where}) END)"


def nsum(x: str, where: str = "true") -> str:
    return f"coalesce(sum({x}) FILTER ({where}), 0.0)"


def cell(x: str, where: str) -> str:
    """Cell of a pivot: missing without rows, otherwise the sum of known values."""
    return f"(CASE WHEN count(*) FILTER ({where}) > 0 THEN coalesce(sum({x}) FILTER ({where}), 0.0) END)"


def ratio(n: str, d: str) -> str:
    return (
        f"(CASE WHEN ({d}) = 0 THEN CASE WHEN ({n}) > 0 THEN 'inf'::DOUBLE WHEN ({n}) < 0 THEN '-inf'::DOUBLE END "
        f"ELSE ({n}) / ({d}) END)"
    )


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def items(values: Sequence[str]) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def case(column: str, mapping: Mapping[str, str]) -> str:
    return "(CASE " + " ".join(f"WHEN {column} = {text(k)} THEN {text(v)}" for k, v in mapping.items()) + " END)"


def choose(labels: Sequence[str], number: str) -> str:
    return "([" + ", ".join(text(x) for x in labels) + f"])[({number})::INTEGER + 1]"


def sig(x: str) -> str:
    """Advice rounding: three digits if the first one is 1, else two."""
    digits = f"(CASE WHEN abs({x}) / pow(10.0, floor(log10(abs({x})))) < 2 THEN 3 ELSE 2 END)"
    e = f"(floor(log10(abs({x}))) - {digits} + 1)"
    return (
        f"(CASE WHEN ({x}) = 0 THEN 0.0 WHEN {e} < 0 THEN round_even(({x}) * pow(10.0, -{e}), 0)::DOUBLE / pow(10.0, -{e}) "
        f"ELSE round_even(({x}) / pow(10.0, {e}), 0)::DOUBLE * pow(10.0, {e}) END)"
    )


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


AREA_NO = "(l_suppkey * 7 + l_linenumber)"
NATION = "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
STOCK = "'S' || (l_partkey % 3)"
SPECIES3 = "l_partkey % 5 % 3"

CATCH = f"""
catch AS (
  SELECT {STOCK} AS stock, year(l_shipdate)::INTEGER AS year, quarter(l_shipdate)::INTEGER AS season,
    {choose(data.NATION_LABELS, 'n_nationkey')} AS country, {choose(data.AREAS, AREA_NO + ' % 10')} AS area,
    substr(p_type, 1, 3) || '_' || substr(p_brand, 7, 2) AS fleet,
    CASE WHEN l_returnflag = 'A' THEN 'Discards' WHEN l_returnflag = 'N' THEN 'Landings'
      WHEN l_linestatus = 'F' THEN '{codes.LOGBOOK}' ELSE '{codes.BMS}' END AS category,
    CASE WHEN l_linestatus = 'F' THEN 'Imported_Data' ELSE 'Raised_Discards' END AS origin,
    CASE WHEN l_suppkey % 7 = 0 AND l_quantity = 13 THEN NULL
      WHEN {AREA_NO} % 10 = 8 AND year(l_shipdate) = 1996 AND l_returnflag = 'N' THEN 0.0::DOUBLE
      WHEN {AREA_NO} % 10 = 7 AND year(l_shipdate) = 1997 AND l_returnflag IN ('N', 'A') THEN 0.0::DOUBLE
      ELSE l_quantity END AS caton,
    l_quantity AS weight, (floor(l_quantity / 10) * 10)::INTEGER AS length
  FROM lineitem {NATION} JOIN part ON l_partkey = p_partkey
)"""

PRELIM = f"""
prelim AS (
  SELECT {STOCK} AS stock, year(l_shipdate)::INTEGER AS year,
    {choose((*codes.SPECIES_LATIN.values(), 'Pleuronectes platessa'), SPECIES3)} AS species_latin,
    {choose(data.PRELIMINARY_AREAS, AREA_NO + ' % 10')} AS area, {choose(data.NATION_CODES, 'n_nationkey')} AS country,
    CASE WHEN NOT (n_nationkey = 0 AND year(l_shipdate) = 1999) AND l_quantity <> 13 THEN l_quantity END AS ams,
    CASE WHEN n_nationkey <> 0 AND l_linenumber % 3 <> 0 THEN l_linenumber::DOUBLE END AS bms
  FROM lineitem {NATION}
)"""

HIST = f"""
hist_sums AS (
  SELECT {choose(('Brill', 'Turbot', 'Plaice'), SPECIES3)} AS species, {choose(data.DIVISIONS, AREA_NO + ' % 9')} AS division,
    {choose(data.NATION_LABELS, 'n_nationkey')} AS country, year(l_shipdate)::INTEGER AS year, sum(l_quantity)::BIGINT AS w
  FROM lineitem {NATION} GROUP BY ALL
), hist AS (
  SELECT *, CASE WHEN w % 11 IN (0, 1, 2) THEN NULL WHEN w % 11 IN (3, 4) THEN 0.0::DOUBLE ELSE w::DOUBLE END AS value
  FROM hist_sums WHERE w % 11 NOT IN (0, 1, 2)
)"""

DATASET = f"""
dataset_ids AS (
  SELECT {choose(('BLL', 'TUR', 'PLE'), SPECIES3)} AS species, {choose(data.DATASET_AREAS, AREA_NO + ' % 6')} AS area,
    'TLW' AS units, {choose(data.NATION_CODES, 'n_nationkey')} AS country, year(l_shipdate)::INTEGER AS year, l_quantity
  FROM lineitem {NATION}
), dataset_sums AS (
  SELECT species, area, units, country, year, sum(l_quantity)::BIGINT AS w FROM dataset_ids GROUP BY ALL
), dataset AS (
  SELECT i.*, y.year, CASE WHEN w % 7 <> 0 THEN w + 0.5::DOUBLE END AS value
  FROM (SELECT DISTINCT species, area, units, country FROM dataset_ids) i
  CROSS JOIN (SELECT unnest(range(1995, 2002))::INTEGER AS year) y
  LEFT JOIN dataset_sums s ON s.species = i.species AND s.area = i.area AND s.country = i.country AND s.year = y.year
)"""

OFFICIAL = f"""
official AS (
  SELECT stock, area, CASE WHEN code = 'IE' AND year % 3 = 0 THEN 'DE' WHEN code <> 'PL' THEN code END AS country, year, landings FROM (
    SELECT {STOCK} AS stock, {choose(('27.3.a', '27.4', '27.7.de'), AREA_NO + ' % 3')} AS area,
      {choose(data.NATION_CODES, 'n_nationkey')} AS code, year(l_shipdate)::INTEGER AS year,
      CASE WHEN l_quantity <> 13 THEN l_quantity / 2 END AS landings
    FROM lineitem {NATION})
), summary AS (
  SELECT stock, year, country, area, coalesce(sum(landings), 0.0) AS landings FROM official GROUP BY ALL
)"""

QUOTA = """
yearly AS (SELECT year(o_orderdate)::INTEGER AS year, count(*)::DOUBLE AS tac FROM orders GROUP BY ALL),
quota AS (
  SELECT CASE WHEN year IN (1997, 2000) THEN year - 100 ELSE year END AS year, tac FROM yearly
  UNION ALL SELECT 2030, tac FROM yearly WHERE year = 1995
)"""

RAISING = """
strata AS (
  SELECT 'S' || (user_id % 3) AS stock, CASE WHEN user_id % 11 <> 5 THEN 'g' || (user_id % 11) END AS "group",
    CASE WHEN event_type = 'error' THEN 'MIS' ELSE 'TBB' END AS gear_group,
    CASE WHEN event_type = 'signup' THEN 'Discards' ELSE 'Landings' END AS category,
    (event_id % 3 + 1)::INTEGER AS "count",
    CASE WHEN user_id % 11 <> 7 OR event_id % 13 <> 4 THEN floor(value)::DOUBLE END AS caton,
    CASE WHEN event_id % 5 <> 3 THEN (event_id % 64) / 64.0::DOUBLE END AS perc,
    event_id AS ord
  FROM events
), kept AS (
  SELECT *, CASE WHEN "count" = 2 THEN caton END AS weight FROM strata WHERE category <> 'Discards' AND gear_group <> 'MIS'
)"""

EVENT_STOCK = "'S' || CASE WHEN user_id % 3 = 0 THEN user_id + 3 ELSE user_id % 3 END"

SERIES = f"""
series AS (
  SELECT stock, quantity, time, obs, ln(obs) AS est, (1 + n % 7)::DOUBLE AS cv, 0.1::DOUBLE + 0.01::DOUBLE * (n % 7) AS sd,
    time <= 28 AS in_est, 0.25::DOUBLE AS dt
  FROM (
    SELECT {EVENT_STOCK} AS stock, {case('event_type', data.QUANTITIES)} AS quantity,
      day(ts) + floor(hour(ts) / 6) / 4.0::DOUBLE AS time, avg(floor(value) + 1) AS obs, count(*) AS n
    FROM events GROUP BY ALL)
), retro AS (
  SELECT series.*, p.run::INTEGER AS run, obs * (1 + p.run / 7.0::DOUBLE) AS nat
  FROM series CROSS JOIN (SELECT unnest(range(0, 6)) AS run) p WHERE floor(time) <= 30 - p.run
)"""

INDEX = f"""
idx AS (
  SELECT stock, "index", time, CASE WHEN NOT (stock = 'S2' AND "index" = 'hist' AND time = 3) THEN obs END AS obs,
    (1 + n % 7)::DOUBLE AS cv
  FROM (
    SELECT {EVENT_STOCK} AS stock,
      CASE WHEN event_type IN ('view', 'click') THEN 'sem1' WHEN event_type IN ('signup', 'error') THEN 'sem2' ELSE 'hist' END
        AS "index",
      day(ts)::DOUBLE AS time, avg(floor(value) + 1) AS obs, count(*) AS n
    FROM events GROUP BY ALL)
), means AS (
  SELECT stock, "index", CASE WHEN bool_and(obs IS NOT NULL) THEN avg(obs) END AS m, avg(cv) AS mcv FROM idx GROUP BY ALL
), normal AS (
  SELECT idx.*, obs / m AS normalized, cv / mcv AS stdevfac FROM idx JOIN means USING (stock, "index")
), peels AS (
  SELECT stock, p.peel::INTEGER AS peel, CASE WHEN "index" = 'sem1' THEN 1 ELSE 2 END AS semester, time,
    obs * (1 + p.peel / 7.0::DOUBLE) AS obs, cv
  FROM idx CROSS JOIN (SELECT unnest(range(0, 6)) AS peel) p WHERE "index" <> 'hist' AND time <= 30 - p.peel
)"""

DAILY = f"""
daily AS (
  SELECT {EVENT_STOCK} AS stock, day(ts)::INTEGER AS year, count(*)::DOUBLE AS landings FROM events GROUP BY ALL
)"""

OVERVIEW = f"""
over AS (
  SELECT stock, CASE WHEN country <> 'Ys' THEN country END AS country, substr(area, 1, 4) AS area, season,
    substr(fleet, 1, 3) AS fleet, category, origin, sum(caton) AS catch_wt
  FROM catch GROUP BY ALL
), prepared AS (
  SELECT stock, country, area, season, fleet, origin, catch_wt,
    substr(CASE WHEN category = '{codes.BMS}' THEN 'Discards' ELSE category END, 1, 1) AS category
  FROM over WHERE category <> '{codes.LOGBOOK}'
), sampled_sums AS (
  SELECT stock, CASE WHEN country <> 'Ys' THEN country END AS country, substr(area, 1, 4) AS area, season,
    CASE WHEN origin = 'Imported_Data' AND length >= 20 THEN substr(fleet, 1, 3) ELSE 'none' END AS fleet,
    substr(category, 1, 1) AS category, length, sum(weight) AS w
  FROM catch GROUP BY ALL
), numbers AS (
  SELECT *, CASE WHEN length <> 30 THEN w END AS sampled_catch FROM sampled_sums
), joined AS (
  SELECT p.*, n.length, n.sampled_catch, n.sampled_catch IS NOT NULL AS sampled
  FROM prepared p LEFT JOIN numbers n ON p.stock = n.stock AND p.country IS NOT DISTINCT FROM n.country
    AND p.area = n.area AND p.season = n.season AND p.fleet = n.fleet AND p.category = n.category
)"""

LANDED = f"""
CASE WHEN country IN ('GB') THEN 'UK' ELSE country END AS country"""

PRELIM_CLEAN = f"""
  SELECT {{keys}}'BLL' AS species, {case('area', codes.PRELIMINARY_AREAS)} AS area, 'TLW' AS units,
    CASE WHEN country = 'GB' THEN 'UK' ELSE country END AS country, year, coalesce(sum(ams), 0.0) + coalesce(sum(bms), 0.0) AS landings
  FROM prelim WHERE species_latin = 'Scophthalmus rhombus' AND area IN {items(tuple(codes.PRELIMINARY_AREAS))}
  GROUP BY {{groups}}2, 4, year"""
PRELIM_BY_STOCK = PRELIM_CLEAN.format(keys="stock, ", groups="stock, ").replace("GROUP BY stock, 2, 4", "GROUP BY stock, 3, 5")
PRELIM_PLAIN = PRELIM_CLEAN.format(keys="", groups="")

HIST_CLEAN = f"""
  SELECT 'BLL' AS species, {case('division', codes.DIVISIONS)} AS area, 'TLW' AS units,
    {case('country', codes.COUNTRY_NAMES)} AS country, year, sum(value) AS landings
  FROM hist WHERE species = 'Brill' AND division IN {items(tuple(codes.DIVISIONS))} AND year BETWEEN 1996 AND 2000
  GROUP BY 2, 4, year HAVING sum(value) > 0"""

KNOWN = {c: c for c in dict.fromkeys(codes.COUNTRY_NAMES.values())}
DATASET_CLEAN = f"""
  SELECT species, {case('area', codes.AREA_GROUPS)} AS area, units,
    {case("(CASE WHEN country IN ('GB', 'IM') THEN 'UK' ELSE country END)", KNOWN)} AS country, year,
    coalesce(sum(value), 0.0) AS landings
  FROM dataset WHERE species = 'BLL' AND area IN {items(codes.DATASET_AREAS)} GROUP BY 1, 2, 3, 4, 5"""


def clean(ctes: str, body: str, keys: str = "") -> str:
    return f"WITH {ctes} SELECT {keys}species, area, units, country, year, {r('landings', 'landings')} FROM ({body})"


add("landings_two_measure_sum", clean(PRELIM, PRELIM_BY_STOCK, "stock, "))
add("bms_by_area", f"""
WITH {PRELIM} SELECT stock, year, CASE WHEN country = 'GB' THEN 'UK' ELSE country END AS country, area, {r(nsum('bms'), 'bms')}
FROM prelim WHERE species_latin = 'Scophthalmus rhombus' AND area IN {items(tuple(codes.PRELIMINARY_AREAS))} GROUP BY 1, 2, 3, 4
""")
add("hist_landings_unpivot", clean(HIST, HIST_CLEAN))
add("official_landings_recode", clean(DATASET, DATASET_CLEAN))
add("official_union", clean(
    f"{DATASET}, {HIST}, {PRELIM}", f"({DATASET_CLEAN}) UNION ALL ({HIST_CLEAN}) UNION ALL ({PRELIM_PLAIN})"
))
RANKS = {c: i for i, c in enumerate(KNOWN)}
add("code_harmonise", f"""
WITH {CATCH}, coded AS (
  SELECT {case('country', codes.COUNTRY_NAMES)} AS country, {case('country', codes.REPORT_COUNTRIES)} AS report_country,
    {case('area', codes.AREA_GROUPS)} AS area,
    {case(choose(tuple(codes.GEAR_GROUPS), 'season * 3 - 1'), codes.GEAR_GROUPS)} AS gear_group, caton
  FROM catch)
SELECT country, (CASE {' '.join(f"WHEN country = '{c}' THEN {i}" for c, i in RANKS.items())} END)::INTEGER AS country_rank,
  report_country, {case('country', codes.ISLANDS_TO_UK)} AS country_ol, area, gear_group,
  count(*) AS n_rows, {r('sum(caton)', 'caton_sum')}
FROM coded GROUP BY ALL
""")

# Catch composition

TOTAL = "(discards + landings)"
DETAIL = f"""
sums AS (
  SELECT stock, year, area, country, {psum('caton', "category = 'Discards'")} AS discards,
    {psum('caton', "category = 'Landings'")} AS landings
  FROM catch WHERE category IS NULL OR category NOT IN ('{codes.LOGBOOK}', '{codes.BMS}') GROUP BY stock, year, area, country
), detail AS (
  SELECT stock, year, {case('area', codes.DETAILED_AREAS)} AS area, {case('country', codes.COUNTRY_NAMES)} AS country,
    discards, landings, {TOTAL} AS total,
    CASE WHEN {TOTAL} > 0 THEN {ratio('discards', 'landings + discards')} * 100 WHEN {TOTAL} <= 0 THEN 0.0 END AS discard_ratio,
    CASE WHEN {TOTAL} > 0 THEN {ratio('discards', 'landings')} WHEN {TOTAL} <= 0 THEN 0.0 END AS dl_ratio
  FROM sums
), totals AS (
  SELECT stock, year, coalesce(sum(discards), 0.0) AS discards, coalesce(sum(landings), 0.0) AS landings,
    coalesce(sum(total), 0.0) AS total
  FROM detail GROUP BY stock, year
), both_parts AS (
  SELECT * FROM detail UNION ALL
  SELECT stock, year, 'Total', NULL, discards, landings, total, {ratio('discards', 'landings + discards')} * 100,
    CASE WHEN total > 0 THEN {ratio('discards', 'landings')} ELSE 0.0 END
  FROM totals
)"""
MEASURES = ("discards", "landings", "total", "discard_ratio", "dl_ratio")
add("catch_category_table", f"""
WITH {CATCH}, {DETAIL} SELECT stock, year, area, country, {', '.join(r(m, m) for m in MEASURES)} FROM both_parts
""")
add("catches_detail", f"""
WITH {CATCH}, {DETAIL} SELECT stock, 'BLL' AS species, area, 'TLW' AS units, country, year, {r('landings', 'landings')},
  {r('discards', 'discards')} FROM detail WHERE area <> 'Total'
""")
add("discard_measures_long", f"""
WITH {CATCH}, {DETAIL} SELECT stock, year, area, country, variable, {r('value', 'value')}
FROM both_parts UNPIVOT INCLUDE NULLS (value FOR variable IN ({', '.join(MEASURES)}))
""")


def share(within: str, by: str, label: str, out: str = "catch", where: str = "true", after: str = "true") -> str:
    """Poisoned sums and their percent of the ``within`` total."""
    return f"""
WITH {CATCH}, sums AS (SELECT {within}, {by} AS {label}, {psum('caton')} AS s FROM catch WHERE {where} GROUP BY ALL),
shares AS (SELECT *, (CASE WHEN bool_and(s IS NOT NULL) OVER w THEN sum(s) OVER w END) AS t FROM sums
  WINDOW w AS (PARTITION BY {within}))
SELECT {within}, {label}, {r('s', out)}, {r(ratio('s', 't') + ' * 100', 'perc')} FROM shares WHERE {after}
"""


add("gear_share", share("stock, year, season", "substr(fleet, 1, 3)", "gear"))
add("gear_fine_share", share("stock, year, season", "substr(fleet, 1, 7)", "gear"))
add("season_share", share("stock, year, area", "season", "season"))
add("country_area_share", share("stock, year, country", "area", "area", "landings", "category = 'Landings'"))
add("discard_ratio_gear", share(
    "stock, year, area, gear", "category", "category", "caton_sum", after="category = 'Discards'"
).replace("FROM catch WHERE", "FROM (SELECT *, substr(fleet, 1, 3) AS gear FROM catch) WHERE"))
add("origin_sums", f"""
WITH {CATCH} SELECT stock, year, season, area, origin, {r(psum('caton'), 'caton_sum')} FROM catch GROUP BY ALL
""")
add("raise_percent", f"""
WITH {RAISING}, g AS (
  SELECT stock, "group", sum(perc * weight) FILTER ("count" = 2 AND perc IS NOT NULL) AS n,
    sum(weight) FILTER ("count" = 2 AND perc IS NOT NULL) AS d,
    count(*) FILTER ("count" = 2 AND perc IS NOT NULL AND weight IS NULL) AS bad
  FROM kept GROUP BY ALL)
SELECT k.stock, k."group", gear_group, category, "count", {r('caton', 'caton')}, {r('perc', 'perc')}, ord, {r('weight', 'weight')},
  {r(f'''CASE WHEN "count" = 1 AND bad = 0 THEN {ratio('n', 'd')} END''', 'percraise')}
FROM kept k JOIN g ON k.stock = g.stock AND k."group" IS NOT DISTINCT FROM g."group"
""")


def listed(x: str) -> str:
    return f"coalesce(regexp_replace({x}::VARCHAR, '\\.0$', ''), 'NA')"


add("raise_lists", f"""
WITH {RAISING}, g AS (SELECT DISTINCT stock, "group" FROM kept WHERE "count" = 1)
SELECT k.stock, k."group", ord, {listed('perc')} AS percraise_includes, {listed('weight')} AS percraise_weights
FROM kept k JOIN g ON k.stock = g.stock AND k."group" IS NOT DISTINCT FROM g."group"
""")
add("landings_with_discards", f"""
WITH {CATCH}, lines AS (
  SELECT DISTINCT stock, year, country, area, season, fleet, category, origin,
    CASE WHEN year = 1999 THEN caton ELSE weight END / 1000 AS caton
  FROM catch),
covered AS (
  SELECT DISTINCT stock, year, country, area, season, fleet FROM lines
  WHERE origin = 'Imported_Data' AND category = 'Discards'),
landed AS (
  SELECT l.stock, l.year, l.caton, c.stock IS NOT NULL AS hit
  FROM (SELECT * FROM lines WHERE category = 'Landings') l LEFT JOIN covered c USING (stock, year, country, area, season, fleet))
SELECT stock, year, {r(f"CASE WHEN bool_and(caton IS NOT NULL) THEN {ratio('coalesce(sum(caton) FILTER (hit), 0)', 'sum(caton)')} * 100 END",
                       'perc_landings_with_discards')}
FROM landed GROUP BY ALL
""")
add("unique_codes", f"""
WITH {CATCH}, coded AS (
  SELECT stock, year, area, CASE WHEN area <> '27.2.a' THEN {case('country', codes.COUNTRY_NAMES)} END AS country FROM catch),
u AS (SELECT DISTINCT * FROM coded)
SELECT * FROM u WHERE country IS NOT NULL UNION ALL
SELECT stock, year, area, NULL FROM u GROUP BY stock, year, area HAVING count(country) = 0
""")
add("text_numbers", r"""
WITH parts AS (
  SELECT doc_id, [CASE WHEN regexp_matches(x, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')
      THEN try_cast(regexp_replace(x, '\s', '', 'g') AS DOUBLE) END
    FOR x IN pieces[1:len(pieces) - (len(pieces) > 0 AND pieces[-1] = '')::INT]] AS numbers
  FROM (SELECT doc_id, string_split_regex(replace("text", ',', ''), '[ \t]+') AS pieces FROM documents))
SELECT doc_id, len(numbers) AS n_tokens, list_count(numbers)::BIGINT AS n_numbers,
  round(list_max(numbers), 6) + 0.0 AS largest, round(list_min(numbers), 6) + 0.0 AS smallest
FROM parts
""")

# Sampling coverage

add("overview_join", f"""
WITH {CATCH}, {OVERVIEW} SELECT stock, area, season, fleet, country, category, origin, {r('catch_wt', 'catch_wt')}, length,
  {r('sampled_catch', 'sampled_catch')}, sampled FROM joined
""")
add("overview_exclusions", f"""
WITH {CATCH}, {OVERVIEW} SELECT stock, {r(nsum('catch_wt', f"category = '{codes.LOGBOOK}'"), 'logbook_excluded')},
  {r(nsum('catch_wt', f"category = '{codes.BMS}'"), 'bms_recategorised')} FROM over GROUP BY stock
""")


def strata(dims: str, letter: str) -> str:
    known = " AND ".join(f"{d.strip()} IS NOT NULL" for d in dims.split(","))
    return (f"WITH {CATCH}, {OVERVIEW}, strata AS (SELECT stock, {dims}, {psum('catch_wt')} AS w "
            f"FROM joined WHERE category = '{letter}' AND {known} GROUP BY ALL)")


add("stratum_weights", f"""
{strata('fleet, country, sampled', 'L')} SELECT stock, fleet, country, sampled, {r('w', 'land_wt')} FROM strata
""")
add("stratum_discard_weights", f"""
{strata('fleet, season, sampled', 'D')} SELECT stock, fleet, season, sampled,
  {r('w', 'dis_wt')}, {r('CASE WHEN w IS NOT NULL THEN least(w, 900 * 1.06::DOUBLE) END', 'dis_wt_capped')} FROM strata
""")
add("stratum_percent_cumulative", f"""
{strata('fleet, country, season, area, sampled', 'L')}, p AS (
  SELECT *, sum(w) OVER (PARTITION BY stock, area, season) AS t,
    CASE WHEN bool_and(w IS NOT NULL) OVER run THEN sum(w) OVER run END AS c
  FROM strata WINDOW run AS (PARTITION BY stock, area, season
    ORDER BY sampled DESC, w DESC NULLS FIRST, area DESC, season DESC, country DESC, fleet DESC ROWS UNBOUNDED PRECEDING))
SELECT stock, fleet, country, season, area, sampled, {r('w', 'land_wt')},
  {r(ratio('100 * w', 't'), 'percent')},
  {r(f"CASE WHEN w IS NOT NULL THEN least({ratio('100 * w', 't')}, 10 * 1.06::DOUBLE) END", 'percent_capped')},
  {r(ratio('100 * c', 't'), 'cumulative')} FROM p
""")
add("stratum_percent_overall", f"""
{strata('country, season', 'L')}, p AS (
  SELECT *, sum(w) OVER (PARTITION BY stock) AS t, CASE WHEN bool_and(w IS NOT NULL) OVER run THEN sum(w) OVER run END AS c
  FROM strata WINDOW run AS (PARTITION BY stock, season ORDER BY w DESC NULLS FIRST, season DESC, country DESC
    ROWS UNBOUNDED PRECEDING))
SELECT stock, country, season, {r('w', 'land_wt')}, {r(ratio('100 * w', 't'), 'percent')}, {r(ratio('100 * c', 't'), 'cumulative')}
FROM p
""")
add("stratum_discard_ratio", f"""
WITH {CATCH}, {OVERVIEW},
d AS (SELECT stock, fleet, country, area, sampled, {psum('catch_wt')} AS w FROM joined
  WHERE category = 'D' AND country IS NOT NULL GROUP BY ALL),
l AS (SELECT stock, fleet, country, area, sampled, {psum('catch_wt')} AS w FROM joined
  WHERE category = 'L' AND country IS NOT NULL GROUP BY ALL)
SELECT * FROM (
  SELECT stock, fleet, country, area, d.sampled AS sampled_d, l.sampled AS sampled_l, {r(ratio('d.w', 'd.w + l.w'), 'd_ratio')}
  FROM d FULL JOIN l USING (stock, fleet, country, area)) WHERE d_ratio IS NOT NULL
""")
add("sampled_discard_ratio", f"""
WITH {CATCH}, {OVERVIEW},
d AS (SELECT stock, sampled, {psum('catch_wt')} AS w FROM joined WHERE category = 'D' GROUP BY ALL),
l AS (SELECT stock, sampled, {psum('catch_wt')} AS w FROM joined WHERE category = 'L' GROUP BY ALL)
SELECT * FROM (
  SELECT stock, d.sampled AS sampled_d, l.sampled AS sampled_l, {r(ratio('d.w', 'd.w + l.w'), 'd_ratio')}
  FROM d FULL JOIN l USING (stock)) WHERE d_ratio IS NOT NULL
""")
add("stratum_discards_provided", f"""
WITH {CATCH}, {OVERVIEW},
known AS (SELECT * FROM joined WHERE country IS NOT NULL),
d AS (SELECT stock, fleet, country, season, area, {psum('catch_wt')} AS w FROM known WHERE category = 'D' GROUP BY ALL),
l AS (SELECT stock, fleet, country, season, area, {psum('catch_wt')} AS w FROM known WHERE category = 'L' GROUP BY ALL)
SELECT DISTINCT stock, fleet, country, season, area, {ratio('d.w', 'd.w + l.w')} IS NOT NULL AS provided, {r('l.w', 'land_wt')}
FROM d FULL JOIN l USING (stock, fleet, country, season, area)
""")

# Length frequencies

LENGTH_CELLS = f"""
cells AS (
  SELECT i.year, i.fleet, i.category, n.length, c.k
  FROM (SELECT DISTINCT year, fleet, category FROM catch) i CROSS JOIN (SELECT unnest(range(0, 60, 10))::INTEGER AS length) n
  LEFT JOIN (SELECT year, fleet, category, length, count(*)::DOUBLE AS k FROM catch GROUP BY ALL) c
    ON c.year = i.year AND c.fleet = i.fleet AND c.category = i.category AND c.length = n.length
)"""
LENGTH_GEAR = f"""
WITH {CATCH}, {LENGTH_CELLS} SELECT year, category, substr(fleet, 1, 3) AS gear, length, {r(psum('k'), 'freq')} FROM cells
WHERE category IN ('Discards', 'Landings') GROUP BY ALL
"""
add("length_freq", f"WITH {CATCH}, {LENGTH_CELLS} SELECT year, length, {r(psum('k'), 'freq')} FROM cells GROUP BY year, length")
add("length_freq_cat", f"""
WITH {CATCH}, {LENGTH_CELLS} SELECT year, category, length, {r(psum('k'), 'freq')} FROM cells
WHERE category IN ('Discards', 'Landings') GROUP BY ALL
""")
add("length_freq_cat_gear", LENGTH_GEAR)


def profiled(name: str, x: str) -> str:
    parts = [r(f"quantile_cont({x}, {q}::DOUBLE)", n) for n, q in
             (("min", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1))]
    return (f"SELECT '{name}' AS \"column\", {', '.join(parts)}, {r(f'avg({x})', 'mean')}, "
            f"count(*) - count({x}) AS n_missing FROM lineitem")


add("column_profile", " UNION ALL ".join([
    profiled("l_quantity", "l_quantity"), profiled("l_extendedprice", "l_extendedprice"),
    profiled("l_discount", "nullif(l_discount, 0.05::DOUBLE)"),
]))

# Catch series and quota uptake

SPLICE = f"""
early AS (SELECT stock, year, {psum('landings')} AS landings FROM official WHERE year < 1998 GROUP BY stock, year),
late AS (SELECT stock, year, coalesce(sum(landings / 1000), 0.0) AS landings, coalesce(sum(discards / 1000), 0.0) AS discards
  FROM detail WHERE area <> 'Total' AND year >= 1998 GROUP BY stock, year),
spliced AS (SELECT stock, year, landings, NULL::DOUBLE AS discards FROM early UNION ALL SELECT * FROM late)"""
add("catch_series_splice", f"""
WITH {CATCH}, {DETAIL}, {OFFICIAL}, {SPLICE}
SELECT stock, year, {r('landings', 'landings')}, {r('discards', 'discards')}, {r('landings + discards', 'total')} FROM spliced
""")


def pair(table: str, column: str, names: Mapping[str, str], value: str, where: str) -> str:
    cells = ", ".join(f"{cell(value, f'{column} = {text(v)}')} AS {k}" for k, v in names.items())
    return f"SELECT year, {cells} FROM {table} WHERE {column} IN {items(tuple(names.values()))} AND {where} GROUP BY year"


AMS_BMS = ", ".join(
    f"""{psum('ams', f"species_latin = '{v}'")} + {nsum('bms', f"species_latin = '{v}'")} AS {k}"""
    for k, v in codes.SPECIES_LATIN.items()
)
TWO = f"""
pairs AS (
  {pair('hist', 'species', codes.SPECIES_RAW, 'value', f'year BETWEEN 1995 AND 1996 AND division IN {items(codes.QUOTA_DIVISIONS)}')}
  UNION ALL
  {pair('dataset', 'species', codes.SPECIES_CODES, 'value', f'year BETWEEN 1997 AND 1999 AND area IN {items(codes.QUOTA_DATASET_AREAS)}')}
  UNION ALL
  SELECT year, {AMS_BMS} FROM prelim WHERE species_latin IN {items(tuple(codes.SPECIES_LATIN.values()))}
    AND year >= 2000 AND area IN {items(codes.QUOTA_PRELIMINARY_AREAS)} GROUP BY year
), two AS (SELECT year, brill, turbot, brill + turbot AS total FROM pairs)"""
add("two_species_wide", f"""
WITH {HIST}, {DATASET}, {PRELIM}, {TWO} SELECT year, {r('brill', 'brill')}, {r('turbot', 'turbot')}, {r('total', 'total')} FROM two
""")
UPTAKE = r(f"CASE WHEN total IS NOT NULL THEN {ratio('total', 'tac')} * 100 END", "uptake")
add("quota_uptake", f"""
WITH {HIST}, {DATASET}, {PRELIM}, {TWO}, {QUOTA}
SELECT coalesce(two.year, quota.year) AS year, {r('brill', 'brill')}, {r('turbot', 'turbot')}, {r('total', 'total')},
  {r('tac', 'tac')}, {UPTAKE}
FROM two FULL JOIN quota ON two.year IS NOT DISTINCT FROM quota.year
""")
add("quota_uptake_all", f"""
WITH {PRELIM}, {QUOTA}, yearly_total AS (
  SELECT year, {psum('ams')} + {nsum('bms')} AS total
  FROM (SELECT * REPLACE (CASE WHEN ams IS NULL AND year <> 1996 THEN 0.0 ELSE ams END AS ams) FROM prelim)
  WHERE species_latin = 'Scophthalmus rhombus' AND area IN {items(codes.COMBINED_QUOTA_AREAS)}
  GROUP BY year)
SELECT coalesce(t.year, q.year) AS year, {r('total', 'total')}, {r('tac', 'tac')}, {UPTAKE}
FROM yearly_total t FULL JOIN quota q ON t.year = q.year
""")

# Report tables


def by_country(area: str, columns: Sequence[str], extra: str = "") -> str:
    sums = ", ".join(f"sum(landings) FILTER (country = '{c}') AS {c.lower()}_" for c in columns)
    return (f"wide AS (SELECT stock, year, {sums}, sum(landings) AS every{extra} FROM summary "
            f"WHERE area = '{area}' GROUP BY stock, year)")


def z(c: str) -> str:
    return f"coalesce({c.lower()}_, 0)"


def cells(values: Mapping[str, str]) -> str:
    return ", ".join(f"round_even(({v})::DOUBLE, 0)::DOUBLE + 0.0 AS \"{k}\"" for k, v in values.items())


REST = ", sum(landings) FILTER (country IS NULL OR country NOT IN ('UK', 'IE')) AS rest"
for _name, _uk in (("table_poison", "coalesce(uk_ + ie_, 0)"), ("table_poison_safe", f"{z('UK')} + {z('IE')}")):
    _shown = {c: z(c) for c in ("BE", "DE", "DK", "NL", "NO", "SE")}
    add(_name, f"""
WITH {OFFICIAL}, {by_country('27.3.a', ('BE', 'DE', 'DK', 'NL', 'NO', 'SE', 'UK', 'IE'), REST)}
SELECT stock, year, {cells({**_shown, 'UK': _uk, 'total': f'coalesce(rest, 0) + {_uk}'})} FROM wide
""")
_c4 = ("BE", "DE", "DK", "FR", "UK", "NL", "NO", "SE")
add("table_total_first", f"""
WITH {OFFICIAL}, {by_country('27.4', (*_c4, 'GG', 'IE', 'IM'))}
SELECT stock, year, {cells({**{c: z(c) for c in _c4}, 'UK': ' + '.join(z(c) for c in ('GG', 'IE', 'IM', 'UK')), 'total': 'every'})}
FROM wide
""")
_c7 = ("BE", "DE", "DK", "FR", "UK", "IE", "NL", "CI")
_v7 = {**{c: z(c) for c in _c7}, "CI": " + ".join(z(c) for c in ("CI", "GG", "JE"))}
add("table_explicit_total", f"""
WITH {OFFICIAL}, {by_country('27.7.de', (*_c7, 'GG', 'JE'))}
SELECT stock, year, {cells({**_v7, 'total': ' + '.join(_v7.values())})} FROM wide
""")
add("landings_summary", f"WITH {OFFICIAL} SELECT stock, year, country, area, {r('landings', 'landings')} FROM summary")
for _by in ("area", "country"):
    add(f"{_by}_share_year", f"""
WITH {OFFICIAL}, s AS (SELECT stock, year, {_by}, sum(landings) AS l FROM summary GROUP BY ALL)
SELECT stock, year, {_by}, {r('l', 'landings')}, {r(ratio('100 * l', 'sum(l) OVER (PARTITION BY stock, year)'), 'perc')} FROM s
""")
Z95 = "1.959963984540054::DOUBLE"


def at_start(quantity: str, sign: str, name: str) -> str:
    band = f" {sign} {Z95} * sd" if sign else ""
    return r(f"max(exp(est{band})) FILTER (quantity = '{quantity}' AND time = floor(time))", name)


add("assessment_summary", f"""
WITH {SERIES}, {DAILY}, y AS (
  SELECT stock, floor(time)::INTEGER AS year,
    {at_start('logFFmsy', '', 'FishingPressure')}, {at_start('logFFmsy', '-', 'Low_FishingPressure')},
    {at_start('logFFmsy', '+', 'High_FishingPressure')}, {at_start('logBBmsy', '', 'StockSize')},
    {at_start('logBBmsy', '-', 'Low_StockSize')}, {at_start('logBBmsy', '+', 'High_StockSize')}
  FROM series WHERE in_est AND quantity IN ('logFFmsy', 'logBBmsy') GROUP BY stock, floor(time))
SELECT y.stock, y.year AS "Year", d.landings AS "Landings", 0.0::DOUBLE AS "Discards", FishingPressure, Low_FishingPressure,
  High_FishingPressure, StockSize, Low_StockSize, High_StockSize
FROM y LEFT JOIN daily d ON d.stock = y.stock AND d.year = y.year
""")

# Indices and model input

add("index_normalised", f"""
WITH {INDEX} SELECT stock, "index", time, {r('obs', 'obs')}, cv, {r('normalized', 'normalized')} FROM normal
""")
COMBINED = """
combined AS (
  SELECT stock, CASE "index" WHEN 'sem1' THEN 'Comb.idx.Sem.1' WHEN 'sem2' THEN 'Comb.idx.Sem.2' ELSE 'Hist.idx.Q1' END AS "index",
    CASE WHEN "index" = 'sem2' THEN time + 0.5 ELSE time END AS time, obs, cv, normalized
  FROM normal)"""
add("index_combined", f"""
WITH {INDEX}, {COMBINED} SELECT stock, "index", {r('time', 'time')}, {r('obs', 'obs')}, cv, {r('normalized', 'normalized')} FROM combined
""")
add("index_band", f"""
WITH {INDEX}, {COMBINED}, sd AS (
  SELECT stock, CASE WHEN bool_and(normalized IS NOT NULL) THEN stddev_samp(normalized) END AS sd FROM combined GROUP BY stock)
SELECT stock, "index", {r('time', 'time')}, {r('obs', 'obs')}, cv, {r('normalized', 'normalized')},
  {r('normalized - sd', 'lower')}, {r('normalized + sd', 'upper')} FROM combined JOIN sd USING (stock)
""")
# Files hold the same rows: the run over them gives the same table.
add("index_files", ORACLE["index_band"])
add("index_cv_weight", f"""
WITH {INDEX} SELECT stock, "index", time, {r('obs', 'obs')}, cv, {r('stdevfac', 'stdevfac')} FROM normal
""")
add("catch_weight_step", f"""
WITH {CATCH}, {DETAIL}, {OFFICIAL}, {SPLICE}
SELECT stock, year, {r('landings', 'landings')}, (CASE WHEN year <= 1998 THEN 2 ELSE 1 END)::INTEGER AS stdevfac FROM spliced
""")
add("year_spine", f"""
WITH {OFFICIAL}, ends AS (SELECT stock, area, min(year) AS a, max(year) AS b FROM (
  SELECT stock, area, CASE WHEN year = 1998 THEN 1999 ELSE year END AS year FROM official) GROUP BY stock, area)
SELECT stock, area, unnest(range(a, b + 1))::INTEGER AS year FROM ends
""")
add("management_interval", f"""
WITH {OFFICIAL} SELECT stock, country, min(year) AS first_year, max(year) AS last_year, (max(year) - min(year) + 1)::INTEGER AS n_years,
  (max(year) + 2)::INTEGER AS interval_start, (max(year) + 3)::INTEGER AS interval_end FROM official GROUP BY stock, country
""")
WEIGHT10 = "(CASE WHEN year <= 10 THEN 2 ELSE 1 END)::INTEGER AS stdevfac"
add("model_catch_input", f"""
WITH {DAILY} SELECT stock, year::DOUBLE AS time, landings AS obs, {WEIGHT10} FROM daily
""")
add("model_index_input", f"""
WITH {INDEX} SELECT stock, "index", {r('''CASE WHEN "index" = 'sem2' THEN time + 0.66::DOUBLE ELSE time END''', 'time')},
  {r('obs', 'obs')}, {r('stdevfac', 'stdevfac')} FROM normal
""")
add("retro_catch_input", f"""
WITH {INDEX}, {DAILY}, p AS (SELECT DISTINCT stock, peel FROM peels WHERE semester = 1 AND peel > 0),
own AS (SELECT DISTINCT stock, peel, greatest(time, 12)::INTEGER AS year FROM peels WHERE semester = 1)
SELECT d.stock, p.peel, d.year::DOUBLE AS time, d.landings AS obs, {WEIGHT10} FROM daily d JOIN p ON p.stock = d.stock
WHERE d.year BETWEEN 1 AND 10 OR EXISTS (SELECT 1 FROM own o WHERE o.stock = d.stock AND o.peel = p.peel AND o.year = d.year)
""")
add("retro_index_input", f"""
WITH {INDEX}, p AS (SELECT DISTINCT stock, peel FROM peels WHERE peel > 0), rows_ AS (
  SELECT stock, peel, 'sem' || semester AS "index", CASE WHEN semester = 2 THEN time + 0.66::DOUBLE ELSE time END AS time, obs, cv
  FROM peels WHERE peel > 0 UNION ALL
  SELECT idx.stock, p.peel, 'hist', time, obs, cv FROM idx JOIN p USING (stock) WHERE "index" = 'hist')
SELECT stock, peel, "index", {r('time', 'time')}, {r('obs', 'obs')}, {r('cv / avg(cv) OVER (PARTITION BY stock, peel, "index")', 'stdevfac')}
FROM rows_
""")
add("retro_aligned", f"""
WITH {INDEX}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY stock, peel ORDER BY time) AS place FROM peels WHERE semester = 2)
SELECT stock, max(time) FILTER (peel = 0) AS time, {r('max(obs) FILTER (peel = 0)', 'base')},
  {', '.join(r(f'max(obs) FILTER (peel = {p})', f'peel{p}') for p in range(1, 6))}
FROM placed GROUP BY stock, place
""")

# Model output

add("mohn_rho", f"""
WITH {SERIES}, ends AS (
  SELECT stock, quantity, run, max(time) AS time, arg_max(nat, time) AS v FROM retro WHERE run > 0 GROUP BY ALL)
SELECT e.stock, e.quantity, {r('avg((e.v - b.nat) / b.nat)', 'rho')}
FROM ends e JOIN retro b ON b.run = 0 AND b.stock = e.stock AND b.quantity = e.quantity AND b.time = e.time GROUP BY ALL
""")
BAD_RUNS = "(run = 2 OR (run = 4 AND stock = 'S1') OR (run = 5 AND stock = 'S2'))"
add("converged_runs", f"""
WITH {SERIES} SELECT stock, run, CASE WHEN run = 0 THEN 'All' ELSE '-' || run END AS label, quantity, time, {r('nat', 'nat')}
FROM retro WHERE NOT {BAD_RUNS}
""")
add("excluded_runs", f"""
WITH {SERIES}, bad AS (SELECT DISTINCT stock, run FROM retro WHERE {BAD_RUNS})
SELECT stock, count(*) AS n_excluded, string_agg(run::VARCHAR, ', ' ORDER BY run) AS excluded FROM bad GROUP BY stock
""")
add("state_ci", f"""
WITH {SERIES} SELECT stock, quantity, time, {r(f'exp(est - {Z95} * sd)', 'lower')}, {r('exp(est)', 'estimate')},
  {r(f'exp(est + {Z95} * sd)', 'upper')}
FROM series WHERE in_est AND quantity IN ('logB', 'logBBmsy', 'logF', 'logFFmsy')
""")
Z35 = "0.3853204664075677::DOUBLE"


def last(quantity: str, sign: str, name: str) -> str:
    hit = f"FILTER (quantity = '{quantity}')"
    return r(f"exp(arg_max_null(est, time) {hit} {sign} {Z35} * (arg_max_null(sd, time) {hit}))", name)


add("fractile_series", f"""
WITH {SERIES} SELECT stock, floor(time)::INTEGER AS year, {last('logBBmsy', '-', '"BBmsy_0.35"')}, {last('logFFmsy', '+', '"FFmsy_0.65"')}
FROM series WHERE quantity IN ('logBBmsy', 'logFFmsy') GROUP BY stock, floor(time)
""")
add("fractile_series_modes", f"""
WITH {SERIES}, picked AS (
  SELECT stock, floor(time)::INTEGER AS year, count(DISTINCT time) AS steps,
    [min_by(est, time), avg(est), sum(est)] AS est, [min_by(sd, time), avg(sd), sum(sd)] AS sd
  FROM series WHERE quantity = 'logBBmsy' GROUP BY stock, floor(time)),
modes AS (SELECT unnest(['first', 'mean', 'sum']) AS mode, unnest([1, 2, 3]) AS i)
SELECT stock, mode, year, {r(f"exp(est[i] - {Z35} * sd[i])", '"BBmsy_0.35"')} FROM picked, modes WHERE steps >= 4
""")
_ZS = ", ".join(f"{NormalDist().inv_cdf(k / 20)!r}::DOUBLE" for k in range(1, 20))
add("fractile_table", f"""
WITH {SERIES}, wanted AS (
  SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'logBBmsy' ELSE 'logFFmsy' END AS quantity, p_size % 19 + 1 AS k FROM part),
yearly AS (
  SELECT stock, quantity, floor(time)::INTEGER AS year, arg_max_null(est, time) AS est, arg_max_null(sd, time) AS sd
  FROM series GROUP BY stock, quantity, floor(time))
SELECT stock, y.quantity, year, {r('k / 20.0::DOUBLE', 'fractile')}, {r(f'exp(est + ([{_ZS}])[k] * sd)', 'value')}
FROM yearly y JOIN wanted w ON y.quantity = w.quantity
""")
add("status_at", f"""
WITH {SERIES} SELECT stock, {r(f"max(exp(est - {Z35} * sd)) FILTER (quantity = 'logBBmsy')", 'bbmsy_last')},
  {r(f"max(exp(est + {Z35} * sd)) FILTER (quantity = 'logFFmsy')", 'ffmsy_last')}
FROM series WHERE time = 20.25 AND quantity IN ('logBBmsy', 'logFFmsy') GROUP BY stock
""")
SCENARIOS = """
ends AS (SELECT stock, max(least(year, 20)) + 2 AS a, max(least(year, 20)) + 3 AS b FROM daily GROUP BY stock),
scen AS (
  SELECT s.stock, c.scenario, max(exp(est - c.shift)) FILTER (quantity = 'logCpred' AND time = a) AS landings_pred,
    max(exp(est - c.shift)) FILTER (quantity = 'logFFmsy' AND time = a) AS ffmsy,
    max(exp(est - c.shift)) FILTER (quantity = 'logBBmsy' AND time = b) AS bbmsy, max(a)::INTEGER AS a, max(b)::INTEGER AS b
  FROM series s JOIN ends USING (stock) CROSS JOIN (VALUES ('base', 0.1::DOUBLE), ('half', 0.7::DOUBLE)) c(scenario, shift)
  GROUP BY s.stock, c.scenario
), k AS (SELECT stock, max(landings) AS last_tac, min(landings) AS last_advice FROM daily GROUP BY stock)"""
add("scenario_inputs", f"""
WITH {SERIES}, {DAILY}, {SCENARIOS} SELECT stock, scenario, {r('landings_pred', 'landings_pred')}, {r('ffmsy', 'ffmsy')},
  {r('bbmsy', 'bbmsy')}, a AS interval_start, b AS interval_end FROM scen
""")
add("advice_line", f"""
WITH {SERIES}, {DAILY}, {SCENARIOS}, v AS (
  SELECT stock, scenario, landings_pred / 87.5 * 100 AS ct, landings_pred, ffmsy, bbmsy, last_tac, last_advice,
    (bbmsy - 40) / bbmsy * 100 AS db, (landings_pred / 87.5 * 100 - last_tac) / last_tac * 100 AS dt,
    (landings_pred / 87.5 * 100 - last_advice) / last_advice * 100 AS da
  FROM scen JOIN k USING (stock))
SELECT stock, scenario, round_even(ct, 0)::DOUBLE AS total_catch, round_even(landings_pred, 0)::DOUBLE AS projected_landings,
  round_even(ct * 12.5 / 100, 0)::DOUBLE AS projected_discards, {r(sig('ffmsy'), 'f_fmsy')}, {r(sig('bbmsy'), 'b_bmsy')},
  {r(sig('db'), 'biomass_change')}, {r(sig('dt'), 'tac_change')}, {r(sig('da'), 'advice_change')}
FROM v
""")
add("annual_stock", f"""
WITH {SERIES}, {DAILY}, step AS (
  SELECT stock, time, max(exp(est)) FILTER (quantity = 'logB') AS b, max(exp(est)) FILTER (quantity = 'logF') AS f
  FROM series WHERE quantity IN ('logB', 'logF') GROUP BY stock, time),
y AS (
  SELECT stock, floor(time)::INTEGER AS year, max(b) FILTER (time = floor(time)) AS biomass,
    CASE WHEN bool_and(f IS NOT NULL) THEN avg(f) END AS harvest, {psum('b * f * 0.25::DOUBLE')} AS catch
  FROM step GROUP BY stock, floor(time)),
d AS (SELECT stock, CASE WHEN year = 7 THEN 107 ELSE year END AS year, landings / 4 AS discards FROM daily)
SELECT y.stock, y.year, {r('biomass', 'biomass')}, {r('biomass', 'stock_n')}, {r('harvest', 'harvest')}, {r('catch', 'catch')},
  {r('discards', 'discards')}, {r('catch - discards', 'landings')}
FROM y LEFT JOIN d ON d.stock = y.stock AND d.year = y.year
""")
add("production_params", f"""
WITH p AS (SELECT 'P' || p_partkey AS stock, p_retailprice AS m, (p_size % 7 + 3) / 2.0::DOUBLE AS n, p_retailprice * p_size AS k, p_size
  FROM part)
SELECT stock, {r('m * pow(n, n / (n - 1)) / k', 'r')}, {r('k', 'k')}, {r('n - 1', 'p')}, 0.5::DOUBLE AS fmsy, {r('m', 'bmsy')},
  p_size::DOUBLE AS msy FROM p
""")
_PRICE = "(o_totalprice * CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END)"
add("sig_round", f"""
SELECT o_orderkey, {r(_PRICE, 'price')}, {r(sig(_PRICE), 'price_advice')}, {r(sig('(o_totalprice / 100000000)'), 'small_advice')} FROM orders
""")

# The same results when the input goes through files

add("csv_na_token", clean(DATASET, DATASET_CLEAN))
add("historical_csv_scan", clean(HIST, HIST_CLEAN))
add("schema_drift", clean(PRELIM, PRELIM_PLAIN))
add("skip_lines_scan", LENGTH_GEAR)
add("sectioned_report_scan", f"""
WITH {CATCH}, strata AS (
  SELECT stock, year, country, area, season, substr(fleet, 1, 3) AS gear, category, origin, sum(weight) AS w FROM catch GROUP BY ALL),
flagged AS (
  SELECT *, bool_or(category = 'Discards' AND origin = 'Imported_Data') OVER (PARTITION BY stock, year, country, area, season, gear) AS hit
  FROM strata)
SELECT stock, year, {r("coalesce(sum(w) FILTER (hit), 0) / sum(w) * 100", 'perc_landings_with_discards')}
FROM flagged WHERE category = 'Landings' GROUP BY stock, year
""")
add("tsv_overview_scan", f"""
{strata('fleet, area, sampled', 'L')} SELECT stock, fleet, area, sampled, {r('w', 'land_wt')} FROM strata
""")
add("clean_table_scan", f"""
WITH {INDEX} SELECT time, {r('obs', 'obs')}, cv, stock, "index", {r('normalized', 'normalized')} FROM normal
""")
add("quoted_csv_sink", ORACLE["catch_category_table"])
add("mixed_header_scan", ORACLE["historical_csv_scan"])
add("detailed_tsv_scan", f"SELECT * REPLACE (season::VARCHAR AS season) FROM ({ORACLE['origin_sums']})")
add("table_sink", share("stock, year, area", "season", "season", where="year > 1997"))
add("quoted_cells_scan", f"""
WITH {CATCH} SELECT '"' || country || '", "' || area || '"' || chr(10) || stock || ',' || chr(10) || chr(10) || 'end' AS name, year,
  count(*) AS n, {r('coalesce(sum(caton), 0.0)', 'caton')} FROM catch GROUP BY ALL
""")
add("report_parts", f"""
WITH {OFFICIAL} SELECT stock, year, country, area, {r('landings', 'landings')},
  row_number() OVER (ORDER BY area, country NULLS LAST, year DESC, stock) - 1 AS place FROM summary
""")
add("yearly_refresh", ORACLE["schema_drift"])

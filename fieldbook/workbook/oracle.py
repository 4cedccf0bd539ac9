"""SQL counterparts of the registered queries, written from the definitions for DuckDB.

Each statement starts from the shared table expressions below; an engine evaluates only the ones a
statement reaches.
"""

from __future__ import annotations

# ---- fixed values, written out here so that a wrong one in the package shows up as a difference
SEGMENTS = ("tot", "res", "sex", "agecat", "county")
SEGMENT_LABELS = {"tot": "All", "res": "Residency", "sex": "Gender", "agecat": "Age", "county": "County", "month": "month"}
YEAR_CHANGE_PARTICIPANTS = {"tot": 20, "res": 35, "sex": 35, "agecat": 35, "county": 70}
YEAR_CHANGE_RECRUITS = {"tot": 30, "res": 45, "sex": 45, "agecat": 45, "county": 150}
_CENSUS_GROUPS = """
  (0, 4, 'Under 5 years'), (5, 9, '5 to 9 years'), (10, 14, '10 to 14 years'), (15, 17, '15 to 17 years'),
  (18, 19, '18 and 19 years'), (20, 20, '20 years'), (21, 21, '21 years'), (22, 24, '22 to 24 years'),
  (25, 29, '25 to 29 years'), (30, 34, '30 to 34 years'), (35, 39, '35 to 39 years'), (40, 44, '40 to 44 years'),
  (45, 49, '45 to 49 years'), (50, 54, '50 to 54 years'), (55, 59, '55 to 59 years'), (60, 61, '60 and 61 years'),
  (62, 64, '62 to 64 years'), (65, 66, '65 and 66 years'), (67, 69, '67 to 69 years'), (70, 74, '70 to 74 years'),
  (75, 79, '75 to 79 years'), (80, 84, '80 to 84 years'), (85, 100, '85 years and over')
"""
_AGES = f"SELECT unnest(range(low, high + 1)), label FROM (VALUES {_CENSUS_GROUPS}) g(low, high, label)"

TABLES = f"""
cust AS (
  SELECT c_custkey AS cust_id,
    CAST(CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 2 = 1 THEN 1 ELSE 2 END AS INTEGER) AS sex,
    CAST(CASE WHEN c_custkey % 30 = 3 THEN NULL ELSE 1930 + (c_custkey * 7) % 75 END AS INTEGER) AS birth_year,
    CAST(CASE WHEN c_custkey % 25 = 4 THEN NULL
      ELSE (CASE WHEN c_nationkey < 22 THEN 19000 ELSE 55000 END) + 1 + 2 * c_nationkey END AS INTEGER) AS county_fips,
    c_name, c_mktsegment, c_nationkey
  FROM customer),
lic AS (
  SELECT p_partkey AS lic_id, p_name AS description,
    CASE p_type WHEN 'ECONOMY' THEN 'fish' WHEN 'MEDIUM' THEN 'fish' WHEN 'STANDARD' THEN 'hunt'
      WHEN 'PROMO' THEN 'combo' WHEN 'SMALL' THEN 'trap' ELSE 'other' END AS type,
    CAST(CASE WHEN p_size = 49 THEN 99 WHEN p_size % 10 = 0 THEN 3 ELSE 1 END AS INTEGER) AS duration,
    CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'deer' WHEN p_brand = 'Brand#4' THEN 'trout' END AS priv,
    CASE WHEN p_brand = 'Brand#1' THEN 'youth_deer' END AS subtype
  FROM part),
sale0 AS (
  SELECT CASE WHEN o_orderkey % 500 = 0 THEN NULL ELSE o_custkey END AS cust_id, l_partkey AS lic_id,
    CAST(o_orderdate AS DATE) AS dot, o_orderkey,
    CAST(year(o_orderdate) + (CASE WHEN month(o_orderdate) = 12 THEN 1 ELSE 0 END) AS INTEGER) AS year,
    CAST(CASE WHEN o_orderkey % 40 = 7 THEN NULL WHEN o_custkey % 10 < 8 THEN 1 ELSE 0 END AS INTEGER) AS res
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sale AS (
  SELECT cust_id, lic_id, dot, year, res, o_orderkey,
    CAST((year(dot) - year) * 12 + month(dot) AS INTEGER) AS month FROM sale0),
permission AS (
  SELECT 'all_sports' AS permission, lic_id, description FROM lic WHERE type IN ('fish', 'hunt', 'combo', 'trap')
  UNION ALL SELECT 'hunt', lic_id, description FROM lic WHERE type IN ('hunt', 'combo', 'trap')
  UNION ALL SELECT 'fish', lic_id, description FROM lic WHERE type IN ('fish', 'combo')
  UNION ALL SELECT 'deer', lic_id, description FROM lic WHERE priv = 'deer'
  UNION ALL SELECT 'trout', lic_id, description FROM lic WHERE priv = 'trout'
  UNION ALL SELECT 'youth_deer', lic_id, description FROM lic WHERE subtype = 'youth_deer'),
county_fips AS (
  SELECT CAST((CASE WHEN n_nationkey < 22 THEN 19000 ELSE 55000 END) + 1 + 2 * n_nationkey AS INTEGER) AS county_fips,
    n_name AS county_name, CASE WHEN n_nationkey < 22 THEN 'IA' ELSE 'WI' END AS state_abbrev
  FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)),
counties AS (SELECT county_fips, county_name AS county FROM county_fips WHERE state_abbrev = 'IA'),
age_map AS (
  SELECT CAST(age_year AS INTEGER) AS age_year, age_acs,
    CAST(CASE WHEN age_year < 18 THEN 1 WHEN age_year < 25 THEN 2 WHEN age_year < 35 THEN 3 WHEN age_year < 45 THEN 4
      WHEN age_year < 55 THEN 5 WHEN age_year < 65 THEN 6 ELSE 7 END AS INTEGER) AS age
  FROM ({_AGES}) v(age_year, age_acs)),
pop_acs AS (
  SELECT CASE WHEN c_nationkey < 22 THEN 'IA' ELSE 'WI' END AS state_abbrev, c.county_fips,
    CAST(y.year AS INTEGER) AS year, c.sex, m.age, m.age_acs, CAST(sum(100 + c.cust_id % 50) AS BIGINT) AS pop
  FROM cust c CROSS JOIN (SELECT unnest(range(1995, 2000)) AS year) y
  JOIN age_map m ON m.age_year = y.year - c.birth_year
  WHERE c.county_fips IS NOT NULL AND c.sex IS NOT NULL AND c.birth_year IS NOT NULL
  GROUP BY ALL),
outline AS (
  SELECT CASE WHEN n_nationkey < 22 THEN 'IA' ELSE 'WI' END AS state, n_name AS county,
    CAST((CASE WHEN n_nationkey < 22 THEN 19000 ELSE 55000 END) + 1 + 2 * n_nationkey AS INTEGER) AS county_fips,
    min(c_acctbal / 100) AS w, max(c_acctbal / 100) AS e,
    min(((c_custkey * 7) % 9000) / 100) AS s, max(((c_custkey * 7) % 9000) / 100) AS n
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey <> 5 GROUP BY ALL),
county_map_us AS (
  SELECT state, county, county_fips, CAST(1 AS INTEGER) AS seq, w AS long, s AS lat FROM outline
  UNION ALL SELECT state, county, county_fips, 2, e, s FROM outline
  UNION ALL SELECT state, county, county_fips, 3, e, n FROM outline
  UNION ALL SELECT state, county, county_fips, 4, w, n FROM outline),
county_map AS (SELECT long, lat, seq, county, county_fips FROM county_map_us WHERE state = 'IA'),
county_map_dive AS (
  SELECT CAST(county_fips % 1000 AS INTEGER) AS fips, county, long, lat, seq FROM county_map)
"""

HISTORY = """
perm_sale AS (
  SELECT p.permission, s.cust_id, s.lic_id, s.year, s.month, s.res, l.duration
  FROM sale s JOIN lic l USING (lic_id) JOIN permission p USING (lic_id) WHERE s.cust_id IS NOT NULL),
ranked AS (
  SELECT permission, cust_id, year, duration, res, first_month AS month, lic_id FROM (
    SELECT *, min(month) OVER (PARTITION BY permission, cust_id, year) AS first_month,
      row_number() OVER (PARTITION BY permission, cust_id, year
        ORDER BY duration DESC, res DESC NULLS LAST, month, lic_id) AS place
    FROM perm_sale) WHERE place = 1),
cover AS (
  SELECT permission, cust_id, CAST(y AS INTEGER) AS year, CAST(src + duration - y AS INTEGER) AS remaining, month, res,
    row_number() OVER (PARTITION BY permission, cust_id, y ORDER BY src DESC) AS newest
  FROM (SELECT permission, cust_id, year AS src, duration, month, res,
          unnest(range(year, least(year + duration - 1, 2001) + 1)) AS y FROM ranked)),
made AS (
  SELECT c.permission, c.cust_id, c.year, r.duration_run, c.month, c.res FROM cover c
  JOIN (SELECT permission, cust_id, year, max(remaining) AS duration_run FROM cover GROUP BY ALL) r
    USING (permission, cust_id, year)
  WHERE c.newest = 1),
lapsed AS (
  SELECT a.permission, a.cust_id, a.year,
    CAST(CASE WHEN a.year = 2001 THEN NULL WHEN b.year IS NOT NULL THEN 0 ELSE 1 END AS INTEGER) AS lapse
  FROM made a LEFT JOIN made b ON a.permission = b.permission AND a.cust_id = b.cust_id AND b.year = a.year + 1),
classified AS (
  SELECT a.permission, a.cust_id, a.year,
    CASE WHEN a.year < 2000 THEN NULL WHEN count(b.year) FILTER (b.year = a.year - 1) > 0 THEN 'Renew'
      WHEN count(b.year) > 0 THEN 'Reactivate' ELSE 'Recruit' END AS R3
  FROM made a LEFT JOIN made b ON a.permission = b.permission AND a.cust_id = b.cust_id
    AND b.year BETWEEN a.year - 5 AND a.year - 1
  GROUP BY a.permission, a.cust_id, a.year),
history AS (
  SELECT m.permission, m.cust_id, m.year, m.duration_run, l.lapse, c.R3, m.month, m.res
  FROM made m JOIN lapsed l USING (permission, cust_id, year) JOIN classified c USING (permission, cust_id, year)),
recoded AS (
  SELECT h.permission, h.cust_id, h.year, h.duration_run, h.lapse, h.R3, h.month,
    CASE h.res WHEN 1 THEN 'Resident' WHEN 0 THEN 'Nonresident' END AS res,
    CASE c.sex WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS sex,
    n.county,
    CASE WHEN h.year - c.birth_year < 0 OR c.birth_year IS NULL THEN NULL
      WHEN h.year - c.birth_year <= 17 THEN '0-17' WHEN h.year - c.birth_year <= 24 THEN '18-24'
      WHEN h.year - c.birth_year <= 34 THEN '25-34' WHEN h.year - c.birth_year <= 44 THEN '35-44'
      WHEN h.year - c.birth_year <= 54 THEN '45-54' WHEN h.year - c.birth_year <= 64 THEN '55-64' ELSE '65+' END AS agecat,
    CAST(CASE WHEN h.month <= 3 THEN 1 WHEN h.month <= 6 THEN 2 WHEN h.month <= 9 THEN 3 ELSE 4 END AS INTEGER) AS quarter
  FROM history h LEFT JOIN cust c USING (cust_id) LEFT JOIN counties n USING (county_fips)),
cut2 AS (SELECT * FROM recoded WHERE quarter <= 2),
cut AS (
  SELECT a.permission, 2 AS sq, a.cust_id, a.year, a.R3, a.res, a.sex, a.county, a.agecat,
    CAST(CASE WHEN a.year = 2001 THEN NULL WHEN b.year IS NULL THEN 1 ELSE 0 END AS INTEGER) AS lapse
  FROM cut2 a LEFT JOIN cut2 b ON a.permission = b.permission AND a.cust_id = b.cust_id AND b.year = a.year + 1
  UNION ALL
  SELECT permission, 4, cust_id, year, R3, res, sex, county, agecat, lapse FROM recoded WHERE year < 2001),
sale_month AS (
  SELECT DISTINCT p.permission, s.cust_id, s.year, s.month FROM sale s JOIN permission p USING (lic_id)
  WHERE s.year IN (1999, 2000, 2001)),
sale_month_cut AS (
  SELECT *, 2 AS sq FROM sale_month WHERE month <= 6
  UNION ALL SELECT *, 4 FROM sale_month WHERE year < 2001)
"""

POP = """
pop_cat AS (
  SELECT county_fips, year, sex, age, CAST(sum(pop) AS BIGINT) AS pop FROM pop_acs WHERE state_abbrev = 'IA' GROUP BY ALL),
pop_year AS (SELECT year, sum(pop) AS total FROM pop_cat GROUP BY year),
growth AS (
  SELECT avg(ratio) AS rate FROM (
    SELECT CAST(b.total AS DOUBLE) / a.total AS ratio FROM pop_year a JOIN pop_year b ON b.year = a.year + 1)),
pop_ext AS (
  SELECT county_fips, year, sex, age, CAST(pop AS DOUBLE) AS pop FROM pop_cat
  UNION ALL
  SELECT county_fips, CAST(1999 + k AS INTEGER), sex, age, pop * pow((SELECT rate FROM growth), k)
  FROM pop_cat, (VALUES (1), (2)) v(k) WHERE year = 1999),
pop_ready AS (
  SELECT county_fips, year, CASE sex WHEN 1 THEN 'Male' ELSE 'Female' END AS sex,
    CASE age WHEN 1 THEN '0-17' WHEN 2 THEN '18-24' WHEN 3 THEN '25-34' WHEN 4 THEN '35-44' WHEN 5 THEN '45-54'
      WHEN 6 THEN '55-64' ELSE '65+' END AS agecat, pop FROM pop_ext),
pop_seg AS (
  SELECT 'tot' AS segment, 'All' AS category, year, sum(pop) AS pop FROM pop_ready GROUP BY ALL
  UNION ALL SELECT 'sex', sex, year, sum(pop) FROM pop_ready GROUP BY ALL
  UNION ALL SELECT 'agecat', agecat, year, sum(pop) FROM pop_ready GROUP BY ALL
  UNION ALL SELECT 'county', county, year, sum(pop) FROM pop_ready JOIN counties USING (county_fips) GROUP BY ALL)
"""


def _by_segment(source: str, segs, where: str = "true") -> str:
    """People per segment value; one statement per segment."""
    value = {"tot": "'All'"}
    return " UNION ALL ".join(
        f"SELECT permission, sq, '{s}' AS segment, {value.get(s, s)} AS category, year, count(*) AS n "
        f"FROM {source} WHERE {value.get(s, s)} IS NOT NULL AND {where} GROUP BY ALL"
        for s in segs
    )


def measures(name: str, source: str, segs=SEGMENTS, where: str = "true") -> str:
    """CTEs ``<name>_part`` and ``<name>_resd``: scaled people and scaled residents per segment."""
    plain = [s for s in segs if s != "county"]
    res_segs = [s for s in segs if s != "res"]
    return f"""
{name}_all AS ({_by_segment(source, plain, where)}),
{name}_scaled AS (
  SELECT a.*, CAST(round(CAST(a.n * t.n AS DOUBLE) / sum(a.n) OVER (PARTITION BY a.permission, a.sq, a.segment, a.year)) AS BIGINT) AS v
  FROM {name}_all a JOIN {name}_all t ON t.segment = 'tot' AND t.permission = a.permission AND t.sq = a.sq AND t.year = a.year),
{name}_home AS ({_by_segment(source, res_segs, where + " AND res = 'Resident'")}),
{name}_resd AS (
  SELECT a.permission, a.sq, a.segment, a.category, a.year,
    CAST(round(CAST(a.n * t.v AS DOUBLE) / sum(a.n) OVER (PARTITION BY a.permission, a.sq, a.segment, a.year)) AS BIGINT) AS v
  FROM {name}_home a JOIN {name}_scaled t ON t.segment = 'res' AND t.category = 'Resident'
    AND t.permission = a.permission AND t.sq = a.sq AND t.year = a.year),
{name}_part AS (
  SELECT permission, sq, segment, category, year, v FROM {name}_scaled
  UNION ALL SELECT permission, sq, segment, category, year, v FROM {name}_resd WHERE segment = 'county')"""


def _churn(source: str, segs=SEGMENTS) -> str:
    value = {"tot": "'All'"}
    return " UNION ALL ".join(
        f"SELECT permission, sq, '{s}' AS segment, {value.get(s, s)} AS category, CAST(year + 1 AS INTEGER) AS year, "
        f"sum(lapse) / CAST(count(*) AS DOUBLE) AS v FROM {source} WHERE {value.get(s, s)} IS NOT NULL "
        f"GROUP BY permission, sq, {value.get(s, s)}, year HAVING count(lapse) = count(*)"
        for s in segs
    )


_PARENTS = "(VALUES ('deer', 'hunt'), ('trout', 'fish'), ('youth_deer', 'deer')) v(child, parent)"


def all_metrics(name: str, source: str, segs=SEGMENTS, pop_rate: bool = True) -> str:
    """CTE ``<name>``: permission, sq, metric, segment, category, year, value."""
    rates = f"""
  UNION ALL SELECT p.permission, p.sq, 'rate', p.segment, p.category, p.year, p.v / CAST(r.v AS DOUBLE)
    FROM {name}1_part p JOIN {_PARENTS} ON v.child = p.permission
    LEFT JOIN {name}1_part r ON r.permission = v.parent AND r.sq = p.sq AND r.segment = p.segment
      AND r.category = p.category AND r.year = p.year"""
    if pop_rate:
        rates += f"""
  UNION ALL SELECT permission, sq, 'rate', segment, category, year, rate FROM {name}_rate
  UNION ALL SELECT permission, sq, 'rate', 'res', 'Resident', year, rate FROM {name}_rate WHERE segment = 'tot'
  UNION ALL SELECT permission, sq, 'rate', 'res', 'Nonresident', year, 0 FROM {name}_rate WHERE segment = 'tot'"""
    return f"""
{measures(name + "1", source, segs)},
{measures(name + "2", source, segs, "R3 = 'Recruit'")},
{name}_churn AS ({_churn(source, segs)}),
{name}_rate AS (
  SELECT p.permission, p.sq, p.segment, p.category, p.year, p.v / q.pop AS rate
  FROM {name}1_resd p LEFT JOIN pop_seg q USING (segment, category, year)
  WHERE p.permission NOT IN ('deer', 'trout', 'youth_deer')),
{name}_long AS (
  SELECT permission, sq, 'participants' AS metric, segment, category, year, CAST(v AS DOUBLE) AS value FROM {name}1_part
  UNION ALL SELECT permission, sq, 'recruits', segment, category, year, v FROM {name}2_part
  UNION ALL SELECT permission, sq, 'churn', segment, category, year, v FROM {name}_churn
  {rates}),
{name} AS (
  SELECT m.permission, m.sq, metric, segment, category, m.year, round(value, 9) AS value FROM {name}_long m
  WHERE segment <> 'county' OR (m.year IN (2000, 2001) AND EXISTS (
    SELECT 1 FROM {source} s WHERE s.permission = m.permission AND s.sq = m.sq AND s.year = m.year)))"""


def month_metrics(name: str, source: str = "cut") -> str:
    return f"""
{name} AS (
  SELECT permission, sq, 'participants' AS metric, 'month' AS segment, CAST(month AS VARCHAR) AS category, year,
    CAST(count(*) AS DOUBLE) AS value FROM sale_month_cut GROUP BY ALL
  UNION ALL
  SELECT m.permission, m.sq, 'recruits', 'month', CAST(m.month AS VARCHAR), m.year, count(*)
  FROM sale_month_cut m JOIN {source} h USING (permission, sq, cust_id, year) WHERE h.R3 = 'Recruit' GROUP BY ALL)"""


_LABEL = "CASE segment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_LABELS.items()) + " END"

DASH = f"""
{all_metrics("metric", "cut")},
{month_metrics("metric_month")},
dash AS (
  SELECT CAST(sq AS INTEGER) AS quarter, permission AS "group", {_LABEL} AS segment, year, category, metric, value
  FROM (SELECT * FROM metric UNION ALL SELECT * FROM metric_month))"""

SAMP = """
customers AS (SELECT DISTINCT cust_id FROM history WHERE permission = 'all_sports'),
chosen AS (
  SELECT cust_id FROM (
    SELECT cust_id, row_number() OVER (ORDER BY md5(cust_id || ':42')) AS place, count(*) OVER () AS total FROM customers)
  WHERE place <= round(total * 10 / 100)),
samp AS (
  SELECT h.permission AS priv, h.cust_id, h.year, h.lapse, h.R3,
    CASE h.res WHEN 1 THEN 'Resident' WHEN 0 THEN 'Nonresident' END AS res,
    CASE c.sex WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' END AS sex,
    CAST(CASE WHEN h.res = 1 AND c.county_fips IN (SELECT county_fips FROM county_map) THEN c.county_fips % 1000 END AS INTEGER) AS fips,
    CASE WHEN h.year - c.birth_year BETWEEN 0 AND 17 THEN '0-17' WHEN h.year - c.birth_year BETWEEN 18 AND 24 THEN '18-24'
      WHEN h.year - c.birth_year BETWEEN 25 AND 34 THEN '25-34' WHEN h.year - c.birth_year BETWEEN 35 AND 44 THEN '35-44'
      WHEN h.year - c.birth_year BETWEEN 45 AND 54 THEN '45-54' WHEN h.year - c.birth_year BETWEEN 55 AND 64 THEN '55-64'
      WHEN h.year - c.birth_year >= 65 THEN '65+' END AS age
  FROM history h JOIN chosen USING (cust_id) LEFT JOIN cust c USING (cust_id)),
sports AS (SELECT * FROM samp WHERE priv = 'all_sports')
"""

def _q(body: str, *parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in (TABLES, *parts)) + "\n" + body.strip()


def _h(body: str) -> str:
    return _q(body, HISTORY)


def _dash(body: str, *parts: str) -> str:
    return _q(body, HISTORY, POP, DASH, *parts)


def _samp(body: str) -> str:
    return _q(body, HISTORY, SAMP)


def _only(source: str, where: str) -> str:
    return f"picked AS (SELECT * FROM {source} WHERE {where})"


def _metrics_of(group: str, sq: int, res_type: str | None = None) -> str:
    """Metrics of one permission; ``res_type`` limits history but not participant months."""
    where = f"permission = '{group}' AND sq = {sq}" + (f" AND res = '{res_type}'" if res_type else "")
    segs = [s for s in SEGMENTS if s != "county"] if res_type == "Nonresident" else SEGMENTS
    # years at hand come from the permission's history before the residency limit
    text = all_metrics("m", "picked", segs, pop_rate=res_type != "Nonresident")
    body = f"""SELECT metric, segment, category, year, value FROM m
UNION ALL SELECT metric, segment, category, year, value FROM mm WHERE permission = '{group}' AND sq = {sq}"""
    return _q(body, HISTORY, POP, _only("cut", where), text, month_metrics("mm", "picked"))


ORACLE: dict[str, str] = {}

# ---- sources
ORACLE["src_generic"] = _q("SELECT cust_id, lic_id, month FROM sale WHERE year = 2000")
ORACLE["load_cust"] = _q("SELECT cust_id, sex, birth_year, county_fips FROM cust")
ORACLE["load_cust_standard"] = _q("""
SELECT cust_id, sex, make_date(birth_year, 1, 1) AS dob, c_name AS "last", c_mktsegment AS "first",
  CASE WHEN c_nationkey < 22 THEN 'IA' ELSE 'WI' END AS state,
  CAST(CASE WHEN cust_id % 10 < 8 THEN 1 ELSE 0 END AS INTEGER) AS cust_res, '2001-q2' AS cust_period, cust_id AS raw_cust_id
FROM cust""")
ORACLE["load_sale"] = _q("SELECT cust_id, lic_id, year, month FROM sale WHERE year BETWEEN 1999 AND 2001")
ORACLE["load_sale_standard"] = _q("""
SELECT cust_id, lic_id, year, dot, make_date(year - 1, 12, 1) AS start_date, make_date(year, 11, 30) AS end_date,
  '2001-q2' AS sale_period, o_orderkey AS raw_sale_id FROM sale""")
ORACLE["load_counties"] = _q("SELECT county_fips, county FROM counties")
ORACLE["load_pop"] = _q("SELECT state_abbrev, county_fips, year, sex, age, age_acs, pop FROM pop_acs WHERE state_abbrev = 'IA'")
ORACLE["load_lic_ids"] = _q("SELECT lic_id FROM permission WHERE permission = 'deer'")
ORACLE["load_history"] = _h("""
SELECT cust_id, year, duration_run, lapse, R3, month, res FROM history WHERE permission = 'deer' AND year IN (2000, 2001)""")
ORACLE["load_histories"] = _h("""
SELECT * FROM history WHERE year IN (2000, 2001) AND permission IN (
  SELECT permission FROM permission JOIN lic USING (lic_id) WHERE priv = 'trout' AND duration > 1)""")
ORACLE["load_license_sale"] = _q("SELECT cust_id, lic_id, year, res, month FROM sale WHERE year BETWEEN 1999 AND 2001")
ORACLE["cust_sample"] = _samp("SELECT cust_id FROM chosen")
ORACLE["cust_sample_hash"] = _samp("""
SELECT cust_id FROM customers
WHERE CAST('0x' || substr(md5(cust_id || ':42'), 1, 8) AS BIGINT) < CAST(floor(0.1 * 4294967296) AS BIGINT)""")
ORACLE["county_map"] = _q("SELECT long, lat, seq, county, county_fips FROM county_map")
ORACLE["county_map_dive"] = _q("SELECT fips, county, long, lat, seq FROM county_map_dive")

# ---- sinks
ORACLE["history_all"] = _h("SELECT * FROM history")
ORACLE["write_history_roundtrip"] = ORACLE["history_all"]
ORACLE["write_history_empty"] = _h("SELECT * FROM history WHERE permission <> 'deer'")
ORACLE["write_history_odd_name"] = _h("""
SELECT * FROM history WHERE permission <> 'trout'
UNION ALL SELECT * REPLACE ('trout' AS permission) FROM history WHERE permission = 'deer' AND year > 1999""")
ORACLE["snapshot_commit"] = _h("""
, seen AS (
  SELECT 'history' AS part, permission, cust_id AS id,
    permission = 'youth_deer' OR (permission = 'deer' AND year < 2000) AS goes FROM history
  UNION ALL SELECT 'licenses', permission, lic_id, permission = 'youth_deer' OR (permission = 'deer' AND lic_id % 2 = 1) FROM permission)
SELECT state, part, permission, count(*) AS n, CAST(sum(id) AS BIGINT) AS total
FROM seen, (VALUES ('before'), ('killed'), ('after')) v(state) WHERE state <> 'after' OR NOT goes GROUP BY ALL""")
ORACLE["permission_upsert_empty"] = _q("SELECT permission, lic_id, description FROM permission WHERE permission <> 'trout'")
ORACLE["remove_table"] = _q("SELECT county_fips, county, false AS still_there FROM counties")
ORACLE["permission_upsert"] = _q("""
SELECT * FROM permission WHERE permission NOT IN ('trout', 'ice_fishing')
UNION ALL SELECT name, lic_id, description FROM lic, (VALUES ('trout'), ('ice_fishing')) v(name) WHERE type IN ('fish', 'combo')""")

# ---- checks
ORACLE["check_allowed_values"] = _q("""
SELECT 'allowed_values' AS "check", "table", "column", n_bad FROM (
  SELECT 'cust' AS "table", 'sex' AS "column", count(*) AS n_bad FROM cust WHERE sex IS NOT NULL AND sex NOT IN (1, 2)
  UNION ALL SELECT 'cust', 'birth_year', count(*) FROM cust WHERE birth_year < 1870 OR birth_year > 2001
  UNION ALL SELECT 'lic', 'type', count(*) FROM lic WHERE type IS NULL OR type NOT IN ('fish', 'hunt', 'combo', 'trap', 'other')
  UNION ALL SELECT 'lic', 'duration', count(*) FROM lic WHERE duration IS NULL OR duration < 1 OR duration > 99
  UNION ALL SELECT 'sale', 'year', count(*) FROM sale WHERE year IS NULL OR year < 2000 OR year > 2001
  UNION ALL SELECT 'sale', 'month', count(*) FROM sale WHERE month IS NULL OR month < 0 OR month > 15
  UNION ALL SELECT 'sale', 'res', count(*) FROM sale WHERE res IS NOT NULL AND res NOT IN (0, 1))
WHERE n_bad > 0""")
ORACLE["check_foreign_keys"] = _q("""
SELECT 'foreign_key' AS "check", 'sale' AS "table", "column", n_bad FROM (
  SELECT 'cust_id' AS "column", count(*) AS n_bad FROM sale WHERE cust_id NOT IN (SELECT cust_id FROM cust)
  UNION ALL SELECT 'lic_id', count(*) FROM sale WHERE lic_id NOT IN (SELECT lic_id FROM lic)
  UNION ALL SELECT 'cust_id', count(*) FROM sale WHERE cust_id NOT IN (SELECT cust_id FROM cust WHERE county_fips IS NOT NULL)
  UNION ALL SELECT 'lic_id', count(*) FROM sale WHERE lic_id NOT IN (SELECT lic_id FROM lic))
WHERE n_bad > 0""")
ORACLE["check_primary_keys"] = _q("""
SELECT "check", "table", "column", n_bad FROM (
  SELECT 'duplicate_key' AS "check", 'cust' AS "table", 'cust_id' AS "column", count(cust_id) - count(DISTINCT cust_id) AS n_bad FROM cust
  UNION ALL SELECT 'null_key', 'cust', 'cust_id', count(*) - count(cust_id) FROM cust
  UNION ALL SELECT 'duplicate_key', 'lic', 'lic_id', count(lic_id) - count(DISTINCT lic_id) FROM lic
  UNION ALL SELECT 'null_key', 'lic', 'lic_id', count(*) - count(lic_id) FROM lic
  UNION ALL SELECT 'duplicate_key', 'sale', 'raw_sale_id', count(o_orderkey) - count(DISTINCT o_orderkey) FROM sale
  UNION ALL SELECT 'null_key', 'sale', 'raw_sale_id', count(*) - count(o_orderkey) FROM sale)
WHERE n_bad > 0""")
ORACLE["check_fips_integer"] = _q("""
SELECT 'integer_fips' AS "check", 'cust' AS "table", 'county_fips' AS "column", count(*) AS n_bad
FROM cust WHERE county_fips IS NULL HAVING count(*) > 0
UNION ALL SELECT 'integer_fips_type', 'cust', 'county_fips', 1""")
ORACLE["data_check"] = _q("""
SELECT "check", "table", "column", n_bad FROM (
  SELECT 'required_column' AS "check", 'cust' AS "table", 'sex' AS "column", 1 AS n_bad
  UNION ALL SELECT 'allowed_values', 'cust', 'birth_year', count(*) FROM cust WHERE birth_year NOT BETWEEN 1870 AND 2001
  UNION ALL SELECT 'allowed_values', 'lic', 'type', count(*) FROM broken WHERE coalesce(type, '') NOT IN ('fish', 'hunt', 'combo', 'trap', 'other')
  UNION ALL SELECT 'allowed_values', 'lic', 'duration', count(*) FROM broken WHERE coalesce(duration, 0) NOT BETWEEN 1 AND 99
  UNION ALL SELECT 'allowed_values', 'sale', 'year', count(*) FROM sale WHERE coalesce(year, 0) NOT BETWEEN 2000 AND 2001
  UNION ALL SELECT 'allowed_values', 'sale', 'month', count(*) FROM sale WHERE coalesce(month - 1, -1) NOT BETWEEN 0 AND 15
  UNION ALL SELECT 'allowed_values', 'sale', 'res', count(*) FROM sale WHERE res <> 1
  UNION ALL SELECT 'foreign_key', 'sale', 'cust_id', count(*) FROM sale WHERE cust_id IS NOT NULL AND cust_id NOT IN (SELECT cust_id FROM cust)
  UNION ALL SELECT 'foreign_key', 'sale', 'lic_id', count(*) FROM sale WHERE lic_id NOT IN (SELECT lic_id FROM broken)
  UNION ALL SELECT 'duplicate_key', 'cust', 'cust_id', count(cust_id) - count(DISTINCT cust_id) FROM cust
  UNION ALL SELECT 'null_key', 'cust', 'cust_id', count(*) - count(cust_id) FROM cust
  UNION ALL SELECT 'duplicate_key', 'lic', 'lic_id', count(lic_id) - count(DISTINCT lic_id) FROM broken
  UNION ALL SELECT 'null_key', 'lic', 'lic_id', count(*) - count(lic_id) FROM broken
  UNION ALL SELECT 'integer_fips_type', 'cust', 'county_fips', 1
  UNION ALL SELECT 'integer_fips', 'cust', 'county_fips', count(*) FROM cust WHERE county_fips IS NULL)
WHERE n_bad > 0""", """
broken AS (
  SELECT lic_id, CASE WHEN type <> 'trap' THEN type END AS type, duration FROM lic WHERE lic_id % 7 <> 0
  UNION ALL SELECT lic_id, CASE WHEN type <> 'trap' THEN type END, duration FROM lic WHERE lic_id % 7 <> 0 AND lic_id % 10 = 1)""")

_TAGGED = """
tagged AS (
  SELECT cust_id, lic_id, year, res, month,
    list_filter([CASE WHEN year IS NULL OR year < 1997 OR year > 2001 THEN 'year' END,
      CASE WHEN month IS NULL OR month NOT BETWEEN 1 AND 11 THEN 'month' END, CASE WHEN res <> 1 THEN 'res' END,
      CASE WHEN cust_id NOT IN (SELECT cust_id FROM cust WHERE county_fips IS NOT NULL) THEN 'cust_id' END,
      CASE WHEN lic_id % 7 = 0 THEN 'lic_id' END], lambda x: x IS NOT NULL) AS reasons
  FROM sale)"""
ORACLE["quarantine_sales"] = _q("SELECT * REPLACE (array_to_string(reasons, ',') AS reasons) FROM tagged WHERE len(reasons) > 0", _TAGGED)
ORACLE["quarantine_passed"] = _q("SELECT cust_id, lic_id, year, res, month FROM tagged WHERE len(reasons) = 0", _TAGGED)
ORACLE["quarantine_counts"] = _q("""
SELECT CASE WHEN "column" IN ('cust_id', 'lic_id') THEN 'foreign_key' ELSE 'allowed_values' END AS "check", 'sale' AS "table", "column", count(*) AS n_bad
FROM (SELECT unnest(reasons) AS "column" FROM tagged) GROUP BY ALL""", _TAGGED)

# ---- filters, projections, scalar functions
ORACLE["sale_group"] = _q("""
SELECT DISTINCT cust_id, year, month FROM sale WHERE lic_id IN (SELECT lic_id FROM permission WHERE permission = 'deer')""")
ORACLE["permission_rules"] = _q("SELECT permission, lic_id, description FROM permission")
ORACLE["drop_na_custid"] = _q("SELECT year, count(*) AS n FROM sale WHERE cust_id IS NOT NULL GROUP BY year")
ORACLE["relative_month"] = _q("""
SELECT year, CAST(CASE WHEN month(dot) = 12 THEN 0 ELSE month(dot) END AS INTEGER) AS month, count(*) AS n FROM sale GROUP BY ALL""")
ORACLE["month_to_quarter"] = _q("""
SELECT month, CAST(CASE WHEN month < 4 THEN 1 WHEN month < 7 THEN 2 WHEN month < 10 THEN 3 ELSE 4 END AS INTEGER) AS quarter,
  count(*) AS n FROM sale GROUP BY ALL""")
ORACLE["fiscal_quarter"] = _q("""
SELECT month, CAST(month // 3 + 1 AS INTEGER) AS quarter, count(*) AS n FROM sale GROUP BY ALL""")
ORACLE["recode_history"] = _h("""
SELECT cust_id, permission, year, duration_run, lapse, R3, month, res, sex, county, agecat, quarter FROM recoded""")
ORACLE["quarterly_filter_q2"] = _h("SELECT permission, cust_id, year FROM recoded WHERE month <= 6")
ORACLE["quarterly_filter_ahead"] = _h("SELECT permission, cust_id, year FROM recoded WHERE month <= 9 AND year <= 2000")
ORACLE["factor_age_acs"] = _q("""
SELECT state_abbrev, county_fips, year, sex, age, age_acs, pop, l.age_acs_ord
FROM pop_acs JOIN (SELECT age_acs, min(age_year) AS age_acs_ord FROM age_map GROUP BY age_acs) l USING (age_acs)
WHERE state_abbrev = 'IA'""")
ORACLE["age_acs_check"] = _q("""
SELECT age_acs AS new, age_acs AS old, count(*) AS n FROM pop_acs WHERE state_abbrev = 'IA' GROUP BY ALL""")
ORACLE["set_other_county_na"] = _q("""
SELECT cust_id, sex, birth_year,
  CASE WHEN county_fips IN (SELECT county_fips FROM county_map) THEN county_fips END AS county_fips FROM cust""")
ORACLE["set_nonres_county_na"] = _h("""
SELECT permission, cust_id, year, h.res, CASE WHEN h.res = 1 THEN c.county_fips END AS county_fips
FROM history h LEFT JOIN cust c USING (cust_id)""")
ORACLE["filter_demo_sex"] = _samp("SELECT * FROM samp WHERE sex IS DISTINCT FROM 'Female'")
ORACLE["filter_demo_r3"] = _samp("SELECT * FROM samp WHERE R3 <> 'Recruit'")
ORACLE["metrics_resident"] = _metrics_of("hunt", 2, "Resident")
ORACLE["metrics_nonresident"] = _metrics_of("hunt", 2, "Nonresident")
ORACLE["drop_state_code"] = _q("SELECT cust_id, county_fips, CAST(county_fips % 1000 AS INTEGER) AS fips FROM cust")

# ---- joins
ORACLE["history_enriched"] = _h("""
SELECT cust_id, permission, year, duration_run, lapse, R3, month, res, county_fips, sex, birth_year, county
FROM history LEFT JOIN (SELECT cust_id, sex, birth_year, county_fips FROM cust) c USING (cust_id) LEFT JOIN counties USING (county_fips)""")
ORACLE["history_bucketed"] = _h("""
SELECT cust_id, permission, year, duration_run, lapse, R3, month, res, sex, birth_year, c.county_fips
FROM history LEFT JOIN (SELECT cust_id, sex, birth_year, county_fips FROM cust) c USING (cust_id)""")
ORACLE["county_from_zip"] = _q("""
SELECT c.cust_id, c.sex, c.birth_year, coalesce(c.county_fips, z.fips) AS county_fips,
  CAST(50000 + c_nationkey * 10 + c.cust_id % 7 AS BIGINT) AS zip
FROM cust c LEFT JOIN (
  SELECT 50000 + c_nationkey * 10 + cust_id % 7 AS zip, min(county_fips) AS fips FROM cust WHERE county_fips IS NOT NULL GROUP BY 1) z
  ON z.zip = 50000 + c_nationkey * 10 + c.cust_id % 7""")
ORACLE["county_of_point"] = _q("""
SELECT cust_id, long, lat, CAST(min(county_fips) FILTER (crossings % 2 = 1) AS INTEGER) AS county_fips FROM (
  SELECT p.cust_id, p.long, p.lat, e.county_fips, count(*) FILTER (
    (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.long < (e.x2 - e.x1) * (p.lat - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1) AS crossings
  FROM (SELECT c_custkey AS cust_id, c_acctbal / 100 + 0.003 AS long, ((c_custkey * 7) % 9000) / 100 + 0.003 AS lat FROM customer) p,
    (SELECT county_fips, long AS x1, lat AS y1, lead(long, 1, first) OVER w AS x2, lead(lat, 1, low) OVER w AS y2
     FROM (SELECT *, first_value(long) OVER w AS first, first_value(lat) OVER w AS low FROM county_map_us
           WHERE county_fips % 4 = 1 WINDOW w AS (PARTITION BY county_fips ORDER BY seq))
     WINDOW w AS (PARTITION BY county_fips ORDER BY seq)) e
  GROUP BY ALL)
GROUP BY ALL""")
ORACLE["join_county_map"] = _dash("""
SELECT d.quarter, d."group", lower(d.segment) AS segment, d.year, d.category, d.metric, d.value, n.county_fips,
  CAST(o.n AS INTEGER) AS n_vertices, o.west, o.north
FROM dash d LEFT JOIN counties n ON n.county = d.category AND d.segment = 'County'
LEFT JOIN (SELECT county_fips, count(*) AS n, min(long) AS west, max(lat) AS north FROM county_map GROUP BY county_fips) o
  ON o.county_fips = n.county_fips""")
ORACLE["county_map_missing"] = _dash("""
SELECT count(*) FILTER (n.county_fips IS NULL) AS rows_without_fips,
  count(DISTINCT n.county_fips) FILTER (n.county_fips NOT IN (SELECT county_fips FROM county_map)) AS fips_without_outline
FROM dash d LEFT JOIN counties n ON n.county = d.category WHERE d.segment = 'County'""")

# ---- history
ORACLE["rank_sale"] = _h("SELECT permission, cust_id, year, duration, res, month, lic_id FROM ranked")
ORACLE["make_history"] = _h("SELECT permission, cust_id, year, duration_run, month, res FROM made")
ORACLE["lapse"] = _h("SELECT permission, cust_id, year, lapse FROM lapsed")
ORACLE["r3"] = _h("SELECT permission, cust_id, year, R3 FROM classified")
ORACLE["quarterly_lapse"] = _h("SELECT permission, cust_id, year, lapse FROM cut WHERE sq = 2")
ORACLE["open_year_lapse"] = _h("""
SELECT permission, cust_id, year, CASE WHEN year < 2000 THEN lapse END AS lapse FROM cut WHERE sq = 4""")
ORACLE["deer_by_year"] = _h("SELECT year, count(*) AS n FROM history WHERE permission = 'deer' GROUP BY year")



def _through(last: int) -> str:
    """The history that is known when ``last`` is the latest year sold."""
    text = HISTORY[: HISTORY.index("recoded AS")].rstrip().rstrip(",")
    text = text.replace("2001", str(last)).replace("WHERE s.cust_id IS NOT NULL", f"WHERE s.cust_id IS NOT NULL AND s.year <= {last}")
    return _q(f"SELECT *, CAST({last} AS INTEGER) AS through FROM history", text)


ORACLE["history_incremental"] = " UNION ALL ".join(f"SELECT * FROM ({_through(y)})" for y in (1999, 2000, 2001))

# ---- population
ORACLE["aggregate_pop"] = _q("SELECT county_fips, year, sex, age, pop FROM pop_cat", POP)
ORACLE["extrapolate_pop"] = _q("SELECT county_fips, year, sex, age, round(pop, 6) AS pop FROM pop_ext", POP)
ORACLE["qa_extrapolation"] = _q("""
SELECT (SELECT max(year) FROM pop_year) AS last_year, round(rate, 9) AS growth, CAST(2 AS INTEGER) AS n_extrapolated FROM growth""", POP)
ORACLE["prep_pop"] = _q("SELECT county_fips, year, sex, agecat, round(pop, 6) AS pop FROM pop_ready", POP)
ORACLE["est_pop_tot"] = _q("SELECT year, round(sum(pop), 6) AS pop FROM pop_ready GROUP BY year", POP)
ORACLE["est_pop_sex"] = _q("SELECT sex, year, round(sum(pop), 6) AS pop FROM pop_ready GROUP BY sex, year", POP)
ORACLE["est_pop_county"] = _q(
    "SELECT county, year, round(sum(pop), 6) AS pop FROM pop_ready LEFT JOIN counties USING (county_fips) GROUP BY county, year", POP
)

# ---- metrics
for _s in SEGMENTS:
    _value = "'All'" if _s == "tot" else _s
    ORACLE[f"participants_{_s}"] = _h(f"""
SELECT permission, {_value} AS {_s}, year, count(*) AS participants FROM recoded WHERE {_value} IS NOT NULL GROUP BY ALL""")
    ORACLE[f"recruits_{_s}"] = _h(f"""
SELECT permission, {_value} AS {_s}, year, count(*) AS recruits FROM recoded
WHERE {_value} IS NOT NULL AND R3 = 'Recruit' GROUP BY ALL""")
    ORACLE[f"churn_{_s}"] = _h(f"""
SELECT permission, {_value} AS {_s}, CAST(year + 1 AS INTEGER) AS year, round(sum(lapse) / CAST(count(*) AS DOUBLE), 9) AS churn
FROM recoded WHERE {_value} IS NOT NULL AND year < 2001 GROUP BY permission, {_value}, year""")

_RATE_SEX = """
SELECT permission, sex, year, round(count(*) / (
  SELECT sum(pop) FROM pop_ready p WHERE p.sex = r.sex AND p.year = r.year), 9) AS rate
FROM recoded r WHERE res = 'Resident' AND sex IS NOT NULL GROUP BY permission, sex, year"""
ORACLE["est_rate"] = _q(_RATE_SEX, HISTORY, POP)
ORACLE["rate_threshold"] = _q(f"SELECT * FROM ({_RATE_SEX}) WHERE rate > 0.005", HISTORY, POP)
ORACLE["priv_rate"] = _q("""
SELECT p.segment, p.category, p.year, round(p.v / CAST(r.v AS DOUBLE), 9) AS rate
FROM m_part p LEFT JOIN m_part r ON r.permission = 'hunt' AND r.segment = p.segment AND r.category = p.category AND r.year = p.year
WHERE p.permission = 'deer'""", HISTORY, _only("cut", "sq = 2"), measures("m", "picked"))
ORACLE["part_rate"] = _q("""
SELECT segment, category, year, round(v / pop, 9) AS rate FROM m_resd LEFT JOIN pop_seg USING (segment, category, year)
UNION ALL SELECT 'res', category, year, CASE category WHEN 'Resident' THEN round(v / pop, 9) ELSE 0 END
FROM (SELECT year, v FROM m_resd WHERE segment = 'tot') LEFT JOIN (SELECT year, pop FROM pop_seg WHERE segment = 'tot') USING (year),
  (VALUES ('Resident'), ('Nonresident')) c(category)""",
    HISTORY, POP, _only("cut", "sq = 2 AND permission = 'hunt'"), measures("m", "picked"))
ORACLE["scaleup_sex"] = _h("""
SELECT permission, sex, year, CAST(round(CAST(n * total AS DOUBLE) / sum(n) OVER (PARTITION BY permission, year)) AS BIGINT) AS participants
FROM (SELECT permission, sex, year, count(*) AS n FROM recoded WHERE sex IS NOT NULL GROUP BY ALL)
JOIN (SELECT permission, year, count(*) AS total FROM recoded GROUP BY ALL) USING (permission, year)""")
_UNITS = """CAST(low + CASE WHEN row_number() OVER (PARTITION BY {by} ORDER BY rest DESC, category) <= total - sum(low) OVER (PARTITION BY {by}) THEN 1 ELSE 0 END AS BIGINT)"""
_SHARES = """SELECT *, (CAST(n AS HUGEINT) * total) // sum(n) OVER (PARTITION BY {by}) AS low,
    (CAST(n AS HUGEINT) * total) % CAST(sum(n) OVER (PARTITION BY {by}) AS HUGEINT) AS rest"""
_BY = "permission, segment, year"
ORACLE["scaleup_exact"] = _h(f"""
, known AS (
  SELECT permission, segment, category, year, count(*) AS n FROM (
    SELECT permission, year, unnest(['res', 'sex', 'agecat']) AS segment, unnest([res, sex, agecat]) AS category FROM recoded)
  WHERE category IS NOT NULL GROUP BY ALL)
SELECT permission, segment, category, year, {_UNITS.format(by=_BY)} AS participants
FROM ({_SHARES.format(by=_BY)} FROM known JOIN (SELECT permission, year, count(*) AS total FROM recoded GROUP BY ALL) USING (permission, year))""")
ORACLE["calc_part_exact"] = _q(f"""
, people AS (SELECT segment, category, year, v FROM (
    SELECT segment, category, year, {_UNITS.format(by="segment, year")} AS v
    FROM ({_SHARES.format(by="segment, year")} FROM m_all JOIN (SELECT year, n AS total FROM m_all WHERE segment = 'tot') USING (year)))),
residents AS (
    SELECT segment, category, year, {_UNITS.format(by="segment, year")} AS v
    FROM ({_SHARES.format(by="segment, year")} FROM m_home JOIN (SELECT year, v AS total FROM people WHERE category = 'Resident') USING (year)))
SELECT segment, category, year, p.v AS participants, r.v AS residents FROM people p LEFT JOIN residents r USING (segment, category, year)
UNION ALL SELECT segment, category, year, v, v FROM residents WHERE segment = 'county'""",
    HISTORY, _only("cut", "sq = 2 AND permission = 'deer'"), measures("m", "picked"))
ORACLE["calc_part"] = _q("""
SELECT segment, category, year, p.v AS participants, r.v AS residents
FROM m_part p LEFT JOIN m_resd r USING (permission, sq, segment, category, year)""",
    HISTORY, _only("cut", "sq = 2 AND permission = 'deer'"), measures("m", "picked"))
ORACLE["month_participants"] = _h("""
SELECT CAST(month AS VARCHAR) AS month, year, count(*) AS participants FROM sale_month_cut
WHERE permission = 'deer' AND sq = 2 GROUP BY ALL""")
ORACLE["month_recruits"] = _h("""
SELECT CAST(month AS VARCHAR) AS month, year, count(*) AS recruits FROM sale_month_cut m
WHERE permission = 'deer' AND sq = 2 AND EXISTS (
  SELECT 1 FROM cut h WHERE h.permission = 'deer' AND h.sq = 2 AND h.cust_id = m.cust_id AND h.year = m.year AND h.R3 = 'Recruit')
GROUP BY ALL""")
ORACLE["calc_metrics"] = _metrics_of("hunt", 4)
ORACLE["dashboard_all"] = _dash("SELECT * FROM dash")
ORACLE["dashboard_incremental"] = ORACLE["dashboard_all"]
ORACLE["dashboard_spaced_names"] = _dash("""
SELECT quarter, CASE "group" WHEN 'hunt' THEN 'all_hunt' ELSE 'any_deer' END AS "group", segment, year, category, metric, value
FROM dash WHERE "group" IN ('hunt', 'deer')""")
ORACLE["dashboard_all_residency"] = " UNION ALL ".join(
    f"""SELECT CAST({sq} AS INTEGER) AS quarter, '{name}' AS "group", {_LABEL} AS segment, year, category, metric, value
FROM ({_metrics_of("hunt", sq, res)})"""
    for name, res in (("home_hunt", "Resident"), ("away_hunt", "Nonresident"))
    for sq in (2, 4)
)
ORACLE["fill_missing_categories"] = f"""
WITH shown AS ({ORACLE["dashboard_all_residency"]})
SELECT * FROM shown
UNION ALL
SELECT quarter, "group", segment, year, category, metric, 0 FROM (
  SELECT DISTINCT s.quarter, s."group", s.year, s.metric, v.segment, v.category FROM shown s, (VALUES
    ('Residency', 'Resident'), ('Residency', 'Nonresident'), ('Gender', 'Male'), ('Gender', 'Female'), ('Age', '0-17'), ('Age', '18-24'),
    ('Age', '25-34'), ('Age', '35-44'), ('Age', '45-54'), ('Age', '55-64'), ('Age', '65+')) v(segment, category)
  WHERE s.segment = 'All' AND s.metric IN ('participants', 'recruits')) f
WHERE NOT EXISTS (SELECT 1 FROM shown x WHERE x.quarter = f.quarter AND x."group" = f."group" AND x.year = f.year AND x.metric = f.metric
  AND x.segment = f.segment AND x.category = f.category)"""
ORACLE["dashboard"] = _dash("""SELECT * FROM dash WHERE "group" = 'deer' AND quarter = 2""")
ORACLE["write_dash_roundtrip"] = ORACLE["dashboard_all"]
ORACLE["fill_missing_months"] = _dash("""
SELECT * FROM dash
UNION ALL
SELECT quarter, "group", 'month', year, category, metric, 0 FROM (
  SELECT k.quarter, k."group", k.year, s.category, k.metric
  FROM (SELECT DISTINCT quarter, "group", year, metric FROM dash WHERE segment = 'month') k,
    (SELECT DISTINCT category FROM dash WHERE segment = 'month') s
  WHERE NOT (k.quarter = 2 AND CAST(s.category AS INTEGER) BETWEEN 7 AND 15)
  EXCEPT SELECT quarter, "group", year, category, metric FROM dash WHERE segment = 'month')""")

_LIMITS = " ".join(
    f"WHEN metric = '{m}' AND segment = '{SEGMENT_LABELS[s]}' THEN {limit}"
    for m, limits in (
        ("participants", YEAR_CHANGE_PARTICIPANTS), ("churn", YEAR_CHANGE_PARTICIPANTS), ("recruits", YEAR_CHANGE_RECRUITS)
    )
    for s, limit in limits.items()
)
ORACLE["qa_year_change"] = _dash(f"""
SELECT * FROM (
  SELECT a.*, CAST(CASE {_LIMITS} END AS INTEGER) AS threshold, round(100 * (a.value - b.value) / nullif(b.value, 0), 6) AS pct_change
  FROM (SELECT * FROM dash) a JOIN (SELECT quarter, "group" AS g, segment AS s, category AS c, metric AS m, year + 1 AS y, value FROM dash) b
  ON b.quarter = a.quarter AND b.g = a."group" AND b.s = a.segment AND b.c = a.category AND b.m = a.metric AND b.y = a.year)
WHERE abs(pct_change) > threshold""")
_UNKNOWN = " UNION ALL ".join(
    f"SELECT permission, '{s}' AS segment, year, count(CASE WHEN {known} THEN 1 END) AS known, count(*) AS total "
    f"FROM recoded WHERE {base} GROUP BY ALL"
    for s, known, base in (
        ("tot", "true", "true"), ("res", "res IS NOT NULL", "true"), ("sex", "sex IS NOT NULL", "true"),
        ("agecat", "agecat IS NOT NULL", "true"), ("county", "county IS NOT NULL", "res = 'Resident'"),
    )
)
ORACLE["qa_scaleup"] = _h(f"""
SELECT permission, segment, year, known, total, round(100 * (total - known) / CAST(total AS DOUBLE), 9) AS pct_unknown,
  CAST(t AS INTEGER) AS threshold
FROM ({_UNKNOWN}), (VALUES (25), (3)) v(t) WHERE 100 * (total - known) / CAST(total AS DOUBLE) > t""")

# ---- exploratory views
ORACLE["hist_samp"] = _samp("SELECT * FROM samp")
ORACLE["trend_none"] = _samp("SELECT year, count(*) * 10.0::DOUBLE AS value FROM sports GROUP BY year")
ORACLE["trend_sex_age"] = _samp("""
SELECT sex, age, year, count(*) * 10.0::DOUBLE AS value FROM sports WHERE sex IS NOT NULL AND age IS NOT NULL GROUP BY ALL""")
ORACLE["trend_churn"] = _samp("""
SELECT sex, CAST(year + 1 AS INTEGER) AS year, round(sum(lapse) / CAST(count(*) AS DOUBLE) * 100, 9) AS value
FROM sports WHERE sex IS NOT NULL AND year < 2001 GROUP BY sex, year""")
ORACLE["trend_pivot"] = _samp("""
SELECT age, year, nullif(count(*) FILTER (sex = 'Male'), 0) * 10.0::DOUBLE AS Male, nullif(count(*) FILTER (sex = 'Female'), 0) * 10.0::DOUBLE AS Female
FROM sports WHERE sex IS NOT NULL AND age IS NOT NULL GROUP BY age, year""")
ORACLE["dist_age"] = _samp("""
SELECT age, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM sports) AS DOUBLE) * 100, 9) AS pct FROM sports GROUP BY age""")
ORACLE["county_dive"] = _samp("""
SELECT v.fips, v.value, m.county, m.long, m.lat, m.seq
FROM (SELECT fips, count(*) * 10.0::DOUBLE AS value FROM sports WHERE year = 2000 AND fips IS NOT NULL GROUP BY fips) v
LEFT JOIN county_map_dive m USING (fips)""")
ORACLE["county_dive_churn"] = _samp("""
SELECT v.fips, v.value, m.county, m.long, m.lat, m.seq
FROM (SELECT fips, round(sum(lapse) / CAST(count(*) AS DOUBLE) * 100, 3) AS value FROM sports
      WHERE year = 1999 AND fips IS NOT NULL GROUP BY fips) v
LEFT JOIN county_map_dive m USING (fips)""")
ORACLE["dive_query"] = _samp("""
, shown AS (
  SELECT * FROM samp WHERE priv = 'deer' AND (res = 'Resident' OR res IS NULL) AND R3 IN ('Renew', 'Reactivate')
    AND (age IN ('25-34', '35-44') OR age IS NULL))
SELECT 'trend' AS part, sex AS item, year, count(*) * 10.0::DOUBLE AS value FROM shown WHERE sex IS NOT NULL GROUP BY sex, year
UNION ALL
SELECT 'age', age, 2000, round(count(*) / CAST((SELECT count(*) FROM shown WHERE year = 2000) AS DOUBLE) * 100, 9)
FROM shown WHERE year = 2000 GROUP BY age""")

ORACLE["dive_menu"] = _samp("""
SELECT DISTINCT 'priv' AS menu, priv AS option, CAST(NULL AS INTEGER) AS ord FROM samp
UNION ALL SELECT DISTINCT 'year', CAST(year AS VARCHAR), CAST(-year AS INTEGER) FROM samp""")

# ---- dashboard views
ORACLE["month_view"] = _dash("""
SELECT quarter, "group", segment, CAST(year AS VARCHAR) AS year, CAST(category AS INTEGER) AS category, metric, value
FROM dash WHERE segment = 'month'""")
ORACLE["dash_labels"] = _dash("""
SELECT quarter, "group", segment, year, lower(category) AS category,
  CASE metric WHEN 'participants' THEN 'part' ELSE metric END AS metric, value FROM dash""")
ORACLE["dash_slice"] = _dash("""SELECT * FROM dash WHERE "group" = 'hunt' AND quarter = 2""")
ORACLE["dash_segment"] = _dash("""
SELECT quarter, "group", 'residency' AS segment, year, category, metric, value FROM dash WHERE segment = 'Residency'""")
ORACLE["month_compare"] = _dash("""
SELECT * FROM dash WHERE "group" = 'hunt' AND quarter = 2 AND segment = 'month' AND year IN (2000, 2001)""")
ORACLE["county_view"] = _dash("""
SELECT * FROM dash WHERE "group" = 'hunt' AND quarter = 2 AND segment = 'County' AND year = 2001""")
ORACLE["value_grid"] = _dash("SELECT metric, category, " + ", ".join(
    f"max(value) FILTER (year = {y}) AS y{y}" for y in range(1995, 2002)
) + """ FROM dash WHERE "group" = 'hunt' AND quarter = 2 AND segment = 'Gender' GROUP BY metric, category""")
ORACLE["menu_options"] = _dash("""
SELECT DISTINCT 'quarter' AS menu, CAST(quarter AS VARCHAR) AS option FROM dash
UNION ALL SELECT DISTINCT 'group', "group" FROM dash
UNION ALL SELECT DISTINCT 'year', CAST(year AS VARCHAR) FROM dash WHERE segment = 'County'""")

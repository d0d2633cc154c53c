"""DuckDB text of the test-bed frames, for the oracle side of the check.

Each constant is one or more CTE bodies (``name AS (...)``) that the oracle
queries in ``catalog`` prepend with ``WITH``. They state the same
definitions as ``testbed`` in plain SQL.
"""

LI = """li AS (
  SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev
  FROM lineitem GROUP BY l_orderkey)"""

DAILY_WIDE = LI + """,
daily_wide AS (
  SELECT CAST(o.o_orderdate AS DATE) AS dt, CAST(c.c_nationkey AS BIGINT) AS location,
         o.o_orderstatus AS provider, lower(c.c_mktsegment) AS age, o.o_orderpriority AS race,
         count(*) AS orders, CAST(sum(li.qty) AS DOUBLE) AS quantity,
         CAST(sum(li.rev) AS DOUBLE) AS revenue
  FROM orders o JOIN li ON o.o_orderkey = li.l_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3, 4, 5)"""

_OBS_PART = """SELECT TIMESTAMP '2024-02-01 05:00:00' AS vintage, dt, location, 'county' AS location_type,
         provider, age, race, 'all' AS ethnicity, 'all' AS sex, '{cat}' AS category,
         'new' AS measurement, '{unit}' AS unit, CAST({col} AS DOUBLE) AS value
  FROM daily_wide WHERE {col} IS NOT NULL"""

OBS = DAILY_WIDE + """,
obs AS (
  """ + "\n  UNION ALL\n  ".join(
    _OBS_PART.format(cat=c, unit=u, col=c)
    for c, u in (("orders", "count"), ("quantity", "units"), ("revenue", "usd"))) + ")"

OBS_CUM = OBS + """,
obs_cum AS (
  SELECT vintage, dt, location, location_type, provider, age, race, ethnicity, sex, category,
         'cumulative' AS measurement, unit,
         CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (
           PARTITION BY location, provider, age, race, ethnicity, sex, category, unit
           ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value
  FROM obs)"""

OBS_ALL = OBS + """,
obs_all AS (
  SELECT vintage, dt, location, location_type, category, measurement, unit,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value,
         'all' AS age, 'all' AS race, 'all' AS ethnicity, 'all' AS sex
  FROM obs GROUP BY vintage, dt, location, location_type, category, measurement, unit)"""

LOCATIONS = """locations AS (
  SELECT 'loc#' || CAST(n.n_nationkey AS VARCHAR) AS id, CAST(n.n_nationkey AS BIGINT) AS location,
         'county' AS location_type, CAST(n.n_regionkey AS INTEGER) AS state_fips,
         r.r_name AS state, n.n_name AS name, n.n_name || ', ' || r.r_name AS fullname
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT 'state#' || CAST(r_regionkey AS VARCHAR), CAST(r_regionkey AS BIGINT), 'state',
         CAST(r_regionkey AS INTEGER), r_name, r_name, r_name
  FROM region)"""

VARIABLES = """variables AS (
  SELECT CAST(row_number() OVER (ORDER BY category, measurement, unit) AS INTEGER) AS id, *
  FROM (VALUES ('orders','new','count'), ('quantity','new','units'), ('revenue','new','usd'),
               ('orders','cumulative','count'), ('quantity','cumulative','units'),
               ('revenue','cumulative','usd')) t(category, measurement, unit))"""

PROVIDERS = """providers AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS id, name, priority
  FROM (VALUES ('F', 1), ('O', 1), ('P', 1)) t(name, priority))"""

DEMOGRAPHICS = """demographics AS (
  SELECT CAST(row_number() OVER (ORDER BY age, race, ethnicity, sex) AS INTEGER) AS id, *
  FROM (SELECT s.age, p.race, 'all' AS ethnicity, 'all' AS sex
        FROM (VALUES ('automobile'), ('building'), ('furniture'), ('household'), ('machinery')) s(age),
             (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) p(race)
        UNION ALL SELECT 'all', 'all', 'all', 'all') d)"""

DIMS = ",\n".join([LOCATIONS, VARIABLES, PROVIDERS, DEMOGRAPHICS])

RESOLVED = OBS + ",\n" + DIMS + """,
resolved AS (
  SELECT o.*, l.id AS location_id, p.id AS provider_id, d.id AS demographic_id, v.id AS variable_id
  FROM obs o
  LEFT JOIN locations l ON o.location = l.location AND o.location_type = l.location_type
  LEFT JOIN providers p ON o.provider = p.name
  LEFT JOIN demographics d ON o.age = d.age AND o.race = d.race AND o.ethnicity = d.ethnicity
                          AND o.sex = d.sex
  LEFT JOIN variables v ON o.category = v.category AND o.measurement = v.measurement
                       AND o.unit = v.unit)"""

# Fact table versions used by the state tests: all observations (loaded from
# landing v1, first-of-month rows deleted in batch 7); the base of the upserts has
# two of three parts of the keys, the batch re-delivers one of them and brings the
# third from landing v2 with doubled values.
FACTS = RESOLVED + """,
parted AS (SELECT *, (CAST(dayofyear(dt) AS BIGINT) + location) % 3 AS part FROM resolved),
facts_parted AS (
  SELECT dt, location_id, variable_id, demographic_id, provider_id, value,
         vintage AS last_updated, 'file:///landed/v1' AS source_url, 'orders warehouse' AS source_name,
         (day(dt) = 1) AS deleted, CASE WHEN day(dt) = 1 THEN CAST(7 AS BIGINT) END AS delete_batch_id, part
  FROM parted),
facts AS (SELECT * EXCLUDE (part) FROM facts_parted),
fact_base AS (SELECT * EXCLUDE (part) FROM facts_parted WHERE part <> 2),
fact_batch AS (
  SELECT dt, location_id, variable_id, demographic_id, provider_id, value * 2 AS value,
         TIMESTAMP '2024-03-01 05:00:00' AS last_updated, 'file:///landed/v2' AS source_url,
         'orders warehouse v2' AS source_name, false AS deleted, CAST(NULL AS BIGINT) AS delete_batch_id
  FROM parted WHERE part <> 0)"""

UPSERTED = FACTS + """,
upserted AS (
  SELECT dt, location_id, variable_id, demographic_id, provider_id,
         CASE WHEN n.dt IS NOT NULL THEN n.value ELSE o.value END AS value,
         CASE WHEN n.dt IS NOT NULL THEN n.last_updated ELSE o.last_updated END AS last_updated,
         CASE WHEN o.dt IS NOT NULL THEN o.source_url ELSE n.source_url END AS source_url,
         CASE WHEN o.dt IS NOT NULL THEN o.source_name ELSE n.source_name END AS source_name,
         CASE WHEN n.dt IS NOT NULL THEN n.deleted ELSE o.deleted END AS deleted,
         CASE WHEN n.dt IS NOT NULL THEN n.delete_batch_id ELSE o.delete_batch_id END AS delete_batch_id
  FROM fact_base o FULL OUTER JOIN fact_batch n
    USING (dt, location_id, variable_id, demographic_id, provider_id))"""

PANEL = DAILY_WIDE + """,
pdaily AS (
  SELECT d.location, d.dt, sum(d.orders) AS orders,
         sum(CASE WHEN d.race = '1-URGENT' THEN d.orders ELSE 0 END) AS urgent,
         CAST(n.n_regionkey AS INTEGER) AS state_fips
  FROM daily_wide d JOIN nation n ON d.location = n.n_nationkey GROUP BY d.location, d.dt, n.n_regionkey),
pboth AS (
  SELECT 'county' AS location_type, location, state_fips, dt, orders, urgent FROM pdaily
  UNION ALL
  SELECT 'state', CAST(state_fips AS BIGINT), state_fips, dt, sum(orders), sum(urgent)
  FROM pdaily GROUP BY state_fips, dt),
plong AS (
  SELECT location_type, location, state_fips, dt, 'orders' AS category, CAST(orders AS DOUBLE) AS v FROM pboth
  UNION ALL SELECT location_type, location, state_fips, dt, 'urgent', CAST(urgent AS DOUBLE) FROM pboth),
panel AS (
  SELECT location_type, location, state_fips, dt, category,
         sum(v) OVER (PARTITION BY location_type, location, category ORDER BY dt
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM plong)"""

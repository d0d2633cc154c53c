"""Catalog part 2: joins and dimensions, aggregations, windows, validation,
corrections, serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from almanac import functions as X
from almanac.operators import aggregate as A
from almanac.operators import corrections as M
from almanac.operators import joins as J
from almanac.operators import validate as V
from almanac.operators import windows as W
from almanac.plans import oracle_ctes as C
from almanac.plans import serve as S
from almanac.plans import testbed as TB
from almanac.plans.catalog import query
from almanac.session import scratch_path, table

_VIEW_SQL = """
  SELECT p.name AS provider, f.dt, f.location_id, l.location, l.location_type,
         v.category AS variable_name, v.measurement, v.unit, d.age, d.race, d.ethnicity, d.sex,
         f.last_updated, f.source_url, f.source_name, f.value
  FROM facts f
  LEFT JOIN variables v ON f.variable_id = v.id
  LEFT JOIN locations l ON f.location_id = l.id
  LEFT JOIN providers p ON f.provider_id = p.id
  LEFT JOIN demographics d ON f.demographic_id = d.id
  WHERE NOT f.deleted"""
VIEW = C.FACTS + ",\napi_view AS (" + _VIEW_SQL + ")"


def _view(spark, sf, columns=None):
    return S.api_view(TB.facts(spark, sf), TB.variables(spark), TB.locations(spark, sf),
                      TB.providers(spark), TB.demographics(spark), columns)


# --------------------------------------------------------------- dimensions and joins

@query("load_dimension", """
SELECT CAST(row_number() OVER (ORDER BY location_type, state_fips, name) AS INTEGER) AS id,
       location_type, state_fips, name
FROM (SELECT DISTINCT 'county' AS location_type, CAST(n_regionkey AS INTEGER) AS state_fips, n_name AS name
      FROM nation UNION SELECT 'state', CAST(r_regionkey AS INTEGER), r_name FROM region)""")
def q_load_dimension(spark, sf):
    n = table(spark, sf, "nation").select(F.lit("county").alias("location_type"),
                                          F.col("n_regionkey").cast("int").alias("state_fips"),
                                          F.col("n_name").alias("name"))
    r = table(spark, sf, "region").select(F.lit("state").alias("location_type"),
                                          F.col("r_regionkey").cast("int").alias("state_fips"),
                                          F.col("r_name").alias("name"))
    return J.load_dimension(n.unionByName(r), ["location_type", "state_fips", "name"])


@query("dimension_table", """
WITH r AS (SELECT r_name AS name, row_number() OVER (ORDER BY r_name) AS id FROM region),
n AS (SELECT DISTINCT n_name AS name FROM nation WHERE n_name NOT IN (SELECT name FROM r))
SELECT CAST(id AS INTEGER) AS id, name FROM r
UNION ALL SELECT CAST((SELECT count(*) FROM r) + row_number() OVER (ORDER BY name) AS INTEGER), name FROM n""")
def q_dimension_table(spark, sf):
    """A stored dimension loaded twice: the ids of the first load stay."""
    dim = J.DimensionTable(spark, scratch_path(spark, "dimension"), ["name"])
    regions = table(spark, sf, "region").select(F.col("r_name").alias("name"))
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    dim.load(regions)
    return dim.load(nations.unionByName(regions)).select("id", "name")


_RESOLVED_COLS = ("dt, location, location_type, provider, age, race, ethnicity, sex, category, "
                  "measurement, unit, value, vintage, location_id, provider_id, demographic_id, variable_id")


@query("resolve_keys_fips", "WITH " + C.RESOLVED + f" SELECT {_RESOLVED_COLS} FROM resolved")
def q_resolve_keys_fips(spark, sf):
    return TB.resolved(spark, sf).select(*[c.strip() for c in _RESOLVED_COLS.split(",")])


@query("resolve_keys_name", "WITH " + C.OBS + ",\n" + C.DIMS + """,
named AS (
  SELECT o.*, l.name AS location_name, l.state_fips FROM obs o
  JOIN locations l ON o.location = l.location AND l.location_type = 'county')
SELECT o.dt, o.location_name, o.state_fips, o.category, o.value, l.id AS location_id,
       p.id AS provider_id, d.id AS demographic_id, v.id AS variable_id
FROM named o
LEFT JOIN locations l ON o.location_type = l.location_type AND o.state_fips = l.state_fips
                     AND o.location_name = l.name
LEFT JOIN providers p ON o.provider = p.name
LEFT JOIN demographics d ON o.age = d.age AND o.race = d.race AND o.ethnicity = d.ethnicity AND o.sex = d.sex
LEFT JOIN variables v ON o.category = v.category AND o.measurement = v.measurement AND o.unit = v.unit""")
def q_resolve_keys_name(spark, sf):
    locs = TB.locations(spark, sf)
    names = locs.filter(F.col("location_type") == "county").select(
        "location", F.col("name").alias("location_name"), "state_fips")
    named = TB.obs(spark, sf).join(names, ["location"]).drop("location")
    out = J.resolve_keys(named, locs, TB.providers(spark), TB.demographics(spark),
                         TB.variables(spark), by="name")
    return out.select("dt", "location_name", "state_fips", "category", "value", "location_id",
                      "provider_id", "demographic_id", "variable_id")


@query("api_view", "WITH " + VIEW + " SELECT * FROM api_view")
def q_api_view(spark, sf):
    return _view(spark, sf)


@query("rest_query", "WITH " + VIEW + """
SELECT dt, location, provider, age, race, value FROM api_view
WHERE variable_name = 'revenue' AND dt > DATE '1997-06-01' AND location < 10
ORDER BY dt DESC, location, provider, age, race LIMIT 100""")
def q_rest_query(spark, sf):
    params = {"variable_name": "eq.revenue", "dt": "gt.1997-06-01", "location": "lt.10",
              "order": "dt.desc,location,provider,age,race", "limit": 100,
              "select": "dt,location,provider,age,race,value"}
    return S.rest_query(_view(spark, sf), params)


# Test bed with some dimension rows removed: the unknown-key checks must
# find exactly those.
def _gappy_dims(spark, sf):
    locs = TB.locations(spark, sf).filter(~F.col("location").isin(3, 17) | (F.col("location_type") != "county"))
    dem = TB.demographics(spark).filter(F.col("age") != "household")
    var = TB.variables(spark).filter(F.col("category") != "quantity")
    return locs, dem, var


_GAPPY = C.OBS + ",\n" + C.DIMS + """,
g_locations AS (SELECT * FROM locations WHERE location NOT IN (3, 17) OR location_type <> 'county'),
g_demographics AS (SELECT * FROM demographics WHERE age <> 'household'),
g_variables AS (SELECT * FROM variables WHERE category <> 'quantity')"""


@query("unknown_variables", "WITH " + _GAPPY + """
SELECT DISTINCT category, measurement, unit FROM obs o WHERE NOT EXISTS (
  SELECT 1 FROM g_variables v WHERE v.category = o.category AND v.measurement = o.measurement
  AND v.unit = o.unit)""")
def q_unknown_variables(spark, sf):
    _, _, var = _gappy_dims(spark, sf)
    return J.unknown_variables(TB.obs(spark, sf), var)


@query("unknown_demographics", "WITH " + _GAPPY + """
SELECT DISTINCT age, race, ethnicity, sex FROM obs o WHERE NOT EXISTS (
  SELECT 1 FROM g_demographics d WHERE d.age = o.age AND d.race = o.race
  AND d.ethnicity = o.ethnicity AND d.sex = o.sex)""")
def q_unknown_demographics(spark, sf):
    _, dem, _ = _gappy_dims(spark, sf)
    return J.unknown_demographics(TB.obs(spark, sf), dem)


@query("unknown_locations", "WITH " + _GAPPY + """
SELECT DISTINCT location FROM obs o WHERE NOT EXISTS (
  SELECT 1 FROM g_locations l WHERE l.location = o.location)""")
def q_unknown_locations(spark, sf):
    locs, _, _ = _gappy_dims(spark, sf)
    return J.unknown_locations(TB.obs(spark, sf), locs)


@query("unknown_report", "WITH " + _GAPPY + """
SELECT DISTINCT 'variable' AS kind, category || '|' || measurement || '|' || unit AS key FROM obs o
WHERE NOT EXISTS (SELECT 1 FROM g_variables v WHERE v.category = o.category
                  AND v.measurement = o.measurement AND v.unit = o.unit)
UNION ALL
SELECT DISTINCT 'demographic', age || '|' || race || '|' || ethnicity || '|' || sex FROM obs o
WHERE NOT EXISTS (SELECT 1 FROM g_demographics d WHERE d.age = o.age AND d.race = o.race
                  AND d.ethnicity = o.ethnicity AND d.sex = o.sex)
UNION ALL
SELECT DISTINCT 'location', CAST(location AS VARCHAR) FROM obs o
WHERE NOT EXISTS (SELECT 1 FROM g_locations l WHERE l.location = o.location)""")
def q_unknown_report(spark, sf):
    locs, dem, var = _gappy_dims(spark, sf)
    return J.unknown_report(TB.obs(spark, sf), locs, dem, var)


@query("reject_unresolved", "WITH " + _GAPPY + """,
r AS (
  SELECT o.dt, o.location, o.provider, o.age, o.race, o.category, o.value,
         l.id AS location_id, p.id AS provider_id, d.id AS demographic_id, v.id AS variable_id
  FROM obs o
  LEFT JOIN g_locations l ON o.location = l.location AND o.location_type = l.location_type
  LEFT JOIN providers p ON o.provider = p.name
  LEFT JOIN g_demographics d ON o.age = d.age AND o.race = d.race AND o.ethnicity = d.ethnicity
                            AND o.sex = d.sex
  LEFT JOIN g_variables v ON o.category = v.category AND o.measurement = v.measurement
                         AND o.unit = v.unit)
SELECT dt, location, provider, age, race, category, value,
       array_to_string(list_filter([CASE WHEN location_id IS NULL THEN 'location' END,
                                    CASE WHEN provider_id IS NULL THEN 'provider' END,
                                    CASE WHEN demographic_id IS NULL THEN 'demographic' END,
                                    CASE WHEN variable_id IS NULL THEN 'variable' END],
                                   lambda x: x IS NOT NULL), ',') AS unresolved
FROM r WHERE location_id IS NULL OR provider_id IS NULL OR demographic_id IS NULL
          OR variable_id IS NULL""")
def q_reject_unresolved(spark, sf):
    locs, dem, var = _gappy_dims(spark, sf)
    res = J.resolve_keys(TB.obs(spark, sf), locs, TB.providers(spark), dem, var, on_unresolved="keep")
    rej = J.reject_unresolved(res)
    return rej.select("dt", "location", "provider", "age", "race", "category", "value",
                      F.array_join("unresolved", ",").alias("unresolved"))


@query("nway_merge", """
WITH o AS (SELECT o_custkey AS key, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS ordered, count(*) AS orders
           FROM orders GROUP BY o_custkey),
     e AS (SELECT user_id AS key, count(*) AS events FROM events GROUP BY user_id)
SELECT c.c_custkey AS key, c.c_acctbal AS balance, o.ordered, o.orders, e.events
FROM customer c JOIN o ON c.c_custkey = o.key JOIN e ON c.c_custkey = e.key""")
def q_nway_merge(spark, sf):
    # one frame per source table, merged on the common key
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("key"), F.col("c_acctbal").alias("balance"))
    o = (table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("bigint").alias("key"))
         .agg(X.money_sum("o_totalprice").alias("ordered"), F.count(F.lit(1)).alias("orders")))
    e = table(spark, sf, "events").groupBy(F.col("user_id").cast("bigint").alias("key")).agg(F.count(F.lit(1)).alias("events"))
    return J.nway_merge([c, o, e], ["key"])


@query("key_intersect", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def q_key_intersect(spark, sf):
    o = table(spark, sf, "orders")
    f = o.filter(F.col("o_orderstatus") == "F").select("o_custkey")
    p = o.filter(F.col("o_orderstatus") == "P").select("o_custkey")
    return f.intersect(p)


@query("union_all", """
SELECT event_id, user_id, value FROM events
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders
UNION ALL SELECT event_id, user_id, value FROM events""")
def q_union_all(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "value")
    # by name, not by place; repeated rows stay
    o = table(spark, sf, "orders").select(F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("event_id"),
                                          F.col("o_custkey").alias("user_id"))
    return ev.unionByName(o).unionByName(ev)


@query("union_missing", """
SELECT event_id, user_id, value, NULL::VARCHAR AS props, 'valued' AS kind FROM events
WHERE event_type NOT IN ('signup', 'error')
UNION ALL SELECT event_id, user_id, NULL::DOUBLE, props, 'described' FROM events WHERE event_type IN ('signup', 'error')""")
def q_union_missing(spark, sf):
    ev = table(spark, sf, "events")
    described = F.col("event_type").isin("signup", "error")
    a = ev.filter(~described).select("event_id", "user_id", "value", F.lit("valued").alias("kind"))
    b = ev.filter(described).select("event_id", "user_id", "props", F.lit("described").alias("kind"))
    return a.unionByName(b, allowMissingColumns=True)


# --------------------------------------------------------------- aggregations

@query("rollup_sum", "WITH " + C.OBS + """,
g AS (SELECT o.*, n.n_regionkey FROM obs o JOIN nation n ON o.location = n.n_nationkey)
SELECT n_regionkey AS state_fips, dt, category,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM g GROUP BY n_regionkey, dt, category""")
def q_rollup_sum(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("location"),
                                               F.col("n_regionkey").alias("state_fips"))
    g = TB.obs(spark, sf).join(nation, ["location"])
    return A.rollup_sum(g, ["state_fips", "dt", "category"], ["value"], scale=2)


@query("detail_and_rollup", "WITH " + C.OBS_ALL + """,
g AS (SELECT o.*, n.n_regionkey FROM obs_all o JOIN nation n ON o.location = n.n_nationkey
      WHERE o.location NOT IN (23))
SELECT dt, category, location, value, 'county' AS location_type FROM g WHERE location > 4
UNION ALL
SELECT dt, category, CAST(n_regionkey AS BIGINT), CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 'state'
FROM g GROUP BY dt, category, n_regionkey""")
def q_detail_and_rollup(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("location"),
                                               F.col("n_regionkey").alias("state_fips"))
    g = TB.obs_all(spark, sf).join(nation, ["location"])
    # nations 0-4 play the "unallocated" rows; nation 23 is dropped from both levels
    return A.detail_and_rollup(g, "location", "state_fips", ["dt", "category"], exclude=[23],
                               detail_min_exclusive=4, scale=2)


@query("merge_members_sum", """
SELECT CASE o_orderstatus WHEN 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
       CAST(o_orderdate AS DATE) AS dt,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS o_totalprice
FROM orders GROUP BY 1, 2""")
def q_merge_members_sum(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", F.col("o_orderdate").cast("date").alias("dt"),
                                          "o_totalprice")
    return A.merge_members_sum(o, "o_orderstatus", {"P": "O"}, ["dt"], ["o_totalprice"], scale=2)


@query("strict_group_sum", """
SELECT l_orderkey,
  CASE WHEN count(*) = count(CASE WHEN l_discount > 0 THEN l_discount END)
       THEN CAST(sum(CAST(CASE WHEN l_discount > 0 THEN l_discount END AS DECIMAL(18,2))) AS DOUBLE)
  END AS discount,
  CASE WHEN count(*) = count(l_quantity)
       THEN CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) END AS quantity
FROM lineitem GROUP BY l_orderkey""")
def q_strict_group_sum(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", X.sentinel_to_null("l_discount").alias("discount"),
                                             F.col("l_quantity").alias("quantity"))
    return A.strict_group_sum(li, ["l_orderkey"], ["discount", "quantity"], scale=2)


@query("last_per_key", """
SELECT user_id, event_type,
  max_by(CASE WHEN value - 50 > 0 THEN value - 50 END,
         CASE WHEN value - 50 > 0 THEN event_id END) AS value
FROM events GROUP BY user_id, event_type""")
def q_last_per_key(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "event_id",
                                           X.sentinel_to_null(F.col("value") - 50).alias("value"))
    return A.last_per_key(ev, ["user_id", "event_type"], "value", ordinal="event_id")


@query("distinct_rows", """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS dt FROM events""")
def q_distinct_rows(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("dt"))
    return A.distinct_rows(ev)


@query("is_time_series", "WITH " + C.OBS + """
SELECT location, count(DISTINCT dt) > 1 AS is_time_series FROM obs GROUP BY location
UNION ALL SELECT NULL, count(DISTINCT dt) > 1 FROM obs WHERE location = 0 AND dt = DATE '1996-01-02'""")
def q_is_time_series(spark, sf):
    o = TB.obs(spark, sf)
    per_loc = A.is_time_series(o, ["location"])
    one_day = A.is_time_series(o.filter((F.col("location") == 0) & (F.col("dt") == F.lit("1996-01-02").cast("date"))))
    return per_loc.unionByName(one_day.withColumn("location", F.lit(None).cast("bigint")))


@query("cumulative_present", "WITH " + C.OBS_CUM + """,
mixed AS (SELECT * FROM obs UNION ALL SELECT * FROM obs_cum WHERE category = 'orders')
SELECT category, count(*) FILTER (WHERE measurement = 'cumulative') > 0 AS has_cumulative
FROM mixed GROUP BY category""")
def q_cumulative_present(spark, sf):
    mixed = TB.obs(spark, sf).unionByName(TB.obs_cum(spark, sf).filter(F.col("category") == "orders"))
    return A.cumulative_present(mixed, ["category"])


@query("variable_names", "WITH " + VIEW + """
SELECT DISTINCT provider AS dataset, variable_name FROM api_view
UNION SELECT 'economics', 'wei'""")
def q_variable_names(spark, sf):
    return S.dataset_variables(_view(spark, sf, ["provider", "variable_name"]),
                               registry={"economics": ["wei"]})


@query("required_categories", "WITH " + C.OBS + """
SELECT location, dt, array_to_string(list_filter([
    CASE WHEN count(*) FILTER (WHERE category = 'orders') = 0 THEN 'orders' END,
    CASE WHEN count(*) FILTER (WHERE category = 'refunds') = 0 THEN 'refunds' END],
  lambda x: x IS NOT NULL), ',') AS missing
FROM obs GROUP BY location, dt""")
def q_required_categories(spark, sf):
    out = V.required_categories(TB.obs(spark, sf), ["orders", "refunds"], ["location", "dt"])
    return out.withColumn("missing", F.array_join("missing", ","))


@query("proportional_allocation", "WITH " + C.OBS_ALL + """,
g AS (SELECT o.*, n.n_regionkey FROM obs_all o JOIN nation n ON o.location = n.n_nationkey
      WHERE category = 'orders')
SELECT n_regionkey AS state_fips, location, dt, value,
       round_even(value / sum(value) OVER (PARTITION BY n_regionkey, dt) * 1000, 0) AS allocated
FROM g""")
def q_proportional_allocation(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("location"),
                                               F.col("n_regionkey").alias("state_fips"))
    g = TB.obs_all(spark, sf).filter(F.col("category") == "orders").join(nation, ["location"])
    out = A.proportional_allocation(g, ["state_fips", "dt"], "value", F.lit(1000))
    return out.select("state_fips", "location", "dt", "value", "allocated")


@query("week_bucket", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt,
  CAST(o_orderdate AS DATE) + CAST((8 - CAST(isodow(o_orderdate) AS INTEGER)) % 7 AS INTEGER) AS week_end
FROM orders""")
def q_week_bucket(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("dt"))
    return o.withColumn("week_end", X.week_end_monday("dt"))


# --------------------------------------------------------------- windows

@query("running_total", """
SELECT event_id, user_id, event_type, value,
  CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS total
FROM events""")
def q_running_total(spark, sf):
    ev = table(spark, sf, "events").withColumn("ord", F.struct("ts", "event_id"))
    # a user's events are split by day, so one very active user does not make one task
    out = W.running_total(ev, ["user_id", "event_type"], "ord", "value", out="total", scale=2,
                          bucket=F.to_date("ts"))
    return out.select("event_id", "user_id", "event_type", "value", "total")


@query("daily_new", "WITH " + C.PANEL + """
SELECT location_type, location, category, dt, value,
  value - lag(value) OVER (PARTITION BY location_type, location, category ORDER BY dt) AS new_value
FROM panel""")
def q_daily_new(spark, sf):
    p = TB.county_panel(spark, sf)
    # daily series are short: one window per series
    return W.daily_new(p, ["location_type", "location", "category"]).select(
        "location_type", "location", "category", "dt", "value", "new_value")


@query("drop_plateaus", "WITH " + C.PANEL + """,
f AS (SELECT *, coalesce(dt BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
                         AND location_type = 'county' AND state_fips = 2, false) AS inw FROM panel),
d AS (SELECT *, value - lag(value) OVER (PARTITION BY location_type, location, category, inw
                                         ORDER BY dt) AS diff FROM f)
SELECT location_type, location, state_fips, dt, category, value FROM d
WHERE NOT (inw AND coalesce(diff = 0, false))""")
def q_drop_plateaus(spark, sf):
    p = TB.county_panel(spark, sf)
    scope = (F.col("location_type") == "county") & (F.col("state_fips") == 2)
    return W.drop_plateaus(p, ["location_type", "location", "category"], "1996-01-01", "1996-12-31",
                           scope=scope)


@query("duplicate_keys", """
SELECT user_id, event_type, CAST(ts AS DATE) AS dt, event_id FROM events
QUALIFY count(*) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) > 1""")
def q_duplicate_keys(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("dt"),
                                           "event_id")
    return W.duplicate_keys(ev, ["user_id", "event_type", "dt"])


_SEEDED = """seeded AS (
  SELECT * REPLACE (CASE WHEN day(dt) = 13 THEN value / 2 ELSE value END AS value) FROM obs_cum)"""


def _seeded(spark, sf):
    oc = TB.obs_cum(spark, sf)
    return oc.withColumn("value", F.when(F.dayofmonth("dt") == 13, F.col("value") / 2)
                         .otherwise(F.col("value")))


@query("cumulative_decreases", "WITH " + C.OBS_CUM + ",\n" + _SEEDED + """
SELECT location, provider, age, race, ethnicity, sex, category, unit, dt, value, diff FROM (
  SELECT *, value - lag(value) OVER (PARTITION BY location, provider, category, unit, age, sex, race,
                                     ethnicity ORDER BY dt) AS diff
  FROM seeded WHERE measurement = 'cumulative' AND value IS NOT NULL AND dt >= DATE '1997-01-01')
WHERE diff < 0""")
def q_cumulative_decreases(spark, sf):
    key = ["location", "provider", "category", "unit", "age", "sex", "race", "ethnicity"]
    out = W.cumulative_decreases(_seeded(spark, sf), key, cut_date="1997-01-01")
    return out.select("location", "provider", "age", "race", "ethnicity", "sex", "category", "unit",
                      "dt", "value", "diff")


_ORDER_KEYS = "location, dt, measurement, age, sex, race, ethnicity, provider"
_ORDER_SQL = "WITH " + C.OBS_CUM + """
SELECT """ + _ORDER_KEYS + """, s.unit AS small_unit, l.unit AS large_unit,
       s.value AS small_value, l.value AS large_value
FROM (SELECT * FROM obs_cum WHERE category = '{small}') s
JOIN (SELECT * FROM obs_cum WHERE category = '{large}') l USING (""" + _ORDER_KEYS + """)
WHERE l.value {op} s.value"""


@query("category_order_check", _ORDER_SQL.format(small="quantity", large="orders", op="<"))
def q_category_order_check(spark, sf):
    return V.category_order_check(TB.obs_cum(spark, sf), small="quantity", large="orders")


@query("category_order_check_strict", _ORDER_SQL.format(small="orders", large="quantity", op="<="))
def q_category_order_check_strict(spark, sf):
    return V.category_order_check(TB.obs_cum(spark, sf), small="orders", large="quantity", strict=True)


_FOUND = """SELECT '{check}' AS "check", {category} AS category, {other} AS other_category, location, age, sex, race,
  ethnicity, provider, dt, {unit} AS unit, {ounit} AS other_unit, {value} AS value, {ovalue} AS other_value FROM """


@query("validation_report", "WITH " + C.OBS_CUM + ",\n" + _SEEDED + ",\nfalls AS (" + """
  SELECT *, lag(value) OVER (PARTITION BY location, provider, category, unit, age, sex, race, ethnicity
                             ORDER BY dt) AS before
  FROM seeded WHERE dt >= DATE '1997-01-01')
""" + _FOUND.format(check="cumulative_decrease", category="category", other="CAST(NULL AS VARCHAR)", unit="unit",
                    ounit="unit", value="value", ovalue="before") + " falls WHERE value < before" + "".join(
    "\nUNION ALL " + _FOUND.format(check="category_order", category=f"'{a}'", other=f"'{b}'", unit="s.unit", ounit="l.unit",
                                   value="s.value", ovalue="l.value")
    + f"(SELECT * FROM seeded WHERE category = '{a}') s JOIN (SELECT * FROM seeded WHERE category = '{b}') l "
    + f"USING ({_ORDER_KEYS}) WHERE l.value < s.value" for a, b in (
        ("orders", "quantity"), ("quantity", "revenue"), ("revenue", "orders"))))
def q_validation_report(spark, sf):
    """Decreases and three ordered pairs (the last one never holds) in one frame."""
    return V.violations(_seeded(spark, sf), [("orders", "quantity"), ("quantity", "revenue"), ("revenue", "orders")],
                        cut_date="1997-01-01")


# --------------------------------------------------------------- corrections

# Test corrections (location or state, date, count).
COUNTY_CORRECTIONS = [(3, "1996-03-01", 5), (7, "1997-06-15", 3), (12, "1995-01-10", 2)]
STATE_CORRECTIONS = [(1, "1996-07-01", 20), (4, "1998-02-02", 10), (1, "1999-05-05", 7)]

_COUNTY_DELTAS = """
cc AS (SELECT * FROM (VALUES (3, DATE '1996-03-01', 5), (7, DATE '1997-06-15', 3),
                             (12, DATE '1995-01-10', 2)) t(location, cdt, n)),
deltas1 AS (
  SELECT 'county' AS location_type, CAST(location AS BIGINT) AS location, cdt, n FROM cc
  UNION ALL
  SELECT 'state', CAST(nn.n_regionkey AS BIGINT), cdt, n FROM cc JOIN nation nn ON cc.location = nn.n_nationkey),
adj1 AS (
  SELECT p.location_type, p.location, p.category, p.dt,
         coalesce(sum(d.n) FILTER (WHERE p.category = 'orders'), 0) AS a
  FROM panel p LEFT JOIN deltas1 d ON p.location_type = d.location_type AND p.location = d.location
                                   AND d.cdt <= p.dt
  GROUP BY p.location_type, p.location, p.category, p.dt),
panel1 AS (
  SELECT p.location_type, p.location, p.state_fips, p.dt, p.category, p.value - a.a AS value
  FROM panel p JOIN adj1 a USING (location_type, location, category, dt))"""


@query("backfill_county", "WITH " + C.PANEL + "," + _COUNTY_DELTAS + " SELECT * FROM panel1")
def q_backfill_county(spark, sf):
    return M.backfill_county(TB.county_panel(spark, sf), COUNTY_CORRECTIONS,
                             TB.locations(spark, sf), category="orders")


@query("backfill_state", "WITH " + C.PANEL + "," + _COUNTY_DELTAS + """,
sc AS (SELECT * FROM (VALUES (1, DATE '1996-07-01', 20), (4, DATE '1998-02-02', 10),
                             (1, DATE '1999-05-05', 7)) t(sf, cdt, n)),
cnew AS (
  SELECT location, state_fips, dt,
         value - lag(value) OVER (PARTITION BY location, category ORDER BY dt) AS w
  FROM panel1 WHERE location_type = 'county' AND category = 'orders'),
alloc AS (
  SELECT 'county' AS location_type, c.location, sc.cdt,
         CAST(coalesce(round_even(c.w / sum(c.w) OVER (PARTITION BY sc.sf, sc.cdt) * sc.n, 0), 0)
              AS BIGINT) AS n
  FROM cnew c JOIN sc ON c.state_fips = sc.sf AND c.dt = sc.cdt),
deltas2 AS (
  SELECT * FROM alloc UNION ALL SELECT 'state', CAST(sf AS BIGINT), cdt, n FROM sc),
adj2 AS (
  SELECT p.location_type, p.location, p.category, p.dt,
         coalesce(sum(d.n) FILTER (WHERE p.category = 'orders'), 0) AS a
  FROM panel1 p LEFT JOIN deltas2 d ON p.location_type = d.location_type AND p.location = d.location
                                    AND d.cdt <= p.dt
  GROUP BY p.location_type, p.location, p.category, p.dt)
SELECT p.location_type, p.location, p.state_fips, p.dt, p.category, p.value - a.a AS value
FROM panel1 p JOIN adj2 a USING (location_type, location, category, dt)""")
def q_backfill_state(spark, sf):
    p = M.backfill_county(TB.county_panel(spark, sf), COUNTY_CORRECTIONS,
                          TB.locations(spark, sf), category="orders")
    return M.backfill_state(p, STATE_CORRECTIONS, category="orders")


# --------------------------------------------------------------- changelog

_CHANGELOG_SQL = "WITH " + VIEW + """,
starts AS (
  SELECT v.variable_name, v.source_name AS source, min(v.dt) AS start_date,
         l.location AS fips, l.state, l.fullname
  FROM api_view v LEFT JOIN locations l ON v.location_id = l.id
  GROUP BY v.location_id, v.variable_name, v.source_name, l.location, l.state, l.fullname),
wk AS (SELECT *, start_date + CAST((8 - CAST(isodow(start_date) AS INTEGER)) % 7 AS INTEGER) AS week_end
       FROM starts)
SELECT week_end, week_end - 7 AS week_start, state, fips, fullname AS name, source,
       array_to_string(list_sort(list(variable_name)), ',') AS variables
FROM wk GROUP BY week_end, state, fips, fullname, source"""


@query("changelog_report", _CHANGELOG_SQL)
def q_changelog_report(spark, sf):
    view = _view(spark, sf, ["location_id", "variable_name", "source_name", "dt"]) \
        .withColumnRenamed("source_name", "source")
    starts = S.variable_start_dates(view, TB.locations(spark, sf))
    report = S.changelog_report(starts)
    counties = report.select("week_end", "week_start", "state", F.explode("counties").alias("c"))
    return counties.select("week_end", "week_start", "state", F.col("c.fips").alias("fips"),
                           F.col("c.name").alias("name"),
                           F.explode("c.sources").alias("source", "vars")) \
        .withColumn("variables", F.array_join("vars", ",")).drop("vars")

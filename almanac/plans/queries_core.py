"""Catalog part 1: projections, filters, scalar functions, reshape."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from almanac import functions as X
from almanac.operators import reshape as R
from almanac.operators import transform as P
from almanac.plans import oracle_ctes as C
from almanac.plans import testbed as TB
from almanac.plans.catalog import query
from almanac.session import table

# DuckDB spelling of Python title case (letter runs capitalised).
def _title_sql(expr: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1),"
            f" lambda x: upper(x[1]) || lower(x[2:])), '')")


# --------------------------------------------------------------- scans / limits

@query("scan_table", "SELECT * FROM orders")
def q_scan_table(spark, sf):
    return table(spark, sf, "orders")


@query("order_limit", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def q_order_limit(spark, sf):
    # top-k report: the limit is the feature
    o = table(spark, sf, "orders")
    return (o.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date"))
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20))


@query("range_filter", """
SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
WHERE l_quantity > 10 AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""")
def q_range_filter(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date"))
    li = P.range_filter(li, "l_quantity", low=10, low_inclusive=False)
    return P.range_filter(li, "l_shipdate", "1996-01-01", "1997-12-31")


@query("keep_by_values", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'""")
def q_keep_by_values(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return P.keep_by_values(o, {"o_orderstatus": ["F", "O"], "o_orderpriority": "1-URGENT"})


@query("drop_by_values", """
SELECT c_custkey, c_mktsegment, seg FROM (
  SELECT c_custkey, c_mktsegment,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer)
WHERE seg IS NULL OR seg NOT IN ('BUILDING', 'MACHINERY')""")
def q_drop_by_values(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg"))
    # null keys pass, as with pandas ~isin
    return P.drop_by_values(c, "seg", ["BUILDING", "MACHINERY"])


@query("drop_nulls", """
SELECT l_orderkey, l_linenumber, l_discount AS discount, l_tax AS tax FROM lineitem
WHERE l_discount > 0 AND l_tax > 0""")
def q_drop_nulls(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", X.sentinel_to_null("l_discount").alias("discount"),
        X.sentinel_to_null("l_tax").alias("tax"))
    return P.drop_nulls(li, ["discount", "tax"])


@query("drop_zeros", """
SELECT l_orderkey, l_linenumber, l_discount AS value FROM lineitem WHERE l_discount <> 0""")
def q_drop_zeros(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                             F.col("l_discount").alias("value"))
    return P.drop_zeros(li)


# --------------------------------------------------------------- column housekeeping

@query("normalize_column_names", "SELECT * FROM orders")
def q_normalize_column_names(spark, sf):
    o = table(spark, sf, "orders")
    messy = o.toDF(*[f"  {c.upper()} " for c in o.columns])
    return P.normalize_column_names(messy)


_CONTRACT = ("vintage, dt, location, category, measurement, unit, age, race, ethnicity, sex, value")


@query("project_contract", "WITH " + C.OBS + f"""
SELECT {_CONTRACT}, 'orders warehouse' AS source_name FROM obs""")
def q_project_contract(spark, sf):
    from almanac.schema import contract_columns
    return P.project_contract(TB.obs(spark, sf), contract_columns() + ["source_name"],
                              constants={"source_name": TB.SOURCE_NAME})


_LOADED = ("dt, location, location_type, category, measurement, unit, age, race, ethnicity, sex, "
           "value, provider, vintage AS last_updated, 'file:///landed/orders' AS source_url, "
           "'orders warehouse' AS source_name")


@query("load_defaults", "WITH " + C.OBS + f"SELECT {_LOADED}, 'op-1' AS insert_op FROM obs")
def q_load_defaults(spark, sf):
    return P.load_defaults(TB.obs(spark, sf), provider=None, source_url=TB.SOURCE_URL,
                           source_name=TB.SOURCE_NAME, location_type="state", insert_op="op-1")


@query("conform_columns", "WITH " + C.OBS + f"SELECT {_LOADED} FROM obs")
def q_conform_columns(spark, sf):
    staged = P.load_defaults(TB.obs(spark, sf), provider=None, source_url=TB.SOURCE_URL,
                             source_name=TB.SOURCE_NAME, location_type="state", insert_op="op-1")
    target = ["dt", "location", "location_type", "category", "measurement", "unit", "age", "race",
              "ethnicity", "sex", "value", "provider", "last_updated", "source_url", "source_name"]
    return P.conform_columns(staged, target)


@query("contract_check", "WITH " + C.OBS + f"SELECT {_CONTRACT} FROM obs")
def q_contract_check(spark, sf):
    from almanac.schema import contract_columns
    return P.contract_check(TB.obs(spark, sf)).select(*contract_columns())


# --------------------------------------------------------------- string functions

@query("title_case", f"""
SELECT p_partkey, {_title_sql('p_name')} AS name_t, {_title_sql('p_type')} AS type_t,
       {_title_sql("p_brand || '-' || lower(p_type)")} AS brand_t FROM part""")
def q_title_case(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.title_case("p_name").alias("name_t"),
                    X.title_case("p_type").alias("type_t"),
                    X.title_case(F.concat("p_brand", F.lit("-"), F.lower("p_type"))).alias("brand_t"))


@query("replace_substring", """
SELECT p_partkey, replace(replace(p_type, 'ECONOMY', 'econ'), 'O', '0') AS t,
       lower(replace(p_name, ' ', '')) AS n FROM part""")
def q_replace_substring(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.replace_substrings("p_type", [("ECONOMY", "econ"), ("O", "0")]).alias("t"),
                    X.normalize_name("p_name").alias("n"))


@query("replace_values", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction'
  WHEN 'MACHINERY' THEN 'industrial' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def q_replace_values(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return P.replace_values(c, "c_mktsegment", {"BUILDING": "construction", "MACHINERY": "industrial"})


@query("replace_values_all", """
SELECT p_partkey,
  CASE WHEN p_name = 'ECONOMY' THEN 'budget' WHEN p_name = 'Brand#1' THEN NULL ELSE p_name END AS p_name,
  CASE WHEN p_brand = 'ECONOMY' THEN 'budget' WHEN p_brand = 'Brand#1' THEN NULL ELSE p_brand END AS p_brand,
  CASE WHEN p_type = 'ECONOMY' THEN 'budget' WHEN p_type = 'Brand#1' THEN NULL ELSE p_type END AS p_type,
  p_size FROM part""")
def q_replace_values_all(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return P.replace_values_all(p, {"ECONOMY": "budget"}, to_null=["Brand#1"])


@query("zero_pad", """
SELECT c_custkey, repeat('0', greatest(5 - length(CAST(c_nationkey AS VARCHAR)), 0)) || c_nationkey AS fips,
       repeat('0', greatest(2 - length(CAST(c_custkey AS VARCHAR)), 0)) || c_custkey AS short FROM customer""")
def q_zero_pad(spark, sf):
    # most customer keys are longer than two digits: they stay whole
    c = table(spark, sf, "customer")
    return c.select("c_custkey", X.zero_pad("c_nationkey").alias("fips"), X.zero_pad("c_custkey", 2).alias("short"))


@query("fips_prefix_match", """
SELECT c_custkey, fips, substr(fips, 1, 2) AS state_prefix FROM (
  SELECT c_custkey, repeat('0', greatest(5 - length(CAST(c_custkey AS VARCHAR)), 0)) || c_custkey AS fips FROM customer)
WHERE regexp_matches(fips, '^0[0-4]')""")
def q_fips_prefix_match(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", X.zero_pad("c_custkey").alias("fips"))
    return (c.filter(F.col("fips").rlike("^0[0-4]"))
            .withColumn("state_prefix", F.substring("fips", 1, 2)))


@query("state_to_fips", """
SELECT c.c_custkey, 'NATION_' || CAST(c.c_nationkey AS VARCHAR) AS code,
       n.n_nationkey AS location
FROM customer c JOIN nation n ON n.n_name = 'NATION_' || CAST(c.c_nationkey AS VARCHAR)""")
def q_state_to_fips(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("code"))
    states = table(spark, sf, "nation").select(F.col("n_name").alias("code"),
                                               F.col("n_nationkey").alias("fips"))
    return P.state_to_fips(c, states, "code")


# Priority spellings -> ordinal (with spelling variants).
PRIORITY_ORDINAL = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "3-MEDUIM": 2,
                    "4-NOT SPECIFIED": 3, "5-LOW": 4}


@query("ordinal_map", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
  WHEN '3-MEDIUM' THEN 2 WHEN '3-MEDUIM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4
  END AS level FROM orders""")
def q_ordinal_map(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", X.replace_map("o_orderpriority", PRIORITY_ORDINAL)
                    .cast("int").alias("level"))


@query("conditional_assign", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS o_totalprice
FROM orders""")
def q_conditional_assign(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return P.conditional_assign(o, "o_totalprice", F.col("o_orderstatus") == "F", 0.0) \
        .drop("o_orderstatus")


# --------------------------------------------------------------- numeric / date functions

@query("parse_numeric", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity AS qty FROM lineitem""")
def q_parse_numeric(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.format_number("l_extendedprice", 2).alias("price_text"),
        F.when(F.col("l_quantity").isNull(), F.lit("nan")).otherwise(
            F.format_number("l_quantity", 2)).alias("qty_text"))
    return li.select("l_orderkey", "l_linenumber", X.parse_numeric("price_text").alias("price"),
                     X.parse_numeric("qty_text").alias("qty"))


@query("parse_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders""")
def q_parse_date(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("raw"))
    return o.select("o_orderkey", X.parse_date("raw", "MM/dd/yyyy").alias("dt"))


@query("epoch_ms_to_date", """
SELECT event_id, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ms, CAST(ts AS DATE) AS dt FROM events""")
def q_epoch_ms_to_date(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return ev.withColumn("dt", X.epoch_ms_to_date("ms"))


@query("run_date_vintage", """
SELECT event_id, date_trunc('hour', ts) AS vintage,
       CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS run_date,
       CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) - 1 AS run_date_m1
FROM events""")
def q_run_date_vintage(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("run_ts"))
    return ev.select("event_id", X.vintage_of("run_ts").cast("timestamp_ntz").alias("vintage"),
                     X.run_date("run_ts", "America/New_York").alias("run_date"),
                     X.run_date("run_ts", "America/New_York", minus_days=1).alias("run_date_m1"))


@query("date_shift", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 6 AS week_end FROM orders""")
def q_date_shift(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", X.date_shift(F.col("o_orderdate").cast("date"), 6).alias("week_end"))


@query("scale_ratio", """
SELECT l_orderkey, l_linenumber, (l_discount * 100) / 100 AS ratio FROM lineitem""")
def q_scale_ratio(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                             (F.col("l_discount") * 100).alias("pct"))
    return li.select("l_orderkey", "l_linenumber", (F.col("pct") / 100).alias("ratio"))


@query("ratio_times_population", """
SELECT l_orderkey, l_linenumber, l_discount * l_extendedprice AS people FROM lineitem""")
def q_ratio_times_population(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_discount") * F.col("l_extendedprice")).alias("people"))


@query("coverage_average", """
SELECT l_orderkey, l_linenumber,
       l_extendedprice / CASE WHEN l_discount > 0 THEN l_discount END AS avg FROM lineitem""")
def q_coverage_average(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.coverage_average("l_extendedprice", X.sentinel_to_null("l_discount")).alias("avg"))


@query("coverage_week_total", """
SELECT l_orderkey, l_linenumber,
       (l_extendedprice / CASE WHEN l_discount > 0 THEN l_discount END) * 7 AS adult,
       coalesce((l_quantity / CASE WHEN l_discount > 0 THEN l_discount END) * 7, 0) AS pediatric
FROM lineitem""")
def q_coverage_week_total(spark, sf):
    li = table(spark, sf, "lineitem")
    cov = X.sentinel_to_null("l_discount")
    # the paediatric estimate divides by the adult coverage column, as the source does
    return li.select("l_orderkey", "l_linenumber",
                     X.coverage_week_total("l_extendedprice", cov).alias("adult"),
                     F.coalesce(X.coverage_week_total("l_quantity", cov), F.lit(0.0)).alias("pediatric"))


@query("null_asymmetric_sum", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_discount > 0 THEN l_discount END + coalesce(CASE WHEN l_tax > 0 THEN l_tax END, 0) AS ab,
  CASE WHEN l_tax > 0 THEN l_tax END + coalesce(CASE WHEN l_discount > 0 THEN l_discount END, 0) AS ba
FROM lineitem""")
def q_null_asymmetric_sum(spark, sf):
    li = table(spark, sf, "lineitem")
    a, b = X.sentinel_to_null("l_discount"), X.sentinel_to_null("l_tax")
    return li.select("l_orderkey", "l_linenumber", X.asymmetric_sum(a, b).alias("ab"),
                     X.asymmetric_sum(b, a).alias("ba"))


@query("strict_column_sum", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_discount > 0 THEN l_discount END + CASE WHEN l_tax > 0 THEN l_tax END + l_quantity AS s
FROM lineitem""")
def q_strict_column_sum(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.strict_sum(X.sentinel_to_null("l_discount"), X.sentinel_to_null("l_tax"),
                                  "l_quantity").alias("s"))


@query("sentinel_to_null", """
SELECT event_id, CASE WHEN value - 100 > 0 THEN value - 100 END AS v FROM events""")
def q_sentinel_to_null(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", X.sentinel_to_null(F.col("value") - 100).alias("v"))


@query("sentinel_to_zero", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS v FROM events""")
def q_sentinel_to_zero(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit("suppressed"))
        .otherwise(F.col("value").cast("string")).alias("raw"))
    return ev.select("event_id", X.parse_numeric(X.sentinel_to_zero("raw")).alias("v"))


# --------------------------------------------------------------- rename / locations

_RENAMED_SQL = f"""
SELECT o.o_orderkey, o.o_totalprice, CAST(o.o_orderdate AS DATE) AS dt,
  CASE WHEN t.nm = 'Nation_4' THEN 'Nation Four' ELSE t.nm END AS location_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN (SELECT n_nationkey, n_name, {_title_sql('n_name')} AS nm FROM nation) t
  ON c.c_nationkey = t.n_nationkey
WHERE t.n_name IS NULL OR t.n_name NOT IN ('NATION_3', 'NATION_5')"""


@query("rename_add_date_location", _RENAMED_SQL)
def q_rename_add_date_location(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                          F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey) \
        .select("o_orderkey", "o_totalprice", "o_orderdate", "n_name")
    return P.rename_add_date_location(
        j, location_name_column="n_name", date_column="o_orderdate",
        location_names_to_drop=["NATION_3", "NATION_5"],
        location_names_to_replace={"Nation_4": "Nation Four"})


@query("locations_of_state", "WITH " + C.LOCATIONS + """
SELECT name, repeat('0', greatest(5 - length(CAST(location AS VARCHAR)), 0)) || location AS fips,
       CASE WHEN name = 'NATION_1' THEN 'Nation One' ELSE name END AS display_name
FROM locations WHERE state_fips = 1 AND location <> 1""")
def q_locations_of_state(spark, sf):
    from almanac.sources.dims import locations_of_state
    return locations_of_state(TB.locations(spark, sf), 1, replace={"NATION_1": "Nation One"})


# --------------------------------------------------------------- reshape

_MELT_SQL = "WITH " + C.DAILY_WIDE + """
SELECT dt, location, provider, age, race, 'orders' AS variable, CAST(orders AS DOUBLE) AS value FROM daily_wide
UNION ALL SELECT dt, location, provider, age, race, 'quantity', quantity FROM daily_wide
UNION ALL SELECT dt, location, provider, age, race, 'revenue', revenue FROM daily_wide"""


@query("melt", _MELT_SQL)
def q_melt(spark, sf):
    return R.melt(TB.daily_wide(spark, sf), ["dt", "location", "provider", "age", "race"],
                  ["orders", "quantity", "revenue"])


@query("reshape_variables", "WITH " + C.OBS + " SELECT * FROM obs")
def q_reshape_variables(spark, sf):
    return TB.obs(spark, sf)


# Descriptor of each event type for the attach test.
EVENT_CMU = {
    "click": R.cmu(category="clicks", measurement="new", unit="events"),
    "view": R.cmu(category="views", measurement="new", unit="events"),
    "purchase": R.cmu(category="purchases", measurement="new", unit="usd", sex="unknown"),
    "signup": R.cmu(category="signups", measurement="new", unit="people"),
    "error": R.cmu(category="errors", measurement="new", unit="events", age="0-17"),
}


@query("attach_cmu", """
SELECT event_id, event_type AS variable, value,
  CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' WHEN 'purchase' THEN 'purchases'
    WHEN 'signup' THEN 'signups' WHEN 'error' THEN 'errors' END AS category,
  'new' AS measurement,
  CASE event_type WHEN 'purchase' THEN 'usd' WHEN 'signup' THEN 'people' ELSE 'events' END AS unit,
  CASE event_type WHEN 'error' THEN '0-17' ELSE 'all' END AS age, 'all' AS race, 'all' AS ethnicity,
  CASE event_type WHEN 'purchase' THEN 'unknown' ELSE 'all' END AS sex
FROM events""")
def q_attach_cmu(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("event_type").alias("variable"), "value")
    return R.attach_cmu(ev, EVENT_CMU)


@query("reshape_with_demographic", "WITH " + C.DAILY_WIDE + """
SELECT TIMESTAMP '2024-02-01 05:00:00' AS vintage, dt, location, provider,
  CASE age WHEN 'automobile' THEN 'auto' ELSE age END AS age, 'all' AS race, 'all' AS ethnicity,
  'all' AS sex, category, 'new' AS measurement, unit, value FROM (
  SELECT dt, location, provider, age, 'orders' AS category, 'count' AS unit,
         CAST(orders AS DOUBLE) AS value FROM daily_wide
  UNION ALL SELECT dt, location, provider, age, 'quantity', 'units', quantity FROM daily_wide
  UNION ALL SELECT dt, location, provider, age, 'revenue', 'usd', revenue FROM daily_wide)""")
def q_reshape_with_demographic(spark, sf):
    wide = TB.daily_wide(spark, sf).drop("race")
    return R.reshape_with_demographic(wide, TB.VARIABLE_MAP, "age", relabel={"automobile": "auto"},
                                      id_vars=["provider", "age"], vintage=TB.run_ts())


_SPLIT_SQL = "WITH " + C.DAILY_WIDE + """,
by_dim AS (
  SELECT dt, location, 'Segment' AS demographic_category, age AS demographic_value,
         count(*) AS n, CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
  FROM daily_wide GROUP BY 1, 2, 3, 4
  UNION ALL
  SELECT dt, location, 'Priority', race, count(*), CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE)
  FROM daily_wide GROUP BY 1, 2, 3, 4)
SELECT TIMESTAMP '2024-02-01 05:00:00' AS vintage, dt, location, demographic_category,
  demographic_value,
  CASE WHEN demographic_category = 'Segment' THEN demographic_value ELSE 'all' END AS age,
  CASE WHEN demographic_category = 'Priority' THEN demographic_value ELSE 'all' END AS race,
  'all' AS ethnicity, 'all' AS sex, category, 'new' AS measurement, unit, value FROM (
  SELECT *, 'orders' AS category, 'count' AS unit, CAST(n AS DOUBLE) AS value FROM by_dim
  UNION ALL SELECT *, 'revenue', 'usd', revenue FROM by_dim)"""


@query("split_demographics", _SPLIT_SQL)
def q_split_demographics(spark, sf):
    # each wide row counts once for its segment and once for its priority: one pass
    dims = F.array(*[F.struct(F.lit(label).alias("demographic_category"), F.col(c).alias("demographic_value"))
                     for c, label in (("age", "Segment"), ("race", "Priority"))])
    stacked = (TB.daily_wide(spark, sf).select("dt", "location", "revenue", F.inline(dims))
               .groupBy("dt", "location", "demographic_category", "demographic_value")
               .agg(F.count(F.lit(1)).alias("n"), X.money_sum("revenue").alias("revenue")))
    split = R.split_demographics(stacked, "demographic_category", "demographic_value",
                                 {"Segment": "age", "Priority": "race"})
    vmap = {"n": R.cmu(category="orders", measurement="new", unit="count"),
            "revenue": R.cmu(category="revenue", measurement="new", unit="usd")}
    return R.reshape_variables(split, vmap, id_vars=["demographic_category", "demographic_value",
                                                     "age", "race", "ethnicity", "sex"],
                               vintage=TB.run_ts(), skip_columns=["age", "race", "ethnicity", "sex"])


@query("melt_date_columns", """
SELECT user_id, CAST(ts AS DATE) AS dt, CAST(count(*) AS DOUBLE) AS value
FROM events GROUP BY 1, 2""")
def q_melt_date_columns(spark, sf):
    ev = table(spark, sf, "events")
    # wide: one column per day of the calendar between the first and the last event,
    # as a landed wide file would be; the column list comes from two dates
    first, last = ev.select(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    days = [str(first + _dt.timedelta(days=i)) for i in range((last - first).days + 1)] if first else []
    wide = (ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
            .groupBy("user_id").pivot("day", days).agg(F.count(F.lit(1))))
    long = R.melt_date_columns(wide, ["user_id"])
    return P.drop_nulls(long)


@query("pivot_sum_total", """
SELECT o_orderpriority,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS "F",
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS "O",
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS "P",
  CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F'), 0)
     + coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O'), 0)
     + coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P'), 0)
     AS DOUBLE) AS total
FROM orders GROUP BY o_orderpriority""")
def q_pivot_sum_total(spark, sf):
    o = table(spark, sf, "orders")
    return R.pivot_sum_total(o, ["o_orderpriority"], "o_orderstatus", "o_totalprice", ["F", "O", "P"], scale=2)


@query("pivot_first_metrics", """
SELECT user_id,
  min_by(value, event_id) FILTER (WHERE event_type = 'click') AS click,
  min_by(value, event_id) FILTER (WHERE event_type = 'error') AS error,
  min_by(value, event_id) FILTER (WHERE event_type = 'purchase') AS purchase,
  min_by(value, event_id) FILTER (WHERE event_type = 'signup') AS signup,
  min_by(value, event_id) FILTER (WHERE event_type = 'view') AS view
FROM events GROUP BY user_id""")
def q_pivot_first_metrics(spark, sf):
    ev = table(spark, sf, "events")
    return R.pivot_first_metrics(ev, ["user_id"], "event_type", "value",
                                 ["click", "error", "purchase", "signup", "view"], ordinal="event_id")


# Revenue is reported three days after the rest: the window still ends at the latest
# date of the whole frame.
_LATE = """late AS (
  SELECT * REPLACE (CASE WHEN category = 'revenue' THEN dt + 3 ELSE dt END AS dt) FROM obs_all)"""


@query("latest_window_pivot", "WITH " + C.OBS_ALL + ",\n" + _LATE + """,
m AS (SELECT max(dt) AS mx FROM late)
SELECT location, dt,
  max(value) FILTER (WHERE category = 'orders') AS orders,
  max(value) FILTER (WHERE category = 'quantity') AS quantity
FROM late, m WHERE dt > mx - 40 AND category IN ('orders', 'quantity') AND location_type = 'county'
GROUP BY location, dt""")
def q_latest_window_pivot(spark, sf):
    late = TB.obs_all(spark, sf).withColumn(
        "dt", F.when(F.col("category") == "revenue", F.date_add("dt", 3)).otherwise(F.col("dt")))
    return R.latest_window_pivot(late, ["orders", "quantity"], days_back=40, location_type="county")


@query("decode_codes", """
SELECT c.c_custkey, n.n_name AS c_nationkey, c.c_acctbal FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_acctbal > 0""")
def q_decode_codes(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    dictionary = table(spark, sf, "nation").select(F.col("n_nationkey").alias("idx"),
                                                   F.col("n_name").alias("value"))
    return R.decode_codes(c, "c_nationkey", dictionary, pre_filter=F.col("c_acctbal") > 0)

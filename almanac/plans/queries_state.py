"""Catalog part 3: fact-table state (upsert, select, delete, undelete,
reprocess), snapshots and publishing."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from almanac.errors import ValidationError
from almanac.operators import store as ST
from almanac.operators.dimensions import Dimension, DimensionSet
from almanac.plans import oracle_ctes as C
from almanac.plans import serve as S
from almanac.plans import testbed as TB
from almanac.plans.catalog import query
from almanac.plans.maintenance import reprocess_vintages
from almanac.plans.queries_more import VIEW, _view
from almanac.schema import PUBLISHED_SCHEMA
from almanac.session import literal_frame, scratch_path, settle, table
from almanac.sources import files as FS
from almanac.sources import raw as RAW

_PK = "dt, location_id, variable_id, demographic_id, provider_id"


def _versions(spark, sf):
    res = TB.resolved(spark, sf)
    return TB.fact_base(spark, sf, res), TB.fact_batch(spark, sf, res)


@query("upsert", "WITH " + C.UPSERTED + " SELECT * FROM upserted")
def q_upsert(spark, sf):
    base, batch = _versions(spark, sf)
    return ST.upsert(base, batch)


@query("upsert_counts", "WITH " + C.FACTS + f"""
SELECT count(*) FILTER (WHERE o.dt IS NULL) AS rows_inserted,
       count(*) FILTER (WHERE o.dt IS NOT NULL) AS rows_updated, count(*) AS batch_rows
FROM fact_batch n LEFT JOIN (SELECT {_PK}, true AS hit FROM fact_base) o USING ({_PK})""")
def q_upsert_counts(spark, sf):
    base, batch = _versions(spark, sf)
    return ST.upsert_counts(base, batch)


@query("upsert_revives_deleted", "WITH " + C.UPSERTED + f"""
SELECT u.* FROM upserted u JOIN fact_base o USING ({_PK}) WHERE o.deleted AND NOT u.deleted""")
def q_upsert_revives_deleted(spark, sf):
    base, batch = _versions(spark, sf)
    merged = ST.upsert(base, batch)
    was_deleted = base.filter("deleted").select(*ST.FACT_PK)
    return merged.join(was_deleted, ST.FACT_PK, "left_semi").filter(~F.col("deleted"))


_SELECTED = f"""
  provider_id IN (SELECT id FROM providers WHERE regexp_matches(name, 'F|O'))
  AND variable_id IN (SELECT id FROM variables WHERE regexp_matches(category, 'rev|ord')
                      AND regexp_matches(unit, '.+') AND regexp_matches(measurement, 'new'))
  AND location_id IN (SELECT id FROM locations WHERE state_fips = 1
                      AND regexp_matches(location_type, 'coun'))
  AND dt >= DATE '1996-01-01' AND dt <= DATE '1998-06-30'"""

_DELETE_ARGS = dict(provider="F|O", variable_regex="rev|ord", measurement_regex="new", state_fips=1,
                    location_type_regex="coun", start_date="1996-01-01", end_date="1998-06-30")


@query("soft_delete", "WITH " + C.FACTS + f""",
nb AS (SELECT coalesce(max(delete_batch_id), 0) + 1 AS b FROM facts)
SELECT dt, location_id, variable_id, demographic_id, provider_id, value, last_updated, source_url,
       source_name, CASE WHEN sel THEN true ELSE deleted END AS deleted,
       CASE WHEN sel THEN b ELSE delete_batch_id END AS delete_batch_id, sel AS changed
FROM (SELECT *, ({_SELECTED}) AS sel FROM facts), nb""")
def q_soft_delete(spark, sf):
    base = TB.facts(spark, sf)
    # the batch id comes from the caller's sequence (the next after the table's
    # batch 7); ST.next_batch_id derives max + 1 from a stored table instead
    batch_id = TB.BASE_DELETE_BATCH + 1
    return ST.soft_delete(base, TB.providers(spark), TB.variables(spark), TB.locations(spark, sf),
                          batch_id=batch_id, **_DELETE_ARGS)


@query("undelete", "WITH " + C.FACTS + """
SELECT dt, location_id, variable_id, demographic_id, provider_id, value, last_updated, source_url,
       source_name, CASE WHEN coalesce(delete_batch_id = 7, false) THEN false ELSE deleted END AS deleted,
       CASE WHEN coalesce(delete_batch_id = 7, false) THEN NULL ELSE delete_batch_id END AS delete_batch_id,
       coalesce(delete_batch_id = 7, false) AS changed
FROM facts""")
def q_undelete(spark, sf):
    return ST.undelete(TB.facts(spark, sf), TB.BASE_DELETE_BATCH)


@query("select_observations", "WITH " + C.FACTS + """
SELECT * FROM facts
WHERE provider_id IN (SELECT id FROM providers WHERE regexp_matches(name, 'P'))
  AND variable_id IN (SELECT id FROM variables WHERE regexp_matches(category, '.+')
                      AND regexp_matches(unit, 'count|usd') AND regexp_matches(measurement, '.+'))
  AND location_id IN (SELECT id FROM locations WHERE location = 5)
  AND dt >= DATE '1995-06-01'""")
def q_select_observations(spark, sf):
    # the location filter beats the state filter; the type regex would only
    # apply in the state branch
    return ST.select_observations(TB.facts(spark, sf), TB.providers(spark), TB.variables(spark),
                                  TB.locations(spark, sf), provider="P", unit_regex="count|usd",
                                  location=5, state_fips=3, location_type_regex="state",
                                  start_date="1995-06-01")


@query("selection_row_cap", "WITH " + C.FACTS + f"""
SELECT * FROM facts
WHERE provider_id IN (SELECT id FROM providers WHERE regexp_matches(name, 'F|O'))
  AND location_id IN (SELECT id FROM locations WHERE state_fips = 2 AND regexp_matches(location_type, '.+'))
ORDER BY {_PK} LIMIT 500""")
def q_selection_row_cap(spark, sf):
    # the cap is the feature: the first rows of the selection by key
    return ST.select_observations(TB.facts(spark, sf), TB.providers(spark), TB.variables(spark),
                                  TB.locations(spark, sf), provider="F|O", state_fips=2, limit=500)


@query("fact_table_upsert", "WITH " + C.UPSERTED + " SELECT * FROM upserted")
def q_fact_table_upsert(spark, sf):
    """The stored table: base written, batch merged into its folders, read back."""
    base, batch = _versions(spark, sf)
    facts = ST.FactTable(spark, scratch_path(spark, "fact"))
    facts.write_state(base)
    facts.upsert(batch)
    return facts.read()


@query("fact_table_delete", "WITH " + C.FACTS + f"""
SELECT dt, location_id, variable_id, demographic_id, provider_id, value, last_updated, source_url, source_name,
       CASE WHEN sel THEN true WHEN coalesce(delete_batch_id = 7, false) THEN false ELSE deleted END AS deleted,
       CASE WHEN sel THEN 8 WHEN coalesce(delete_batch_id = 7, false) THEN NULL ELSE delete_batch_id END AS delete_batch_id
FROM (SELECT *, ({_SELECTED}) AS sel FROM facts)""")
def q_fact_table_delete(spark, sf):
    """The stored table: a soft delete, then the base's own delete batch undone."""
    facts = ST.FactTable(spark, scratch_path(spark, "fact"))
    facts.write_state(TB.facts(spark, sf))
    facts.delete(TB.providers(spark), TB.variables(spark), TB.locations(spark, sf), **_DELETE_ARGS)
    facts.undelete(TB.BASE_DELETE_BATCH)
    return facts.read()


@query("delete_batches", "WITH " + C.FACTS + f""",
a AS (SELECT *, ({_SELECTED}) AS first_sel, provider_id IN (SELECT id FROM providers WHERE regexp_matches(name, 'F')) AS second_sel FROM facts),
b AS (SELECT *, CASE WHEN second_sel THEN 9 WHEN first_sel THEN 8 ELSE delete_batch_id END AS batch FROM a)
SELECT 8 AS delete_batch_id, count(*) FILTER (WHERE first_sel) AS rows_changed, count(*) FILTER (WHERE batch = 8) AS rows_undeleted,
       count(*) FILTER (WHERE batch <> 8 AND batch IS NOT NULL) AS rows_left_deleted FROM b
UNION ALL SELECT 9, count(*) FILTER (WHERE second_sel), 0, count(*) FILTER (WHERE batch <> 8 AND batch IS NOT NULL) FROM b""")
def q_delete_batches(spark, sf):
    """Two deletes take two ids from the table's sequence, the second over part of the
    first's rows; undoing the first leaves the second."""
    facts = ST.FactTable(spark, scratch_path(spark, "fact"))
    facts.write_state(TB.facts(spark, sf))
    dims = (TB.providers(spark), TB.variables(spark), TB.locations(spark, sf))
    first, first_id = facts.delete(*dims, **_DELETE_ARGS)
    second, second_id = facts.delete(*dims, provider="F")
    undone = facts.undelete(first_id)
    left = facts.read().agg(F.count_if("deleted").alias("rows_left_deleted"))
    batches = literal_frame(spark, [(first_id, first, undone), (second_id, second, 0)],
                            "delete_batch_id int, rows_changed long, rows_undeleted long")
    return batches.withColumn("rows_left_deleted", left.scalar())


@query("put_counts", "WITH " + C.FACTS + f"""
SELECT count(*) FILTER (WHERE o.dt IS NULL) AS rows_inserted, count(*) FILTER (WHERE o.dt IS NOT NULL) AS rows_updated,
       count(*) AS batch_rows, count(*) AS rows_deleted
FROM fact_batch n LEFT JOIN (SELECT {_PK}, true AS hit FROM fact_base) o USING ({_PK})""")
def q_put_counts(spark, sf):
    """What a load into the stored table reports: rows new and known, and the rows that
    passed through (and left) the staging area."""
    base, batch = _versions(spark, sf)
    facts = ST.FactTable(spark, scratch_path(spark, "fact"))
    facts.write_state(base)
    counts = facts.upsert(batch)
    return literal_frame(spark, [tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


@query("reprocess_vintages", "WITH " + C.FACTS + f""",
v2 AS (SELECT * REPLACE (value * 3 AS value, TIMESTAMP '2024-04-01 05:00:00' AS last_updated, 'file:///landed/v3' AS source_url)
       FROM fact_batch WHERE day(dt) <= 15),
allv AS (SELECT * FROM fact_batch UNION ALL SELECT * FROM v2),
newest AS (
  SELECT {_PK}, arg_max(value, last_updated) AS value, max(last_updated) AS last_updated,
         arg_min(source_url, last_updated) AS source_url, arg_min(source_name, last_updated) AS source_name,
         arg_max(deleted, last_updated) AS deleted, arg_max(delete_batch_id, last_updated) AS delete_batch_id
  FROM allv GROUP BY {_PK})
SELECT dt, location_id, variable_id, demographic_id, provider_id,
       CASE WHEN n.dt IS NOT NULL THEN n.value ELSE o.value END AS value,
       CASE WHEN n.dt IS NOT NULL THEN n.last_updated ELSE o.last_updated END AS last_updated,
       CASE WHEN o.dt IS NOT NULL THEN o.source_url ELSE n.source_url END AS source_url,
       CASE WHEN o.dt IS NOT NULL THEN o.source_name ELSE n.source_name END AS source_name,
       CASE WHEN n.dt IS NOT NULL THEN n.deleted ELSE o.deleted END AS deleted,
       CASE WHEN n.dt IS NOT NULL THEN n.delete_batch_id ELSE o.delete_batch_id END AS delete_batch_id
FROM fact_base o FULL OUTER JOIN newest n USING ({_PK})""")
def q_reprocess_vintages(spark, sf):
    base, batch = _versions(spark, sf)
    v2 = (batch.filter(F.dayofmonth("dt") <= 15)
          .withColumns({"value": F.col("value") * 3, "source_url": F.lit("file:///landed/v3"),
                        "last_updated": F.lit("2024-04-01 05:00:00").cast("timestamp_ntz")}))
    newest = ST.newest_vintage_wins(batch.unionByName(v2))
    return ST.upsert(base, newest)


@query("reprocess_stored", "WITH " + C.FACTS + f""",
newest AS (
  SELECT {_PK}, arg_max(value, last_updated) AS value, max(last_updated) AS last_updated, 'file:///landed/v3' AS source_url
  FROM (SELECT {_PK}, value, TIMESTAMP '2024-03-02 05:00:00' AS last_updated FROM fact_batch
        UNION ALL SELECT {_PK}, value * 3, TIMESTAMP '2024-04-01 05:00:00' FROM fact_batch WHERE day(dt) <= 15) v
  GROUP BY {_PK})
SELECT dt, location_id, variable_id, demographic_id, provider_id,
       CASE WHEN n.dt IS NOT NULL THEN n.value ELSE o.value END AS value,
       CASE WHEN n.dt IS NOT NULL THEN n.last_updated ELSE o.last_updated END AS last_updated,
       CASE WHEN o.dt IS NOT NULL THEN o.source_url ELSE n.source_url END AS source_url,
       CASE WHEN n.dt IS NOT NULL THEN false ELSE o.deleted END AS deleted,
       CASE WHEN n.dt IS NOT NULL THEN NULL ELSE o.delete_batch_id END AS delete_batch_id
FROM fact_base o FULL OUTER JOIN newest n USING ({_PK})""")
def q_reprocess_stored(spark, sf):
    """Stored vintages normalised again into the stored table: one of the four has values
    that don't parse and is left out, one lies outside the range."""
    base, batch = _versions(spark, sf)
    root = scratch_path(spark, "snapshots")
    raw = batch.select(*ST.FACT_PK, F.col("value").cast("string").alias("value"))
    drops = {"2024-03-02_05": raw, "2024-03-15_05": raw.withColumn("value", F.lit("n/a")),
             "2024-04-01_05": raw.where(F.dayofmonth("dt") <= 15).withColumn("value", (F.col("value").cast("double") * 3).cast("string")),
             "2024-05-01_05": raw.withColumn("value", F.lit("0"))}
    for vintage, drop in drops.items():
        FS.write_snapshot(drop, root, "orders", vintage)

    def to_fact(rows):
        return rows.select(*ST.FACT_PK, F.col("value").cast("double").alias("value"),
                           F.to_timestamp("snapshot", "yyyy-MM-dd_HH").cast("timestamp_ntz").alias("last_updated"),
                           F.lit("file:///landed/v3").alias("source_url"), F.lit("reprocessed").alias("source_name"),
                           F.lit(False).alias("deleted"), F.lit(None).cast("bigint").alias("delete_batch_id"))

    facts = ST.FactTable(spark, scratch_path(spark, "fact"))
    facts.write_state(base)
    reprocess_vintages(spark, root, "orders", lambda r: r, to_fact, facts, end="2024-04-30_23", continue_on_fail=True)
    return facts.read().drop("source_name")


@query("publish_view", "WITH " + VIEW + "".join(
    f" {'UNION ALL ' if i else ''}SELECT *, '{name}' AS extract FROM api_view"
    for i, name in enumerate(("latest", "dated", "csv"))))
def q_publish_view(spark, sf):
    """All three extracts read back: the latest and the dated Parquet copy, and the CSV."""
    root = scratch_path(spark, "publish")
    paths = S.publish_view(_view(spark, sf), root, _dt.date(2024, 2, 1))
    csv = FS.scan_csv(spark, paths["csv"], PUBLISHED_SCHEMA)
    frames = {"latest": spark.read.parquet(paths["latest"]), "dated": spark.read.parquet(paths["dated"]), "csv": csv}
    out = [df.withColumn("extract", F.lit(name)) for name, df in frames.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("write_snapshot", "WITH " + C.OBS + " SELECT * FROM obs")
def q_write_snapshot(spark, sf):
    root = scratch_path(spark, "snapshots")
    FS.write_snapshot(TB.obs(spark, sf), root, "orders", "2024-02-01_05")
    return FS.read_snapshot(spark, root, "orders", "2024-02-01_05")


@query("read_snapshot", "WITH " + C.OBS + " SELECT * FROM obs WHERE category = 'revenue'")
def q_read_snapshot(spark, sf):
    root = scratch_path(spark, "snapshots")
    o = TB.obs(spark, sf)
    FS.write_snapshot(o.filter(F.col("category") == "revenue"), root, "orders", "2024-02-01_05")
    FS.write_snapshot(o.filter(F.col("category") == "orders"), root, "orders", "2024-01-01_05")
    FS.write_snapshot(o.filter(F.col("category") == "quantity"), root, "lines", "2024-02-01_05")
    return FS.read_snapshot(spark, root, "orders", "2024-02-01_05")


@query("list_vintages", """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d_%H') AS vintage FROM orders
WHERE strftime(o_orderdate, '%Y-%m-%d_%H') BETWEEN '1996-01-01_00' AND '1996-12-31_23'
UNION ALL SELECT max(strftime(o_orderdate, '%Y-%m-%d_%H')) FROM orders""")
def q_list_vintages(spark, sf):
    snaps = table(spark, sf, "orders").select(FS.vintage_text("o_orderdate").alias("vintage"))
    year = FS.list_vintages(snaps, "1996-01-01_00", "1996-12-31_23")
    last = FS.list_vintages(snaps, only_last=True)
    return year.unionByName(last)


# --------------------------------------------------------------- load order of dimensions

@query("dimension_load_order", """
SELECT 'region' AS dimension, r_name AS name, CAST(row_number() OVER (ORDER BY r_name) AS INTEGER) AS id, 1 AS loaded, 3 AS deleted FROM region
UNION ALL
SELECT 'nation', n_name, CAST(row_number() OVER (ORDER BY n_regionkey % 2, n_name) AS INTEGER), 2, 2 FROM nation
UNION ALL
SELECT 'customer', c_name, CAST(row_number() OVER (ORDER BY n_regionkey % 2, c_name) AS INTEGER), 3, 1
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_dimension_load_order(spark, sf):
    """Three dimensions that refer to each other, given in the wrong order and loaded in
    two steps (nations of even regions first): ids are given once; deletes run in
    reverse, and are refused while orders refer to a customer."""
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    nations = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("name"), F.col("r_name").alias("region"), (F.col("n_regionkey") % 2).alias("step"), "n_nationkey")
    customers = customer.join(nations, customer.c_nationkey == nations.n_nationkey).select(
        F.col("c_name").alias("name"), nations.name.alias("nation"), "step", "c_custkey")
    dims = DimensionSet(spark, scratch_path(spark, "dimensions"), [
        Dimension("customer", ["name"], {"nation": ("nation", "name")}),
        Dimension("nation", ["name"], {"region": ("region", "name")}), Dimension("region", ["name"])])
    even = lambda df: df.where("step = 0")
    loaded = dims.load({"customer": even(customers), "nation": even(nations), "region": region.select(F.col("r_name").alias("name"))})
    dims.load({"customer": customers, "nation": nations})
    held = {n: settle(dims.read(n), "dimension") for n in loaded}
    orders = table(spark, sf, "orders")
    try:
        dims.delete(facts={"customer": [(orders, "o_custkey", "c_custkey")]})
        raise AssertionError("a referred customer was deleted")
    except ValidationError:
        deleted = dims.delete()
    out = [held[n].select(F.lit(n).alias("dimension"), "name", "id", F.lit(loaded.index(n) + 1).alias("loaded"),
                          F.lit(deleted.index(n) + 1).alias("deleted")) for n in loaded]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --------------------------------------------------------------- raw files

@query("raw_landing", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice, o_orderpriority,
       '2024-02-01_05' AS vintage FROM orders
UNION ALL
SELECT o_orderkey, NULL, strftime(o_orderdate, '%Y-%m-%d'), o_totalprice * 2, NULL, '2024-02-02_05' FROM orders WHERE o_orderstatus = 'F'""")
def q_raw_landing(spark, sf):
    """Two vintages of CSV files, stored as received and decoded by header when read back:
    the second has other columns, in another order, and quoted values."""
    drop, root = scratch_path(spark, "drop"), scratch_path(spark, "raw")
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    first = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    first.write.option("header", True).csv(f"{drop}/1")
    second = orders.where("o_orderstatus = 'F'").select((F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderdate",
                                                        F.lit("a, \"b\"").alias("note"), "o_orderkey")
    second.write.options(header=True, quoteAll=True, escape='"').csv(f"{drop}/2")
    vintages = {"2024-02-01_05": f"{drop}/1", "2024-02-02_05": f"{drop}/2"}
    for vintage, folder in vintages.items():
        RAW.land_raw(RAW.received(spark, folder, pattern="*.csv"), root, "orders", vintage)
    schema = "o_orderkey long, o_custkey long, o_orderdate string, o_totalprice double, o_orderpriority string"
    read = [RAW.raw_csv(RAW.read_raw(spark, root, "orders", v), schema).drop("name", "line_no").withColumn("vintage", F.lit(v)) for v in vintages]
    return read[0].unionByName(read[1])

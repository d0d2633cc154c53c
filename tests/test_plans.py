"""Plan tests: no Python in any plan, broadcast dimension joins, pushdown,
column pruning before the unpivot."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from almanac.operators import reshape as R
from almanac.plans import testbed as TB


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() if mode == "exec" else \
        df._jdf.queryExecution().toString()


@pytest.mark.parametrize("key", ["reshape_variables", "resolve_keys_fips", "api_view", "upsert",
                                 "soft_delete", "backfill_state", "changelog_report",
                                 "decode_dictionary_columns", "decode_delta_rows", "title_case"])
def test_no_python_udf(spark, sf_dir, key):
    text = plan(E.queries()[key](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert node not in text


def test_dimension_joins_are_broadcast(spark, sf_dir):
    text = plan(E.queries()["resolve_keys_fips"](spark, sf_dir))
    assert text.count("BroadcastHashJoin") >= 4


def test_filter_pushed_to_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(E.queries()["range_filter"](spark, sf_dir))
    assert "GreaterThan(l_quantity,10.0)" in text
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in text


def test_variable_pruning_before_unpivot(spark, sf_dir):
    wide = TB.daily_wide(spark, sf_dir)
    pruned = R.reshape_variables(wide, TB.VARIABLE_MAP, id_vars=["provider", "age", "race"],
                                 vintage=TB.run_ts(), skip_columns=["age", "race"],
                                 variables=["orders"])
    text = plan(pruned)
    assert "l_extendedprice" not in text.split("== Physical Plan ==")[1]
    assert pruned.select("category").distinct().count() == 1


def test_validation_pass_is_one_exchange(spark, sf_dir):
    from almanac.operators.validate import series_checks
    from almanac.operators.windows import cumulative_decreases, duplicate_keys
    oc = TB.obs_cum(spark, sf_dir)
    key = ["location", "provider", "category", "unit", "age", "sex", "race", "ethnicity"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        checked = series_checks(oc, key, cut_date="1997-01-01")
        text = checked._jdf.queryExecution().executedPlan().toString()
        base = oc._jdf.queryExecution().executedPlan().toString()
        # at most one exchange more than building the input (here none: the
        # input's own running total is already hash-partitioned by the series)
        assert text.count("Exchange hashpartitioning") <= base.count("Exchange hashpartitioning") + 1
        dec = cumulative_decreases(oc, key, cut_date="1997-01-01").count()
        dup = duplicate_keys(oc, key + ["dt"]).count()
        kinds = {r.kind: r["count"] for r in checked.groupBy("kind").count().collect()}
        assert kinds.get("cumulative_decrease", 0) == dec and kinds.get("duplicate", 0) == dup
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_fact_upsert_prunes_partitions(spark):
    import datetime as dt

    from almanac.operators.store import FactTable
    from almanac.schema import FACT_SCHEMA
    from almanac.session import scratch_path
    t0 = dt.datetime(2024, 1, 1)
    rows = [(dt.date(2024, m, 1), "a", 1, 1, p, 1.0, t0, "u", "n", False, None)
            for m in range(1, 7) for p in (1, 2)]
    table = FactTable(spark, scratch_path(spark, "prune"))
    table.write_state(spark.createDataFrame(rows, FACT_SCHEMA))
    batch = spark.createDataFrame([(dt.date(2024, 3, 5), "a", 1, 1, 2, 9.0, t0, "u", "n", False, None)],
                                  FACT_SCHEMA)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(table.touched(batch))
    assert "(provider_id#" in text and "= 2024-03)" in text
    assert table.touched(batch).count() == 1


def test_backfill_does_not_shuffle_the_panel(spark, sf_dir):
    from almanac.operators import corrections as M
    panel = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.lit("county").alias("location_type"), F.col("o_custkey").cast("bigint").alias("location"),
        F.lit(1).alias("state_fips"), F.col("o_orderdate").cast("date").alias("dt"), F.lit("cases").alias("category"),
        F.col("o_totalprice").alias("value"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = M.apply_deltas(panel, M._corrections_frame(spark, [(1, "1996-01-01", 5)], "location long, dt string, delta long")
                              .withColumns({"location_type": F.lit("county"), "category": F.lit("cases")}))
        text = text._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    tree = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in tree and "Exchange hashpartitioning" not in tree and "SortMergeJoin" not in text


def test_unknown_report_reads_its_input_once(spark, sf_dir):
    text = E.queries()["unknown_report"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert text.count("lineitem.parquet") == 1

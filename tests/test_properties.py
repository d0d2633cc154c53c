"""Property tests (few examples each: every example is a Spark job)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almanac.operators import aggregate as A
from almanac.operators import reshape as R
from almanac.operators import store as ST
from almanac.schema import FACT_SCHEMA

SETTINGS = settings(max_examples=5, deadline=None)
values = st.one_of(st.none(), st.integers(min_value=-1000, max_value=1000))


@SETTINGS
@given(st.lists(st.tuples(values, values, values), min_size=1, max_size=8))
def test_melt_then_pivot_is_identity(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, a int, b int, c int")
    long = R.melt(df, ["k"], ["a", "b", "c"])
    back = long.groupBy("k").pivot("variable", ["a", "b", "c"]).agg(F.first("value"))
    want = sorted((i, *[None if v is None else float(v) for v in r]) for i, r in enumerate(rows))
    assert sorted(tuple(x) for x in back.select("k", "a", "b", "c").collect()) == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.booleans(), st.sampled_from([None, 3, 4])),
                min_size=1, max_size=10, unique_by=lambda t: t[0]))
def test_delete_then_undelete_restores(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    fact = spark.createDataFrame(
        [(dt.date(2024, 1, 1), f"l{k}", 1, 1, 1, 1.0, t0, "u", "n", d, b if d else None) for k, d, b in rows],
        FACT_SCHEMA)
    prov = spark.createDataFrame([(1, "state")], "id int, name string")
    var = spark.createDataFrame([(1, "cases", "cumulative", "people")],
                                "id int, category string, measurement string, unit string")
    loc = spark.createDataFrame([(f"l{k}", k, "county", 1) for k in range(6)],
                                "id string, location long, location_type string, state_fips int")
    # delete live rows only, with a fresh batch id; undo restores the original state
    live = fact.filter(~F.col("deleted"))
    gone = ST.soft_delete(live, prov, var, loc, batch_id=99).drop("changed")
    back = ST.undelete(gone, 99).drop("changed")
    assert sorted(back.collect()) == sorted(live.collect())


@SETTINGS
@given(st.lists(st.integers(min_value=1, max_value=50), min_size=1, max_size=12),
       st.integers(min_value=0, max_value=500))
def test_allocation_sum_within_rounding(spark, weights, n):
    df = spark.createDataFrame([("s", float(w)) for w in weights], "g string, w double")
    total = A.proportional_allocation(df, ["g"], "w", F.lit(n)).agg(F.sum("allocated")).first()[0]
    assert abs(total - n) <= len(weights) / 2

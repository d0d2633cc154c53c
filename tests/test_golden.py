"""Golden tests on tiny hand-made frames for every operator with a quirk."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from almanac import functions as X
from almanac.operators import aggregate as A
from almanac.operators import corrections as M
from almanac.operators import joins as J
from almanac.operators import reshape as R
from almanac.operators import store as ST
from almanac.operators import transform as P
from almanac.operators import validate as V
from almanac.operators import windows as W
from almanac.schema import FACT_SCHEMA
from almanac.sources import pages as PG

D = dt.date


def test_title_case_python_rules(spark):
    df = spark.createDataFrame([("miami-dade",), ("o'brien",), ("st. mary's",), ("MCDOWELL",),
                                ("doña ana",), (None,)], "s string")
    got = [r[0] for r in df.select(X.title_case("s")).collect()]
    assert got == ["Miami-Dade", "O'Brien", "St. Mary'S", "Mcdowell", "Doña Ana", None]
    assert got[:5] == [s.title() for s in ["miami-dade", "o'brien", "st. mary's", "MCDOWELL", "doña ana"]]


def test_parse_numeric(spark):
    df = spark.createDataFrame([("1,234",), ("0",), ("nan",), (None,)], "s string")
    assert [r[0] for r in df.select(X.parse_numeric("s")).collect()] == [1234.0, 0.0, None, None]
    bad = spark.createDataFrame([("12x",)], "s string")
    with pytest.raises(Exception):
        bad.select(X.parse_numeric("s")).collect()
    assert bad.select(X.parse_numeric("s", errors="null")).collect()[0][0] is None


def test_drop_by_values_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert sorted(P.drop_by_values(df, "k", ["a"]).collect(), key=str) == sorted(
        [(None,), ("b",)], key=str)


def test_sentinel_and_sums(spark):
    df = spark.createDataFrame([(-999999.0,), (0.0,), (0.5,)], "x double")
    assert [r[0] for r in df.select(X.sentinel_to_null("x")).collect()] == [None, None, 0.5]
    ab = spark.createDataFrame([(1.0, None), (None, 1.0)], "a double, b double")
    assert [r[0] for r in ab.select(X.asymmetric_sum("a", "b")).collect()] == [1.0, None]
    assert [r[0] for r in ab.select(X.strict_sum("a", "b")).collect()] == [None, None]
    s = spark.createDataFrame([("suppressed",), ("%null%",), ("7",)], "s string")
    assert [r[0] for r in s.select(X.sentinel_to_zero("s")).collect()] == ["0", "0", "7"]


def test_half_even_allocation(spark):
    df = spark.createDataFrame([("s", 1.0), ("s", 1.0), ("s", 2.0)], "g string, w double")
    out = A.proportional_allocation(df, ["g"], "w", F.lit(10)).orderBy("w").collect()
    # 2.5 -> 2, 2.5 -> 2, 5 -> 5 (numpy rounds ties to even)
    assert [r.allocated for r in out] == [2.0, 2.0, 5.0]


def test_week_bucket_w_mon(spark):
    df = spark.createDataFrame([(D(2024, 1, 7),), (D(2024, 1, 8),), (D(2024, 1, 9),)], "d date")
    got = [r[0] for r in df.select(X.week_end_monday("d")).collect()]
    assert got == [D(2024, 1, 8), D(2024, 1, 8), D(2024, 1, 15)]


def test_decode_delta_rows(spark):
    pages = spark.createDataFrame(
        [(1, [{"C": ["a", "x", "1"]}, {"C": ["2"]}, {"C": ["y", "3"]}])],
        "page int, DM1 array<struct<C: array<string>>>")
    out = PG.decode_delta_rows(pages, ["l1", "l2", "l3"], initial="0").orderBy("ordinal").collect()
    assert [(r.l1, r.l2, r.l3) for r in out] == [("a", "x", "1"), ("a", "x", "2"), ("a", "y", "3")]


def test_last_per_key_skips_null(spark):
    df = spark.createDataFrame([("k", 1, 5.0), ("k", 2, None)], "k string, o int, v double")
    assert A.last_per_key(df, ["k"], "v", "o").collect()[0].v == 5.0


def _fact(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


def test_upsert_postgres_semantics(spark):
    base = _fact(spark, [
        (D(2024, 1, 1), "a", 1, 1, 1, 10.0, T0, "u-old", "n-old", False, None),
        (D(2024, 1, 2), "a", 1, 1, 1, 11.0, T0, "u-old", "n-old", True, 7),
        (D(2024, 1, 3), "a", 1, 1, 1, 12.0, T0, "u-old", "n-old", False, None)])
    batch = _fact(spark, [
        (D(2024, 1, 1), "a", 1, 1, 1, 20.0, T1, "u-new", "n-new", False, None),
        (D(2024, 1, 2), "a", 1, 1, 1, 21.0, T1, "u-new", "n-new", False, None),
        (D(2024, 1, 4), "a", 1, 1, 1, 23.0, T1, "u-new", "n-new", False, None)])
    out = {r.dt: r for r in ST.upsert(base, batch).collect()}
    assert out[D(2024, 1, 1)].value == 20.0 and out[D(2024, 1, 1)].source_url == "u-old"
    assert out[D(2024, 1, 2)].deleted is False and out[D(2024, 1, 2)].delete_batch_id is None
    assert out[D(2024, 1, 3)].value == 12.0
    assert out[D(2024, 1, 4)].source_url == "u-new"
    repl = {r.dt: r for r in ST.upsert(base, batch, mode="replace").collect()}
    assert repl[D(2024, 1, 1)].source_url == "u-new"
    # idempotent
    once = ST.upsert(base, batch)
    assert sorted(ST.upsert(once, batch).collect()) == sorted(once.collect())
    counts = ST.upsert_counts(base, batch).collect()[0]
    assert (counts.rows_inserted, counts.rows_updated) == (1, 2)


def test_upsert_duplicate_key_in_batch_fails(spark):
    base = _fact(spark, [])
    dup = _fact(spark, [(D(2024, 1, 1), "a", 1, 1, 1, 1.0, T0, "u", "n", False, None)] * 2)
    with pytest.raises(Exception):
        ST.upsert(base, dup).collect()


def _dims(spark):
    prov = spark.createDataFrame([(1, "cdc"), (2, "cdc2"), (3, "state")], "id int, name string")
    var = spark.createDataFrame([(1, "cases", "cumulative", "people")],
                                "id int, category string, measurement string, unit string")
    loc = spark.createDataFrame([("c1", 101, "county", 1), ("s1", 1, "state", 1), ("c2", 202, "county", 2)],
                                "id string, location long, location_type string, state_fips int")
    return prov, var, loc


def test_soft_delete_and_undelete(spark):
    prov, var, loc = _dims(spark)
    base = _fact(spark, [
        (D(2024, 1, 1), "c1", 1, 1, 1, 1.0, T0, "u", "n", True, 3),   # already deleted
        (D(2024, 1, 1), "c1", 1, 1, 2, 1.0, T0, "u", "n", False, None),  # cdc2
        (D(2024, 1, 1), "c1", 1, 1, 3, 1.0, T0, "u", "n", False, None)])  # state
    out = ST.soft_delete(base, prov, var, loc, batch_id=9, provider="cdc")
    got = {r.provider_id: (r.deleted, r.delete_batch_id) for r in out.collect()}
    assert got == {1: (True, 9), 2: (True, 9), 3: (False, None)}
    back = ST.undelete(out.drop("changed"), 9)
    assert {r.provider_id: r.deleted for r in back.collect()} == {1: False, 2: False, 3: False}


def test_select_location_beats_state_and_type_regex_only_in_state_branch(spark):
    prov, var, loc = _dims(spark)
    base = _fact(spark, [
        (D(2024, 1, 1), "c1", 1, 1, 3, 1.0, T0, "u", "n", False, None),
        (D(2024, 1, 1), "s1", 1, 1, 3, 1.0, T0, "u", "n", False, None),
        (D(2024, 1, 1), "c2", 1, 1, 3, 1.0, T0, "u", "n", False, None)])
    sel = ST.select_observations(base, prov, var, loc, location=202, state_fips=1)
    assert [r.location_id for r in sel.collect()] == ["c2"]
    no_state = ST.select_observations(base, prov, var, loc, location_type_regex="county")
    assert no_state.count() == 3
    by_state = ST.select_observations(base, prov, var, loc, state_fips=1, location_type_regex="county")
    assert [r.location_id for r in by_state.collect()] == ["c1"]


def test_duplicate_keys_returns_all_members(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (3,)], "k int")
    assert W.duplicate_keys(df, ["k"]).count() == 5


def test_cumulative_decrease_cut_before_diff(spark):
    rows = [(D(2020, 12, 30), 10.0), (D(2020, 12, 31), 5.0),   # drop before the cut: ignored
            (D(2021, 1, 1), 3.0),                             # drop across the cut: ignored
            (D(2021, 1, 2), 4.0), (D(2021, 1, 3), 2.0)]       # drop after: reported
    df = spark.createDataFrame([(1, "cumulative", d, v) for d, v in rows],
                               "location int, measurement string, dt date, value double")
    bad = W.cumulative_decreases(df, ["location"]).collect()
    assert [r.dt for r in bad] == [D(2021, 1, 3)]


def test_drop_plateaus_keeps_first_row_of_window(spark):
    rows = [(1, D(2020, 8, 10), 5.0), (1, D(2020, 8, 11), 5.0), (1, D(2020, 8, 12), 5.0),
            (1, D(2020, 8, 13), 6.0), (2, D(2020, 8, 12), 1.0), (2, D(2020, 8, 13), 1.0)]
    df = spark.createDataFrame(rows, "fips int, dt date, value double")
    out = W.drop_plateaus(df, ["fips"], "2020-08-11", "2020-08-18", scope=F.col("fips") == 1)
    got = sorted((r.fips, r.dt) for r in out.collect())
    assert got == [(1, D(2020, 8, 10)), (1, D(2020, 8, 11)), (1, D(2020, 8, 13)),
                   (2, D(2020, 8, 12)), (2, D(2020, 8, 13))]


def test_running_total_then_diff_is_identity(spark):
    df = spark.createDataFrame([(1, D(2024, 1, i), float(i)) for i in range(1, 6)],
                               "k int, dt date, value double")
    cum = W.running_total(df, ["k"], out="cum")
    back = W.daily_new(cum, ["k"], value="cum", out="back").collect()
    assert [r.back for r in back][1:] == [r.value for r in back][1:]


def test_melt_keeps_nulls_and_reshape_drops_them(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1, "1,234", None)], "dt date, location long, a string, b string")
    assert R.melt(df, ["dt", "location"], ["a", "b"]).count() == 2
    out = R.reshape_variables(df, {"a": R.cmu(category="cases"), "b": R.cmu(category="deaths")},
                              vintage=F.lit(T0).cast("timestamp_ntz")).collect()
    assert len(out) == 1 and out[0].value == 1234.0 and out[0].category == "cases"


def test_attach_cmu_unknown_variable_fails(spark):
    df = spark.createDataFrame([("a",), ("zzz",)], "variable string")
    with pytest.raises(Exception):
        R.attach_cmu(df, {"a": R.cmu()}).collect()


def test_strict_group_sum_null_poisons(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("h", 2.0)], "k string, v double")
    got = {r.k: r.v for r in A.strict_group_sum(df, ["k"], ["v"]).collect()}
    assert got == {"g": None, "h": 2.0}


def test_resolve_unknown_keys_reported(spark):
    prov, var, loc = _dims(spark)
    dem = spark.createDataFrame([(1, "all", "all", "all", "all")],
                                "id int, age string, race string, ethnicity string, sex string")
    obs = spark.createDataFrame(
        [(D(2024, 1, 1), 999, "county", "cdc", "cases", "cumulative", "people", "all", "all", "all", "all", 1.0),
         (D(2024, 1, 1), 101, "county", "nope", "x", "new", "people", "0-9", "all", "all", "all", 1.0)],
        "dt date, location long, location_type string, provider string, category string, measurement string,"
        " unit string, age string, race string, ethnicity string, sex string, value double")
    res = J.resolve_keys(obs, loc, prov, dem, var, on_unresolved="keep")
    rej = {r.location: sorted(r.unresolved) for r in J.reject_unresolved(res).collect()}
    assert rej == {999: ["location"], 101: ["demographic", "provider", "variable"]}
    with pytest.raises(Exception):
        J.resolve_keys(obs, loc, prov, dem, var, on_unresolved="fail").collect()
    kinds = sorted(r.kind for r in J.unknown_report(obs, loc, dem, var).collect())
    assert kinds == ["demographic", "location", "variable"]


def test_category_order_check(spark):
    rows = [(1, D(2024, 1, 1), "initiated", 5.0), (1, D(2024, 1, 1), "doses", 4.0),
            (2, D(2024, 1, 1), "initiated", 3.0), (2, D(2024, 1, 1), "doses", 3.0),
            (3, D(2024, 1, 1), "initiated", 3.0)]
    df = spark.createDataFrame([(l, d, c, "cumulative", "people", "all", "all", "all", "all", v)
                                for l, d, c, v in rows],
                               "location int, dt date, category string, measurement string, unit string,"
                               " age string, race string, ethnicity string, sex string, value double")
    bad = V.category_order_check(df, "initiated", "doses").collect()
    assert [r.location for r in bad] == [1]
    strict = V.category_order_check(df, "initiated", "doses", strict=True).collect()
    assert sorted(r.location for r in strict) == [1, 2]


def test_backfill_state_one_pass_equals_loop(spark):
    # two counties of state 1, one state row; allocate 10 on day 2 by new counts 3:1
    rows = [("county", 11, 1, D(2024, 1, 1), 10.0), ("county", 11, 1, D(2024, 1, 2), 13.0),
            ("county", 12, 1, D(2024, 1, 1), 10.0), ("county", 12, 1, D(2024, 1, 2), 11.0),
            ("state", 1, 1, D(2024, 1, 1), 20.0), ("state", 1, 1, D(2024, 1, 2), 24.0)]
    df = spark.createDataFrame([(t, l, s, d, "cases", v) for t, l, s, d, v in rows],
                               "location_type string, location long, state_fips int, dt date,"
                               " category string, value double")
    out = {(r.location_type, r.location, r.dt): r.value
           for r in M.backfill_state(df, [(1, "2024-01-02", 10)], "cases").collect()}
    # 3/4*10 = 7.5 -> 8 (half-even), 1/4*10 = 2.5 -> 2
    assert out[("county", 11, D(2024, 1, 2))] == 5.0
    assert out[("county", 12, D(2024, 1, 2))] == 9.0
    assert out[("state", 1, D(2024, 1, 2))] == 14.0
    assert out[("county", 11, D(2024, 1, 1))] == 10.0
    with pytest.raises(Exception):
        M.backfill_state(df, [(1, "2024-01-02", 1), (1, "2024-01-02", 2)], "cases")


def test_required_categories(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], "g string, category string")
    got = {r.g: r.missing for r in V.required_categories(df, ["x", "y"], ["g"]).collect()}
    assert got == {"a": ["y"]}


def test_load_defaults_keeps_existing_columns(spark):
    df = spark.createDataFrame([(T0, "given")], "vintage timestamp, source_url string")
    out = P.load_defaults(df, provider="state", source_url="default", source_name="nm",
                          location_type="county", state_fips=6).collect()[0]
    assert out.source_url == "given" and out.provider == "state" and out.last_updated == T0
    with pytest.raises(Exception):
        P.conform_columns(df, ["missing_col"])


def test_bucketed_series_windows_equal_plain(spark):
    import random
    rnd = random.Random(7)
    rows = [(k, D(2020, 1, 1) + dt.timedelta(days=d), float(rnd.randint(0, 9)) if rnd.random() > 0.1 else None)
            for k in range(3) for d in rnd.sample(range(900), 120)]
    df = spark.createDataFrame(rows, "k int, dt date, value double")
    plain = W.running_total(df, ["k"], out="c")
    split = W.running_total(df, ["k"], out="c", bucket=F.year("dt"))
    assert sorted(plain.collect()) == sorted(split.collect())
    plain = W.daily_new(df, ["k"])
    split = W.daily_new(df, ["k"], bucket=F.trunc("dt", "month"))
    assert sorted(plain.collect(), key=str) == sorted(split.collect(), key=str)


def test_flatten_json_long_paths_and_first_match(spark):
    import json
    docs = [(1, json.dumps({"G0": "Adams", "X": [{"M0": 10}, {"M1": 5, "I": 1}], "C": {"M2": 7}})),
            (2, json.dumps({"G0": "Mckean", "X": [{"M1": 3}, {"M0": 4}], "N": None, "E": []}))]
    df = spark.createDataFrame(docs, "rid int, doc string")
    long = PG.flatten_json_long(df, "rid", "doc")
    paths = sorted((r.id, r.path, r.value) for r in long.collect())
    assert (1, "X_1_I", "1") in paths and (1, "C_M2", "7") in paths and (2, "N", None) in paths
    picked = {r.id: (r.name, r.m0, r.m2) for r in
              PG.pick_long_by_path_substring(long, {"name": "G0", "m0": "M0", "m2": "M2"}).collect()}
    assert picked == {1: ("Adams", "10", "7"), 2: ("Mckean", "4", None)}


def test_record_pages_guards(spark):
    schema = ("page int, success boolean, result struct<total: bigint, records: array<struct<a: int>>>")
    ok = spark.createDataFrame([(1, True, (3, [(1,), (2,)])), (2, True, (3, [(3,)]))], schema)
    assert sorted(r.a for r in PG.flatten_record_pages(ok).collect()) == [1, 2, 3]
    short = spark.createDataFrame([(1, True, (3, [(1,)]))], schema)
    with pytest.raises(Exception):
        PG.flatten_record_pages(short).collect()
    failed = spark.createDataFrame([(1, False, (1, [(1,)]))], schema)
    with pytest.raises(Exception):
        PG.flatten_record_pages(failed).collect()


def test_next_batch_id(spark):
    t0 = dt.datetime(2024, 1, 1)
    fact = _fact(spark, [(D(2024, 1, 1), "a", 1, 1, 1, 1.0, t0, "u", "n", True, 4),
                         (D(2024, 1, 2), "a", 1, 1, 1, 1.0, t0, "u", "n", False, None)])
    assert fact.select(ST.next_batch_id(fact).alias("b")).first().b == 5
    empty = _fact(spark, [])
    assert spark.range(1).select(ST.next_batch_id(empty).alias("b")).first().b == 1


def test_json_row_cap_and_missing_snapshot(spark, tmp_path):
    import json as _json

    from almanac.errors import ValidationError
    from almanac.sources import files as FS
    p = tmp_path / "recs.json"
    p.write_text("\n".join(_json.dumps({"a": i}) for i in range(5)))
    assert FS.scan_json_records(spark, str(p), "a int", row_cap=10).count() == 5
    with pytest.raises(Exception):
        FS.scan_json_records(spark, str(p), "a int", row_cap=5).collect()
    root = str(tmp_path / "snaps")
    FS.write_snapshot(spark.createDataFrame([(1,)], "a int"), root, "ds", "2024-01-01_05")
    assert FS.read_snapshot(spark, root, "ds", "2024-01-01_05").count() == 1
    with pytest.raises(ValidationError):
        FS.read_snapshot(spark, root, "ds", "2024-01-02_05")


# ------------------------------------------------------------------ review findings

def test_zero_pad_keeps_longer_values(spark):
    df = spark.createDataFrame([("7",), ("123456",), ("12345",), ("-5",), (None,), ("",)], "v string")
    assert [r.p for r in df.select(X.zero_pad("v").alias("p")).collect()] == \
        [None if v is None else v.zfill(5) for v in ("7", "123456", "12345", "-5", None, "")]


def test_sums_keep_small_decimals(spark):
    df = spark.createDataFrame([("a", 0.004), ("a", 0.004)], "k string, v double")
    assert A.rollup_sum(df, ["k"], ["v"]).first().v == 0.008
    assert A.strict_group_sum(df, ["k"], ["v"]).first().v == 0.008
    assert A.rollup_sum(df, ["k"], ["v"], scale=3).first().v == 0.008
    wide = R.pivot_sum_total(df.withColumn("c", F.lit("x")), ["k"], "c", "v", ["x"]).first()
    assert (wide.x, wide.total) == (0.008, 0.008)


def test_bucketed_windows_with_null_keys(spark):
    rows = [(k, D(2023 + y, 6, d), float(d)) for k in (None, "a") for y in (0, 1) for d in (1, 2, 4)]
    df = spark.createDataFrame(rows, "k string, dt date, value double")
    for op in (lambda b: W.running_total(df, ["k"], out="c", bucket=b), lambda b: W.daily_new(df, ["k"], bucket=b)):
        assert sorted(op(None).collect(), key=str) == sorted(op(F.year("dt")).collect(), key=str)


def test_flatten_json_any_depth_and_keys(spark):
    import json
    deep = 1
    for i in range(12):
        deep = {f"k{i}": [deep]} if i % 2 else {f"k{i}": deep}
    docs = [(1, json.dumps(deep)), (2, json.dumps({"it's \"q\"": 5, "t": '{"not": "parsed"}', "u": "[1]", "b": True})), (3, "7")]
    got = {(r.id, r.path): r.value for r in PG.flatten_json_long(
        spark.createDataFrame(docs, "rid int, doc string"), "rid", "doc").collect()}
    path = "_".join(f"k{i}_0" if i % 2 else f"k{i}" for i in reversed(range(12)))
    assert got == {(1, path): "1", (2, "it's \\\"q\\\""): "5", (2, "t"): '{\\"not\\": \\"parsed\\"}', (2, "u"): "[1]",
                   (2, "b"): "true", (3, ""): "7"} or got == {
        (1, path): "1", (2, 'it\'s "q"'): "5", (2, "t"): '{"not": "parsed"}', (2, "u"): "[1]", (2, "b"): "true", (3, ""): "7"}


def test_flatten_json_of_a_planned_depth(spark):
    import json

    from pyspark.errors import PySparkException
    docs = [(1, json.dumps({"a": {"b": [1, {"c": "[x"}]}, "d": "{"})), (2, "5"), (3, None), (4, json.dumps({"e": {}, "f": [[]]}))]
    df = spark.createDataFrame(docs, "rid int, doc string")
    rows = lambda out: sorted((r.id, r.path, r.ord, r.value) for r in out.collect())
    whole = rows(PG.flatten_json_long(df, "rid", "doc"))
    assert rows(PG.flatten_json_long(df, "rid", "doc", max_depth=4)) == rows(PG.flatten_json_long(df, "rid", "doc", max_depth=9)) == whole
    with pytest.raises(PySparkException, match="deeper than max_depth: 1"):
        PG.flatten_json_long(df, "rid", "doc", max_depth=3).collect()
    never = df.withColumn("doc", F.raise_error(F.lit("read while planning")).cast("string"))
    PG.flatten_json_long(never, "rid", "doc", max_depth=4)  # no job runs


def test_record_pages_missing_total_or_success(spark):
    schema = "page int, success boolean, result struct<total: bigint, records: array<struct<a: int>>>"
    for row in ((1, True, (None, [(1,)])), (1, None, (1, [(1,)]))):
        with pytest.raises(Exception):
            PG.flatten_record_pages(spark.createDataFrame([row], schema)).collect()


def test_csv_files_with_other_column_orders(spark, tmp_path):
    from almanac.errors import ContractError
    from almanac.sources import files as FS
    (tmp_path / "a.csv").write_text("x,y\n1,one\n2,two\n")
    (tmp_path / "b.csv").write_text("extra,y,x\nz,three,3\n")
    got = FS.scan_csv(spark, str(tmp_path), "x int, y string").collect()
    assert sorted(tuple(r) for r in got) == [(1, "one"), (2, "two"), (3, "three")]
    (tmp_path / "c.csv").write_text("x\n9\n")
    with pytest.raises(ContractError):
        FS.scan_csv(spark, str(tmp_path), "x int, y string")


def test_dimension_ids_are_stable(spark, tmp_path):
    from almanac.operators.joins import DimensionTable
    table = DimensionTable(spark, str(tmp_path / "dim"), ["name"])
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    first = {r.name: r.id for r in table.load(frame(["b", "d", None, "d"])).collect()}
    assert first == {None: 1, "b": 2, "d": 3}
    again = {r.name: r.id for r in table.load(frame(["a", "b", "c", None])).collect()}
    assert again == {**first, "a": 4, "c": 5}


def test_grown_dimension_is_no_longer_broadcast(spark, tmp_path):
    from almanac.operators.reshape import decode_codes
    path = str(tmp_path / "dim")
    facts = spark.range(100).select(F.col("id").alias("code"))
    plan = lambda: decode_codes(facts, "code", spark.read.parquet(path), code_key="id",
                                value_key="name")._jdf.queryExecution().executedPlan().toString()
    spark.range(5).selectExpr("id", "cast(id as string) as name").write.parquet(path)
    assert "BroadcastHashJoin" in plan()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        assert "BroadcastHashJoin" in plan()
        spark.range(50_000).selectExpr("id", "cast(id as string) as name").write.mode("append").parquet(path)
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def _orders_frame(spark, rows):
    return spark.createDataFrame([(l, D(2024, 1, 1), c, "cumulative", u, "all", "all", "all", "all", v) for l, c, u, v in rows],
                                 "location int, dt date, category string, measurement string, unit string,"
                                 " age string, race string, ethnicity string, sex string, value double")


def test_category_orders_of_repeated_rows_and_several_units(spark):
    """Rows that repeat a key, category and unit are compared one by one; a missing value
    is a violation."""
    rows = [(1, "initiated", "people", 1.0), (1, "initiated", "people", 9.0), (1, "doses", "people", 5.0), (1, "doses", "people", 12.0),
            (2, "initiated", "people", 1.0), (2, "doses", "people", 5.0), (2, "doses", "people", None),
            (3, "initiated", "people", float("nan")), (3, "doses", "people", 5.0),
            (4, "initiated", "people", 3.0), (4, "doses", "people", 5.0), (4, "doses", "people", 4.0),
            (5, "initiated", "a", 7.0), (5, "initiated", "b", 2.0), (5, "doses", "c", 5.0), (5, "doses", "d", 8.0),
            (None, "initiated", None, 7.0), (None, "doses", "c", 5.0)]
    got = {(r.location, r.small_unit, r.large_unit): (str(r.small_value), r.large_value)
           for r in V.category_order_check(_orders_frame(spark, rows), "initiated", "doses").collect()}
    assert got == {(1, "people", "people"): ("9.0", 5.0), (2, "people", "people"): ("1.0", None), (3, "people", "people"): ("nan", 5.0),
                   (5, "a", "c"): ("7.0", 5.0), (None, None, "c"): ("7.0", 5.0)}


def test_category_orders_keep_units_apart_and_report_missing(spark):
    rows = [(1, "initiated", "people", 10.0), (1, "doses", "people", 5.0), (1, "doses", "percentage", 50.0),
            (2, "initiated", "people", 10.0), (2, "doses", "doses", 5.0),
            (3, "initiated", "people", 10.0), (3, "initiated", "percentage", 1.0),
            (3, "doses", "people", 20.0), (3, "doses", "percentage", 2.0),
            (4, "initiated", "people", 10.0), (4, "doses", "people", None), (5, "initiated", "people", 1.0)]
    df = spark.createDataFrame([(l, D(2024, 1, 1), c, "cumulative", u, "all", "all", "all", "all", v) for l, c, u, v in rows],
                               "location int, dt date, category string, measurement string, unit string,"
                               " age string, race string, ethnicity string, sex string, value double")
    bad = V.category_order_check(df, "initiated", "doses").collect()
    assert sorted((r.location, r.small_unit, r.large_unit, r.large_value) for r in bad if r.large_value is not None) == \
        [(1, "people", "people", 5.0), (2, "people", "doses", 5.0)]
    assert [r.location for r in bad if r.large_value is None] == [4]


def test_violations_and_check(spark):
    from almanac.errors import ValidationError
    rows = [(D(2022, 1, 1), "total_vaccine_initiated", 5.0), (D(2022, 1, 2), "total_vaccine_initiated", 4.0),
            (D(2022, 1, 1), "total_vaccine_completed", 6.0), (D(2022, 1, 1), "total_vaccine_doses_administered", 9.0)]
    df = spark.createDataFrame([(1, d, c, "cumulative", "people", "all", "all", "all", "all", v) for d, c, v in rows],
                               "location int, dt date, category string, measurement string, unit string,"
                               " age string, race string, ethnicity string, sex string, value double")
    got = sorted((r.check, r.category, r.other_category, r.dt, r.value, r.other_value) for r in V.violations(df).collect())
    assert got == [("category_order", "total_vaccine_completed", "total_vaccine_initiated", D(2022, 1, 1), 6.0, 5.0),
                   ("cumulative_decrease", "total_vaccine_initiated", None, D(2022, 1, 2), 4.0, 5.0)]
    with pytest.raises(ValidationError):
        V.check_observations(df)
    good = df.filter(F.col("category") == "total_vaccine_doses_administered")
    assert V.check_observations(good).count() == 1


def test_latest_window_ends_at_the_latest_date_of_all(spark):
    rows = [(1, "county", D(2024, 1, 1), "a", 1.0), (1, "county", D(2024, 1, 5), "a", 2.0), (2, "state", D(2024, 1, 5), "a", 3.0),
            (1, "county", D(2024, 1, 10), "other", 9.0)]
    df = spark.createDataFrame([(l, t, d, c, "all", "all", "all", "all", v) for l, t, d, c, v in rows],
                               "location int, location_type string, dt date, category string, age string, race string,"
                               " ethnicity string, sex string, value double")
    pick = lambda **k: sorted((r.location, r.dt, r.a) for r in R.latest_window_pivot(df, ["a"], 7, **k).collect())
    assert pick() == [(1, D(2024, 1, 5), 2.0), (2, D(2024, 1, 5), 3.0)]
    assert pick(location_type="state") == [(2, D(2024, 1, 5), 3.0)] and pick(location=1) == [(1, D(2024, 1, 5), 2.0)]
    with pytest.raises(Exception):
        R.latest_window_pivot(df.unionByName(df.withColumn("value", F.col("value") + 1)), ["a"], 7).collect()


def test_rest_query_pages(spark):
    from almanac.plans.serve import rest_query
    df = spark.range(10).withColumn("v", F.col("id") % 3).repartition(4)
    page = lambda **p: [(r.v, r.id) for r in rest_query(df, {"order": "v,id", "limit": 4, **p}).collect()]
    assert page() + page(offset=4) + page(offset=8) == sorted((r.v, r.id) for r in df.collect())
    assert [r.id for r in rest_query(df, {"limit": 3}).collect()] == [0, 1, 2]


def test_single_pane_metrics_skip_unknown(spark):
    dicts = [("integer", ["10", "20"]), ("real", ["1.5"]), ("cstring", ["x", "2024-01-01"])]
    rows = [("p", "cases", "integer", 1, 0, dicts), ("p", "rate", "real", 0, 1, dicts), ("p", "odd", "cstring", 0, 2, dicts),
            ("p", "none", None, 0, 3, dicts), ("p", "nidx", "integer", None, 4, dicts)]
    df = spark.createDataFrame(rows, "payload string, name string, dtype string, idx int, ordinal int,"
                                     " dataColumns array<struct<dataType: string, dataValues: array<string>>>")
    got = PG.single_pane_metrics(df, ["cases", "rate", "odd", "none", "nidx"]).first().asDict()
    assert got == {"payload": "p", "cases": "20", "rate": "1.5", "odd": None, "none": None, "nidx": None,
                   "Last update": "2024-01-01"}


def test_select_limit_is_the_same_each_time(spark):
    prov, var, loc = _dims(spark)
    t0 = dt.datetime(2024, 1, 1)
    fact = _fact(spark, [(D(2024, 1, d), "a", 1, 1, 1, 1.0, t0, "u", "n", False, None) for d in range(1, 20)])
    args = dict(provider=".+", limit=3)
    ids = [r.dt for r in ST.select_observations(fact.repartition(5), prov, var, loc, **args).collect()]
    assert ids == [r.dt for r in ST.select_observations(fact, prov, var, loc, **args).collect()]


def test_upsert_counts_guard(spark):
    t0 = dt.datetime(2024, 1, 1)
    row = lambda loc: (D(2024, 1, 1), loc, 1, 1, 1, 1.0, t0, "u", "n", False, None)
    fact, batch = _fact(spark, [row("a")]), _fact(spark, [row("a"), row("b")])
    assert ST.upsert_counts(fact, batch).first().asDict() == {"rows_inserted": 1, "rows_updated": 1, "batch_rows": 2}
    with pytest.raises(Exception, match="no rows written"):
        ST.upsert_counts(fact, _fact(spark, [row("b")]), merged=fact).collect()
    none = ST.upsert_counts(fact, batch.limit(0)).first().asDict()
    assert none == {"rows_inserted": 0, "rows_updated": 0, "batch_rows": 0}


def test_newest_vintage_equals_upserts_in_order(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    fact = _fact(spark, [(D(2024, 1, 1), "a", 1, 1, 1, 0.0, t[0], "u0", "n0", True, 4)])
    drops = [_fact(spark, [(D(2024, 1, 1), loc, 1, 1, 1, float(10 * i + k), t[i], f"u{i}", f"n{i}", False, None)
                           for k, loc in enumerate("abc"[:3 - i])]) for i in (1, 2)]
    one_by_one = ST.upsert(ST.upsert(fact, drops[0]), drops[1])
    at_once = ST.upsert(fact, ST.newest_vintage_wins(drops[1].unionByName(drops[0])))
    assert sorted(one_by_one.collect(), key=str) == sorted(at_once.collect(), key=str)


def test_scratch_folder_needs_a_shared_one_on_a_cluster():
    from types import SimpleNamespace

    from almanac.session import ensure_checkpoint_dir
    nothing = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: nothing, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=nothing))

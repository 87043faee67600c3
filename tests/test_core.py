import datetime as dt

import pytest
from pyspark.sql import functions as F

from causeway.functions import aqi, scalar
from causeway.operators import causal, checks, evaluate, raster, runs, series_quality, spatial, summaries, upsert
from causeway.plans import adapters


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def results(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_index_goldens(spark):
    pm25 = [12.0, 35.4, 35.5, 9.0, 9.1, 55.5, 125.5, 225.5, 500.0, 0.0, None, -1.0]
    assert results(column(spark, pm25), aqi.sub_index("pm25", F.col("x"))) == [56, 100, 101, 50, 51, 151, 201, 301, 500, 0, None, None]
    assert results(column(spark, [100.0, 54.9, 425.0, 604.0]), aqi.sub_index("pm10", F.col("x"))) == [73, 50, 301, 500]
    clamped = [-5.0, 0.0, 9.0, 9.1, 35.4, 35.5, 55.4, 55.5, 125.4, 125.5, 225.4, 225.5, 400.0]
    assert results(column(spark, clamped), aqi.to_aqi(F.col("x"))) == [0, 0, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301, 500]


def test_overall_and_category(spark):
    df = spark.createDataFrame([(0, 10.0, 200.0), (1, 60.0, 90.0), (2, None, None), (3, 9.0, None)], "i int, a double, b double")
    both = {"pm25": aqi.sub_index("pm25", F.col("a")), "pm10": aqi.sub_index("pm10", F.col("b"))}
    top, name = aqi.overall(both)
    assert results(df, name) == ["pm10", "pm25", None, "pm25"] and results(df, top)[2] is None
    assert results(df, aqi.pollutants_used(both)) == ["pm25+pm10", "pm25+pm10", "", "pm25"]
    assert results(column(spark, [50.0, 50.5, 501.0, None]), aqi.category(F.col("x"))) == ["Good", "Moderate", "Hazardous", None]


@pytest.mark.parametrize("pollutant", ["pm25", "pm10", "no2", "o3"])
def test_index_never_falls(spark, pollutant):
    scale = {"o3": 3000.0}.get(pollutant, 10.0)
    rows = spark.range(6000).select(F.lit("k").alias("k"), (F.col("id") / scale).alias("x"))
    rows = rows.withColumn("y", aqi.sub_index(pollutant, F.col("x")))
    assert causal.is_monotone(rows, "x", "y", "k").first().monotone


def test_missing_values(spark):
    df = column(spark, [float("nan"), float("inf"), -9999.0, 1.0, None])
    assert results(scalar.nan_to_null(df, -9999.0), "x") == [None, None, None, 1.0, None]
    assert results(column(spark, [-1.0, None, 2.0]), scalar.at_least(F.col("x"))) == [0.0, None, 2.0]
    assert results(column(spark, [123456.0, 0.00123456, 0.0, None]), scalar.significant(F.col("x"), 3)) == [pytest.approx(123000), pytest.approx(0.00123), 0.0, None]
    assert results(column(spark, [float("nan"), 1.0, None]), scalar.is_finite(F.col("x"))) == [False, True, False]
    assert results(column(spark, [12.5]), scalar.improvement(F.lit(20.0), F.col("x"))) == [38]


def panel(spark, days=40, zones=3):
    rows = [(z, dt.date(2024, 1, 1) + dt.timedelta(days=i), None if (i * 7 + z) % 5 == 0 else float((i * 37 + z * 11) % 23), ((i * 13 + z) % 10) / 10) for z in range(zones) for i in range(days)]
    return spark.createDataFrame(rows, "zone_id int, date date, value double, valid double")


BUILDERS = {
    "lags": lambda p: causal.lags(p, "value", (1, 2, 7)),
    "trailing": lambda p: causal.trailing(p, "value", (3, 7), 0.5),
    "city lag": lambda p: causal.city_lag(p, "value"),
    "prior": lambda p: causal.target_day(p, "value", 0).select("zone_id", "date", "valid", "value_prior3"),
}


@pytest.mark.parametrize("name", BUILDERS)
def test_nothing_depends_on_the_future(spark, name):
    p = panel(spark)
    build = BUILDERS[name]
    for day in ("2024-01-09", "2024-01-25"):
        assert checks.changed_before(p, build, ["value"], day).count() == 0


def test_the_causality_test_has_teeth(spark):
    assert checks.changed_before(panel(spark), lambda p: causal.target_day(p, "value", 1), ["value"], "2024-01-20").count() > 0


def test_completion_is_a_prefix_of_itself(spark):
    build = lambda p: causal.complete(p, "value", "valid")
    assert checks.truncation_differs(panel(spark), build, "2024-01-20").count() == 0


def test_completion_tiers(spark):
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i) if i < 3 else None, 1.0 if i < 3 else 0.0) for i in range(100)]
    out = causal.complete(spark.createDataFrame(rows, "zone_id int, date date, value double, valid double"), "value", "valid").orderBy("date").collect()
    assert [out[i].level for i in (0, 3, 32, 33, 92, 93)] == [0, 1, 1, 2, 2, 3]
    assert out[3].complete == 1.0 and out[3].age_days == 1 and out[93].complete is None and out[93].age_days == 91


def test_densify_and_live_day(spark):
    p = spark.createDataFrame([(1, dt.date(2024, 1, 1), 1.0), (2, dt.date(2024, 1, 4), 2.0)], "zone_id int, date date, value double")
    assert causal.densify(p).count() == 8
    live = causal.lags(causal.densify(p, until=dt.date(2024, 1, 5)), "value", (1,)).where("date = date'2024-01-05'")
    assert {(r.zone_id, r.value_lag1) for r in live.collect()} == {(1, None), (2, 2.0)}


def test_flat_lines_need_contiguous_hours(spark):
    hours = [(1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), 5.0) for h in (0, 1, 2, 4, 5)] + [(2, dt.datetime(2024, 1, 1, h), 7.0) for h in range(3)] + [(3, dt.datetime(2024, 1, 1, h), None) for h in range(3)]
    df = spark.createDataFrame(hours, "k int, hour timestamp_ntz, v double")
    out = series_quality.hour_rules(df, "k", "hour", "v", 100.0, flat=3).groupBy("k").agg(F.count_if("flat_line").alias("flat"), F.count_if("valid").alias("valid"), F.max("run_id").alias("runs"))
    assert {tuple(r) for r in out.collect()} == {(1, 0, 5, 1), (2, 3, 0, 1), (3, 0, 0, 3)}


def test_newest_usable_run_replaces_whole_rows(spark):
    day = dt.date(2024, 3, 10)
    back = lambda k: day - dt.timedelta(days=k)
    r = spark.createDataFrame([(back(1), 0, 1, None, 1.0), (back(2), 1, 1, 5.0, 2.0), (back(3), 2, 1, 6.0, 3.0), (back(4), 3, 2, None, 4.0), (back(1), 0, 3, None, 9.0)], "init date, lead int, zone_id int, v double, w double")
    issues = spark.createDataFrame([(day, z) for z in (1, 2, 3)], "date date, zone_id int")
    out = {x.zone_id: x for x in runs.newest_usable_run(r, issues, 0, "v").collect()}
    assert (out[1].v, out[1].w, out[1].run_age, out[1].init) == (5.0, 2.0, 2.0, back(2))
    assert (out[2].v, out[2].w, out[2].run_age) == (None, 4.0, 4.0)
    assert (out[3].w, out[3].run_age, out[3].init) == (None, None, None)


def test_constant_and_linear_fields(spark):
    cells = spark.range(64).select(F.lit(1).alias("day"), F.floor(F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col")).withColumn("v", F.lit(1.0))
    for out in (raster.zonal_stats(cells, adapters.weights(spark)), raster.zonal_series(cells, adapters.weights(spark))):
        assert all(abs(r["mean"] - 1) < 1e-12 and r.valid_fraction == 1 and abs(r["std"]) < 1e-6 for r in out.collect())
    linear = cells.withColumn("v", 3.0 + 2 * F.col("row") - 5 * F.col("col"))
    points = spark.createDataFrame([(1, 2.25, 3.5), (2, 0.0, 0.0), (3, 6.75, 6.1), (4, 7.5, 2.0)], "id int, y double, x double")
    out = {r.id: r.value for r in raster.bilinear(linear, points).collect()}
    assert all(out[i] == pytest.approx(3 + 2 * y - 5 * x) for i, y, x in ((1, 2.25, 3.5), (2, 0, 0), (3, 6.75, 6.1))) and out[4] is None


def test_idw_needs_three_donors_and_breaks_ties_by_place(spark):
    cells = [(1, r, c, None) for r in range(3) for c in range(3)]
    cells[0], cells[2], cells[8] = (1, 0, 0, 1.0), (1, 0, 2, 2.0), (1, 2, 2, 4.0)
    df = spark.createDataFrame(cells, "day int, row int, col int, v double")
    out = {(r.row, r.col): r.idw for r in raster.idw_fill(df, 5.0).collect()}
    assert out[1, 1] == pytest.approx(7 / 3) and len(out) == 6
    assert raster.idw_fill(df, 5.0, k=3, least=4).count() == 0
    flags = {(r.row, r.col): r.flag for r in raster.gap_fill(df, df.where("row < 2"), 5.0).collect()}
    assert flags[0, 0] == 0 and flags[1, 1] == 1 and flags[2, 2] == 9


def test_points_inside_near_and_far(spark):
    points = spark.createDataFrame([(1, 20.0, 20.0), (2, 8.0, 20.0), (3, 200.0, 200.0), (4, 40.0, 20.0)], "id int, x double, y double")
    out = {r.id: r for r in spatial.locate(points, adapters.zones(spark), most=5.0).collect()}
    assert (out[1].zone_id, out[1].outside, out[1].snapped) == (1, 0.0, False) and (out[2].zone_id, out[2].outside) == (1, 2.0) and out[3].zone_id is None
    assert out[4].zone_id in (1, 2)
    square = adapters.zones(spark).where("zone_id = 1").select(spatial.area(F.col("ring"))).first()[0]
    assert square == 900 and spatial.snapped_extent(101.0, 950.0, 100.0, 20.0) == (0.0, 1000.0)


def test_revisions(spark):
    rows = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "x")], "k int, t int, v string")
    assert {tuple(r) for r in upsert.keep_last(rows, ["k"], [F.col("t")]).collect()} == {(1, 2, "new"), (2, 1, "x")}
    assert {tuple(r) for r in upsert.keep_first(rows, ["k"], [F.col("t")]).collect()} == {(1, 1, "old"), (2, 1, "x")}
    with pytest.raises(ValueError):
        upsert.require_unique(rows, ["k"])
    assert upsert.sample(rows, 2, ["k", "t"]).collect() == upsert.sample(rows.repartition(3), 2, ["k", "t"]).collect()
    with pytest.raises(ValueError):
        upsert.require_schema(rows, {"k": "bigint"})


def test_fold_edges_go_to_the_next_fold(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 11)], "date date")
    assert [r.fold for r in evaluate.folds(rows, "date").orderBy("date").collect()] == [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]


def test_macro_f1_divides_by_all_labels(spark):
    df = spark.createDataFrame([("Good", "Good"), ("Good", "Moderate"), ("Hazardous", "Hazardous")], "t string, p string").withColumn("k", F.lit(1))
    assert evaluate.macro_f1(df, "t", "p", ["k"]).first().macro_f1 == pytest.approx((2 / 3 + 1) / 6)


def test_metrics_of_one_row_have_no_r2(spark):
    df = spark.createDataFrame([(0, 10.0, 12.0)], "horizon int, truth double, m double")
    assert all(r.r2 is None and r.rmse == 2 for r in evaluate.metrics(df, ["m"]).collect())


def test_gated_write(spark, tmp_path):
    df = spark.range(3)
    bad = spark.createDataFrame([("c", "FAIL")], "check string, status string")
    assert not evaluate.write_if_passed(df, bad, f"{tmp_path}/a") and evaluate.write_if_passed(df, bad.where("false"), f"{tmp_path}/b")
    assert not (tmp_path / "a").exists() and spark.read.parquet(f"{tmp_path}/b").count() == 3


def test_reconciliation(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "k int, v double")
    b = spark.createDataFrame([(1, 1.00001), (2, 2.1), (3, None), (4, 1.0)], "k int, v double")
    assert {r.k for r in checks.reconcile(a, b, ["k"], "v").collect()} == {2, 4}


def test_mode_goes_to_the_first_seen(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "a", 3), ("k", "b", 4)], "g string, v string, o int")
    assert summaries.mode_first(df, "v", "o", ["g"]).first().mode == "b"




def test_a_calendar_with_gaps_is_an_error(spark):
    p = panel(spark, days=6, zones=2)
    assert causal.require_calendar(p) is p
    for bad in (p.where("not (zone_id = 1 and date = date'2024-01-03')"), p.unionByName(p.limit(1)), p.where("zone_id = 0 or date > date'2024-01-01'")):
        with pytest.raises(ValueError):
            causal.require_calendar(bad)


def test_missing_days_shift_nothing(spark):
    day = lambda i: dt.date(2024, 1, i)
    p = spark.createDataFrame([(1, day(i), float(i)) for i in (1, 2, 3, 6, 7)], "zone_id int, date date, value double")
    out = {r.date.day: r for r in causal.trailing(causal.lags(p, "value", (1, 3)), "value", (3,)).collect()}
    assert (out[6].value_lag1, out[6].value_lag3, out[6].value_roll3_mean) == (None, 3.0, 3.0)
    assert (out[7].value_lag1, out[7].value_roll3_mean, out[7].value_roll3_std) == (6.0, 6.0, None)
    ahead = {r.date.day: r for r in causal.target_day(p, "value", 2).collect()}
    assert ahead[1].value_target == 3.0 and ahead[2].value_target is None and ahead[1].value_sum3 == 6.0


def test_satellite_windows_need_all_their_days(spark):
    from causeway.operators import features

    day = dt.date(2024, 1, 1)
    sat = spark.createDataFrame([(1, day + dt.timedelta(days=i), None if i == 4 else float(i)) for i in range(10)], "zone_id int, date date, value double")
    met = spark.createDataFrame([(1, day + dt.timedelta(days=i), 1.0) for i in range(12)], "zone_id int, date date, value double")
    none = spark.createDataFrame([], "init date, lead int, target date, zone_id int, v double")
    out = {r.issue_date.day: r.sat_roll3_mean for r in features.build(sat, met, none, (0,)).collect()}
    assert out[4] == 1.0 and out[5] == 2.0 and out[6] is None and out[8] is None and out[9] == 6.0


def test_upsert_asserts_unique_keys(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    assert upsert.upsert(old, new, ["k"]).count() == 2
    with pytest.raises(ValueError):
        upsert.upsert(old, new, ["k"], unique=["k"])
    with pytest.raises(ValueError):
        upsert.join_one_to_one(old, new.limit(1).withColumn("k", F.lit(2)), ["k"])
    assert upsert.numeric(old).columns == ["k"]


def test_two_formulations_agree_on_a_sample(spark, sf):
    """Independent recomputation: the district day of sampled keys, from the sensors themselves."""
    s = adapters.sensor_day(spark, sf).withColumn("zone_id", F.col("sensor") % 4)
    some = upsert.sample(series_quality.zone_day(s, ["date", "zone_id"], "value"), 12, ["date", "zone_id"]).collect()
    rows = s.collect()
    for r in some:
        own = sorted(x.value for x in rows if x.date == r.date and x.zone_id == r.zone_id)
        n = len(own)
        mean = sum(own) / n
        assert n == r.n_stations and abs(mean - r["mean"]) < 1e-9 and abs((own[(n - 1) // 2] + own[n // 2]) / 2 - r["median"]) < 1e-9
        assert r["std"] is None if n == 1 else abs((sum((x - mean) ** 2 for x in own) / (n - 1)) ** 0.5 - r["std"]) < 1e-9


def test_bilinear_regrid_of_a_linear_field(spark):
    cells = spark.range(64).select(F.lit(1).alias("day"), F.floor(F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col"))
    linear = cells.withColumn("v", 3.0 + 2 * (F.col("row") + 0.5) - 5 * (F.col("col") + 0.5))
    out = raster.regrid(linear, 3, 3, 2.5, method="bilinear").collect()
    assert len(out) == 9 and all(r.v == pytest.approx(3 + 2 * (r.row + 0.5) * 2.5 - 5 * (r.col + 0.5) * 2.5) for r in out)
    with pytest.raises(ValueError):
        raster.regrid(linear, 3, 3, 2.5, method="cubic")
    with pytest.raises(ValueError):
        raster.reference_weight(cells, "2021-01", "2021-12", before="2021-06")


def test_models_stop_early_and_are_refitted(spark):
    import random

    from causeway.operators import models

    rnd = random.Random(1)
    rows = []
    for i in range(240):
        x = rnd.random()
        rows.append((dt.date(2024, 1, 1) + dt.timedelta(days=i // 4), i % 4, 0, i // 80, None if i % 17 == 0 else x, 10 * x + rnd.gauss(0, 3), 1.0 + i % 3))
    df = spark.createDataFrame(rows, "date date, zone_id int, horizon int, fold int, x double, truth double, weight double")
    out, used = models.fit_folds(df, ["x"], "truth", weight="weight", rounds=15, order=["date", "zone_id"])
    assert out.count() == 240 and out.where("pred_gbt is null or pred_gbt < 0").count() == 0
    assert set(used) == {(0, 0), (0, 1), (0, 2)} and all(1 <= n <= 15 for n in used.values()) and min(used.values()) < 15
    final = models.median_rounds(used)
    assert models.median_rounds({(0, 0): 3, (0, 1): 8, (1, 0): 5}) == {0: 5, 1: 5}
    fitted = models.refit(df, ["x"], "truth", final, weight="weight")
    assert models.rounds_of(fitted[0]) == final[0]
    live = models.predict_live(fitted, df.drop("truth").limit(10))
    assert live.count() == 10 and live.where("pred_gbt >= 0").count() == 10
    assert models.importances(fitted[0])[0][0] == "x"


def test_zones_of_any_unit_are_located(spark):
    big = adapters.zones(spark).withColumn("ring", F.transform("ring", lambda p: F.struct((p.x * 1e4).alias("x"), (p.y * 1e4).alias("y"))))
    points = spark.createDataFrame([(1, 20e4, 20e4), (2, 8e4, 20e4), (3, 200e4, 200e4)], "id int, x double, y double")
    out = {r.id: r for r in spatial.locate(points, big, most=5e4).collect()}
    assert out[1].zone_id == 1 and out[2].zone_id == 1 and out[2].outside == 2e4 and out[3].zone_id is None

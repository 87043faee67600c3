"""More named queries and their SQL: calendars with holes, coverage, serving, products, gates and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import aqi, scalar
from ..operators import causal, checks, evaluate, features, raster, series_quality, spatial, summaries, upsert
from ..operators.products import Product, Registry
from . import adapters as a
from .catalogue import _BACK, _FLAG, _LONG, _MODELS, EDGES, EVENTS, FORECASTS, GAPPY, PANEL, PM25, PRIO, RASTER, SENSOR, WEIGHTS, _band, _filled, _index, _r, query, rounded

# --- calendars --------------------------------------------------------------------------------------------------------

_HOLES = f"{PANEL}, holes AS (SELECT * FROM panel WHERE day(date) % 6 <> 4 AND NOT (zone_id = 2 AND day(date) IN (8, 9)))"


def _holes(spark, d):
    return a.panel(spark, d).where("dayofmonth(date) % 6 <> 4 and not (zone_id = 2 and dayofmonth(date) in (8, 9))")


def _near(low: int, high: int) -> str:
    at = [f"INTERVAL {-k} DAYS PRECEDING" if k < 0 else f"INTERVAL {k} DAYS FOLLOWING" for k in (low, high)]
    return f"OVER (PARTITION BY h.zone_id ORDER BY h.date RANGE BETWEEN {at[0]} AND {at[1]})"


@query(f"""WITH {_HOLES} SELECT h.date, h.zone_id, round(a.value, 6) AS value_lag1, round(b.value, 6) AS value_lag2, round(avg(h.value) {_near(-3, -1)}, 6) AS value_roll3_mean,
round(CASE WHEN count(h.value) {_near(-3, -1)} >= 2 THEN stddev_samp(h.value) {_near(-3, -1)} END, 6) AS value_roll3_std
FROM holes h LEFT JOIN holes a ON a.zone_id = h.zone_id AND a.date = h.date - 1 LEFT JOIN holes b ON b.zone_id = h.zone_id AND b.date = h.date - 2""")  # fmt: skip
def lags_over_missing_days(spark, d):
    """Days without a row shift nothing."""
    return rounded(causal.trailing(causal.lags(_holes(spark, d), "value", (1, 2)), "value", (3,)).drop("value"))


@query(f"""WITH {_HOLES} SELECT h.date, h.zone_id, round(a.value, 6) AS value_target, round(a.value - h.value, 6) AS value_change, round(CASE WHEN count(h.value) {_near(-1, 1)} >= 3 THEN avg(h.value) {_near(-1, 1)} END, 6) AS value_mean3,
round(CASE WHEN count(h.value) {_near(-1, 1)} >= 3 THEN sum(h.value) {_near(-1, 1)} END, 6) AS value_sum3, round(CASE WHEN count(h.value) {_near(-3, -1)} >= 3 THEN sum(h.value) {_near(-3, -1)} END, 6) AS value_prior3
FROM holes h LEFT JOIN holes a ON a.zone_id = h.zone_id AND a.date = h.date + 1""")  # fmt: skip
def targets_over_missing_days(spark, d):
    return rounded(causal.target_day(_holes(spark, d), "value", 1).drop("value"))


@query(f"WITH {PANEL} SELECT date, zone_id FROM panel WHERE date BETWEEN DATE '2024-01-15' AND DATE '2024-01-16'")
def causality_leaks(spark, d):
    """The test of causality must find every row that a leak touches: here a target of the next day among the features."""
    return checks.changed_before(a.panel(spark, d), lambda x: causal.target_day(x, "value", 1), ["value"], "2024-01-16")


@query(f"""WITH {PANEL}, w AS (SELECT date, zone_id, round(avg(value) OVER (PARTITION BY zone_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS value_roll3_mean FROM panel)
SELECT * FROM w WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'""")  # fmt: skip
def padded_window(spark, d):
    """Five days, with three more read in front of them: the same as of the whole table."""
    out = causal.padded(a.panel(spark, d), lambda x: causal.trailing(x, "value", (3,), std=False), "2024-01-10", "2024-01-14", before=3)
    return rounded(out.drop("value"))


@query("SELECT CAST(date_trunc('hour', max(ts)) + INTERVAL 1 HOUR - INTERVAL 19 HOURS AS DATE) AS last_day FROM events")
def last_local_day(spark, d):
    hour = a.events(spark, d).agg(F.date_trunc("hour", F.max("ts")).alias("hour"))
    return hour.select(scalar.last_complete_local_day(F.col("hour")).alias("last_day"))


@query("""WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders) SELECT month, CAST(last_day(month) + 21 AS DATE) < (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS mature FROM m""")
def mature_months(spark, d):
    o = a.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"))
    today = o.agg(F.max("date")).first()[0]
    return o.select(F.trunc("date", "MM").alias("month")).distinct().withColumn("mature", scalar.is_mature(F.col("month"), today))


# --- coverage ---------------------------------------------------------------------------------------------------------


@query(f"WITH {PRIO} SELECT zone_id, round(avg(valid), 6) AS valid, count(value) AS days_with_value FROM prio GROUP BY 1")
def zone_coverage(spark, d):
    return rounded(summaries.zone_coverage(a.prio_day(spark, d), "value", ["valid"]))


_SHARE = f"""{_filled(_BACK)}, f AS (SELECT day, {_FLAG} AS flag FROM p), sh AS (SELECT day, avg(CAST(flag IN (1, 2) AS INT)) AS filled FROM f WHERE flag <> 9 GROUP BY 1)"""


@query(f"{_SHARE} SELECT day, round(filled, 6) AS filled FROM sh")
def filled_share_by_day(spark, d):
    return rounded(summaries.filled_share(raster.gap_fill(a.raster(spark, d), a.weights(spark).where("w > 0"), 2.5)))


@query(f"{_SHARE} SELECT day, round(filled, 6) AS filled FROM sh ORDER BY sh.filled DESC, day LIMIT 1")
def most_filled_day(spark, d):
    return rounded(summaries.most_filled(raster.gap_fill(a.raster(spark, d), a.weights(spark).where("w > 0"), 2.5)))


@query(f"""{_filled(_BACK)}, j AS (SELECT day, zone, w, v, CASE WHEN inside THEN coalesce(sp, past) ELSE v END AS f FROM p JOIN weights USING ("row", col) WHERE w > 0),
z AS (SELECT day, zone, sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END) / sum(w) AS clear_fraction, sum(CASE WHEN f IS NOT NULL THEN w ELSE 0 END) / sum(w) AS valid_fraction FROM j GROUP BY 1, 2)
SELECT day, zone, {_r('clear_fraction', 'valid_fraction')}, round(greatest(valid_fraction - clear_fraction, 0), 6) AS filled_fraction FROM z""")  # fmt: skip
def filled_fraction(spark, d):
    cells, w = a.raster(spark, d), a.weights(spark)
    valid = raster.zonal_series(raster.gap_fill(cells, w.where("w > 0"), 2.5), w).select("day", "zone", "valid_fraction")
    clear = raster.zonal_series(cells, w).select("day", "zone", F.col("valid_fraction").alias("clear_fraction"))
    return rounded(valid.join(clear, ["day", "zone"]).withColumn("filled_fraction", summaries.filled_fraction(F.col("valid_fraction"), F.col("clear_fraction"))))


@query(f'WITH {PRIO} SELECT zone_id, CAST(year(date) AS INT) AS year, count(*) AS "rows", count(DISTINCT date) AS days, CAST(median(n) AS DOUBLE) AS median_stations FROM prio WHERE value IS NOT NULL GROUP BY 1, 2')
def coverage_by_year(spark, d):
    return summaries.by_year(a.prio_day(spark, d).where("value is not null"), "date", "n")


@query(f"""WITH {PRIO}, y AS (SELECT zone_id, year(date) AS y, count(DISTINCT date) AS days, CAST(median(n) AS DOUBLE) AS s FROM prio WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT zone_id, {', '.join(f'coalesce(max(CASE WHEN y = {k} THEN days END), 0) AS days_{k}, max(CASE WHEN y = {k} THEN s END) AS stations_{k}' for k in (1995, 1996, 2050))} FROM y GROUP BY 1""")  # fmt: skip
def coverage_year_table(spark, d):
    return summaries.year_table(a.prio_day(spark, d).where("value is not null"), "date", "n", [1995, 1996, 2050])


@query("SELECT l_returnflag, l_linestatus, CAST(trunc(median(l_extendedprice)) AS INT) AS median FROM lineitem GROUP BY 1, 2")
def median_whole(spark, d):
    return summaries.median_int(a.table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


@query(f"""WITH {EVENTS}, h AS (SELECT zone_id, date_trunc('hour', ts) AS hour, avg(value) AS t FROM ev GROUP BY 1, 2), s AS (SELECT CAST(hour + INTERVAL 5 HOURS AS DATE) AS date, zone_id, avg(t) AS t_mean, max(t) AS t_max, count(t) AS n_hours FROM h GROUP BY 1, 2)
SELECT date, zone_id, n_hours, round(CASE WHEN n_hours >= 22 THEN t_mean END, 6) AS t_mean, round(CASE WHEN n_hours >= 22 THEN t_max END, 6) AS t_max FROM s""")  # fmt: skip
def incomplete_days_are_null(spark, d):
    h = a.events(spark, d).groupBy("zone_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.avg("value").alias("t"))
    s = h.groupBy(scalar.local_day(F.col("hour")).alias("date"), "zone_id").agg(F.avg("t").alias("t_mean"), F.max("t").alias("t_max"), F.count("t").alias("n_hours"))
    return rounded(series_quality.only_complete(s, ["t_mean", "t_max"], "n_hours", 22))


@query(f"""WITH {SENSOR}, st AS (SELECT DISTINCT sensor, CASE WHEN sensor % 3 <> 0 THEN sensor % 4 END AS zone_id FROM sensors) SELECT s.sensor, s.date, round(s.value, 6) AS value FROM sensors s JOIN st ON st.sensor = s.sensor WHERE st.zone_id IS NOT NULL""")
def sensors_in_zones(spark, d):
    s = a.sensor_day(spark, d)
    stations = s.select("sensor").distinct().withColumn("zone_id", F.when(F.col("sensor") % 3 != 0, F.col("sensor") % 4))
    return rounded(series_quality.of_known_stations(s, stations, "sensor"))


# --- products and derived values --------------------------------------------------------------------------------------

PRODUCTS = Registry({
    "aod": Product("l_extendedprice", "packed_aod", bits=((0, 3, 1), (3, 2, 0)), valid=(0.0, 50.0)),
    "gas": Product("l_quantity", "mol_to_umol", cloud_max=0.05),
    "air": Product("l_quantity", "kelvin_to_celsius"),
})


@query("""SELECT 'aod' AS product, l_returnflag, l_linenumber, round(avg(CASE WHEN (l_orderkey & 7) = 1 AND ((l_orderkey >> 3) & 3) = 0 AND l_extendedprice * 0.001 BETWEEN 0 AND 50 THEN l_extendedprice * 0.001 END), 6) AS v FROM lineitem GROUP BY ALL
UNION ALL SELECT 'gas', l_returnflag, l_linenumber, round(avg(CASE WHEN l_discount <= 0.05 THEN l_quantity * 1e6 END), 6) FROM lineitem GROUP BY ALL
UNION ALL SELECT 'air', l_returnflag, l_linenumber, round(avg(l_quantity - 273.15), 6) FROM lineitem GROUP BY ALL""")  # fmt: skip
def product_values(spark, d):
    looks = a.table(spark, d, "lineitem").withColumnsRenamed({"l_discount": "cloud_fraction", "l_orderkey": "qa"})
    return rounded(PRODUCTS.build_all(dict.fromkeys(PRODUCTS.products, looks), ["l_returnflag", "l_linenumber"]))


@query(f"""WITH {EVENTS}, h AS (SELECT zone_id, date_trunc('hour', ts) AS hour, avg(value) AS b, CAST(count(*) AS DOUBLE) AS s, max(value) AS hi, min(value) AS lo FROM ev GROUP BY 1, 2)
SELECT CAST(hour + INTERVAL 5 HOURS AS DATE) AS date, zone_id, round(avg(b * s), 6) AS ventilation, round(avg(hi) - avg(lo), 6) AS inversion FROM h GROUP BY 1, 2""")  # fmt: skip
def ventilation_inversion(spark, d):
    h = a.events(spark, d).groupBy("zone_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.avg("value").alias("b"), F.count(F.lit(1)).cast("double").alias("s"), F.max("value").alias("hi"), F.min("value").alias("lo"))
    h = h.withColumn("vent", scalar.ventilation(F.col("b"), F.col("s")))
    days = h.groupBy(scalar.local_day(F.col("hour")).alias("date"), "zone_id").agg(F.avg("vent").alias("ventilation"), F.avg("hi").alias("hi"), F.avg("lo").alias("lo"))
    return rounded(days.select("date", "zone_id", "ventilation", scalar.inversion(F.col("hi"), F.col("lo")).alias("inversion")))


_AQI = _index("greatest(value - 20, 0)", PM25, 1)


@query(f"SELECT event_id, round(greatest(value - 20, 0), 6) AS pred, {_AQI} AS pred_aqi, {_band(_AQI)} AS pred_category FROM events")
def predicted_aqi(spark, d):
    """A prediction clipped at 0 with its index and band."""
    e = a.events(spark, d).select("event_id", evaluate.persistence(F.col("value") - 20).alias("pred"))
    return rounded(aqi.with_aqi(e, ["pred"]))


# --- evaluation and serving -------------------------------------------------------------------------------------------


@query(f"""WITH {FORECASTS}, f AS (SELECT * FROM forecasts WHERE zone_id <= 3 OR day(date) <= 2), enough AS (SELECT zone_id FROM f GROUP BY 1 HAVING count(*) >= 10),
long AS (SELECT zone_id, truth, 'persistence' AS model, persistence AS pred FROM f UNION ALL SELECT zone_id, truth, 'roll3', roll3 FROM f UNION ALL SELECT zone_id, truth, 'roll7', roll7 FROM f),
m AS (SELECT zone_id, model, count(*) AS n, sqrt(avg((truth - pred) ** 2)) AS rmse, avg(abs(truth - pred)) AS mae, CASE WHEN count(*) > 1 THEN 1 - sum((truth - pred) ** 2) / (var_pop(truth) * count(*)) END AS r2
  FROM long WHERE pred IS NOT NULL AND zone_id IN (SELECT zone_id FROM enough) GROUP BY 1, 2)
SELECT zone_id, model, n, {_r('rmse', 'mae', 'r2')} FROM m""")  # fmt: skip
def zone_metrics(spark, d):
    return rounded(evaluate.zone_metrics(a.forecasts(spark, d).where("zone_id <= 3 or dayofmonth(date) <= 2"), _MODELS))


@query(f"WITH {FORECASTS} SELECT round(avg(abs(roll3 - roll7)), 6) AS mean_diff, round(max(abs(roll3 - roll7)), 6) AS max_diff, count(roll3 - roll7) AS n FROM forecasts")
def model_agreement(spark, d):
    return rounded(evaluate.agreement(a.forecasts(spark, d), "roll3", "roll7"))


@query(f"""WITH {_LONG} SELECT m.horizon, m.model, CAST(floor((b.rmse - m.rmse) / b.rmse * 100 + 0.5) AS INT) AS improvement FROM metrics m JOIN metrics b ON b.model = 'persistence' AND b.horizon IS NOT DISTINCT FROM m.horizon WHERE m.model <> 'persistence'""")
def improvement_over_baseline(spark, d):
    m = evaluate.metrics(a.forecasts(spark, d), _MODELS).select("horizon", "model", "rmse")
    base = m.where("model = 'persistence'").select(F.col("horizon").alias("h"), F.col("rmse").alias("base"))
    both = m.where("model <> 'persistence'").join(F.broadcast(base), F.col("horizon").eqNullSafe(F.col("h")))
    return both.select("horizon", "model", scalar.improvement(F.col("base"), F.col("rmse")).alias("improvement"))


_BASE = "metrics m JOIN metrics b ON b.model = 'persistence' AND b.horizon IS NOT DISTINCT FROM m.horizon AND m.model <> 'persistence'"


@query(f"""WITH {_LONG}, top AS (SELECT p_name AS feature FROM part WHERE p_partkey <= 5) SELECT 'coverage' AS "check", CASE WHEN count_if(roll3 IS NULL OR roll7 IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM forecasts
UNION ALL SELECT 'no target or identifier among the features', 'FAIL' UNION ALL SELECT 'one fold per row', 'PASS'
UNION ALL SELECT m.model || ' beats the baseline overall', CASE WHEN m.rmse < b.rmse AND m.mae < b.mae THEN 'PASS' ELSE 'FAIL' END FROM {_BASE} WHERE m.horizon IS NULL
UNION ALL SELECT m.model || ' beats the baseline at every horizon', CASE WHEN bool_and(m.rmse < b.rmse) THEN 'PASS' ELSE 'WARN' END FROM {_BASE} WHERE m.horizon IS NOT NULL GROUP BY m.model
UNION ALL SELECT 'physical features among the most important', CASE WHEN count_if({' OR '.join(f"contains(lower(feature), '{k}')" for k in evaluate.PHYSICAL)}) >= 3 THEN 'PASS' ELSE 'WARN' END FROM top""")  # fmt: skip
def full_gate(spark, d):
    """Every kind of check, on forecasts that lack some rows and features that hold a target."""
    f = a.forecasts(spark, d)
    keys = ["date", "zone_id", "horizon"]
    assigned = f.select(*keys).join(evaluate.folds(f, "date"), "date")
    top = a.table(spark, d, "part").where("p_partkey <= 5").select(F.col("p_name").alias("feature"))
    return evaluate.full_gate(f, f.select(*keys), assigned, ["roll3", "roll7"], "persistence", ["roll3", "truth"], ["truth", "zone_id"], top, keys)


@query(f"""WITH {PANEL} SELECT DATE '2024-01-20' AS issue_date, p.zone_id, CAST(h AS INT) AS horizon, round(m.value, 6) AS met_target, round(l.value, 6) AS ground_lag1
FROM panel p CROSS JOIN range(3) r(h) JOIN panel m ON m.zone_id = p.zone_id AND m.date = CAST(p.date + CAST(h AS INT) AS DATE) LEFT JOIN panel l ON l.zone_id = p.zone_id AND l.date = p.date - 1 WHERE p.date = DATE '2024-01-20'""")  # fmt: skip
def live_features(spark, d):
    """The issue day's features with the ground history of that day, joined by zone alone."""
    p = a.panel(spark, d)
    ground = causal.lags(p.withColumnRenamed("value", "ground"), "ground", (1,)).drop("ground")
    f = features.live(features.build(p, p, a.runs(spark, d)), ground, "2024-01-20")
    return rounded(f.select("issue_date", "zone_id", "horizon", "met_target", "ground_lag1"))


@query(f"""WITH {PANEL}, s AS (SELECT DATE '2024-01-10' AS issue_date, zone_id, value FROM panel WHERE date = DATE '2024-01-10'), f AS (SELECT DATE '2024-01-11' AS issue_date, zone_id, value FROM panel WHERE date = DATE '2024-01-11')
SELECT 'new day' AS kind, issue_date, zone_id, round(value, 6) AS value FROM f UNION ALL SELECT 'same day', issue_date, zone_id, round(value, 6) FROM s UNION ALL SELECT 'empty', issue_date, zone_id, round(value, 6) FROM f""")  # fmt: skip
def reseeded_table(spark, d):
    """A serving table is replaced whole when another issue date comes, and left alone otherwise."""
    day = lambda x: a.panel(spark, d).where(F.col("date") == F.lit(x).cast("date")).withColumnRenamed("date", "issue_date")
    stored, fresh = day("2024-01-10"), day("2024-01-11")
    again = stored.withColumn("value", F.lit(0.0))
    parts = {"new day": upsert.reseeded(stored, fresh), "same day": upsert.reseeded(stored, again), "empty": upsert.reseeded(stored.where("false"), fresh)}
    out = [df.withColumn("kind", F.lit(k)) for k, df in parts.items()]
    return rounded(out[0].unionByName(out[1]).unionByName(out[2]))


# --- keys and columns -------------------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('sat_lag1', 'first'), ('target', 'both'), ('truth', 'second'), ('zone_id', 'both')) t(name, place)")
def column_sets(spark, d):
    return upsert.column_sets(spark, ["zone_id", "target", "sat_lag1"], ["zone_id", "target", "truth"])


@query("SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 END AS segment_id, c_custkey, c_name FROM customer")
def mapped_codes(spark, d):
    c = a.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    c = c.withColumn("segment_id", upsert.mapped(F.col("c_mktsegment"), {"BUILDING": 1, "MACHINERY": 2}))
    return upsert.lead_first(upsert.all_but(c, ["c_mktsegment", "c_nationkey", "not there"]), ["segment_id"])


@query("SELECT n_nationkey, n_name, customers FROM nation JOIN (SELECT n_nationkey AS k, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1) ON k = n_nationkey")
def one_to_one_join(spark, d):
    n = a.table(spark, d, "nation").select("n_nationkey", "n_name")
    c = a.table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("c_custkey").alias("customers"))
    counted = n.select("n_nationkey").join(c, "n_nationkey", "left").fillna(0, ["customers"])
    return upsert.join_one_to_one(n, counted, ["n_nationkey"])


# --- grids ------------------------------------------------------------------------------------------------------------


@query(f"""WITH {RASTER}, t AS (SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c, CAST(floor((r + 0.5) * 2.5) AS INT) AS y, CAST(floor((c + 0.5) * 2.5) AS INT) AS x FROM range(3) a(r), range(3) b(c))
SELECT 'nearest' AS method, day, t.r AS "row", t.c AS col, round(v, 6) AS v FROM t JOIN cells ON "row" = t.y AND col = t.x
UNION ALL SELECT 'average', day, CAST(floor(("row" + 0.5) / 2.5) AS INT), CAST(floor((col + 0.5) / 2.5) AS INT), round(avg(v), 6) FROM cells WHERE "row" < 7 AND col < 7 GROUP BY 1, 2, 3, 4""")  # fmt: skip
def regridded(spark, d):
    out = [raster.regrid(a.raster(spark, d), 3, 3, 2.5, method=m).withColumn("method", F.lit(m)) for m in ("nearest", "average")]
    return rounded(out[0].unionByName(out[1]))


@query(f"""WITH {RASTER}, x AS (SELECT day // 30 AS month, "row", col, v, CAST(("row" + col + day) % 3 <> 0 AS INT) AS clear, coalesce(v > 0.1, false) AS built FROM cells)
SELECT month, "row", col, round(median(CASE WHEN clear = 1 THEN v END), 6) AS v, round(100 * avg(CAST(built AS INT)), 6) AS built_pct, CAST(sum(clear) AS BIGINT) AS clear_obs FROM x GROUP BY 1, 2, 3""")  # fmt: skip
def median_composite(spark, d):
    x = a.raster(spark, d).select(F.floor(F.col("day") / 30).cast("bigint").alias("month"), "row", "col", "v", ((F.col("row") + F.col("col") + F.col("day")) % 3 != 0).cast("int").alias("clear"), F.coalesce(F.col("v") > 0.1, F.lit(False)).alias("built"))
    return rounded(raster.median_composite(x, ["v"], "built", "clear"))


@query(f'WITH {RASTER} SELECT "row", col, round(coalesce(avg(v / 100), 0), 6) AS weight FROM cells WHERE day % 24 BETWEEN 0 AND 11 GROUP BY 1, 2')
def reference_weight(spark, d):
    months = a.raster(spark, d).withColumn("month", F.col("day") % 24)
    return rounded(raster.reference_weight(months, 0, 11, before=12))


@query('SELECT CAST(i // 8 AS INT) AS "row", CAST(i % 8 AS INT) AS col, 100 + (i % 8 + 0.5) * 2.5 AS x, 900 - (i // 8 + 0.5) * 2.5 AS y FROM range(56) r(i)'.replace("2.5", "2.5::DOUBLE"))
def cell_centres(spark, d):
    return raster.cell_centres(a.weights(spark).where("zone = 1").select("row", "col"), 100.0, 900.0, 2.5)


@query(f"""WITH {EDGES}, s AS (SELECT zone_id, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area FROM edges GROUP BY 1), c AS (SELECT CAST(r AS INT) AS "row", CAST(k AS INT) AS col FROM range(100) a(r), range(100) b(k)),
i AS (SELECT "row", col, zone_id FROM c, edges WHERE (y1 > "row" + 0.5) <> (y2 > "row" + 0.5) AND col + 0.5 < (x2 - x1) * ("row" + 0.5 - y1) / (y2 - y1) + x1 GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1),
z AS (SELECT "row", col, min(zone_id) AS zone_id FROM i GROUP BY 1, 2), w AS (SELECT zone_id, "row" // 10 AS r, col // 10 AS k, count(*) / 100.0 AS w FROM z GROUP BY 1, 2, 3), ra AS (SELECT zone_id, count(*) * 1.0 AS ra FROM z GROUP BY 1),
t AS (SELECT zone_id, CAST(count_if(w > 0) AS BIGINT) AS touched, CAST(count_if(w = 1) AS BIGINT) AS "full", CAST(sum(w) AS DOUBLE) AS weighted FROM w GROUP BY 1)
SELECT s.zone_id, round(area, 6) AS area, round(CAST(coalesce(ra, 0) AS DOUBLE), 6) AS raster_area, touched, "full", round(weighted, 6) AS weighted, round(100 * (coalesce(ra, 0) - area) / area, 6) AS diff_pct FROM s LEFT JOIN ra ON ra.zone_id = s.zone_id LEFT JOIN t ON t.zone_id = s.zone_id""")  # fmt: skip
def area_check(spark, d):
    zones = a.zones(spark)
    cells = spatial.rasterise(100, 100, zones)
    w = cells.groupBy(F.col("zone_id").alias("zone"), F.floor(F.col("row") / 10).cast("int").alias("row"), F.floor(F.col("col") / 10).cast("int").alias("col")).agg((F.count(F.lit(1)) / 100.0).cast("double").alias("w"))
    return rounded(raster.area_check(cells, w, zones.select("zone_id", spatial.area(F.col("ring")).alias("area")), 1.0))

"""Named queries over the driver's tables, and the SQL that checks each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import aqi, scalar
from ..operators import causal, checks, evaluate, features, raster, runs, series_quality, spatial, summaries, upsert
from . import adapters as a

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

# --- the adapters in SQL ---------------------------------------------------------------------------------------------

ZONE = "CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END"
EVENTS = f"ev AS (SELECT *, CAST(ts AS DATE) AS date, {ZONE} AS zone_id FROM events)"
PANEL = f"{EVENTS}, panel AS (SELECT date, zone_id, avg(value) AS value FROM ev GROUP BY date, zone_id)"
_GAPPY = "gappy AS (SELECT date, zone_id, CASE WHEN (day(date) * 7 + zone_id * 3) % 5 <> 0 THEN value END AS value FROM panel)"
GAPPY = f"{PANEL}, {_GAPPY}"
HOURLY = f"{EVENTS}, hourly AS (SELECT zone_id, date_trunc('hour', ts) AS hour, CAST(floor(avg(value) / 20) AS DOUBLE) AS value FROM ev GROUP BY 1, 2)"
SENSOR = f"{EVENTS}, sensors AS (SELECT CAST(user_id % 12 AS INT) AS sensor, date, avg(value * (1 + (user_id % 12) % 4)) AS value FROM ev GROUP BY 1, 2)"
RUNS = f"""{PANEL}, runs AS (
  SELECT * FROM (SELECT CAST(date - CAST(lead + 1 AS INT) AS DATE) AS init, CAST(lead AS INT) AS lead, date AS target, zone_id, value FROM panel, range(4) r(lead)) WHERE day(init) % 11 <> 0
), forecast_runs AS (SELECT init, lead, target, zone_id, CASE WHEN (day(init) * 3 + zone_id) % 7 <> 0 THEN value + lead END AS v FROM runs)"""
PRIO = """od AS (SELECT CAST(o_orderdate AS DATE) AS date, CAST(substr(o_orderpriority, 1, 1) AS INT) AS zone_id, avg(o_totalprice) AS value, count(*) AS n FROM orders GROUP BY 1, 2),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM od), (SELECT max(date) FROM od), INTERVAL 1 DAY)) AS DATE) AS date),
prio AS (SELECT c.date, z.zone_id, od.value, od.n, coalesce(od.n / 4.0, 0.0) AS valid FROM cal c CROSS JOIN (SELECT DISTINCT zone_id FROM od) z LEFT JOIN od ON od.date = c.date AND od.zone_id = z.zone_id)"""
PRIO_MONTH = """om AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(substr(o_orderpriority, 1, 1) AS INT) AS zone_id, avg(o_totalprice) AS value FROM orders
  WHERE month(o_orderdate) NOT BETWEEN 3 AND 6 GROUP BY 1, 2),
mcal AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM om), (SELECT max(month) FROM om), INTERVAL 1 MONTH)) AS DATE) AS month),
months AS (SELECT c.month, z.zone_id, om.value FROM mcal c CROSS JOIN (SELECT DISTINCT zone_id FROM om) z LEFT JOIN om ON om.month = c.month AND om.zone_id = z.zone_id)"""
RASTER = """cells AS (SELECT day, CAST(floor(i / 8) AS INT) AS "row", CAST(i % 8 AS INT) AS col, CASE WHEN x >= 0 THEN CAST(x AS DOUBLE) END AS v FROM (
  SELECT vec_id AS day, unnest(embedding) AS x, unnest(range(64)) AS i FROM embeddings))"""
WEIGHTS = """left_zone AS (SELECT CAST(floor(i / 8) AS INT) AS "row", CAST(i % 8 AS INT) AS col, CASE WHEN i % 8 < 3 THEN 1.0::DOUBLE WHEN i % 8 < 5 THEN 0.5 ELSE 0.0 END AS w FROM range(56) r(i)),
weights AS (SELECT 1 AS zone, "row", col, w FROM left_zone UNION ALL SELECT 2, "row", col, 1.0 - w FROM left_zone)"""
POINTS = "points AS (SELECT c_custkey AS id, (c_custkey * 7919 % 1000) / 10.0 AS x, (c_custkey * 104729 % 1009) / 10.0 AS y FROM customer)"
EDGES = "edges AS (SELECT * FROM (VALUES " + ", ".join(f"({z}, {p[0]}::DOUBLE, {p[1]}::DOUBLE, {q[0]}::DOUBLE, {q[1]}::DOUBLE)" for z, r in a.ZONES.items() for p, q in zip(r, r[1:] + r[:1])) + ") t(zone_id, x1, y1, x2, y2))"
FORECASTS = f"""{PANEL}, forecasts AS (SELECT date, zone_id, value + horizon AS truth, CAST(horizon AS INT) AS horizon, persistence, roll3, roll7 FROM (
  SELECT date, zone_id, value, lag(value) OVER w AS persistence, avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS roll3, avg(value) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll7
  FROM panel WINDOW w AS (PARTITION BY zone_id ORDER BY date)), range(3) h(horizon))"""


def _index(c: str, table: list, digits: int) -> str:
    t = f"(floor(({c}) * 1e{digits} + 1e-9) / 1e{digits})"
    steps = "".join(f" WHEN {t} >= {cl} THEN ({ih - il} / ({ch}::DOUBLE - {cl}::DOUBLE)) * ({t} - {cl}::DOUBLE) + {il}" for cl, ch, il, ih in reversed(table))
    return f"(CASE WHEN {t} >= 0 THEN least(round_even(CASE{steps} END, 0), 500.0) END)"


def _band(i: str) -> str:
    return "(CASE " + " ".join(f"WHEN {i} <= {high} THEN '{name}'" for high, name in aqi.BANDS) + " END)"


PM25 = aqi.BREAKPOINTS["pm25", "epa_2024"]
PM10 = aqi.BREAKPOINTS["pm10", "any"]


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


# --- flagship ---------------------------------------------------------------------------------------------------------


@query(f"""WITH {EVENTS}, d AS (SELECT CAST(ts + INTERVAL 5 HOURS AS DATE) AS date, zone_id, avg(value) AS value, count(value) AS n FROM ev GROUP BY 1, 2),
i AS (SELECT *, {_index('value', PM25, 1)} AS aqi FROM d)
SELECT date, zone_id, round(value, 6) AS value, n, aqi, {_band('aqi')} AS category, round(lag(value) OVER w, 6) AS value_lag1,
  round(CASE WHEN count(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) >= 1 THEN avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END, 6) AS value_roll3_mean
FROM i WINDOW w AS (PARTITION BY zone_id ORDER BY date)""")  # fmt: skip
def flagship_air_quality(spark, d):
    """Local-day means per zone, their index and band, and the lag and trailing mean a forecast would start from."""
    days = a.events(spark, d).groupBy(scalar.local_day(F.col("ts")).alias("date"), "zone_id").agg(F.avg("value").alias("value"), F.count("value").alias("n"))
    days = days.withColumn("aqi", aqi.sub_index("pm25", F.col("value"))).withColumn("category", aqi.category(F.col("aqi")))
    return rounded(causal.trailing(causal.lags(days, "value", (1,)), "value", (3,), std=False))


# --- local days, air quality ------------------------------------------------------------------------------------------


@query(f"""WITH {EVENTS}, h AS (SELECT zone_id, date_trunc('hour', ts) AS hour, avg(value) AS t, max(value) AS top FROM ev GROUP BY 1, 2)
SELECT CAST(hour + INTERVAL 5 HOURS AS DATE) AS date, zone_id, round(avg(t), 6) AS t_mean, round(max(top), 6) AS t_max, round(min(t), 6) AS t_min, round(sum(t), 6) AS t_sum, count(t) AS n_hours
FROM h GROUP BY 1, 2 HAVING count(t) >= 22""")  # fmt: skip
def local_day_stats(spark, d):
    h = a.events(spark, d).groupBy("zone_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.avg("value").alias("t"), F.max("value").alias("top"))
    out = h.groupBy(scalar.local_day(F.col("hour")).alias("date"), "zone_id").agg(F.avg("t").alias("t_mean"), F.max("top").alias("t_max"), F.min("t").alias("t_min"), F.sum("t").alias("t_sum"), F.count("t").alias("n_hours"))
    return rounded(out.where("n_hours >= 22"))


@query(f"""SELECT event_id, {_index('value', PM25, 1)} AS aqi_pm25, {_index('value', aqi.BREAKPOINTS['pm25', 'epa_2012'], 1)} AS aqi_2012, {_index('value * 1.3', PM10, 0)} AS aqi_pm10,
{_index('value * 4', aqi.BREAKPOINTS['no2', 'any'], 0)} AS aqi_no2, {_index('value / 2000', aqi.BREAKPOINTS['o3', 'any'], 3)} AS aqi_o3 FROM events""")  # fmt: skip
def aqi_subindex(spark, d):
    v = F.col("value")
    return a.events(spark, d).select(
        "event_id", aqi.sub_index("pm25", v).alias("aqi_pm25"), aqi.sub_index("pm25", v, "epa_2012").alias("aqi_2012"), aqi.sub_index("pm10", v * 1.3).alias("aqi_pm10"),
        aqi.sub_index("no2", v * 4).alias("aqi_no2"), aqi.sub_index("o3", v / 2000).alias("aqi_o3"),
    )


_TWO = f"""i AS (SELECT event_id, {_index('CASE WHEN event_id % 3 <> 0 THEN value END', PM25, 1)} AS a, {_index('CASE WHEN event_id % 5 <> 0 THEN value * 2 END', PM10, 0)} AS b FROM events)"""


@query(f"""WITH {_TWO} SELECT event_id, greatest(a, b) AS aqi, CASE WHEN a = greatest(a, b) THEN 'pm25' WHEN b = greatest(a, b) THEN 'pm10' END AS dominant,
concat_ws('+', CASE WHEN a IS NOT NULL THEN 'pm25' END, CASE WHEN b IS NOT NULL THEN 'pm10' END) AS used FROM i""")  # fmt: skip
def aqi_overall_dominant(spark, d):
    e = a.events(spark, d)
    pm25 = aqi.sub_index("pm25", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    pm10 = aqi.sub_index("pm10", F.when(F.col("event_id") % 5 != 0, F.col("value") * 2))
    e = e.select("event_id", pm25.alias("pm25"), pm10.alias("pm10"))
    both = {"pm25": F.col("pm25"), "pm10": F.col("pm10")}
    top, name = aqi.overall(both)
    return e.select("event_id", top.alias("aqi"), name.alias("dominant"), aqi.pollutants_used(both).alias("used"))


@query(f"""WITH i AS (SELECT {_band(_index('value', PM25, 1))} AS category FROM events), c AS (SELECT category, count(*) AS n FROM i GROUP BY 1)
SELECT category, n, round(n / sum(n) OVER (), 6) AS share FROM c""")  # fmt: skip
def aqi_category_share(spark, d):
    e = a.events(spark, d).select(aqi.category(aqi.sub_index("pm25", F.col("value"))).alias("category"))
    return rounded(summaries.shares(e, ["category"]))


# --- causal windows ---------------------------------------------------------------------------------------------------

_STD = "stddev_samp"
_W = "WINDOW w AS (PARTITION BY zone_id ORDER BY date)"


def _roll(k: int, need: int, fn: str = "avg", c: str = "value") -> str:
    f = f"OVER (w ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"round(CASE WHEN count({c}) {f} >= {need} THEN {fn}({c}) {f} END, 6)"


@query(f"WITH {GAPPY} SELECT date, zone_id, {', '.join(f'round(lag(value, {k}) OVER w, 6) AS value_lag{k}' for k in (1, 2, 3, 7))} FROM gappy {_W}")
def causal_lags(spark, d):
    return rounded(causal.lags(a.gappy(spark, d), "value", (1, 2, 3, 7)).drop("value"))


@query(f"WITH {GAPPY} SELECT date, zone_id, {', '.join(f'{_roll(k, 1)} AS value_roll{k}_mean, {_roll(k, 2, _STD)} AS value_roll{k}_std' for k in (3, 7))} FROM gappy {_W}")
def rolling_mean_std(spark, d):
    return rounded(causal.trailing(a.gappy(spark, d), "value", (3, 7)).drop("value"))


@query(f"WITH {GAPPY} SELECT date, zone_id, {_roll(3, 3)} AS value_roll3_mean, {_roll(3, 3, 'stddev_samp')} AS value_roll3_std, {_roll(7, 6)} AS value_roll7_mean, {_roll(7, 6, 'stddev_samp')} AS value_roll7_std FROM gappy {_W}")
def rolling_min_frac(spark, d):
    return rounded(causal.trailing(a.gappy(spark, d), "value", (3, 7), least=0.8).drop("value"))


def _target(h: int) -> str:
    at = {0: "value", 1: "lead(value, 1) OVER w", 2: "lead(value, 2) OVER w"}
    before = {0: "lag(value, 1) OVER w", 1: "value", 2: "lead(value, 1) OVER w"}[h]
    low, high = ["2 PRECEDING", "1 PRECEDING", "CURRENT ROW"][h], ["CURRENT ROW", "1 FOLLOWING", "2 FOLLOWING"][h]
    f = f"OVER (w ROWS BETWEEN {low} AND {high})"
    p = "OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"
    return f"""SELECT date, zone_id, CAST({h} AS INT) AS horizon, round({at[h]}, 6) AS value_target, round({at[h]} - {before}, 6) AS value_change, round(CASE WHEN count(value) {f} >= 3 THEN avg(value) {f} END, 6) AS value_mean3,
round(CASE WHEN count(value) {f} >= 3 THEN sum(value) {f} END, 6) AS value_sum3, round(CASE WHEN count(value) {p} >= 3 THEN sum(value) {p} END, 6) AS value_prior3 FROM gappy {_W}"""


@query(f"WITH {GAPPY} " + " UNION ALL ".join(f"({_target(h)})" for h in (0, 1, 2)))
def target_lead_features(spark, d):
    p = a.gappy(spark, d)
    parts = [causal.target_day(p, "value", h).withColumn("horizon", F.lit(h)) for h in (0, 1, 2)]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("value"))


@query(f"WITH {PANEL} SELECT date, zone_id, {_roll(3, 3, 'sum')} AS prior_sum3 FROM panel {_W}")
def prior_sum3(spark, d):
    return rounded(causal.target_day(a.panel(spark, d), "value", 0).select("date", "zone_id", F.col("value_prior3").alias("prior_sum3")))


_DIRECT = "direct AS (SELECT *, CASE WHEN valid >= 0.5 THEN value END AS dv, row_number() OVER (PARTITION BY zone_id ORDER BY date) AS pos FROM prio)"


@query(f"""WITH {PRIO}, {_DIRECT}, m AS (SELECT *, quantile_cont(dv, 0.5) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS m30, quantile_cont(dv, 0.5) OVER (w ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING) AS m90 FROM direct {_W})
SELECT date, zone_id, round(coalesce(dv, m30, m90), 6) AS complete, CAST(CASE WHEN dv IS NOT NULL THEN 0 WHEN m30 IS NOT NULL THEN 1 WHEN m90 IS NOT NULL THEN 2 ELSE 3 END AS INT) AS level FROM m""")  # fmt: skip
def tiered_median_complete(spark, d):
    return rounded(causal.complete(a.prio_day(spark, d), "value", "valid").select("date", "zone_id", "complete", "level"))


@query(f"""WITH {PRIO}, {_DIRECT} SELECT date, zone_id, CAST(pos - last_value(CASE WHEN dv IS NOT NULL THEN pos END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS age_days FROM direct {_W}""")
def age_since_direct(spark, d):
    return causal.complete(a.prio_day(spark, d), "value", "valid").select("date", "zone_id", "age_days")


@query(f"""WITH {PRIO_MONTH}, r AS (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY month) AS pos FROM months)
SELECT month, zone_id, round(last_value(value IGNORE NULLS) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS value_filled,
CAST(pos - last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS INT) AS value_age, value IS NOT NULL AS value_real
FROM r WINDOW w AS (PARTITION BY zone_id ORDER BY month)""")  # fmt: skip
def locf_max_age(spark, d):
    return rounded(causal.carry_forward(a.prio_month(spark, d), "value", 2, date="month").drop("value"))


@query(f"WITH {GAPPY} SELECT date, zone_id, round(avg(value) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS value_smooth, round(last_value(value IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value_ffill FROM gappy {_W}")
def smooth_and_fill(spark, d):
    return rounded(causal.newest_before(causal.smooth(a.gappy(spark, d), "value"), "value").drop("value"))


@query(f"""WITH {PANEL}, c AS (SELECT CAST(date + 1 AS DATE) AS date, avg(value) AS city FROM panel GROUP BY 1)
SELECT p.date, p.zone_id, round(c.city, 6) AS city_value_lag1 FROM panel p LEFT JOIN c ON c.date = p.date""")
def city_lag(spark, d):
    return rounded(causal.city_lag(a.panel(spark, d), "value").select("date", "zone_id", "city_value_lag1"))


@query(f"""WITH x AS (SELECT event_type, value, {_index('value', PM25, 1)} AS i FROM events), s AS (SELECT event_type, i - lag(i) OVER (PARTITION BY event_type ORDER BY value) AS step FROM x)
SELECT event_type, coalesce(min(step), 0) >= 0 AS monotone FROM s GROUP BY 1""")  # fmt: skip
def monotone_index(spark, d):
    e = a.events(spark, d).select("event_type", "value", aqi.sub_index("pm25", F.col("value")).alias("i"))
    return causal.is_monotone(e, "value", "i", "event_type")


# --- sensor quality ---------------------------------------------------------------------------------------------------

_ISLANDS = """n AS (SELECT *, CASE WHEN value = lag(value) OVER (PARTITION BY zone_id ORDER BY hour) THEN 0 ELSE 1 END AS new FROM hourly),
g AS (SELECT *, sum(new) OVER (PARTITION BY zone_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS run_id FROM n),
q AS (SELECT zone_id, hour, value, CAST(run_id AS BIGINT) AS run_id, count(*) OVER r AS run_length, date_diff('hour', min(hour) OVER r, max(hour) OVER r) + 1 = count(*) OVER r AS contiguous FROM g WINDOW r AS (PARTITION BY zone_id, run_id))"""


@query(f"WITH {HOURLY}, {_ISLANDS} SELECT * FROM q")
def flatline_islands(spark, d):
    return series_quality.runs(a.hourly(spark, d), "zone_id", "hour", "value")


@query(f"""WITH {HOURLY}, {_ISLANDS}, f AS (SELECT *, hour(hour) = 4 AS flagged, value < 0 AS negative, value > 3 AS too_high, run_length >= 3 AND contiguous AS flat FROM q)
SELECT zone_id, count(*) AS hours, CAST(count_if(flagged) AS BIGINT) AS flagged, CAST(count_if(negative) AS BIGINT) AS negative, CAST(count_if(too_high) AS BIGINT) AS too_high, CAST(count_if(flat) AS BIGINT) AS flat_line, CAST(count_if(NOT (flagged OR negative OR too_high OR flat)) AS BIGINT) AS valid FROM f GROUP BY 1""")  # fmt: skip
def hour_qc_counts(spark, d):
    h = a.hourly(spark, d).withColumn("bad", F.hour("hour") == 4)
    h = series_quality.hour_rules(h, "zone_id", "hour", "value", 3.0, "bad", flat=3)
    return h.groupBy("zone_id").agg(F.count(F.lit(1)).alias("hours"), *(F.count_if(c).alias(c) for c in ("flagged", "negative", "too_high", "flat_line", "valid")))


@query(f"""WITH {HOURLY}, {_ISLANDS} SELECT zone_id, CAST(hour + INTERVAL 5 HOURS AS DATE) AS date, round(avg(value), 6) AS value, count(value) AS n_hours FROM q
WHERE NOT (value > 3 OR (run_length >= 3 AND contiguous)) GROUP BY 1, 2 HAVING count(value) >= 10""")  # fmt: skip
def valid_days(spark, d):
    h = series_quality.hour_rules(a.hourly(spark, d), "zone_id", "hour", "value", 3.0, flat=3)
    return rounded(series_quality.daily(h, ["zone_id"], scalar.local_day(F.col("hour")), "value", 10))


@query(f"""WITH {SENSOR}, o AS (SELECT s.sensor, s.date, s.value, median(t.value) AS others FROM sensors s JOIN sensors t ON t.date = s.date AND t.sensor <> s.sensor GROUP BY 1, 2, 3),
r AS (SELECT sensor, count(*) AS days, median(value / others) AS ratio FROM o GROUP BY 1)
SELECT sensor, days, round(ratio, 6) AS ratio, days >= 20 AND coalesce(NOT (ratio BETWEEN 0.4 AND 2.5), true) AS excluded FROM r""")  # fmt: skip
def sensor_ratio_qc(spark, d):
    return rounded(series_quality.sensor_ratios(a.sensor_day(spark, d), "sensor", "value", ["date"]))


@query(f"""WITH {SENSOR} SELECT date, sensor % 4 AS zone_id, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(min(value), 6) AS min, round(max(value), 6) AS max, round(stddev_samp(value), 6) AS std, count(value) AS n_stations
FROM sensors GROUP BY 1, 2""")  # fmt: skip
def district_day_stats(spark, d):
    s = a.sensor_day(spark, d).withColumn("zone_id", F.col("sensor") % 4)
    return rounded(series_quality.zone_day(s, ["date", "zone_id"], "value"))


# --- look-ups in time -------------------------------------------------------------------------------------------------


def _usable(h: int) -> str:
    joins = " ".join(f"LEFT JOIN forecast_runs r{k} ON r{k}.init = CAST(p.date - {k} AS DATE) AND r{k}.lead = {h + k - 1} AND r{k}.zone_id = p.zone_id" for k in (1, 2, 3, 4))
    pick = "CASE WHEN r1.v IS NOT NULL THEN 1 WHEN r2.v IS NOT NULL THEN 2 WHEN r3.v IS NOT NULL THEN 3 WHEN r4.init IS NOT NULL THEN 4 END"
    of = lambda c: f"CASE {pick} " + " ".join(f"WHEN {k} THEN r{k}.{c}" for k in (1, 2, 3, 4)) + " END"
    return f"SELECT p.date, p.zone_id, CAST({h} AS INT) AS horizon, {of('init')} AS init, {of('target')} AS target, round({of('v')}, 6) AS v, CAST({pick} AS DOUBLE) AS run_age FROM panel p {joins}"


@query(f"WITH {RUNS} " + " UNION ALL ".join(_usable(h) for h in (0, 1, 2)))
def newest_usable_run(spark, d):
    r, issues = a.runs(spark, d), a.panel(spark, d).select("date", "zone_id")
    parts = [runs.newest_usable_run(r, issues, h, "v").withColumn("horizon", F.lit(h)) for h in (0, 1, 2)]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(f"""WITH {RUNS}, h AS (SELECT target AS date, zone_id, v FROM forecast_runs WHERE lead = 0) SELECT h.date, h.zone_id, round(b.v, 6) AS v_lag1, round(avg(h.v) OVER r, 6) AS v_roll3_mean
FROM h LEFT JOIN h b ON b.zone_id = h.zone_id AND b.date = h.date - 1 WINDOW r AS (PARTITION BY h.zone_id ORDER BY h.date RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)""")  # fmt: skip
def run_history_lags(spark, d):
    h = runs.run_history(a.runs(spark, d), "v")
    return rounded(causal.trailing(causal.lags(h, "v", (1,)), "v", (3,), std=False).drop("v"))


@query(f"""WITH {PRIO}, {PRIO_MONTH} SELECT p.date, p.zone_id, CAST(date_trunc('month', p.date) - INTERVAL 1 MONTH AS DATE) AS month, round(m.value, 6) AS month_value
FROM prio p LEFT JOIN months m ON m.zone_id = p.zone_id AND m.month = CAST(date_trunc('month', p.date) - INTERVAL 1 MONTH AS DATE)""")  # fmt: skip
def prev_month_lookup(spark, d):
    months = a.prio_month(spark, d).withColumnRenamed("value", "month_value")
    return rounded(runs.month_before(a.prio_day(spark, d).select("date", "zone_id"), months))


# --- joins, keys, revisions -------------------------------------------------------------------------------------------


@query(f"""WITH {EVENTS}, x AS (SELECT date, zone_id, avg(value) AS a_mean FROM ev WHERE zone_id <= 3 AND day(date) % 3 <> 0 GROUP BY 1, 2), y AS (SELECT date, zone_id, max(value) AS b_max FROM ev WHERE zone_id >= 2 GROUP BY 1, 2),
z AS (SELECT date, zone_id, count(*) AS c_n FROM ev WHERE day(date) <= 9 GROUP BY 1, 2)
SELECT date, zone_id, round(a_mean, 6) AS a_mean, round(b_max, 6) AS b_max, c_n FROM x FULL JOIN y USING (date, zone_id) FULL JOIN z USING (date, zone_id)""")  # fmt: skip
def densify_outer_join(spark, d):
    e = a.events(spark, d)
    keys = ["date", "zone_id"]
    x = e.where("zone_id <= 3 and dayofmonth(date) % 3 <> 0").groupBy(keys).agg(F.avg("value").alias("mean"))
    y = e.where("zone_id >= 2").groupBy(keys).agg(F.max("value").alias("max"))
    z = e.where("dayofmonth(date) <= 9").groupBy(keys).agg(F.count(F.lit(1)).alias("n"))
    return rounded(upsert.full_join([upsert.prefixed(t, p, keys) for t, p in ((x, "a"), (y, "b"), (z, "c"))], keys))


@query(f"WITH {EVENTS} SELECT user_id, date, event_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date ORDER BY ts DESC, event_id DESC) AS n FROM ev) WHERE n = 1")
def dedupe_keep_last(spark, d):
    e = a.events(spark, d).select("user_id", "date", "event_id", "ts", "value")
    return rounded(upsert.keep_last(e, ["user_id", "date"], [F.col("ts"), F.col("event_id")]).select("user_id", "date", "event_id", "value"))


@query(f"WITH {PANEL}, fresh AS (SELECT date, zone_id, value * 2 AS value FROM panel WHERE day(date) BETWEEN 10 AND 15 AND zone_id <> 2) SELECT date, zone_id, round(value, 6) AS value FROM panel WHERE date NOT IN (SELECT date FROM fresh) UNION ALL SELECT date, zone_id, round(value, 6) FROM fresh")
def upsert_by_date(spark, d):
    p = a.panel(spark, d)
    fresh = p.where("dayofmonth(date) between 10 and 15 and zone_id <> 2").withColumn("value", F.col("value") * 2)
    return rounded(upsert.upsert(p, fresh, ["date"]))


@query(f"""WITH {EVENTS}, u AS (SELECT DISTINCT user_id % 50 AS bucket, date FROM ev WHERE zone_id = 3), c AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM u), (SELECT max(date) FROM u), INTERVAL 1 DAY)) AS DATE) AS date)
SELECT b.bucket, c.date FROM (SELECT DISTINCT bucket FROM u) b CROSS JOIN c EXCEPT SELECT bucket, date FROM u""")  # fmt: skip
def calendar_gaps(spark, d):
    u = a.events(spark, d).where("zone_id = 3").select((F.col("user_id") % 50).alias("bucket"), "date").distinct()
    return upsert.missing_days(u, ["bucket"])


@query(f"""WITH {EVENTS}, s AS (SELECT *, CASE WHEN zone_id = 1 THEN 2 ELSE 1 END AS p FROM ev WHERE zone_id IN (1, 4)), m AS (SELECT user_id, date, min(p) AS p FROM s GROUP BY 1, 2)
SELECT s.event_id, s.user_id, s.zone_id FROM s JOIN m ON m.user_id = s.user_id AND m.date = s.date AND m.p = s.p""")  # fmt: skip
def best_source_rows(spark, d):
    s = a.events(spark, d).where("zone_id in (1, 4)")
    return upsert.from_best_source(s, ["user_id", "date"], F.when(F.col("zone_id") == 1, 2).otherwise(1)).select("event_id", "user_id", "zone_id")


@query(f"WITH {EVENTS} SELECT event_id, user_id FROM ev WHERE zone_id = 3 UNION ALL SELECT event_id, user_id FROM ev WHERE zone_id = 4 AND user_id NOT IN (SELECT user_id FROM ev WHERE zone_id = 3)")
def source_fallback(spark, d):
    e = a.events(spark, d).select("event_id", "user_id", "zone_id")
    return upsert.with_fallback(e.where("zone_id = 3").drop("zone_id"), e.where("zone_id = 4").drop("zone_id"), ["user_id"])


@query("SELECT o_orderkey, c_name, c_mktsegment, round(o_totalprice, 6) AS o_totalprice FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def left_join_checked(spark, d):
    c = a.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return rounded(upsert.left_join_one(a.table(spark, d, "orders"), c, ["o_custkey"]).select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice"))


# --- rasters ----------------------------------------------------------------------------------------------------------


@query(f"""WITH {RASTER}, {WEIGHTS}, j AS (SELECT day, zone, w, v FROM cells JOIN weights USING ("row", col) WHERE w > 0), m AS (SELECT day, zone, sum(w * v) / sum(CASE WHEN v IS NOT NULL THEN w END) AS mean, min(v) AS min, max(v) AS max,
count(v) AS n_valid_cells, coalesce(sum(CASE WHEN v IS NOT NULL THEN w END) / sum(w), 0) AS valid_fraction FROM j GROUP BY 1, 2),
s AS (SELECT j.day, j.zone, sqrt(sum(w * (v - mean) ** 2) / sum(CASE WHEN v IS NOT NULL THEN w END)) AS std FROM j JOIN m USING (day, zone) GROUP BY 1, 2)
SELECT day, zone, n_valid_cells, {_r('mean', 'min', 'max', 'valid_fraction', 'std')} FROM m JOIN s USING (day, zone)""")  # fmt: skip
def zonal_stats(spark, d):
    return rounded(raster.zonal_stats(a.raster(spark, d), a.weights(spark)))


@query(f"""WITH {RASTER}, {WEIGHTS}, j AS (SELECT day, zone, w * (1.0 + ("row" % 2)) AS w, v FROM cells JOIN weights USING ("row", col) WHERE w > 0),
m AS (SELECT day, zone, sum(w * v) / sum(CASE WHEN v IS NOT NULL THEN w END) AS mean, sum(w * v * v) / sum(CASE WHEN v IS NOT NULL THEN w END) AS sq, coalesce(sum(CASE WHEN v IS NOT NULL THEN w END) / sum(w), 0) AS valid_fraction FROM j GROUP BY 1, 2)
SELECT day, zone, round(mean, 6) AS mean, round(valid_fraction, 6) AS valid_fraction, round(CASE WHEN mean IS NOT NULL THEN sqrt(greatest(sq - mean * mean, 0)) END, 6) AS std FROM m""")  # fmt: skip
def zonal_series_weighted(spark, d):
    return rounded(raster.zonal_series(a.raster(spark, d).withColumn("extra", 1.0 + F.col("row") % 2), a.weights(spark), "extra"))


_IDW = """off AS (SELECT dr, dc, CAST(dr * dr + dc * dc AS DOUBLE) AS d2 FROM (SELECT CAST(a - 3 AS INT) AS dr FROM range(7) x(a)), (SELECT CAST(b - 3 AS INT) AS dc FROM range(7) y(b)) WHERE dr * dr + dc * dc > 0 AND dr * dr + dc * dc < 6.25),
near AS (SELECT h.day, h."row", h.col, o.d2, n.v, row_number() OVER (PARTITION BY h.day, h."row", h.col ORDER BY o.d2, n."row", n.col) AS nth FROM cells h JOIN (SELECT day FROM cells GROUP BY day HAVING count(v) >= 3) e ON e.day = h.day CROSS JOIN off o JOIN cells n ON n.day = h.day AND n."row" = h."row" + o.dr AND n.col = h.col + o.dc WHERE h.v IS NULL AND n.v IS NOT NULL),
idw AS (SELECT day, "row", col, sum(v / d2) / sum(1 / d2) AS idw FROM near WHERE nth <= 8 GROUP BY 1, 2, 3 HAVING count(*) >= 3)"""


@query(f'WITH {RASTER}, {_IDW} SELECT day, "row", col, round(idw, 6) AS idw FROM idw')
def idw_fill(spark, d):
    return rounded(raster.idw_fill(a.raster(spark, d), 2.5))


def _filled(past: str) -> str:
    return f"""WITH {RASTER}, {_IDW}, {WEIGHTS}, ins AS (SELECT DISTINCT "row", col FROM weights WHERE w > 0),
s AS (SELECT c.day, c."row", c.col, c.v, i."row" IS NOT NULL AS inside, coalesce(c.v, CASE WHEN i."row" IS NOT NULL THEN idw.idw END) AS sp FROM cells c LEFT JOIN idw ON idw.day = c.day AND idw."row" = c."row" AND idw.col = c.col LEFT JOIN ins i ON i."row" = c."row" AND i.col = c.col),
p AS (SELECT *, {past} AS past FROM s WINDOW w AS (PARTITION BY "row", col ORDER BY day))"""


_BACK = "quantile_cont(sp, 0.5) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)"
_AROUND = "CASE WHEN lag(sp) OVER w IS NULL THEN lead(sp) OVER w WHEN lead(sp) OVER w IS NULL THEN lag(sp) OVER w ELSE (lag(sp) OVER w + lead(sp) OVER w) / 2 END"
_FLAG = "CAST(CASE WHEN NOT inside THEN 9 WHEN v IS NOT NULL THEN 0 WHEN sp IS NOT NULL THEN 1 WHEN past IS NOT NULL THEN 2 ELSE 3 END AS INT)"


@query(f"""{_filled(_BACK)} SELECT day, "row", col, round(CASE WHEN inside THEN coalesce(sp, past) ELSE v END, 6) AS v, {_FLAG} AS flag FROM p""")
def gap_fill_flags(spark, d):
    w = a.weights(spark).where("w > 0")
    return rounded(raster.gap_fill(a.raster(spark, d), w, 2.5))


@query(f"""{_filled(_AROUND)} SELECT day, "row", col, round(CASE WHEN inside THEN coalesce(sp, past) ELSE v END, 6) AS v, {_FLAG} AS flag FROM p""")
def temporal_median_fill(spark, d):
    w = a.weights(spark).where("w > 0")
    return rounded(raster.gap_fill(a.raster(spark, d), w, 2.5, mode="centered"))


@query(f"""{_filled(_BACK)}, f AS (SELECT day, "row", col, {_FLAG} AS flag FROM p), j AS (SELECT day, zone, w, flag FROM f JOIN weights USING ("row", col) WHERE w > 0)
SELECT day, zone, round(sum(CASE WHEN flag = 0 THEN w ELSE 0 END) / sum(w), 6) AS observed, round(sum(CASE WHEN flag = 1 THEN w ELSE 0 END) / sum(w), 6) AS idw, round(sum(CASE WHEN flag = 2 THEN w ELSE 0 END) / sum(w), 6) AS temporal FROM j GROUP BY 1, 2""")  # fmt: skip
def zonal_flag_fractions(spark, d):
    w = a.weights(spark)
    filled = raster.gap_fill(a.raster(spark, d), w.where("w > 0"), 2.5)
    return rounded(raster.flag_fractions(filled, w, {"observed": 0, "idw": 1, "temporal": 2}))


@query(f'WITH {RASTER} SELECT day, CAST(floor("row" / 2) AS INT) AS "row", CAST(floor(col / 2) AS INT) AS col, round(avg(v), 6) AS v FROM cells GROUP BY 1, 2, 3')
def block_mean(spark, d):
    return rounded(raster.block_mean(a.raster(spark, d), 2))


@query(f"""WITH {WEIGHTS} SELECT "row", col, CASE WHEN max(w) > 0.5 THEN arg_max(zone, w) ELSE 0 END AS zone FROM weights GROUP BY 1, 2""")
def majority_zone(spark, d):
    return raster.majority_zone(a.weights(spark))


@query(f"""WITH {RASTER}, pts(id, y, x) AS (VALUES (1, 0.25::DOUBLE, 0.75::DOUBLE), (2, 3.0, 4.5), (3, 6.0, 2.0), (4, 7.5, 1.0), (5, 2.5, 5.25)),
c AS (SELECT id, CAST(floor(y) AS INT) + CAST(k // 2 AS INT) AS "row", CAST(floor(x) AS INT) + CAST(k % 2 AS INT) AS col, (CASE WHEN k // 2 = 1 THEN y - floor(y) ELSE 1 - y + floor(y) END) * (CASE WHEN k % 2 = 1 THEN x - floor(x) ELSE 1 - x + floor(x) END) AS share FROM pts, range(4) r(k)),
n AS (SELECT id, count(*) AS need FROM c WHERE share > 0 GROUP BY 1), s AS (SELECT day, id, sum(share * v) AS value, count(v) AS have FROM c JOIN cells USING ("row", col) WHERE share > 0 GROUP BY 1, 2)
SELECT d.day, n.id, round(CASE WHEN have = need THEN value END, 6) AS value FROM (SELECT DISTINCT day FROM cells) d CROSS JOIN n LEFT JOIN s ON s.day = d.day AND s.id = n.id""")  # fmt: skip
def bilinear_sample(spark, d):
    pts = spark.createDataFrame([(1, 0.25, 0.75), (2, 3.0, 4.5), (3, 6.0, 2.0), (4, 7.5, 1.0), (5, 2.5, 5.25)], "id int, y double, x double")
    return rounded(raster.bilinear(a.raster(spark, d), pts))


# --- points and zones -------------------------------------------------------------------------------------------------

_INSIDE = "ins AS (SELECT id, zone_id FROM points, edges WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1)"


@query(f"WITH {POINTS}, {EDGES}, {_INSIDE} SELECT p.id, min(i.zone_id) AS zone_id FROM points p LEFT JOIN ins i ON i.id = p.id GROUP BY 1")
def point_in_zone(spark, d):
    return spatial.locate(a.points(spark, d), a.zones(spark)).select("id", "zone_id")


@query(f"""WITH {POINTS}, {EDGES}, {_INSIDE}, t AS (SELECT id, zone_id, x, y, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy, least(greatest(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2), 0), 1) AS t FROM points, edges),
dist AS (SELECT id, zone_id, min(sqrt((x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2)) AS dd FROM t GROUP BY 1, 2),
best AS (SELECT d.id, d.zone_id, i.zone_id IS NOT NULL AS inside, CASE WHEN i.zone_id IS NOT NULL THEN 0.0 ELSE d.dd END AS dd FROM dist d LEFT JOIN ins i ON i.id = d.id AND i.zone_id = d.zone_id),
pick AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY inside DESC, dd, zone_id) AS n FROM best WHERE inside OR dd <= 5)
SELECT p.id, k.zone_id, round(k.dd, 6) AS outside, NOT k.inside AS snapped FROM points p LEFT JOIN pick k ON k.id = p.id AND k.n = 1""")  # fmt: skip
def snap_nearest_zone(spark, d):
    return rounded(spatial.locate(a.points(spark, d), a.zones(spark), most=5.0).select("id", "zone_id", "outside", "snapped"))


@query(f"""WITH {EDGES}, s AS (SELECT zone_id, sum(x1 * y2 - x2 * y1) AS s, sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS cx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS cy, min(x1) AS x_min, max(x1) AS x_max FROM edges GROUP BY 1)
SELECT zone_id, round(abs(s) / 2, 6) AS area, round(cx / (3 * s), 6) AS cx, round(cy / (3 * s), 6) AS cy, x_min, x_max FROM s""")  # fmt: skip
def zone_geometry(spark, d):
    r = F.col("ring")
    cx, cy = spatial.centroid(r)
    b = spatial.bounds(r)
    return rounded(a.zones(spark).select("zone_id", spatial.area(r).alias("area"), cx.alias("cx"), cy.alias("cy"), b["x_min"].alias("x_min"), b["x_max"].alias("x_max")))


@query(f"""WITH {EDGES}, c AS (SELECT CAST(r AS INT) AS "row", CAST(k AS INT) AS col FROM range(100) a(r), range(100) b(k)),
i AS (SELECT "row", col, zone_id FROM c, edges WHERE (y1 > "row" + 0.5) <> (y2 > "row" + 0.5) AND col + 0.5 < (x2 - x1) * ("row" + 0.5 - y1) / (y2 - y1) + x1 GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)
SELECT "row", col, min(zone_id) AS zone_id FROM i GROUP BY 1, 2""")  # fmt: skip
def rasterised_zones(spark, d):
    return spatial.rasterise(100, 100, a.zones(spark))


# --- scalar expressions and filters -----------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_orderkey & 7) = 1 AND ((l_orderkey >> 3) & 3) = 0")
def qa_bit_filter(spark, d):
    return a.table(spark, d, "lineitem").where(scalar.bits_match(F.col("l_orderkey"), [(0, 3, 1), (3, 2, 0)])).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity BETWEEN 10 AND 30 THEN l_quantity END AS in_range, CASE WHEN l_discount <= 0.05 THEN l_extendedprice END AS clear,
CASE WHEN l_linenumber IN (4, 5, 6, 7) THEN l_quantity END AS kept, round((l_extendedprice - l_quantity) / nullif(l_extendedprice + l_quantity, 0), 6) AS nd FROM lineitem""")
def valid_range_mask(spark, d):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return rounded(
        a.table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalar.within(q, 10, 30).alias("in_range"), scalar.masked(p, F.col("l_discount"), 0.05).alias("clear"),
            scalar.keep_classes(q, F.col("l_linenumber"), [4, 5, 6, 7]).alias("kept"), scalar.normalised_difference(p, q).alias("nd"),
        )
    )


@query("""WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) SELECT date, round(sin(2 * pi() * dayofyear(date) / 365.25), 6) AS doy_sin, round(cos(2 * pi() * dayofyear(date) / 365.25), 6) AS doy_cos,
round(sin(2 * pi() * (isodow(date) - 1) / 7), 6) AS dow_sin, round(cos(2 * pi() * (isodow(date) - 1) / 7), 6) AS dow_cos, CAST(isodow(date) = 7 AS INT) AS is_sunday,
CAST(date_trunc('month', date) - INTERVAL 1 MONTH AS DATE) AS previous_month, CAST(date - last_day(CAST(date_trunc('month', date) - INTERVAL 1 MONTH AS DATE)) AS INT) AS age FROM o""")  # fmt: skip
def calendar_cyclical(spark, d):
    o = a.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    before = scalar.previous_month(F.col("date"))
    return rounded(o.withColumns(scalar.cyclical(F.col("date"))).withColumns({"previous_month": before, "age": scalar.days_since_month_end(F.col("date"), before)}))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(greatest(100 * exp(17.625 * (l_quantity - 10) / (243.04 + l_quantity - 10)) / exp(17.625 * l_quantity / (243.04 + l_quantity)), 0), 100), 6) AS rh,
round(exp(17.625 * 0 / 243.04) * 0 + least(greatest(100 * exp(17.625 * (l_quantity * 2 - 30) / (243.04 + l_quantity * 2 - 30)) / exp(17.625 * l_quantity / (243.04 + l_quantity)), 0), 100), 6) AS rh_wide FROM lineitem""")  # fmt: skip
def magnus_humidity(spark, d):
    t = F.col("l_quantity")
    return rounded(a.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalar.relative_humidity(t, t - 10).alias("rh"), scalar.relative_humidity(t, t * 2 - 30).alias("rh_wide")))


@query("""WITH c AS (SELECT l_returnflag, l_linenumber, -l_quantity * sin(radians(l_partkey % 360)) AS u, -l_quantity * cos(radians(l_partkey % 360)) AS v, l_quantity AS s FROM lineitem),
m AS (SELECT l_returnflag, l_linenumber, avg(u) AS u, avg(v) AS v, avg(s) AS s FROM c GROUP BY 1, 2), p AS (SELECT *, sqrt(u * u + v * v) AS speed FROM m)
SELECT l_returnflag, l_linenumber, round(speed, 6) AS speed, round(CASE WHEN speed > 1e-6 THEN -u / speed END, 6) AS from_sin, round(CASE WHEN speed > 1e-6 THEN -v / speed END, 6) AS from_cos, round(speed / s, 6) AS steadiness FROM p""")  # fmt: skip
def wind_components(spark, d):
    u, v = scalar.wind(F.col("l_quantity"), F.col("l_partkey") % 360)
    m = a.table(spark, d, "lineitem").groupBy("l_returnflag", "l_linenumber").agg(F.avg(u).alias("u"), F.avg(v).alias("v"), F.avg("l_quantity").alias("s"))
    return rounded(m.select("l_returnflag", "l_linenumber", *(c.alias(k) for k, c in scalar.wind_from(F.col("u"), F.col("v"), F.col("s")).items())))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, coalesce(CAST(json_extract_string(props, '$.missing') AS INT), -1) AS missing FROM events")
def json_navigate(spark, d):
    e = a.events(spark, d).withColumn("j", F.from_json("props", "k int, missing int"))
    return e.select("event_id", F.col("j.k").alias("k"), F.coalesce("j.missing", F.lit(-1)).alias("missing"))


@query("""SELECT c_custkey, trim(c_name) AS name, split_part(c_name, '#', 1) AS kind, lower(c_mktsegment) AS segment, starts_with(c_name, 'Cust') AS is_customer, contains(lower(c_mktsegment), 'build') AS builds, replace(c_name, 'Customer#', '') AS number FROM customer""")
def text_functions(spark, d):
    n, s = F.col("c_name"), F.lower("c_mktsegment")
    return a.table(spark, d, "customer").select(
        "c_custkey", F.trim(n).alias("name"), F.split(n, "#")[0].alias("kind"), s.alias("segment"), F.startswith(n, F.lit("Cust")).alias("is_customer"), F.contains(s, F.lit("build")).alias("builds"), F.replace(n, F.lit("Customer#"), F.lit("")).alias("number")
    )


@query("SELECT o_orderkey, o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 14 DAYS AS provisional FROM orders")
def provisional_rows(spark, d):
    """The newest rows by a parameter, here the last day of the table."""
    o = a.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    as_of = o.agg(F.max("o_orderdate")).first()[0]
    return o.select("o_orderkey", (F.col("o_orderdate") >= F.lit(as_of) - F.expr("INTERVAL 14 DAYS")).alias("provisional"))


@query("""WITH d AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders), w AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 30 DAYS)) AS DATE) AS window_start, b FROM d)
SELECT window_start, least(CAST(window_start + 29 AS DATE), b) AS window_end FROM w""")  # fmt: skip
def request_windows(spark, d):
    """The table's span of days tiled by windows of 30 days."""
    o = a.table(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    w = o.select(F.explode(F.sequence("a", "b", F.expr("interval 30 days"))).alias("window_start"), "b")
    return w.select("window_start", F.least(F.date_add("window_start", 29), "b").alias("window_end"))


# --- evaluation -------------------------------------------------------------------------------------------------------

_FOLDS = """per AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1), cum AS (SELECT date, sum(n) OVER (ORDER BY date) AS c, sum(n) OVER () AS total FROM per),
folds AS (SELECT date, CAST(c >= total * 0.2::DOUBLE AS INT) + CAST(c >= total * 0.4::DOUBLE AS INT) + CAST(c >= total * 0.6::DOUBLE AS INT) + CAST(c >= total * 0.8::DOUBLE AS INT) AS fold FROM cum)"""


def _orders(spark, d):
    return a.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.substring("o_orderpriority", 1, 1).alias("zone"))


@query(f"WITH {_FOLDS} SELECT date, fold FROM folds")
def fold_assignment(spark, d):
    return evaluate.folds(_orders(spark, d), "date")


@query(f"""WITH {_FOLDS} SELECT fold, count(*) AS "rows", min(date) AS "first", max(date) AS "last", count(DISTINCT date) AS days, string_agg(DISTINCT substr(o_orderpriority, 1, 1), ',' ORDER BY substr(o_orderpriority, 1, 1)) AS zones
FROM orders JOIN folds ON date = CAST(o_orderdate AS DATE) GROUP BY 1""")  # fmt: skip
def fold_summary(spark, d):
    o = _orders(spark, d)
    return evaluate.fold_summary(o.join(evaluate.folds(o, "date"), "date"), "date", "zone")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) <= floor((SELECT count(*) FROM orders) * 0.85) AS train FROM orders")
def inner_split(spark, d):
    return evaluate.inner_split(_orders(spark, d), ["date", "o_orderkey"]).select("o_orderkey", "train")


_LONG = f"""{FORECASTS}, long AS (SELECT horizon, truth, 'persistence' AS model, persistence AS pred FROM forecasts UNION ALL SELECT horizon, truth, 'roll3', roll3 FROM forecasts UNION ALL SELECT horizon, truth, 'roll7', roll7 FROM forecasts),
there AS (SELECT *, {_index('greatest(truth, 0)', PM25, 1)} AS it, {_index('greatest(pred, 0)', PM25, 1)} AS ip FROM long WHERE pred IS NOT NULL),
metrics AS (SELECT horizon, model, count(*) AS n, sqrt(avg((truth - pred) ** 2)) AS rmse, avg(abs(truth - pred)) AS mae, 1 - sum((truth - pred) ** 2) / (var_pop(truth) * count(*)) AS r2, avg(abs(it - ip)) AS aqi_mae,
  avg(CAST({_band('it')} = {_band('ip')} AS INT)) AS category_accuracy FROM there GROUP BY GROUPING SETS ((horizon, model), (model)))"""
_MODELS = ["persistence", "roll3", "roll7"]


@query(f"WITH {_LONG} SELECT horizon, model, n, {_r('rmse', 'mae', 'r2', 'aqi_mae', 'category_accuracy')} FROM metrics")
def metrics_grouping_sets(spark, d):
    return rounded(evaluate.metrics(a.forecasts(spark, d), _MODELS))


@query(f"""WITH {_LONG}, c AS (SELECT model, {_band('it')} AS t, {_band('ip')} AS p FROM there), l(label) AS (VALUES {', '.join(f"('{n}')" for _, n in aqi.BANDS)}),
f AS (SELECT m.model, l.label, (SELECT count(*) FROM c WHERE c.model = m.model AND t = label AND p = label) AS tp, (SELECT count(*) FROM c WHERE c.model = m.model AND (t = label OR p = label)) AS o FROM (SELECT DISTINCT model FROM c) m CROSS JOIN l)
SELECT model, round(sum(CASE WHEN tp + o > 0 THEN 2.0 * tp / (tp + o) ELSE 0 END) / 6, 6) AS macro_f1 FROM f GROUP BY 1""")  # fmt: skip
def macro_f1(spark, d):
    long = evaluate.long_predictions(a.forecasts(spark, d), _MODELS, ["truth"])
    long = long.select("model", aqi.category(aqi.to_aqi(F.col("truth"))).alias("t"), aqi.category(aqi.to_aqi(F.col("pred"))).alias("p"))
    return rounded(evaluate.macro_f1(long, "t", "p", ["model"]))


_BEST = "best AS (SELECT horizon, arg_min(model, rmse) AS best FROM metrics WHERE horizon IS NOT NULL AND model <> 'persistence' GROUP BY 1)"


@query(f"WITH {_LONG}, {_BEST} SELECT f.date, f.zone_id, f.horizon, best, round(CASE best WHEN 'roll3' THEN roll3 WHEN 'roll7' THEN roll7 END, 6) AS pred_final FROM forecasts f LEFT JOIN best b ON b.horizon = f.horizon")
def best_model_per_horizon(spark, d):
    f = a.forecasts(spark, d)
    best = evaluate.best_models(evaluate.metrics(f, _MODELS), {"roll3": 0, "roll7": 1})
    return rounded(evaluate.chosen(f, best, ["roll3", "roll7"]).select("date", "zone_id", "horizon", "best", "pred_final"))


@query(f"""WITH {_LONG} SELECT 'beats the baseline: ' || m.model || coalesce(' T+' || m.horizon, ' overall') AS "check", CASE WHEN m.rmse < b.rmse AND m.mae < b.mae THEN 'PASS' WHEN m.horizon IS NULL THEN 'FAIL' ELSE 'WARN' END AS status
FROM metrics m JOIN metrics b ON b.model = 'persistence' AND b.horizon IS NOT DISTINCT FROM m.horizon WHERE m.model <> 'persistence'""")  # fmt: skip
def model_gate(spark, d):
    return evaluate.gate(evaluate.metrics(a.forecasts(spark, d), _MODELS), ["roll3", "roll7"], "persistence").drop("detail")


@query("""WITH g AS (SELECT p_brand AS feature, p_type AS model, sum(p_retailprice) AS gain FROM part GROUP BY 1, 2), s AS (SELECT feature, gain / sum(gain) OVER (PARTITION BY model) AS share FROM g)
SELECT feature, round(sum(share) / (SELECT count(DISTINCT model) FROM g), 6) AS importance FROM s GROUP BY 1 ORDER BY sum(share) DESC, feature LIMIT 15""")  # fmt: skip
def topk_importance(spark, d):
    g = a.table(spark, d, "part").groupBy(F.col("p_brand").alias("feature"), F.col("p_type").alias("model")).agg(F.sum("p_retailprice").alias("gain"))
    return rounded(evaluate.importance(g, 15))


# --- summaries --------------------------------------------------------------------------------------------------------


@query(f"WITH {PRIO} SELECT CAST(month(date) AS INT) AS month, round(avg(valid), 6) AS observed, round(100 * avg(CAST(value IS NULL AS INT)), 6) AS pct_missing FROM prio GROUP BY 1")
def coverage_by_month(spark, d):
    return rounded(summaries.coverage_by_month(a.prio_day(spark, d), "value", "valid"))


@query("SELECT o_orderpriority AS priority, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS F, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS O, CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS P FROM orders GROUP BY 1")
def crosstab_counts(spark, d):
    o = a.table(spark, d, "orders").withColumnRenamed("o_orderpriority", "priority")
    return summaries.crosstab(o, "priority", "o_orderstatus", ["F", "O", "P"])


@query("""SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 4) AS F, round(avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 4) AS O, round(avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 4) AS P FROM orders GROUP BY 1""")
def pivot_mean(spark, d):
    return rounded(summaries.pivot_mean(a.table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], "o_totalprice"), 4)


@query("SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS \"values\" FROM customer GROUP BY 1")
def distinct_concat(spark, d):
    return summaries.distinct_text(a.table(spark, d, "customer"), "c_nationkey", "c_mktsegment")


@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr, round(avg(abs(l_quantity - l_extendedprice)), 4) AS mad, round(max(abs(l_quantity - l_extendedprice)), 4) AS max_diff, count(*) AS n FROM lineitem")
def correlation_check(spark, d):
    out = summaries.agreement(a.table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")
    return out.select(F.round("corr", 6).alias("corr"), F.round("mad", 4).alias("mad"), F.round("max_diff", 4).alias("max_diff"), "n")


@query(f"WITH {GAPPY} SELECT 'value' AS \"column\", round(avg(CAST(value IS NULL AS INT)), 6) AS null_share FROM gappy UNION ALL SELECT 'zone_id', 0.0::DOUBLE")
def null_share(spark, d):
    return rounded(summaries.null_shares(a.gappy(spark, d), ["value", "zone_id"]))


@query("""SELECT 'l_quantity' AS "column", min(l_quantity) AS min, round(avg(l_quantity), 6) AS mean, max(l_quantity) AS max, round(stddev_samp(l_quantity), 6) AS std, count(l_quantity) AS n FROM lineitem
UNION ALL SELECT 'l_discount', min(l_discount), round(avg(l_discount), 6), max(l_discount), round(stddev_samp(l_discount), 6), count(l_discount) FROM lineitem""")
def describe_columns(spark, d):
    return rounded(summaries.describe(a.table(spark, d, "lineitem"), ["l_quantity", "l_discount"]))


@query("SELECT round(quantile_cont(value, 0.02), 6) AS p02, round(quantile_cont(value, 0.98), 6) AS p98 FROM events")
def percentile_range(spark, d):
    return rounded(summaries.quantiles(a.events(spark, d), "value", [0.02, 0.98]))


@query(f"""WITH x AS (SELECT event_type, {_band(_index('value', PM25, 1))} AS c, event_id FROM events), s AS (SELECT event_type, c, count(*) AS n, min(event_id) AS f FROM x GROUP BY 1, 2)
SELECT event_type, c AS mode FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, f) AS k FROM s) WHERE k = 1""")  # fmt: skip
def city_mode(spark, d):
    e = a.events(spark, d).select("event_type", "event_id", aqi.category(aqi.sub_index("pm25", F.col("value"))).alias("c"))
    return summaries.mode_first(e, "c", "event_id", ["event_type"])


@query(f"""WITH {PANEL}, z AS (SELECT zone_id, avg(value) AS value FROM panel GROUP BY 1) SELECT zone_id, round(value, 6) AS value, CAST(row_number() OVER (ORDER BY value DESC, zone_id) AS INT) AS "rank",
round(least(100, value / greatest(max(value) OVER (), 100) * 100), 6) AS width, CAST(floor(value + 0.5) AS BIGINT) AS whole FROM z""")  # fmt: skip
def city_rank(spark, d):
    z = a.panel(spark, d).groupBy("zone_id").agg(F.avg("value").alias("value"))
    return rounded(summaries.ranked(z, "value", "zone_id").withColumn("whole", summaries.js_round(F.col("value"))))


@query(f"""WITH {PANEL}, l AS (SELECT zone_id, date, {_index('value', PM25, 1)} AS aqi FROM panel WHERE date >= (SELECT max(date) FROM panel) - 1)
SELECT zone_id, '[' || string_agg('{{"date":"' || date || '","aqi":' || CAST(aqi AS VARCHAR) || '}}', ',' ORDER BY date) || ']' AS "rows" FROM l GROUP BY 1""")  # fmt: skip
def forecast_payload(spark, d):
    p = a.panel(spark, d)
    last = p.agg(F.max("date")).first()[0]
    p = p.where(F.col("date") >= F.date_sub(F.lit(last), 1)).withColumn("aqi", aqi.sub_index("pm25", F.col("value")))
    return summaries.payload(p, "zone_id", "date", ["aqi"])


# --- checks, features -------------------------------------------------------------------------------------------------


@query(f"""WITH {GAPPY}, f AS (SELECT *, CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END AS valid FROM gappy), c AS (SELECT count(DISTINCT (date, zone_id)) = count(*) AS k, count(DISTINCT date) = max(date) - min(date) + 1 AS cal, bool_and((value IS NULL) = (valid = 0)) AS m,
coalesce(bool_and(value BETWEEN 0 AND 500), true) AS v, bool_and(valid BETWEEN 0 AND 1) AS s, bool_and(value BETWEEN 0 AND 50) AS t FROM f)
SELECT 'keys are unique' AS "check", CASE WHEN k THEN 'PASS' ELSE 'FAIL' END AS status FROM c UNION ALL SELECT 'calendar is complete', CASE WHEN cal THEN 'PASS' ELSE 'FAIL' END FROM c
UNION ALL SELECT 'mean is missing exactly where nothing is valid', CASE WHEN m THEN 'PASS' ELSE 'FAIL' END FROM c UNION ALL SELECT 'value in [0, 500]', CASE WHEN v THEN 'PASS' ELSE 'FAIL' END FROM c UNION ALL SELECT 'valid in [0, 1]', CASE WHEN s THEN 'PASS' ELSE 'FAIL' END FROM c""")  # fmt: skip
def table_contract(spark, d):
    f = a.gappy(spark, d).withColumn("valid", F.when(F.col("value").isNull(), 0.0).otherwise(1.0))
    return checks.table_contract(f, ["date", "zone_id"], {"value": (0, 500), "valid": (0, 1)}, "value", "valid")


@query(f"WITH {PANEL} SELECT date, zone_id FROM panel WHERE false")
def causality_violations(spark, d):
    """Rows of the lag and trailing features that change when the future does: none."""
    p = a.panel(spark, d)
    return checks.changed_before(p, lambda x: causal.trailing(causal.lags(x, "value", (1, 2)), "value", (3, 7)), ["value"], "2024-01-16")


_FEATURES = f"""{RUNS}, {_GAPPY}, hist AS (SELECT date, zone_id, value, lag(value, 1) OVER w AS sat_lag1, lag(value, 3) OVER w AS sat_lag3, {_roll(3, 3)} AS sat_roll3_mean, {_roll(3, 3, _STD)} AS sat_roll3_std, {_roll(7, 7)} AS sat_roll7_mean FROM gappy {_W})"""


@query(f"WITH {_FEATURES} " + " UNION ALL ".join(
    f"""SELECT u.date AS issue_date, u.zone_id, u.horizon, CAST(u.date + {h} AS DATE) AS target_date, round(h.sat_lag1, 6) AS sat_lag1, round(h.sat_lag3, 6) AS sat_lag3, h.sat_roll3_mean, h.sat_roll3_std, h.sat_roll7_mean, round(m.value, 6) AS met_target, u.v AS run_v, u.run_age,
round(m.value, 6) AS truth FROM ({_usable(h)}) u JOIN hist h ON h.date = u.date AND h.zone_id = u.zone_id JOIN panel m ON m.date = CAST(u.date + {h} AS DATE) AND m.zone_id = u.zone_id""" for h in (0, 1, 2)))  # fmt: skip
def feature_table(spark, d):
    p = a.panel(spark, d)
    f = features.with_targets(features.build(a.gappy(spark, d), p, a.runs(spark, d)), p)
    f = f.select("issue_date", "zone_id", "horizon", "target_date", "sat_lag1", "sat_lag3", "sat_roll3_mean", "sat_roll3_std", "sat_roll7_mean", "met_target", "run_v", "run_age", "truth")
    return rounded(f)


@query("SELECT c_custkey, " + ", ".join(f"CAST(c_mktsegment = '{s}' AS DOUBLE) AS c_mktsegment_{s}" for s in ("BUILDING", "MACHINERY", "NOWHERE")) + " FROM customer")
def one_hot_fixed(spark, d):
    return features.one_hot(a.table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", ["BUILDING", "MACHINERY", "NOWHERE"]).drop("c_mktsegment")


@query()
def gbt_out_of_fold(spark, d):
    """Out-of-fold predictions of boosted trees on the feature table, with weights and early stopping (no SQL form)."""
    from ..operators.models import out_of_fold

    p = a.panel(spark, d)
    f = features.with_targets(features.build(p, p, a.runs(spark, d), (0, 1)), p)
    f = f.join(evaluate.folds(p, "date", 3).withColumnRenamed("date", "issue_date"), "issue_date").withColumn("weight", 1.0 + F.col("zone_id") % 2)
    columns = ["sat_lag1", "sat_roll3_mean", "sat_roll7_mean", "run_v", "dow_sin", "dow_cos"]
    out = out_of_fold(f, columns, "truth", weight="weight", rounds=5, order=["issue_date", "zone_id"])
    return out.select("issue_date", "zone_id", "horizon", "truth", "pred_gbt")


from . import catalogue_more  # noqa: E402, F401  (registers its queries)

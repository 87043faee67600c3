import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from causeway.sources import files, rest
from causeway.streaming import twins


def served(start, end, page, limit):
    """A service with 7 readings in every window."""
    rows = [json.dumps({"period": {"datetimeFrom": {"utc": f"{start}Z"}}, "value": float(i), "coverage": {"observedCount": 1}}) for i in range(7)]
    return rows[(page - 1) * limit : page * limit]


def test_paged_source(spark):
    spark.dataSource.register(rest.PagedSource)
    reader = spark.read.format("paged").options(fetch="tests.test_io:served", start="2024-01-01", end="2024-03-05", days="30", limit="3")
    df = reader.load()
    assert df.count() == 21 and df.select("window_start").distinct().count() == 3
    hours = rest.hours(df)
    assert hours.where("value is not null and expected_count is null and not has_flags").count() == 21
    assert hours.agg(F.min("hour_utc")).first()[0] == dt.datetime(2024, 1, 1)


def test_windows_and_years():
    assert rest.windows("2024-01-01", "2024-01-31", 30) == [("2024-01-01T00:00:00", "2024-01-31T00:00:00")]
    assert rest.annual(dt.date(2022, 3, 15), dt.date(2023, 6, 30)) == [(dt.date(2022, 3, 15), dt.date(2022, 12, 31)), (dt.date(2023, 1, 1), dt.date(2023, 6, 30))]


def test_attempts_are_bounded():
    calls = []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return "ok"

    assert rest.attempt(call, sleep=lambda s: None) == "ok"
    with pytest.raises(OSError):
        rest.attempt(lambda: (_ for _ in ()).throw(ConnectionError()), tries=2, sleep=lambda s: None)
    with pytest.raises(ValueError):
        rest.attempt(lambda: int("x"), sleep=lambda s: None)


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,v\n2024-01-01,1.25\n2024-01-02,-9999\n")
    df = files.read_csv(spark, f"{tmp_path}/a.csv", "date date, v double", -9999.0)
    assert [tuple(r) for r in df.orderBy("date").collect()] == [(dt.date(2024, 1, 1), 1.25), (dt.date(2024, 1, 2), None)]
    (tmp_path / "b.csv").write_text("date,v\n2024-01-01,x\n2024-01-02,2\n")
    good, bad = files.read_csv_or_reject(spark, f"{tmp_path}/b.csv", "date date, v double")
    assert good.collect()[0].v == 2 and "x" in bad.collect()[0]._corrupt_record
    files.write_csv(spark.createDataFrame([(1.23456789,)], "v double"), f"{tmp_path}/c", 3)
    assert spark.read.csv(f"{tmp_path}/c", header=True).first().v == "1.23"


def test_partitions_are_replaced_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "month string, v int")
    files.write_partitions(df, path, "month")
    files.write_partitions(df.where("v = 2").withColumn("v", F.lit(3)), path, "month")
    assert {tuple(r) for r in spark.read.parquet(path).select(F.col("month").cast("string"), "v").collect()} == {("2024-01", 1), ("2024-02", 3)}


def test_keyed_files_and_polygons(spark, tmp_path):
    for k in (3, 14):
        spark.range(k).coalesce(1).toPandas().to_parquet(tmp_path / f"sensor_{k}.parquet")
    df = files.read_keyed_files(spark, f"{tmp_path}/sensor_*.parquet", "sensor", r"sensor_(\d+)")
    assert {(r.sensor, r["count"]) for r in df.groupBy("sensor").count().collect()} == {("3", 3), ("14", 14)}
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    features = [{"properties": {"id": "a"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"properties": {"id": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]
    (tmp_path / "z.json").write_text(json.dumps({"features": features}))
    zones = files.read_polygons(spark, f"{tmp_path}/z.json", "id").collect()
    assert [z.zone_id for z in zones] == ["a", "b", "b"] and len(zones[0].ring) == 3


def test_incomplete_partitions_are_not_used(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "m string, date int")
    wanted = spark.createDataFrame([(m, d) for m in "ab" for d in (1, 2)], "m string, date int")
    assert {r.m for r in files.complete_partitions(df, wanted, "m").collect()} == {"a"}


def run_stream(spark, query, name):
    q = query.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streams_equal_the_batch(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{tmp_path}/in")
    batch = spark.read.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in")
    out = run_stream(spark, twins.local_days(stream, 3), "days")
    closed = batch.agg(F.max("ts") - F.expr("interval 48 hours")).first()[0]
    want = batch.groupBy(F.to_date(F.col("ts") + F.expr("interval 5 hours")).alias("date"), "event_type").agg(F.avg("value").alias("value"), F.count("value").alias("n")).where("n >= 3")
    want = want.where(F.col("date").cast("timestamp") + F.expr("interval 19 hours") <= F.lit(closed))
    key = lambda df: {(r.date, r.event_type, round(r.value, 6), r.n) for r in df.collect()}
    assert key(out) == key(want) and out.count() > 0
    assert run_stream(spark, twins.hourly(stream), "hours").count() > 0


def test_upserts_are_repeatable_and_touch_their_days_only(spark, tmp_path):
    schema = "k int, date string, ts int, v string"
    write = twins.upsert_sink(f"{tmp_path}/t", ["k", "date"], "ts")
    assert twins.current(spark, f"{tmp_path}/t") is None
    first = spark.createDataFrame([(1, "d1", 1, "a"), (1, "d1", 2, "b"), (2, "d1", 1, "c"), (1, "d2", 7, "x")], schema)
    second = spark.createDataFrame([(2, "d1", 5, "d"), (1, "d1", 1, "late"), (3, "d3", 1, "e")], schema)
    write(first, 0)
    before = {p.name for p in (tmp_path / "t" / "date=d2").iterdir()}
    for _ in range(2):
        write(second, 1)
    rows = {tuple(r) for r in twins.current(spark, f"{tmp_path}/t").select("k", F.col("date").cast("string"), "ts", "v").collect()}
    assert rows == {(1, "d1", 2, "b"), (2, "d1", 5, "d"), (1, "d2", 7, "x"), (3, "d3", 1, "e")}
    assert {p.name for p in (tmp_path / "t" / "date=d2").iterdir()} == before


def test_a_daily_issue_runs_once(spark, tmp_path):
    spark.createDataFrame([(1, "d1", 1, "a")], "k int, date string, ts int, v string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k int, date string, ts int, v string").parquet(f"{tmp_path}/in")
    for _ in range(2):
        twins.daily_issue(stream, lambda s: s, twins.upsert_sink(f"{tmp_path}/t", ["k", "date"], "ts"), f"{tmp_path}/c").awaitTermination(120)
    assert twins.current(spark, f"{tmp_path}/t").count() == 1


def test_answers_of_a_service_are_judged():
    rest.judged(200, {})
    with pytest.raises(rest.Busy) as e:
        rest.judged(429, {"X-RateLimit-Reset": "7"})
    assert e.value.after == 9
    for status in (408, 500, 503):
        with pytest.raises(rest.Busy):
            rest.judged(status, {})
    with pytest.raises(rest.Refused):
        rest.judged(404, {}, "no such sensor")
    waits, answers = [], [429, 503, 200]
    assert rest.attempt(lambda: rest.judged(answers.pop(0), {"x-ratelimit-reset": "3"}) or "ok", pause=5, sleep=waits.append) == "ok"
    assert waits == [5.0, 10]


def test_calls_are_spaced():
    now, slept = [0.0], []
    spaced = rest.Spaced(1.1, clock=lambda: now[0], sleep=lambda s: (slept.append(round(s, 3)), now.__setitem__(0, now[0] + s)))
    for step in (0.3, 2.0, 0.0):
        spaced(lambda: None)
        now[0] += step
    assert slept == [0.8]


def test_pages_end_where_all_were_found():
    asked = []

    def fetch(start, end, page, limit):
        asked.append(page)
        return ["x"] * limit, 4

    assert len(list(rest.pages(fetch, "a", "b", 2))) == 4 and asked == [1, 2]
    with pytest.raises(rest.Refused):
        list(rest.pages(lambda *_: ["x", "y"], "a", "b", 2, whole=True))
    assert list(rest.pages(lambda *_: ["x"], "a", "b", 2, whole=True)) == ["x"]


def test_answers_for_many_locations(spark):
    one = {"latitude": 1.0, "longitude": 2.0, "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "t": [1.5, None]}}
    bodies = spark.createDataFrame([("a", json.dumps([one, {**one, "latitude": 3.0}]))], "request string, body string")
    rows = rest.locations(bodies, ["t"], 2).orderBy("latitude", "time").collect()
    assert [(r.latitude, r.time.hour, r.t) for r in rows] == [(1.0, 0, 1.5), (1.0, 1, None), (3.0, 0, 1.5), (3.0, 1, None)]
    single = spark.createDataFrame([("a", json.dumps(one))], "request string, body string")
    assert rest.locations(single, ["t"], 1).count() == 2
    with pytest.raises(Exception, match="locations: 2 of 3"):
        rest.locations(bodies, ["t"], 3).collect()


def test_days_are_merged_into_their_partitions(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "month string, date int, v int"
    files.merge_partitions(spark, spark.createDataFrame([("m1", 1, 10), ("m1", 2, 20), ("m2", 1, 5)], schema), path, "month")
    files.merge_partitions(spark, spark.createDataFrame([("m1", 2, 21), ("m1", 3, 30)], schema), path, "month")
    rows = spark.read.parquet(path).select(F.col("month").cast("string"), "date", "v").collect()
    assert {tuple(r) for r in rows} == {("m1", 1, 10), ("m1", 2, 21), ("m1", 3, 30), ("m2", 1, 5)} and len(rows) == 4


def test_own_output_may_be_missing_or_broken(spark, tmp_path):
    assert files.read_own(spark, f"{tmp_path}/none", "v int").count() == 0
    spark.createDataFrame([(1,)], "v int").coalesce(1).write.parquet(f"{tmp_path}/t")
    (tmp_path / "t" / "part-bad.parquet").write_bytes(b"PAR1 no parquet at all")
    assert [r.v for r in files.read_own(spark, f"{tmp_path}/t", "v int").collect()] == [1]


def test_a_cache_is_valid_or_null(spark):
    cache = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", 2), ("b", 1), ("b", 1), ("c", 1), ("c", 1), ("c", 2), ("c", 2), ("c", 9)], "m string, date int")
    wanted = spark.createDataFrame([(m, d) for m in "abc" for d in (1, 2)], "m string, date int")
    assert {(r.m, r.valid) for r in files.cached_or_null(cache, wanted, "m", 2).collect()} == {("a", True), ("b", False), ("c", False)}
    years = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),)], "date date")
    assert files.closed_years(years, "2024-06-01").count() == 1


def test_leftovers_and_the_lock(spark, tmp_path):
    folder = tmp_path / "t"
    (folder / "_temporary").mkdir(parents=True)
    (folder / "_temporary" / "x").write_text("half")
    (folder / "empty.csv").write_text("")
    (folder / "good.csv").write_text("1")
    found = {r.path.rsplit("/", 1)[1]: r.kind for r in files.leftovers(spark, str(folder)).collect()}
    assert found == {"empty.csv": "empty", "x": "temporary"}
    with files.SingleWriter(spark, str(folder)) as own:
        with own:
            with pytest.raises(RuntimeError):
                files.SingleWriter(spark, str(folder)).__enter__()
    with files.SingleWriter(spark, str(folder)):
        pass
    stuck = files.SingleWriter(spark, str(folder))
    stuck.__enter__()
    with files.SingleWriter(spark, str(folder), stale=-1):
        pass


def test_zones_are_written_and_read(spark, tmp_path):
    from causeway.plans import adapters

    files.write_geojson(adapters.zones(spark), f"{tmp_path}/z")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/z").collect()]
    (tmp_path / "all.json").write_text(json.dumps({"features": lines}))
    back = {r.zone_id: [tuple(p) for p in r.ring] for r in files.read_polygons(spark, f"{tmp_path}/all.json", "zone_id").collect()}
    assert back == {str(k): [(float(x), float(y)) for x, y in ring] for k, ring in adapters.ZONES.items()}

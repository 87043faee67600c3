"""Paged REST services as a Python data source: windows of time are partitions, pages are read until one is short.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged").options(fetch="package.module:function", start=..., end=..., days="30").load()

``fetch(window_start, window_end, page, limit)`` returns a list of JSON texts, or that and the number found in all. Reads are retried with
growing pauses, or as the service asks (``judged``), and spaced by the option ``gap`` seconds within a task; ``whole`` makes a full page an error.
"""

from __future__ import annotations

import datetime as dt
import importlib
import threading
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Window(InputPartition):
    def __init__(self, start: str, end: str):
        self.start, self.end = start, end


def windows(start: str, end: str, days: int) -> list[tuple[str, str]]:
    """[start, end) in windows of at most ``days``."""
    a, stop, out = dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end), []
    while a < stop:
        b = min(stop, a + dt.timedelta(days=days))
        out.append((a.isoformat(), b.isoformat()))
        a = b
    return out


def annual(start: dt.date, end: dt.date, years: int = 1) -> list[tuple[dt.date, dt.date]]:
    """[start, end] cut at the ends of calendar years."""
    out = []
    while start <= end:
        last = min(end, dt.date(start.year + years - 1, 12, 31))
        out.append((start, last))
        start = last + dt.timedelta(days=1)
    return out


class Refused(RuntimeError):
    """An answer that trying again does not change."""


class Busy(OSError):
    """An answer that another try may change; ``after``: seconds that the service asks to wait."""

    def __init__(self, message: str = "", after: float | None = None):
        super().__init__(message)
        self.after = after


def judged(status: int, headers: dict, body: str = "", reset: str = "x-ratelimit-reset") -> None:
    """Raises what an HTTP status calls for: over the limit, a passing trouble of the server, or a refusal."""
    if status == 429:
        names = {k.lower(): v for k, v in headers.items()}
        raise Busy("429", float(names.get(reset, 30)) + 2)
    if status == 408 or status >= 500:
        raise Busy(str(status))
    if status != 200:
        raise Refused(f"{status}: {body[:200]}")


class Spaced:
    """Calls of one client, at least ``gap`` seconds apart, one at a time."""

    def __init__(self, gap: float, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.clock, self.sleep, self.lock, self.last = gap, clock, sleep, threading.Lock(), None

    def __call__(self, call):
        with self.lock:
            if self.last is not None and (wait := self.gap - (self.clock() - self.last)) > 0:
                self.sleep(wait)
            self.last = self.clock()
            return call()


def attempt(call, tries: int = 8, pause: float = 1.0, most: float = 60.0, sleep=time.sleep):
    """The call's result; OSErrors (time-outs, lost connections, ``Busy`` answers) are tried again after 1, 2, 4, ... pauses of ``most``
    seconds each at most, or as long as the service asks."""
    for k in range(tries):
        try:
            return call()
        except OSError as e:
            if k + 1 == tries:
                raise
            asked = getattr(e, "after", None)
            sleep(min(most, pause * 2**k) if asked is None else asked)
    raise AssertionError


def pages(fetch, start: str, end: str, limit: int, whole: bool = False):
    """All rows of a window: pages until one is shorter than the limit, or until as many came as the service says it found.

    ``fetch`` returns rows, or (rows, found). ``whole``: the window must fit one page, and a full one is an error.
    """
    page = 1
    while True:
        answer = attempt(lambda p=page: fetch(start, end, p, limit))
        rows, found = answer if isinstance(answer, tuple) else (answer, None)
        if whole and len(rows) >= limit:
            raise Refused(f"the window {start} to {end} fills a page of {limit}: some rows may be missing")
        yield from rows
        if len(rows) < limit or found is not None and page * limit >= found:
            return
        page += 1


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        return [Window(a, b) for a, b in windows(self.options["start"], self.options["end"], int(self.options.get("days", "30")))]

    def read(self, partition):
        module, _, name = self.options["fetch"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        spaced = Spaced(float(self.options.get("gap", "0")))
        whole = self.options.get("whole", "false") == "true"
        for text in pages(lambda *a: spaced(lambda: fetch(*a)), partition.start, partition.end, int(self.options.get("limit", "1000")), whole):
            yield (partition.start, text)


class PagedSource(DataSource):
    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return "window_start string, body string"

    def reader(self, schema):
        return PagedReader(self.options)


def hours(bodies: DataFrame) -> DataFrame:
    """Hourly measurements out of nested answers; what an answer lacks is NULL."""
    schema = "period struct<datetimeFrom: struct<utc: string>>, value double, coverage struct<observedCount: int, expectedCount: int>, flagInfo struct<hasFlags: boolean>"
    j = bodies.select(F.from_json("body", schema).alias("j"))
    return j.select(
        F.to_timestamp_ntz(F.regexp_replace("j.period.datetimeFrom.utc", "Z$", "")).alias("hour_utc"), "j.value", F.col("j.coverage.observedCount").alias("observed_count"),
        F.col("j.coverage.expectedCount").alias("expected_count"), F.coalesce("j.flagInfo.hasFlags", F.lit(False)).alias("has_flags"),
    )


def locations(bodies: DataFrame, variables: list[str], expected: int) -> DataFrame:
    """Hourly rows (request, latitude, longitude, time, one column per variable) out of answers for many locations: each body is a JSON array
    with an object per location, or the one object. An answer of another number of locations than ``expected`` is an error."""
    hourly = ", ".join(["time: array<string>", *(f"{v}: array<double>" for v in variables)])
    one = f"struct<latitude: double, longitude: double, hourly: struct<{hourly}>>"
    text = F.trim("body")
    both = F.when(F.startswith(text, F.lit("[")), F.from_json(text, f"array<{one}>")).otherwise(F.array(F.from_json(text, one)))
    rows = bodies.withColumn("all", both)
    wrong = F.concat(F.lit("locations: "), F.coalesce(F.size("all"), F.lit(0)).cast("string"), F.lit(f" of {expected}"))
    rows = rows.withColumn("all", F.when(F.size("all") == expected, F.col("all")).otherwise(F.raise_error(wrong)))
    place = rows.select("request", F.explode("all").alias("p"))
    zipped = F.explode(F.arrays_zip("p.hourly.time", *(F.col(f"p.hourly.{v}") for v in variables))).alias("h")
    hours_ = place.select("request", "p.latitude", "p.longitude", zipped)
    return hours_.select("request", "latitude", "longitude", F.to_timestamp_ntz("h.time").alias("time"), *(F.col(f"h.{v}") for v in variables))

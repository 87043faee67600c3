"""Structured Streaming forms of the incremental batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly(stream: DataFrame, ts: str = "ts", late: str = "48 hours") -> DataFrame:
    """Tumbling hourly means; readings may come up to ``late`` after the newest."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, "1 hour").alias("w"), "event_type").agg(F.avg("value").alias("value"), F.count("value").alias("n")).select(F.col("w.start").alias("hour"), "event_type", "value", "n")


def local_days(stream: DataFrame, least: int, ts: str = "ts", late: str = "48 hours") -> DataFrame:
    """Means over local days (UTC+5: windows from 19:00 UTC) that have at least ``least`` readings; a day is emitted once closed."""
    days = stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day", startTime="19 hours").alias("w"), "event_type")
    days = days.agg(F.avg("value").alias("value"), F.count("value").alias("n")).where(F.col("n") >= least)
    return days.select(F.to_date(F.col("w.end")).alias("date"), "event_type", "value", "n")


def upsert_sink(path: str, key: list[str], order: str, by: str = "date"):
    """For ``foreachBatch``: each micro-batch's last row per key replaces the stored one, in a table partitioned by ``by``, a column of the key.

    Only the partitions that a batch touches are read and written again, so its work follows the batch, not the table. The merged
    partitions are written aside under the batch's number and then put in place; a batch that is repeated finds rows no newer than
    its own and gives the same table. A row that is older than the stored one (by ``order``) changes nothing.
    """
    if by not in key:
        raise ValueError(f"{by} must be a column of the key")

    def write(batch: DataFrame, epoch: int) -> None:
        from ..operators.upsert import keep_last
        from ..sources.files import exists, write_partitions

        spark = batch.sparkSession
        aside = f"{path.rstrip('/')}__batch/{epoch}"
        new = keep_last(batch, key, [F.col(order)])
        if exists(spark, path):
            touched = [r[0] for r in new.select(by).distinct().collect()]  # partitions of one micro-batch: days within the lateness, a handful
            old = spark.read.schema(batch.schema).parquet(path).where(F.col(by).isin(touched))
            new = keep_last(old.select(*batch.columns).unionByName(new), key, [F.col(order)])
        new.select(*batch.columns).write.mode("overwrite").parquet(aside)
        write_partitions(spark.read.schema(batch.schema).parquet(aside), path, by)
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(aside)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    return write


def current(spark, path: str) -> DataFrame | None:
    """The upserted table, None before the first batch."""
    from ..sources.files import exists

    return spark.read.parquet(path) if exists(spark, path) else None


def daily_issue(stream: DataFrame, build, sink, checkpoint: str):
    """One forecast per day: everything that came since the last issue is handled once and the query ends; run it once a day.
    ``build`` makes the rows of a batch, ``sink`` is a function for ``foreachBatch``. The checkpoint admits one writer at a time."""
    return build(stream).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

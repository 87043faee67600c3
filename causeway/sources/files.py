"""Readers and writers of the tables the operators work on."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import nan_to_null, significant


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """NaN becomes NULL where the data comes in."""
    return nan_to_null(spark.read.parquet(path))


def read_csv(spark: SparkSession, path: str, schema: str, sentinel: float | None = None) -> DataFrame:
    """By an explicit schema; lines that don't fit it fail the read."""
    return nan_to_null(spark.read.schema(schema).csv(path, header=True, mode="FAILFAST"), sentinel)


def read_csv_or_reject(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and those that don't, with their lines in ``_corrupt_record``."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    return nan_to_null(rows.where("_corrupt_record is null").drop("_corrupt_record")), rows.where("_corrupt_record is not null")


def read_keyed_files(spark: SparkSession, pattern: str, key: str, name: str) -> DataFrame:
    """Many Parquet files, one per key, in one scan; ``name`` is a regular expression whose group is the key in the file's name."""
    return nan_to_null(spark.read.parquet(pattern)).withColumn(key, F.regexp_extract(F.col("_metadata.file_name"), name, 1))


def read_polygons(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Outer rings of a GeoJSON file as zones (zone_id, ring); each part of a multipolygon is a row."""
    ring = "array<array<array<double>>>"
    schema = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    f = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    f = f.select(F.col("f.properties")[key].alias("zone_id"), F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("c"))
    one = F.when(F.col("type") == "Polygon", F.array(F.from_json("c", ring))).otherwise(F.from_json("c", f"array<{ring}>"))
    part = f.select("zone_id", F.explode(one).alias("part")).select("zone_id", F.col("part")[0].alias("closed"))
    points = F.slice("closed", 1, F.size("closed") - 1)
    return part.select("zone_id", F.transform(points, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("ring"))


def read_config(spark: SparkSession, path: str) -> dict:
    """A small JSON file, through Spark, so that it may lie in any store."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def complete_partitions(df: DataFrame, expected: DataFrame, by: str, date: str = "date") -> DataFrame:
    """Only the partitions (months, say) that hold every expected date; a cache that lacks one is read anew, not used."""
    lacking = expected.join(df.select(by, date).distinct(), [by, date], "left_anti").select(by).distinct()
    return df.join(lacking, by, "left_anti")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_own(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An earlier output that this run adds to: empty if there is none, and without the files that can't be read."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return nan_to_null(spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path))


def cached_or_null(df: DataFrame, expected: DataFrame, by: str, cells: int, date: str = "date") -> DataFrame:
    """The expected (``by``, ``date``) pairs with ``valid``: whether the cache holds that whole partition, ``cells`` rows for each of its dates
    and no other date; a partition that isn't valid is read anew."""
    have = df.groupBy(by, date).agg(F.count(F.lit(1)).alias("rows"))
    both = expected.select(by, date).withColumn("wanted", F.lit(True)).join(have, [by, date], "full")
    ok = both.groupBy(by).agg(F.every(F.coalesce(F.col("wanted") & (F.col("rows") == cells), F.lit(False))).alias("valid"))
    return expected.select(by, date).join(ok, by)


def closed_years(df: DataFrame, today, date: str = "date") -> DataFrame:
    """The rows of calendar years before that of ``today``: those may be cached, the current year is read again."""
    return df.where(F.year(date) < F.year(F.lit(today).cast("date")))


def merge_partitions(spark: SparkSession, fresh: DataFrame, path: str, by: str, date: str = "date") -> None:
    """Adds days to a table partitioned by ``by`` (months, say): days that are there are replaced, other days of the partition stay."""
    if exists(spark, path):
        old = spark.read.schema(fresh.schema).parquet(path).join(fresh.select(by).distinct(), by, "left_semi").join(fresh.select(by, date).distinct(), [by, date], "left_anti")
        # read and written partitions are the same ones: the merged rows are written aside first
        aside = f"{path.rstrip('/')}__merge"
        old.select(*fresh.columns).unionByName(fresh).write.mode("overwrite").parquet(aside)
        write_partitions(spark.read.schema(fresh.schema).parquet(aside), path, by)
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(aside)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    else:
        write_partitions(fresh, path, by)


def leftovers(spark: SparkSession, path: str, marks: tuple[str, ...] = ("_temporary", ".tmp", ".part")) -> DataFrame:
    """Files under a folder that an interrupted run left, or that are empty: path, length, kind. ``_SUCCESS`` marks may be empty."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)  # names and lengths: Spark's readers skip such files
    rows = []
    while found.hasNext():
        f = found.next()
        name, length = f.getPath().toString(), f.getLen()
        last = name.rsplit("/", 1)[1]
        kind = "temporary" if any(m in name for m in marks) else "empty" if not length and not last.startswith(("_", ".")) else None
        if kind:
            rows.append((name, length, kind))
    return spark.createDataFrame(rows, "path string, length bigint, kind string")


class SingleWriter:
    """Exclusive use of a table's folder, by a lock file that only one process can create; the same object may enter again.

    The lock names its holder. One that a lost process left is older than ``stale`` seconds and is taken over.
    """

    def __init__(self, spark: SparkSession, path: str, stale: float = 24 * 3600):
        jvm = spark.sparkContext._jvm
        self.at = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/.writer.lock")
        self.fs = self.at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.stale, self.depth = stale, 0

    def __enter__(self):
        if not self.depth:
            if self.fs.exists(self.at) and time.time() - self.fs.getFileStatus(self.at).getModificationTime() / 1000 > self.stale:
                self.fs.delete(self.at, False)
            if not self.fs.createNewFile(self.at):
                raise RuntimeError(f"another process writes {self.at.getParent()}")
        self.depth += 1
        return self

    def __exit__(self, *_):
        self.depth -= 1
        if not self.depth:
            self.fs.delete(self.at, False)


def write_geojson(df: DataFrame, path: str, key: str = "zone_id") -> None:
    """Zones (key, ring) as GeoJSON features, a line each."""
    ring = F.concat(F.col("ring"), F.slice("ring", 1, 1))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(ring, lambda p: F.array(p.x, p.y))).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col(key)).alias("properties"), shape.alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replaces only the partitions that ``df`` has; the commit protocol makes each appear whole or not at all."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_csv(df: DataFrame, path: str, digits: int) -> None:
    """Doubles rounded to significant digits. The rounding loses what is below; the Parquet tables keep it."""
    rounded = {f.name: significant(F.col(f.name), digits) for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    df.withColumns(rounded).write.mode("overwrite").csv(path, header=True)


def append_stamped(df: DataFrame, path: str, pulled_at) -> None:
    """An archive of everything that was pulled, with when."""
    df.withColumn("pulled_at_utc", F.lit(pulled_at).cast("timestamp")).write.mode("append").parquet(path)


def write_report(checks: DataFrame, path: str) -> None:
    """Check rows as one JSON document."""
    rows = F.to_json(F.sort_array(F.collect_list(F.struct("check", "status"))))
    checks.agg(rows.alias("value")).coalesce(1).write.mode("overwrite").text(path)

"""Arrival ledger (A9, A10): which files have been seen, which days are missing, which files changed.

The original day reader built a path per day whatever existed, and its host kept the record of
processed files out of sight. Here the record is a table: one row per file and run with its
path, length, time and day. A day without files is reported instead of failing the read, and a
file that was replaced after it was read is found by its length or time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.partitions import folder_exists, list_files
from .files import daily_paths, read_lines

LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()), T.StructField("day", T.DateType()), T.StructField("run", T.LongType())])
DAY = r"(\d{4}-\d{2}-\d{2})"


def day_of(path: Column, pattern: str = DAY) -> Column:
    """The last ``yyyy-MM-dd`` in a path; null where there is none."""
    return F.try_element_at(F.regexp_extract_all(path, F.lit(pattern)), F.lit(-1)).try_cast("date")


class ArrivalLedger:
    """The files of ``root`` as seen by numbered runs. A run that is repeated replaces its own rows."""

    def __init__(self, spark: SparkSession, ledger: str, root: str, day_pattern: str = DAY):
        self.spark, self.path, self.root, self.pattern = spark, ledger.rstrip("/"), root, day_pattern

    def listing(self) -> DataFrame:
        """What is there now; an absent root holds nothing."""
        if not folder_exists(self.spark, self.root):
            return self.spark.createDataFrame([], LEDGER_SCHEMA).drop("run")
        files = list_files(self.spark, self.root)
        return files.select("path", "length", "modified", day_of(F.col("path"), self.pattern).alias("day"))

    def seen(self, before: int | None = None) -> DataFrame:
        """The latest row of each file, from runs below ``before``."""
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        if before is not None:
            rows = rows.where(F.col("run") < before)
        last = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("run")))
        return rows.withColumn("_at", last).where("_at = 1").drop("_at")

    def arrivals(self, run: int) -> DataFrame:
        """path, length, modified, day, status of every file that a run finds ``new`` or ``changed``
        against the runs before it, or ``gone``."""
        old = self.seen(run).select("path", F.col("length").alias("was"), F.col("modified").alias("at"), F.col("day").alias("old_day"))
        both = self.listing().withColumn("here", F.lit(True)).join(old.where("was IS NOT NULL"), "path", "full")
        status = (F.when(F.col("here").isNull(), "gone").when(F.col("was").isNull(), "new")
                  .when((F.col("length") != F.col("was")) | (F.col("modified") != F.col("at")), "changed"))
        return (both.select("path", F.coalesce("length", "was").alias("length"), F.coalesce("modified", "at").alias("modified"),
                            F.coalesce("day", "old_day").alias("day"), status.alias("status")).where("status IS NOT NULL"))

    def record(self, run: int) -> DataFrame:
        """Write what this run finds into the ledger (a file that is gone has no length from then
        on) and return it as written."""
        found = self.arrivals(run)
        rows = found.select("path", F.when(F.col("status") != "gone", F.col("length")).alias("length"), "modified", "day", "status")
        rows.write.mode("overwrite").parquet(f"{self.path}/run={run}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/run={run}")

    def days(self, begin: dt.date, end: dt.date, run: int | None = None) -> DataFrame:
        """day, files, bytes, changed, missing for every day of a range, as known after ``run``."""
        known = self.seen(None if run is None else run + 1).where("length IS NOT NULL")
        by_day = known.groupBy("day").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        again = self.spark.createDataFrame([], "day date, changed long")
        if folder_exists(self.spark, self.path):
            full = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("status", T.StringType())])
            rows = self.spark.read.schema(full).parquet(self.path).where("status = 'changed'")
            if run is not None:
                rows = rows.where(F.col("run") <= run)
            again = rows.groupBy("day").agg(F.count(F.lit(1)).alias("changed"))
        n = max(0, (end - begin).days + 1)
        every = self.spark.range(n).select(F.date_add(F.lit(begin), F.col("id").cast("int")).alias("day"))
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        return (every.join(F.broadcast(by_day), "day", "left").join(F.broadcast(again), "day", "left")
                .select("day", zero("files"), zero("bytes"), zero("changed"), F.col("files").isNull().alias("missing")))


def read_present_days(spark: SparkSession, pattern: str, begin: dt.date, end: dt.date,
                      reader: Callable[..., DataFrame] = read_lines, **kwargs) -> tuple[DataFrame | None, list[dt.date]]:
    """A9 where days may be missing: the frame over the days that exist (None if none does), and the
    days that do not. One scan, like ``read_daily``."""
    days = [begin + dt.timedelta(days=i) for i in range((end - begin).days + 1)]
    there = [(d, p) for d, p in zip(days, daily_paths(pattern, begin, end)) if folder_exists(spark, p)]
    missing = sorted(set(days) - {d for d, _ in there})
    return (reader(spark, [p for _, p in there], **kwargs) if there else None), missing

"""Skew probe: one join key holds a third of the base rows.

Runs the enrichment with all rows of a key in one task (``plain``), with the hot
keys found first (``detect``, the finding included) and with the hot key known
(``known``), in turn, and prints warm timings and the median of each.

    python scripts/skew_probe.py 2>/dev/null
"""
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from unfurl.operators.joins import Dim, HotKeys, enrich  # noqa: E402
from unfurl.session import local_session  # noqa: E402

spark = local_session(8, 16, extra={
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1"})
n = 3_000_000
items = spark.range(n).select(
    F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 100000).cast("string")).alias("k"),
    F.col("id").cast("string").alias("item"))
keys = spark.range(100000).select(F.col("id").cast("string").alias("k"))
keys = keys.union(spark.createDataFrame([("hot",)], "k string"))
dims = [Dim(keys.select("k", F.concat(F.lit(c), "k").alias(c)), "k") for c in ("a", "b", "o")]
known = HotKeys({"hot": 16})
times = {"plain": [], "detect": [], "known": []}
for i in range(5):
    for name, skew in (("plain", None), ("detect", "detect"), ("known", known)):
        t = time.perf_counter()
        enrich(items, dims, skew=skew).write.format("noop").mode("overwrite").save()
        if i:   # the first round warms up
            times[name].append(round(time.perf_counter() - t, 2))
for name, ts in times.items():
    print("RESULT", name, statistics.median(ts), ts, flush=True)
spark.stop()

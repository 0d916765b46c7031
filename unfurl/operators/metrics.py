"""Stage row counts without extra jobs.

The original jobs called ``count()`` after each step; every call is a
separate job that recomputes its input. ``observe`` attaches named counters
to a plan instead; they are filled while the one final action runs. They are
sums over finished tasks: where a lost executor makes Spark run tasks of a
stage again, rows of those tasks may be counted twice. ``CommittedCounts``
takes the numbers from files that a write has committed instead, which no
repeated task can change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path


class StageCounts:
    """Collect named row counts over one action.

    >>> counts = StageCounts()
    >>> items = counts.track(items, "items")
    >>> out = counts.track(joined, "joined")
    >>> out.write...            # the single action
    >>> counts.get()            # {"items": 60000, "joined": 60000}
    """

    def __init__(self) -> None:
        self._obs: dict[str, Observation] = {}

    def track(self, df: DataFrame, name: str, where: Column | None = None) -> DataFrame:
        """Count the rows of ``df``, or those for which ``where`` holds."""
        obs = Observation(name)
        self._obs[name] = obs
        rows = F.count(F.lit(1)) if where is None else F.count_if(where)
        return df.observe(obs, rows.alias("rows"))

    def get(self) -> dict[str, int]:
        return {name: obs.get["rows"] for name, obs in self._obs.items()}


class CommittedCounts(StageCounts):
    """Exact counts whatever is lost on the way: a tracked frame is written as Parquet to the shared
    folder, its rows are those that the files' footers state, and the job goes on from the files.

    Each tracked stage costs one write and one read of its rows, and cuts the lineage there: what
    comes later never runs the stage again. Use it where counts must reconcile (audits), and
    ``StageCounts`` where a close number is enough.
    """

    def __init__(self, spark: SparkSession, name: str = "counts") -> None:
        super().__init__()
        self._spark, self._root = spark, shared_path(spark, "counts", name, unique=True)
        self._where: dict[str, Column | None] = {}
        self._frames: dict[str, DataFrame] = {}

    def track(self, df: DataFrame, name: str, where: Column | None = None) -> DataFrame:
        path = f"{self._root}/{name}"
        df.write.option("compression", "zstd").parquet(path)    # nine stages of an order job are much to write
        back = self._spark.read.schema(df.schema).parquet(path)
        self._where[name], self._frames[name] = where, back
        return back

    def files(self) -> DataFrame:
        """stage, file, bytes, rows of every committed file; no column is read for it."""
        parts = [df.groupBy(F.lit(name).alias("stage"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
                 .agg(F.count(F.lit(1)).alias("rows")) for name, df in self._frames.items()]
        return reduce(DataFrame.unionByName, parts)

    def get(self) -> dict[str, int]:
        rows = lambda name, df: df.count() if self._where[name] is None else df.where(self._where[name]).count()
        return {name: rows(name, df) for name, df in self._frames.items()}

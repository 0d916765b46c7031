"""State between batches (A10): late dimensions, distinct, sums, partitions re-run, arrivals, exact counts."""

import datetime as dt
import glob
import os
import random
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from unfurl.operators.aggregate import sales_by_key
from unfurl.operators.metrics import CommittedCounts, StageCounts
from unfurl.plans.orders import order_enrich
from unfurl.sinks.partitions import commits, in_partitions, is_committed, list_files, replace_partitions
from unfurl.sources.arrivals import ArrivalLedger, read_present_days
from unfurl.streaming.incremental import file_stream, run_batches, tagged_union, untagged
from unfurl.session import shared_path
from unfurl.streaming.orders import INPUTS, OrderTable, run_orders
from unfurl.streaming.state import DistinctSink, SumsSink, row_digest

ITEMS = ("amazonOrderId string, nextToken string, orderItems array<struct<orderItemId: string, sellerSKU: string, "
         "quantityOrdered: bigint, itemPrice: struct<amount: string>>>")
SCHEMAS = {"items": ITEMS, "address": "amazonOrderId string, shippingAddress struct<countryCode: string, city: string>",
           "buyer": "amazonOrderId string, buyerEmail string",
           "orders": "amazonOrderId string, purchaseDate string, lastUpdateDate string, orderStatus string"}


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def some(rng, kind, n):
    key = lambda: rng.choice([None, *(f"o{i}" for i in range(12))])
    out = []
    for _ in range(n):
        k = key()
        if kind == "items":
            out.append((k, None, [(f"{k}-{rng.randrange(4)}", f"s{rng.randrange(3)}", rng.randrange(3), (rng.choice(["1.5", "2", "x", None]),))
                                  for _ in range(rng.randrange(3))] or None))
        elif kind == "address":
            out.append((k, rng.choice([None, ("US", rng.choice(["a", "b"]))])))
        elif kind == "buyer":
            out.append((k, rng.choice([None, "x@y", "z@y"])))
        else:
            out.append((k, rng.choice([None, "", "2024-01-01T10:00:00", "2024-01-02T00:00:00", "2024-02-03T01:00:00"]), None, rng.choice(["new", "done"])))
    return out


# -- late dimensions ---------------------------------------------------------------------------------

def test_late_records_reach_written_orders(spark, tmp_path):
    """Any order of arrival, repeats and null keys: after every batch the table is the batch job's."""
    rng = random.Random(1)
    schemas = {n: spark.createDataFrame([], s).schema for n, s in SCHEMAS.items()}
    table = OrderTable(spark, f"{tmp_path}/t", schemas)
    all_rows = {n: [] for n in INPUTS}
    for b in range(3):
        new = {n: some(rng, n, rng.choice([3, 9])) for n in INPUTS}
        if b == 1:      # nothing but late dimensions, some delivered before
            new["items"] = []
            new["orders"] = all_rows["orders"][:2] + some(rng, "orders", 6)
        frames = {n: spark.createDataFrame(r, schemas[n]) for n, r in new.items()}
        batch = tagged_union(frames)
        table.update(batch, b)
        if b == 1:      # handed over again after the commit
            table.update(batch, b)
        for n in INPUTS:
            all_rows[n] += new[n]
        want = order_enrich(*[spark.createDataFrame(all_rows[n], schemas[n]) for n in INPUTS], skew=None)
        empty_date = F.when(F.col("order_date") != "", F.col("order_date")).alias("order_date")     # as folders have it
        names = [empty_date if c == "order_date" else F.col(c) for c in want.columns]
        assert rows(table.read().select(want.columns)) == rows(want.select(names).distinct())


def test_a_batch_is_not_kept_by_executors(spark, tmp_path, monkeypatch):
    """The four writes of a batch read staged files; blocks kept by executors would grow with the batch."""
    import unfurl.streaming.state as S
    from conftest import plan_text
    rng = random.Random(3)
    schemas = {n: spark.createDataFrame([], s).schema for n, s in SCHEMAS.items()}
    table = OrderTable(spark, f"{tmp_path}/t", schemas)
    plans, put = [], S.BatchTable.put

    def seen(self, df, *args, **kw):
        plans.append(plan_text(df))
        put(self, df, *args, **kw)

    monkeypatch.setattr(S.BatchTable, "put", seen)
    table.update(tagged_union({n: spark.createDataFrame(some(rng, n, 9), schemas[n]) for n in INPUTS}), 0)
    assert len(plans) == 4 and all("InMemoryTableScan" not in p and "Scan parquet" in p for p in plans)
    assert os.listdir(shared_path(spark, "orders", "batch").removeprefix("file:")) == []       # gone when the writes are done


def test_interrupted_update_is_repaired(spark, tmp_path, monkeypatch):
    """A run that dies after some folders were replaced, before its commit, is run again."""
    import unfurl.streaming.orders as O
    rng = random.Random(7)
    schemas = {n: spark.createDataFrame([], s).schema for n, s in SCHEMAS.items()}
    table = OrderTable(spark, f"{tmp_path}/t", schemas)
    first = {n: some(rng, n, 12) for n in INPUTS}
    late = {"items": [], "address": some(rng, "address", 5), "buyer": [], "orders": some(rng, "orders", 9)}
    make = lambda r: tagged_union({n: spark.createDataFrame(r[n], schemas[n]) for n in INPUTS})
    table.update(make(first), 0)
    done = O.replace_partitions

    def dies(df, path, **kw):
        some_days = df.where(F.col("order_date") == "2024-01-01")
        some_days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("order_date").parquet(path)
        raise RuntimeError("lost")

    monkeypatch.setattr(O, "replace_partitions", dies)
    with pytest.raises(RuntimeError, match="lost"):
        table.update(make(late), 1)
    monkeypatch.setattr(O, "replace_partitions", done)
    table.update(make(late), 1)
    want = order_enrich(*[spark.createDataFrame(first[n] + late[n], schemas[n]) for n in INPUTS], skew=None)
    day = F.when(F.col("order_date") != "", F.col("order_date")).alias("order_date")
    assert rows(table.read().select(want.columns)) == rows(want.select([day if c == "order_date" else F.col(c) for c in want.columns]).distinct())


def test_four_streams_in_one_run(spark, tmp_path):
    schemas = {n: spark.createDataFrame([], s).schema for n, s in SCHEMAS.items()}
    table = OrderTable(spark, f"{tmp_path}/t", schemas)
    src = lambda n: f"{tmp_path}/in/{n}"
    item = [("o1", None, [("o1-1", "s", 2, ("3.5",))])]
    dims = {"address": [("o1", ("US", "x"))], "buyer": [("o1", "a@b")], "orders": [("o1", "2024-05-06T07:08:09", None, "new")]}
    for n in INPUTS:
        spark.createDataFrame(item if n == "items" else [], schemas[n]).write.json(f"{src(n)}/drop=0")
    streams = lambda: {n: file_stream(spark, f"{src(n)}/*", schemas[n]) for n in INPUTS}
    run_orders(table, streams(), f"{tmp_path}/ckpt")
    got = table.read().first()
    assert (got.city, got.order_date) == (None, None)
    for n, r in dims.items():
        spark.createDataFrame(r, schemas[n]).write.json(f"{src(n)}/drop=1")
    assert run_orders(table, streams(), f"{tmp_path}/ckpt")["rows"] == 3
    got = table.read().collect()
    assert len(got) == 1 and (got[0].city, got[0].buyerEmail, got[0].order_date) == ("x", "a@b", "2024-05-06")
    # the folder of orders without a date is vacated
    assert [os.path.basename(p) for p in glob.glob(f"{tmp_path}/t/table/order_date=*")] == ["order_date=2024-05-06"]
    assert run_orders(table, streams(), f"{tmp_path}/ckpt")["rows"] == 0
    with pytest.raises(ValueError, match="no stream for"):
        run_orders(table, {"items": None}, "x")


def test_tagged_rows_come_back(spark):
    a = spark.createDataFrame([(1, None), (None, None)], "x int, y string")
    b = spark.createDataFrame([("z",)], "`q.r` string")
    both = tagged_union({"a": a, "b": b})
    assert rows(untagged(both, "a")) == rows(a) and rows(untagged(both, "b")) == rows(b)


# -- distinct ------------------------------------------------------------------------------------------

ROWS = "a string, b array<int>, c struct<d: int, e: string>, f double"


def test_rows_are_written_once(spark, tmp_path):
    """Repeats within a batch, across batches and of whole batches; nulls at any depth tell rows apart."""
    rng = random.Random(3)
    value = lambda: (rng.choice([None, "", "x"]), rng.choice([None, [], [1], [None, 1], [1, None]]),
                     rng.choice([None, (None, "e"), (1, None)]), rng.choice([None, 1.0, float("nan")]))
    schema = spark.createDataFrame([], ROWS).schema
    sink = DistinctSink(spark, f"{tmp_path}/sink", f"{tmp_path}/ledger", schema)
    seen = []
    for b in range(5):
        new = [value() for _ in range(40)] + seen[:5]
        df = spark.createDataFrame(new, schema)
        sink(df, b)
        if b in (1, 4):
            sink(df, b)         # the same batch again
        if b == 2:
            sink.compact(b)
        seen += new
        assert rows(sink.read(spark)) == rows(spark.createDataFrame(seen, schema).distinct())
    assert rows(sink.ledger.before()) == rows(sink.read(spark).select(row_digest(sink.read(spark)).alias("digest")))
    sink(spark.createDataFrame([], schema), 5)
    assert sink.read(spark).count() == spark.createDataFrame(seen, schema).distinct().count()


def test_replay_of_an_old_batch_before_compaction(spark, tmp_path):
    """A batch that comes again reads only what was before it, even past a compaction."""
    schema = spark.createDataFrame([], "a int").schema
    sink = DistinctSink(spark, f"{tmp_path}/s", f"{tmp_path}/l", schema)
    frames = [spark.range(i, i + 4).select(F.col("id").cast("int").alias("a")) for i in range(3)]
    for b, df in enumerate(frames):
        sink(df, b)
    sink.compact(2)
    sink(frames[2], 2)
    assert sorted(r.a for r in sink.read(spark).collect()) == [0, 1, 2, 3, 4, 5]


def test_many_equal_rows_combine_before_they_move(spark, tmp_path):
    from conftest import plan_text
    df = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"))
    plan = plan_text(df.dropDuplicates())
    assert plan.count("HashAggregate") >= 4       # two in the list, two in the details: partial and final
    sink = DistinctSink(spark, f"{tmp_path}/s", f"{tmp_path}/l", df.schema)
    sink(df, 0)
    assert sink.read(spark).where("a = 'hot'").count() == 1


# -- sums ----------------------------------------------------------------------------------------------

def test_sums_over_batches(spark, tmp_path):
    rng = random.Random(5)
    schema = "sku string, qty int, price decimal(18,2)"
    import decimal
    make = lambda n: [(rng.choice([None, "a", "b", "c"]), rng.choice([None, rng.randrange(9)]), decimal.Decimal(rng.randrange(10_000)) / 100)
                      for _ in range(n)]
    sums = SumsSink(spark, f"{tmp_path}/sums", spark.createDataFrame([], schema), compact_every=2)
    assert sums.read().count() == 0
    seen = []
    for b, n in enumerate([30, 0, 20, 10, 40]):
        new = make(n)
        df = spark.createDataFrame(new, schema)
        sums(df, b)
        if b in (2, 4):         # handed over again, after a compaction took it in
            sums(df, b)
        seen += new
        want = sales_by_key(spark.createDataFrame(seen, schema))
        assert rows(sums.read()) == rows(want)
    exact = sums.read(revenue_as_double=False)
    assert exact.schema["revenue"].dataType.simpleString() == "decimal(38,2)"


# -- partitions ----------------------------------------------------------------------------------------

def test_only_the_given_partitions_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = "v int, day string, kind string"
    data = [(1, "2024-01-01", "a"), (2, "2024-01-02", "a"), (3, None, "b/c"), (4, "", "b/c"), (5, "2024-01-02", "x=y %")]
    df = spark.createDataFrame(data, schema)
    assert replace_partitions(df, path, partition_by=["day", "kind"], run="1")
    read = lambda: rows(spark.read.schema(schema).parquet(path).select("v", "day", "kind"))
    as_kept = lambda d: sorted(repr((v, d or None, k)) for v, d, k in d)
    assert read() == sorted(repr((v, d or None, k)) for v, d, k in data)
    before = {r.path: r.modified for r in list_files(spark, path, "*.parquet").collect()}
    again = spark.createDataFrame([(20, "2024-01-02", "a"), (30, None, "b/c")], schema)
    assert replace_partitions(again, path, partition_by=["day", "kind"], run="2", vacated=[("2024-01-02", "x=y %"), (None, "b/c")])
    kept = [(1, "2024-01-01", "a"), (20, "2024-01-02", "a"), (30, None, "b/c")]
    assert read() == sorted(map(repr, kept))
    after = {r.path: r.modified for r in list_files(spark, path, "*.parquet").collect()}
    untouched = [p for p in before if "2024-01-01" in p]
    assert untouched and all(after.get(p) == before[p] for p in untouched)
    # a committed run does nothing, whatever it is given
    assert not replace_partitions(df, path, partition_by=["day", "kind"], run="2")
    assert read() == sorted(map(repr, kept)) and is_committed(spark, path, "2") and not is_committed(spark, path, "3")
    record = commits(spark, path)
    assert {(r.run, r["rows"]) for r in record.where("file IS NULL").collect()} == {("1", 5), ("2", 2)}
    named = record.where("file IS NOT NULL AND run = '2'").collect()
    assert sorted((r.partition, r["rows"]) for r in named) == [("day=2024-01-02/kind=a", 1), ("day=null/kind=b/c", 1)]
    assert all(r.bytes > 0 for r in named)


def test_empty_run_and_unknown_table(spark, tmp_path):
    assert commits(spark, f"{tmp_path}/none").count() == 0
    empty = spark.createDataFrame([], "v int, day string")
    assert replace_partitions(empty, f"{tmp_path}/e", partition_by=["day"], run="1")
    assert [(r.run, r["rows"]) for r in commits(spark, f"{tmp_path}/e").collect()] == [("1", 0)]
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "v int, day string")
    assert sorted(r.v for r in df.where(in_partitions([("a",), (None,)], ["day"])).collect()) == [1, 2]
    assert df.where(in_partitions([], ["day"])).count() == 0


def test_rerun_writes_json_and_few_files(spark, tmp_path):
    path = f"{tmp_path}/j"
    df = spark.range(3000).select("id", F.concat(F.lit("d"), F.col("id") % 3).alias("day")).repartition(8)
    replace_partitions(df, path, partition_by=["day"], run="1", fmt="json")
    replace_partitions(df.where("day = 'd1'").limit(10), path, partition_by=["day"], run="2", fmt="json")
    assert spark.read.schema("id long, day string").json(path).groupBy("day").count().orderBy("day").collect()[1]["count"] == 10
    assert all(len(glob.glob(f"{path}/day=d{i}/*.json")) <= 2 for i in range(3))
    assert commits(spark, path).where("run = '1' and file is null").first()["rows"] == 3000


# -- arrivals ------------------------------------------------------------------------------------------

def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_ledger_finds_new_changed_and_gone_files(spark, tmp_path):
    root = f"{tmp_path}/in"
    ledger = ArrivalLedger(spark, f"{tmp_path}/ledger", root)
    assert ledger.record(1).count() == 0 and ledger.seen().count() == 0
    for d in (1, 2, 4):
        put(f"{root}/day=2024-01-0{d}/a.txt", "x" * d)
    put(f"{root}/readme", "no day")
    state = lambda df: sorted((os.path.basename(os.path.dirname(r.path)), r.status) for r in df.collect())
    first = [("day=2024-01-01", "new"), ("day=2024-01-02", "new"), ("day=2024-01-04", "new"), ("in", "new")]
    assert state(ledger.record(2)) == first
    assert state(ledger.record(2)) == first          # the run again: its own rows do not count against it
    put(f"{root}/day=2024-01-02/a.txt", "longer than before")
    os.utime(f"{root}/day=2024-01-04/a.txt", (1, 1))
    os.unlink(f"{root}/day=2024-01-01/a.txt")
    put(f"{root}/day=2024-01-04/b.txt", "y")
    assert state(ledger.record(3)) == [("day=2024-01-01", "gone"), ("day=2024-01-02", "changed"), ("day=2024-01-04", "changed"), ("day=2024-01-04", "new")]
    assert ledger.record(4).count() == 0
    days = {str(r.day): (r.files, r.changed, r.missing) for r in ledger.days(dt.date(2024, 1, 1), dt.date(2024, 1, 5)).collect()}
    assert days == {"2024-01-01": (0, 0, True), "2024-01-02": (1, 1, False), "2024-01-03": (0, 0, True), "2024-01-04": (2, 1, False), "2024-01-05": (0, 0, True)}
    then = {str(r.day): r.missing for r in ledger.days(dt.date(2024, 1, 1), dt.date(2024, 1, 2), run=2).collect()}
    assert then == {"2024-01-01": False, "2024-01-02": False}
    assert ledger.days(dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0


def test_missing_days_are_reported(spark, tmp_path):
    for d in (1, 3):
        put(f"{tmp_path}/2024-01-0{d}/x.txt", f"line {d}\n")
    df, missing = read_present_days(spark, f"{tmp_path}/{{}}", dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    assert sorted(r.value for r in df.collect()) == ["line 1", "line 3"] and missing == [dt.date(2024, 1, 2), dt.date(2024, 1, 4)]
    assert read_present_days(spark, f"{tmp_path}/none/{{}}", dt.date(2024, 1, 1), dt.date(2024, 1, 1)) == (None, [dt.date(2024, 1, 1)])


# -- exact counts --------------------------------------------------------------------------------------

def test_committed_counts(spark):
    counts = CommittedCounts(spark)
    df = counts.track(spark.range(1000).repartition(4), "all")
    counts.track(df.where("id < 10"), "few", F.col("id") % 2 == 0)
    counts.track(df.limit(0), "none")
    assert counts.get() == {"all": 1000, "few": 5, "none": 0}
    files = counts.files().groupBy("stage").agg(F.sum("rows").alias("n"), F.min("bytes").alias("b")).collect()
    assert {r.stage: r.n for r in files} == {"all": 1000, "few": 10} and all(r.b > 0 for r in files)
    assert isinstance(counts, StageCounts)


LOSS = """
    import os, sys, time
    sys.path.insert(0, {repo!r})
    os.environ["PYTHONPATH"] = {repo!r}
    from pyspark.sql import SparkSession, functions as F
    from unfurl.operators.metrics import CommittedCounts, StageCounts
    spark = (SparkSession.builder.master("local-cluster[2,1,900]").config("spark.executor.memory", "800m")
             .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp}/shared").config("spark.driver.host", "127.0.0.1")
             .config("spark.sql.shuffle.partitions", "6").config("spark.sql.adaptive.enabled", "false")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    def kill_once(batches):
        # the first task to come here ends its executor, whose finished map outputs go with it
        for b in batches:
            try:
                os.close(os.open("{tmp}/killed-" + name, os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                pass
            else:
                time.sleep(1)
                pid = os.getpid()
                while b"CoarseGrainedExecutorBackend" not in open(f"/proc/{{pid}}/cmdline", "rb").read():
                    pid = int(open(f"/proc/{{pid}}/stat").read().rsplit(")", 1)[1].split()[1])
                os.kill(pid, 9)
            yield b

    for name, counts in (("observed", StageCounts()), ("committed", CommittedCounts(spark))):
        df = counts.track(spark.range(0, 6000, 1, 6), "rows")
        keyed = counts.track(df.withColumn("k", F.col("id") % 100).repartition(6, "k"), "moved")
        done = counts.track(keyed.mapInArrow(kill_once, keyed.schema), "done")
        done.write.format("noop").mode("overwrite").save()
        print("RESULT", name, counts.get(), flush=True)
    spark.stop()
"""


def test_committed_counts_survive_a_lost_executor(tmp_path):
    """An executor is killed in the middle; its tasks run again. The committed counts stay exact."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = textwrap.dedent(LOSS.format(repo=repo, tmp=tmp_path))
    os.makedirs(f"{tmp_path}/shared")
    env = {**os.environ, "PYTHONPATH": repo}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, env=env, cwd=str(tmp_path))
    results = {line.split()[1]: line.split(" ", 2)[2] for line in out.stdout.splitlines() if line.startswith("RESULT")}
    assert results.get("committed") == "{'rows': 6000, 'moved': 6000, 'done': 6000}", out.stderr[-3000:]
    assert os.path.exists(f"{tmp_path}/killed-committed")

"""A1-A9, A11 and B1-B3 on real files, including the layout traps T1-T3, T19-T21."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_text
from unfurl.sinks import read_folders, save_many_folders, write_json, write_parquet
from unfurl.sources import files as SRC

REC = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_layouts(spark, tmp_dir):
    recs = [{"id": "a", "n": 1}, {"id": "b", "n": 2}]
    put(f"{tmp_dir}/array/f.json", json.dumps(recs, indent=2))
    put(f"{tmp_dir}/nested/f.json", json.dumps([recs, [{"id": "z", "n": 9}]], indent=2))
    put(f"{tmp_dir}/object/f.json", json.dumps(recs[0], indent=2))
    put(f"{tmp_dir}/lines/f.json", "\n".join(json.dumps(r) for r in recs))
    put(f"{tmp_dir}/array/sub/g.json", json.dumps([{"id": "c", "n": 3}]))

    assert ids(SRC.read_json_array(spark, f"{tmp_dir}/array", REC, recursive=True)) == ["a", "b", "c"]
    # without recursion the subfolder is not read
    assert ids(SRC.read_json_array(spark, f"{tmp_dir}/array/f.json", REC)) == ["a", "b"]
    # A2: only the first inner array; the plain reader gives a null row
    assert ids(SRC.read_json_nested(spark, f"{tmp_dir}/nested", REC)) == ["a", "b"]
    plain = SRC.read_json_array(spark, f"{tmp_dir}/nested", REC).collect()
    assert len(plain) == 1 and plain[0]["id"] is None
    # A3 / A4 on an object document
    assert ids(SRC.read_json_document(spark, f"{tmp_dir}/object", REC)) == ["a"]
    assert ids(SRC.read_json_array(spark, f"{tmp_dir}/object", REC)) == ["a"]
    # Multi-line reading of JSON lines keeps only the first record
    assert ids(SRC.read_json_array(spark, f"{tmp_dir}/lines", REC)) == ["a"]
    assert ids(SRC.read_json_lines(spark, f"{tmp_dir}/lines", REC)) == ["a", "b"]
    # inference
    inferred = SRC.read_json_lines(spark, f"{tmp_dir}/lines")
    assert dict(inferred.dtypes)["n"] == "bigint"


def test_document_keeps_whole_array(spark, tmp_dir):
    put(f"{tmp_dir}/d1/f.json", json.dumps([{"id": "a", "n": 1}, {"id": "b", "n": 2}]))
    put(f"{tmp_dir}/d1/g.json", json.dumps([{"id": "c", "n": 3}]))
    docs = SRC.read_json_document(spark, f"{tmp_dir}/d1", T.ArrayType(REC))
    assert sorted(len(r["document"]) for r in docs.collect()) == [1, 2]


def test_nested_mismatched_root(spark, tmp_dir):
    put(f"{tmp_dir}/bad/f.json", json.dumps({"id": "a"}))
    assert SRC.read_json_nested(spark, f"{tmp_dir}/bad", REC).count() == 0


def test_nested_with_any_field_names(spark, tmp_dir):
    from unfurl.schemas import LOG_LINE_SCHEMA
    put(f"{tmp_dir}/log/f.json", json.dumps([[{"@timestamp": "t1", "method": "POST"}], []]))
    assert [r["@timestamp"] for r in SRC.read_json_nested(spark, f"{tmp_dir}/log", LOG_LINE_SCHEMA).collect()] == ["t1"]
    assert ids(SRC.read_json_nested(spark, f"{tmp_dir}/log", "id string, `@timestamp` string")) == [None]


def test_documents_without_schema(spark, tmp_dir):
    # one row per file whatever the root is; no field is dropped
    put(f"{tmp_dir}/v/a.json", json.dumps([{"id": "a"}, {"id": "b", "x": [1]}, 3], indent=1))
    put(f"{tmp_dir}/v/b.json", json.dumps({"id": "c", "deep": {"y.z": None}}))
    got = SRC.read_json_document(spark, f"{tmp_dir}/v").selectExpr("to_json(document) j").collect()
    assert sorted(json.dumps(json.loads(r.j)) for r in got) == sorted(
        [json.dumps([{"id": "a"}, {"id": "b", "x": [1]}, 3]), json.dumps({"deep": {"y.z": None}, "id": "c"})])


def test_truncated_documents_are_counted(spark, tmp_dir):
    from unfurl.operators.metrics import StageCounts
    good = [{"id": "a", "n": 1}, {"id": "b", "n": 2}]
    for kind, doc in (("array", good), ("nested", [good, []]), ("doc", good)):
        put(f"{tmp_dir}/{kind}/good.json", json.dumps(doc))
        put(f"{tmp_dir}/{kind}/cut.json", json.dumps(doc)[:-12])
    for kind, read, rows in (("array", SRC.read_json_array, 3), ("nested", SRC.read_json_nested, 2),
                             ("doc", lambda *a, **k: SRC.read_json_document(a[0], a[1], T.ArrayType(REC), **k), 2),
                             ("doc", lambda *a, **k: SRC.read_json_document(a[0], a[1], **k), 2)):
        counts = StageCounts()
        assert len(read(spark, f"{tmp_dir}/{kind}", REC, counts=counts).collect()) == rows
        assert counts.get() == {"bad_documents": 1}
        with pytest.raises(Exception, match="does not parse"):
            read(spark, f"{tmp_dir}/{kind}", REC, on_bad="fail").collect()


def test_staged_documents_hold_every_row(spark, tmp_dir):
    from unfurl.sources import derived as D
    df = spark.range(5000).selectExpr("cast(id % 4 as string) id", "1L n")
    path = D.stage_json_array(df, f"{tmp_dir}/s", doc_bytes=20_000)
    files = glob.glob(f"{path}/docs/*.txt")
    assert len(files) >= 4 and not any("=" in f.rsplit("/", 2)[-2] for f in files)     # no folder per document
    assert SRC.read_json_array(spark, path, REC, recursive=True).groupBy("id").count().count() == 4
    assert SRC.read_json_array(spark, path, REC, recursive=True).count() == 5000


def test_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    from unfurl import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return spark.sparkContext.getConf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = spark.conf

    monkeypatch.setattr(session, "_conf", lambda s, k: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_lines_and_glob(spark, tmp_dir):
    put(f"{tmp_dir}/t/d1/a.txt", "l1\nl2\n")
    put(f"{tmp_dir}/t/d2/b.txt", "l3\n")
    put(f"{tmp_dir}/t/d2/c.log", "skip\n")
    assert SRC.read_lines(spark, f"{tmp_dir}/t/*/*.txt").count() == 3
    assert SRC.read_lines(spark, f"{tmp_dir}/t", recursive=True).count() == 4


def test_daily(spark, tmp_dir):
    paths = SRC.daily_paths(f"{tmp_dir}/operation-log-{{}}/", dt.date(2021, 10, 1),
                            dt.date(2021, 10, 3))
    assert [p.rsplit("-", 3)[-3:] for p in paths][0] == ["2021", "10", "01/"]
    assert len(paths) == 3 and paths[-1].endswith("2021-10-03/")
    for i, p in enumerate(paths):
        put(f"{p}part.txt", f"line{i}\n")
    df = SRC.read_daily(spark, f"{tmp_dir}/operation-log-{{}}/", dt.date(2021, 10, 1),
                        dt.date(2021, 10, 3))
    assert df.count() == 3
    with pytest.raises(Exception):
        SRC.read_daily(spark, f"{tmp_dir}/operation-log-{{}}/", dt.date(2021, 10, 1),
                       dt.date(2021, 10, 4)).count()


def test_day_partitions_pruned(spark, tmp_dir):
    rows = [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"), ("c", 3, "2024-01-03")]
    df = spark.createDataFrame(rows, "id string, n long, day string")
    write_json(df, f"{tmp_dir}/p", mode="overwrite", partition_by=["day"])
    schema = T.StructType(REC.fields + [T.StructField("day", T.StringType())])
    got = SRC.read_day_partitions(spark, f"{tmp_dir}/p", "day", dt.date(2024, 1, 2),
                                  dt.date(2024, 1, 3), reader=SRC.read_json_lines, schema=schema)
    assert ids(got) == ["b", "c"]
    assert "PartitionFilters: [isnotnull(day" in plan_text(got)


def test_sink_round_trip_and_traps(spark, tmp_dir):
    df = spark.createDataFrame([("a", None, "2024-01-01"), ("b", 2, ""), ("c", 3, None)],
                               "id string, n long, day string")
    out = f"{tmp_dir}/out"
    write_json(df, out, mode="overwrite", partition_by=["day"])
    # Null and "" land in the default partition and read back as null
    assert any("__HIVE_DEFAULT_PARTITION__" in p for p in os.listdir(out))
    back = spark.read.schema(df.schema).json(out)
    assert sorted((r.id, r.day) for r in back.collect()) == [
        ("a", "2024-01-01"), ("b", None), ("c", None)]
    # Null fields are omitted from the written objects
    text = "".join(open(p).read() for p in glob.glob(f"{out}/day=2024-01-01/*.json"))
    assert '"n"' not in text
    # Mode is explicit; "error" fails on an existing path
    with pytest.raises(Exception):
        write_json(df, out, mode="error")
    with pytest.raises(ValueError):
        write_json(df, out, mode="bogus")


def test_partitioned_parquet_has_few_files(spark, tmp_dir):
    df = spark.range(1000).selectExpr("cast(id as string) as id", "id % 7 as n").repartition(4)
    write_parquet(df, f"{tmp_dir}/pq", mode="overwrite", partition_by=["n"])
    assert spark.read.parquet(f"{tmp_dir}/pq").count() == 1000
    # rebalanced on the key: few files per folder
    assert len(glob.glob(f"{tmp_dir}/pq/n=3/*.parquet")) <= 2


def test_many_small_folders_use_all_cores(spark, tmp_dir):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    merge = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    before = spark.conf.get(merge, None)
    try:
        df = spark.range(600).selectExpr("id", "concat('t', id % 300) as k").repartition(3)
        for write, fmt in ((write_json, "json"), (write_parquet, "parquet")):
            write(df, f"{tmp_dir}/{fmt}", mode="overwrite", partition_by=["k"])
            files = glob.glob(f"{tmp_dir}/{fmt}/*/part-*")
            assert len(files) == 300                                    # one a folder
            assert len({os.path.basename(f)[:10] for f in files}) >= 4  # written by as many tasks as there are cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert spark.conf.get(merge, None) == before


def test_many_folders_are_listed_by_few_tasks(spark, tmp_dir):
    write_json(spark.range(120).selectExpr("id", "concat('t', id) as k"), f"{tmp_dir}/l", mode="overwrite", partition_by=["k"])
    sc, schema = spark.sparkContext, T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.StringType())])
    sc.setJobGroup("listing", "listing")
    try:
        back = read_folders(spark, f"{tmp_dir}/l", schema, "json")
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert tasks and max(tasks) <= 16
    assert sorted(r.k for r in back.collect()) == sorted(f"t{i}" for i in range(120))


@pytest.mark.parametrize("fmt", ["json", "parquet"])
@pytest.mark.parametrize("keys", [["day"], ["n", "day"]])
def test_many_folders_are_written_as_spark_writes_them(spark, tmp_dir, fmt, keys):
    rows = [("a", None, "2024-01-01", 1.5), ("b", 2, "", None), ("c", 3, None, -0.0), (None, None, "x/y:z%[]^ \u00e9#'=\\\x7f\n", None),
            ("line\nbreak \u20ac", 4, "2024-01-01", 2.0), ("", 5, "  ", float("nan"))] * 3
    df = spark.createDataFrame(rows, "id string, n long, day string, f double").selectExpr(
        "*", "struct(id, array(n, n) q) s", "date'2024-01-02' d", "timestamp'2024-01-02 03:04:05.123456' t", "cast(n as decimal(20,3)) c")
    ours, sparks = f"{tmp_dir}/new/ours", f"{tmp_dir}/sparks"
    for _ in range(2):      # the second time in place of the first
        assert save_many_folders(df, ours, fmt, "overwrite", keys)
    df.write.partitionBy(*keys).format(fmt).save(sparks)
    folders = lambda p: {os.path.relpath(d, p) for d, _, names in os.walk(p) if any(f.startswith("part-") for f in names)}
    assert folders(ours) == folders(sparks) and os.listdir(f"{tmp_dir}/new") == ["ours"]
    if fmt == "json":
        lines = lambda p: sorted(x for f in glob.glob(f"{p}/**/part-*", recursive=True) for x in open(f, newline="").read().split("\n"))
        assert [x for x in lines(ours) if x] == [x for x in lines(sparks) if x]
    back = [spark.read.schema(df.schema).format(fmt).load(p) for p in (ours, sparks)]
    assert sorted(map(repr, back[0].collect())) == sorted(map(repr, back[1].collect()))


def test_many_folders_open_no_file_through_hadoop(spark, tmp_dir):
    df = spark.range(600).selectExpr("id", "concat('t', id % 300) as k").repartition(3)
    write_json(df, f"{tmp_dir}/j", mode="overwrite", partition_by=["k"], many_folders=True)
    assert len(glob.glob(f"{tmp_dir}/j/*/part-*.json")) == 300
    assert not glob.glob(f"{tmp_dir}/j/*/.*")       # Hadoop's local files have a checksum file each
    with pytest.raises(Exception):
        write_json(df, f"{tmp_dir}/j", mode="error", partition_by=["k"], many_folders=True)
    write_json(df, f"{tmp_dir}/j", mode="append", partition_by=["k"], many_folders=True)       # by Spark's writer
    assert spark.read.json(f"{tmp_dir}/j").count() == 1200


def test_a_failed_write_of_many_folders_keeps_the_old_table(spark, tmp_dir):
    df = spark.range(50).selectExpr("id", "concat('t', id) as k")
    write_json(df, f"{tmp_dir}/f", mode="overwrite", partition_by=["k"], many_folders=True)
    bad = df.selectExpr("if(id = 49, cast(raise_error('no') as bigint), id) id", "k")
    with pytest.raises(Exception):
        write_json(bad, f"{tmp_dir}/f", mode="overwrite", partition_by=["k"], many_folders=True)
    assert os.listdir(tmp_dir) == ["f"] and spark.read.json(f"{tmp_dir}/f").count() == 50


def test_small_files_share_tasks_and_large_ones_do_not(spark, tmp_dir):
    df = spark.range(40000).selectExpr("id", "if(id < 400, concat('t', id), concat('big', id % 2)) k", "repeat(uuid(), 2) v")
    write_json(df, f"{tmp_dir}/m", mode="overwrite", partition_by=["k"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        back = read_folders(spark, f"{tmp_dir}/m", df.schema, "json")
        plain = spark.read.schema(df.schema).json(f"{tmp_dir}/m")
        assert back.rdd.getNumPartitions() <= 20 < plain.rdd.getNumPartitions()
        per_task = [r.n for r in back.where("k LIKE 'big%'").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(per_task) <= 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert back.schema == plain.schema and back.count() == 40000 and back.exceptAll(plain).isEmpty()


def test_partition_by_full_timestamp_escapes_colon(spark, tmp_dir):
    # One folder per distinct timestamp; ':' is escaped in folder names
    df = spark.createDataFrame([("a", "2021-10-22T05:50:08Z")], "id string, ts string")
    write_json(df, f"{tmp_dir}/ts", mode="overwrite", partition_by=["ts"])
    assert any("%3A" in d for d in os.listdir(f"{tmp_dir}/ts"))
    back = spark.read.schema(df.schema).json(f"{tmp_dir}/ts")
    assert back.first().ts == "2021-10-22T05:50:08Z"


def test_preview_and_schema_text(spark):
    from unfurl.sinks import preview, schema_text
    df = spark.range(50)
    assert preview(df, 10).count() == 10
    assert "id: long" in schema_text(df)


# -- record paths and schemas without one given -------------------------------------------------

def write_files(folder, texts):
    os.makedirs(folder, exist_ok=True)
    for name, text in texts.items():
        with open(f"{folder}/{name}.json", "w") as f:
            f.write(text)
    return folder


def plain_path(doc, path):
    """Values that a record path meets, by plain recursion."""
    import re
    steps = re.findall(r"\[\*\]|\[\d+\]|\.[^.\[\]]+|\['[^']+'\]", path[1:])
    now = [doc]
    for s in steps:
        out = []
        for v in now:
            if s == "[*]":
                out += v if isinstance(v, list) else [v[k] for k in sorted(v)] if isinstance(v, dict) else []
            elif s[1:-1].isdigit():
                out += [v[int(s[1:-1])]] if isinstance(v, list) and int(s[1:-1]) < len(v) else []
            else:
                k = s[2:-2] if s[0] == "[" else s[1:]
                out += [v[k]] if isinstance(v, dict) and k in v else []
        now = out
    return now


def test_record_paths_without_schema(spark, tmp_dir):
    docs = {"nested": [[{"a": 1, "b.c": {"d": [1, 2]}}, {"a": "x"}, {}], [{"z": None}], []], "flat": [1, "t", None], "object": {"k": [{"v": 1}], "j": 2},
            "empty": [], "text": "just text", "deep": [[[[5]]]], "null": None}
    path = write_files(f"{tmp_dir}/p", {k: json.dumps(v) for k, v in docs.items()})
    for p in ("$[0][*]", "$[1][*]", "$[*][*]", "$", "$[*]", "$[0][*]['b.c'].d[*]", "$.k[*].v", "$[7][*]", "$[0][0][0][0]"):
        got = [r[0] for r in SRC.read_json_path(spark, path, p).selectExpr("to_json(record)").collect()]
        want = [v for d in docs.values() for v in plain_path(d, p)]
        assert sorted(json.dumps(json.loads(g), sort_keys=True) if g is not None else "null" for g in got) == \
            sorted(json.dumps(v, sort_keys=True) for v in want), p
    for p in ("[0]", "$[x]", "$..a", "a.b"):
        with pytest.raises(ValueError, match="not a record path"):
            SRC.read_json_path(spark, path, p)


def test_record_path_counts_bad_files(spark, tmp_dir):
    from unfurl.operators.metrics import StageCounts
    path = write_files(f"{tmp_dir}/b", {"good": '[[{"a": 1}]]', "bad": "[[{", "other": "{}"})
    counts = StageCounts()
    assert SRC.read_json_path(spark, path, counts=counts).count() == 1 and counts.get() == {"bad_documents": 1}
    with pytest.raises(Exception, match="does not parse"):
        SRC.read_json_path(spark, path, on_bad="fail").collect()


RECORDS = [{"n": 1, "s": "a", "f": 1.5, "b": True, "o": {"x": 1, "l": [1, 2]}}, {"n": 2, "s": None, "o": {"y": "t"}, "e": []},
           {"f": 2, "big": 12345678901, "l": [{"m": 1}, {"k": "v"}]}, {"l": [], "o": None}]


@pytest.mark.parametrize("layout", ["array", "lines", "objects"])
def test_one_pass_schema_equals_inference(spark, tmp_dir, layout):
    if layout == "lines":
        path = write_files(f"{tmp_dir}/l", {str(i): "\n".join(json.dumps(r) for r in RECORDS[i::2]) for i in range(2)})
    elif layout == "array":
        path = write_files(f"{tmp_dir}/a", {str(i): json.dumps(RECORDS[i::2]) for i in range(2)})
    else:
        path = write_files(f"{tmp_dir}/o", {str(i): json.dumps(r) for i, r in enumerate(RECORDS)})
    want = spark.read.option("multiLine", str(layout != "lines").lower()).json(path).schema
    schema, files = SRC.infer_schema(spark, path, lines=layout == "lines")
    assert schema.simpleString() == want.simpleString() and SRC.conflicts(schema) == []
    assert files.count() == (4 if layout == "objects" else 2) and {r.bad for r in files.collect()} == {0}


def test_one_pass_schema_reports_conflicts_and_bad_files(spark, tmp_dir):
    path = write_files(f"{tmp_dir}/c", {"a": '[{"x": 1, "o": {"p": [1]}}, {"x": 2.5}]', "b": '{"x": "text", "o": {"p": ["t"]}}', "bad": "{", "none": "[]"})
    schema, files = SRC.infer_schema(spark, path)
    assert SRC.conflicts(schema) == ["$.o.p[*]", "$.x"]
    assert {os.path.basename(r.file): r.bad for r in files.collect()} == {"a.json": 0, "b.json": 0, "bad.json": 1, "none.json": 0}
    plan = plan_text(SRC.document_schemas(spark, path), "simple")
    assert plan.count("FileScan") == 1 and plan.count("ObjectHashAggregate") + plan.count("SortAggregate") + plan.count("HashAggregate") >= 2
    assert SRC.infer_schema(spark, write_files(f"{tmp_dir}/n", {"bad": "{"}))[0].fields == []
    df = SRC.read_json_document(spark, path)        # what disagrees is still there to read
    assert df.count() == 4


@pytest.mark.parametrize("stage", ["_stage_log_documents", "incremental_documents", "_stage_orders"])
def test_staged_documents_are_compressed(spark, tmp_path, monkeypatch, stage):
    """The multi-line reader reads plain files many times over where objects stand under string fields."""
    from unfurl import catalog
    root = f"{tmp_path}/tables"
    spark.sql("""SELECT id event_id, timestamp'2024-01-15 12:00:00' + make_interval(0, 0, 0, 0, id) ts, id user_id, 'purchase' event_type,
                 10D value, '{"k": 1}' props FROM range(40)""").write.parquet(f"{root}/events.parquet")
    spark.sql("SELECT id l_orderkey, id l_partkey, 1 l_linenumber, 2D l_quantity, 3D l_extendedprice FROM range(9)").write.parquet(f"{root}/lineitem.parquet")
    spark.sql("SELECT id o_orderkey, id o_custkey, timestamp'2024-01-15 12:00:00' o_orderdate, 'O' o_orderstatus FROM range(9)").write.parquet(f"{root}/orders.parquet")
    spark.sql("SELECT id c_custkey, 'C' c_name, 0 c_nationkey, 'M' c_mktsegment FROM range(9)").write.parquet(f"{root}/customer.parquet")
    spark.sql("SELECT 0 n_nationkey, 'N' n_name").write.parquet(f"{root}/nation.parquet")
    monkeypatch.setattr(catalog, "_stage", lambda spark, name: f"{tmp_path}/{name}")
    if stage == "_stage_orders":
        catalog._stage_orders(spark, root, nested=True)
    elif stage == "incremental_documents":
        catalog.q_incremental_documents(spark, root)
    else:
        catalog._stage_log_documents(spark, root, "log_docs", [])
    docs = glob.glob(f"{tmp_path}/**/docs/part-*", recursive=True)
    assert docs and all(f.endswith(".gz") for f in docs)


def test_compressed_documents_read_like_plain_ones(spark, tmp_dir):
    from unfurl.sources import derived as D
    df = spark.sql("SELECT cast(id % 4 as string) id, id n, named_struct('k', id, 'x', 'a \"q\"') o FROM range(500)")
    schema = "id string, n bigint, o string"
    read = lambda p: sorted(tuple(r) for r in SRC.read_json_array(spark, p, schema, recursive=True).collect())
    plain, packed = (read(D.stage_json_array(df, f"{tmp_dir}/{c}", compression=c)) for c in (None, "gzip"))
    assert plain == packed and len(plain) == 500

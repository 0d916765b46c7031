"""Registered queries against their SQL, and the pipeline against the plain versions."""

import os

import duckdb
import pytest

import corpus_pipeline
from unfurl.llm import common, queries

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE_SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(str(tuple(r[c] for c in cols)) for r in got.collect()) == \
        sorted(str(tuple(r)) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall())


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES if n not in queries.ORACLE_SQL))
def test_query_returns_every_row(spark, con, name):
    table, key = ("pages", "page_id") if any(x in name for x in ("page", "html", "warc")) else ("documents", "doc_id")
    got = queries.QUERIES[name](spark, SF)
    assert got.select(key).distinct().count() == con.sql(f"SELECT count(DISTINCT {key}) FROM {table}").fetchall()[0][0]


def run_stages(spark, docs, sf_dir):
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(spark, docs, sf_dir), name)
        out[name] = docs
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_pipeline_stages(spark):
    out = run_stages(spark, common.table(spark, SF, "documents"), SF)
    names = [n for n, _ in corpus_pipeline.STAGES]
    for n in names[:-1]:
        assert out[n].columns == out["documents"].columns and out[n].schema == out["documents"].schema
    start = rows(out["documents"])
    # language ID keeps the documents of the four languages; all texts here are in one of them
    assert sorted(rows(out[names[0]])) == sorted(start)
    want = {d: (n, gone) for d, n, gone, _ in brute.lines_kept(rows(out[names[0]]))}
    import hashlib
    sha = {d: s for d, _, _, s in brute.lines_kept(rows(out[names[0]]))}
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in rows(out[names[1]])} == sha and len(want) == len(start)
    assert all(r.n_chars == len(r.text) for r in out[names[1]].collect())
    comps = brute.linked_components(rows(out[names[1]]))
    assert sorted(d for d, _ in rows(out[names[2]])) == sorted(d for d, _, c in comps if d == c)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r[0] for r in brute.contaminated(rows(out[names[2]]), bench) if not r[5]]
    assert sorted(d for d, _ in rows(out[names[3]])) == sorted(clean)
    got = out[names[4]].collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(brute.pieces(rows(out[names[3]]), queries.tokenizer_path()))
    load = {}
    for r in got:
        load.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in load.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 2048
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect())) == \
        sorted((r.doc_id, r.piece, r.ids_crc32) for r in got)


def test_pipeline_on_odd_rows(spark, make, edge_rows, tmp_path):
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make(edge_rows + [(50 + i, f"the words of text {i} and some more of them") for i in range(30)])
    out = run_stages(spark, docs, str(tmp_path))
    # nulls, blanks and texts without letters go with the language stage; nothing else is lost before dedup
    kept = {d for d, _ in rows(out["language_id"])}
    assert {1, 2, 3, 8}.isdisjoint(kept) and {50 + i for i in range(30)} <= kept
    assert out["line_dedup"].count() == out["language_id"].count()
    assert out["best_fit_pack"].select("doc_id").distinct().count() == out["decontaminate"].select("doc_id").distinct().count()
    empty = run_stages(spark, docs.limit(0), str(tmp_path))
    assert all(df.count() == 0 for df in empty.values())

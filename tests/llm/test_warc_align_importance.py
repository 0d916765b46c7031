"""WARC source, importance resampling and cross-tokenizer alignment against plain versions."""

import gzip
import hashlib
import io
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from unfurl.llm import align, importance, queries, warc

# -- WARC ------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"
TRICKY = "<p>x</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\n" * 3 + "é\x00\t"
LONG = "<div>word &amp; more</div>\n" * 40_000


def page_rows():
    same = "the same page of a hundred bytes and more, " * 4
    return [(5, "http://a/1", same), (3, None, same), (9, "http://a/\r\nX: y é", same), (None, "http://n", same), (3, "http://again", same),
            (1, "http://s/1", "short"), (2, "http://s/2", "short"), (4, "u", None), (6, "u", ""), (7, "v", TRICKY), (8, "v", TRICKY),
            (10, "w", LONG), (None, "z", "only null ids hold this text, " * 5), (None, "z", "only null ids hold this text, " * 5),
            (11, "x", "é" * 49), (12, "x", "é" * 49), (13, "x", "é" * 50), (14, "x", "é" * 50)]


def plain_archive(rows):
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = least.get(h or "")
        again = len(raw) >= 100 and first is not None and i != first
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"fileBytes": "2000", "indexBytes": "300"}])
def test_pages_come_back(spark, tmp_path, options):
    rows = page_rows()
    df = spark.createDataFrame(rows, PAGES)
    for c in ("row", "key", "first", "digest", "payload", "a.b"):
        df = df.withColumn(c, F.lit(1))
    path = warc.write_pages(df.repartition(3), f"{tmp_path}/w", **options)
    got = warc.read_pages(spark, path)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_archive(rows)
    full = warc.read_warc(spark, path).collect()
    texts = Counter(bytes(r.payload) for r in full if r.record_type == "response")
    kept = Counter((h or "").encode() for r, h in zip(plain_archive_types(rows), [h for _, _, h in rows]) if r == "response")
    assert texts == kept
    assert all(r.payload is None and r.refers_to for r in full if r.record_type == "revisit")
    urls = {r.target_uri for r in full}
    assert "http://a/%0D%0AX: y é" in urls and None in urls


def plain_archive_types(rows):
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h] = min(i, least.get(h, i))
    return ["revisit" if len((h or "").encode()) >= 100 and least.get(h) is not None and i != least[h] else "response" for i, _, h in rows]


def test_query_equals_sql_on_repeated_pages(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i % 7} " * (i % 40)) for i in range(400)] + [(1000 + i, "u", "copy of one page " * 20) for i in range(300)]
    spark.createDataFrame(rows, PAGES).repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op11_warc(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL['op11_warc']})").fetchall()
    assert sorted(str(tuple(r[c] for c in cols)) for r in got.collect()) == sorted(map(str, want))
    assert sum(r.record_type == "revisit" for r in got.collect()) > 299


def test_hot_payload_is_spread(spark):
    # with 4 shuffle partitions a payload of 2,500 of 4,000 rows is over a task's share
    df = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                  F.when(F.col("id") < 2500, F.lit("hot " * 50)).otherwise(F.concat(F.lit("x" * 200), F.col("id"))).alias("html"))
    out = warc.page_records(df)
    assert out.where("record_type = 'revisit'").count() == 2499
    assert out.where("record_type = 'revisit'").select("refers_to").distinct().count() == 1


def test_no_pages(spark, tmp_path):
    path = warc.write_pages(spark.createDataFrame([], PAGES), f"{tmp_path}/none")
    assert warc.read_pages(spark, path).count() == 0
    assert warc.read_warc(spark, path).columns == warc.SCHEMA.names


def test_filters_are_pushed_and_hold(spark, tmp_path):
    path = warc.write_pages(spark.createDataFrame(page_rows(), PAGES), f"{tmp_path}/w")
    every = warc.read_warc(spark, path).cache()
    for test in ("record_type = 'revisit'", "record_type IN ('response', 'request')", "target_uri LIKE 'http://a/%'", "target_uri LIKE '%1'",
                 "target_uri LIKE '%a%'", "target_uri IS NULL", "refers_to IS NOT NULL", "target_uri > 'http://s'", "target_uri <= 'http://s/1'",
                 "NOT record_type = 'revisit'", "record_type <> 'response'", "refers_to <=> NULL", "payload_bytes > 100", "record_id >= '<urn'",
                 "target_uri = 'v' AND payload_bytes > 10", "target_uri = 'u' OR target_uri = 'v'"):
        got = warc.read_warc(spark, path, ["record_id", "record_type", "target_uri", "refers_to", "payload_bytes"]).where(test)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, every.where(test).select(*got.columns).collect())), test
    plan = plan_text(warc.read_warc(spark, path, ["record_id", "record_type"]).where("record_type = 'revisit'"))
    assert "PushedFilters: [IsNotNull(record_type), EqualTo(record_type,revisit)]" in plan and "Filter (" not in plan
    assert "payload" not in plan


class Counted(io.BytesIO):
    """A file that counts the bytes read from it."""
    seen = 0

    def size(self):
        return len(self.getvalue())

    def read(self, n=-1):
        out = super().read(n)
        self.seen += len(out)
        return out


def noisy(n, size):
    rng = random.Random(5)
    return [{"record_type": "response" if i % 20 == 0 else "resource", "record_id": f"<urn:x:{i}>", "payload": rng.randbytes(size)} for i in range(n)]


@pytest.mark.parametrize("packed", [True, False])
def test_unwanted_payloads_are_passed_over(packed):
    rows = noisy(40, 3 << 20 if packed else 2 << 20)
    data = b"".join(warc.gzip_member(warc.record(r), 1) if packed else warc.record(r) for r in rows)
    handle = Counted(data)
    want = warc.Wanted(["record_id", "payload"], [("record_type", "is", "response")])
    got = list(warc.scan_file(handle, "x.warc.gz" if packed else "x.warc", 0, None, want))
    assert [r[0] for r in got] == ["<urn:x:0>", "<urn:x:20>"] and [r[1] for r in got] == [rows[0]["payload"], rows[20]["payload"]]
    assert handle.seen < len(data) / 3
    handle = Counted(data)
    assert len(list(warc.scan_file(handle, "x.warc.gz" if packed else "x.warc", 0, None, warc.Wanted(["record_id"])))) == 40
    assert handle.seen < len(data) / 4


def test_archives_of_others():
    """Members without a length, several records a file, folded and oddly cased headers, no HTTP block."""
    one = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <a>\r\nX-Long: one\r\n two\r\ncontent-length: 5\r\n\r\nhello\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <b>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 21\r\n\r\nHTTP/1.0 200 OK\r\n\r\nab\r\n\r\n"
    columns = ["record_type", "record_id", "headers", "payload", "payload_bytes"]
    for data, name in ((one + two, "x.warc"), (gzip.compress(one) + gzip.compress(two), "x.warc.gz")):
        got = list(warc.scan_file(Counted(data), name, 0, None, warc.Wanted(columns)))
        assert [(r[0], r[1], r[3], r[4]) for r in got] == [("warcinfo", "<a>", b"hello", 5), ("response", "<b>", b"ab", 2)]
        assert got[0][2]["X-Long"] == "one two"
    with pytest.raises(ValueError, match="cut off"):
        list(warc.scan_file(Counted((one + two)[:-12]), "x.warc", 0, None, warc.Wanted(["payload"])))
    with pytest.raises(ValueError, match="no record at byte"):
        list(warc.scan_file(Counted(b"plain text\r\n\r\n"), "x.warc", 0, None, warc.Wanted(["payload"])))


def test_partitions_cut_at_records_and_read_once(spark, tmp_path):
    rows = spark.range(500).select(F.concat(F.lit("<urn:x:"), "id", F.lit(">")).alias("record_id"), F.lit("resource").alias("record_type"),
                                   F.repeat(F.lit("word "), 300).cast("binary").alias("payload")).coalesce(1)
    path = f"{tmp_path}/w"
    warc.write_warc(rows, path, compression="none", indexBytes="5000")
    got = warc.read_warc(spark, path, ["record_id"], splitBytes="100000")
    assert got.rdd.getNumPartitions() > 5
    assert got.count() == got.distinct().count() == 500


def test_only_committed_files_are_read(spark, tmp_path):
    path = f"{tmp_path}/w"
    df = spark.createDataFrame([("resource", "<a>", b"one")], "record_type string, record_id string, payload binary")
    warc.write_warc(df, path)
    with open(f"{path}/part-left-behind.warc", "wb") as f:      # of a task that was lost before the commit
        f.write(warc.record({"record_type": "resource", "record_id": "<lost>"}))
    ids = lambda: sorted(r.record_id for r in warc.read_warc(spark, path, ["record_id"]).collect())
    assert ids() == ["<a>"]
    warc.write_warc(df.withColumn("record_id", F.lit("<b>")), path)
    assert ids() == ["<a>", "<b>"]
    warc.write_warc(df.withColumn("record_id", F.lit("<c>")), path, mode="overwrite")
    assert ids() == ["<c>"]


def test_wrong_digest_fails(spark, tmp_path):
    df = spark.createDataFrame([("response", "<urn:page:1:0123456789abcdef>", "sha256:00", b"one")],
                               "record_type string, record_id string, payload_digest string, payload binary")
    warc.write_warc(df, f"{tmp_path}/w")
    with pytest.raises(Exception, match="payload differs"):
        warc.read_pages(spark, f"{tmp_path}/w").collect()


# -- importance resampling -------------------------------------------------------------------

def plain_words(text):
    out, now = [], bytearray()
    for b in (text or "").encode() + b" ":
        b = b + 32 if 65 <= b <= 90 else b
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            now.append(b)
        elif now:
            out.append(bytes(now))
            now = bytearray()
    return out


def plain_buckets(text, m=10_000):
    w = plain_words(text)
    return [zlib.crc32(b" ".join(w[i:i + n])) % m for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain_draw(docs, target, how=importance.Sampling()):
    each = [plain_buckets(t) for _, t in docs]
    s, t = Counter(b for e in each for b in e), Counter(b for x in target for b in plain_buckets(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in s}
    rows = []
    for (d, text), e in zip(docs, each):
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in e)
        rows.append([d, len(e), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text)), None])
    able = sorted((r for r in rows if r[4] >= how.min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:how.percent * len(able) // 100], 1):
        r[5] = k
    return sorted(str((*r[:4], r[5])) for r in rows)


def test_crcs_of_all_ngrams():
    texts = [b"Hello, World foo-bar \xc3\xa9t\xc3\xa9 baz", b"", b"...", b"x" * 200 + b" y " + b"q" * 70_000 + b" z", b"one", b"a b c"]
    n, found = importance.feature_crcs(texts, 4)
    assert n.tolist() == [len(plain_words(t.decode())) for t in texts]
    for size, (owner, crc) in enumerate(found, 1):
        want = [(i, zlib.crc32(b" ".join(w[j:j + size]))) for i, w in enumerate(plain_words(t.decode()) for t in texts) for j in range(len(w) - size + 1)]
        assert list(zip(owner.tolist(), crc.tolist())) == want
    assert [len(c) for _, c in importance.feature_crcs([b"", b"!"], 3)[1]] == [0, 0, 0]


def test_shift_cancels_any_prefix():
    rng = random.Random(3)
    for _ in range(200):
        a, b = rng.randbytes(rng.randrange(300)), rng.randbytes(rng.choice([0, 1, 5, 63, 64, 65, 127, 128, 1000, 5000]))
        moved = int(importance.shift(np.array([zlib.crc32(a)]), np.array([len(b)]))[0])
        assert zlib.crc32(a + b) ^ moved == zlib.crc32(b)


def draw_rows(edge_rows):
    rng = random.Random(1)
    some = [(100 + i, " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(rng.randrange(15, 60))))
            for i in range(120)]
    return edge_rows + some + [(100, some[0][1]), (None, some[1][1])]


def test_draw_matches_plain(spark, make, edge_rows):
    rows = draw_rows(edge_rows)
    target = ["alpha beta gamma and so on", None, "", "kappa KAPPA kappa"]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.importance_scores(make(rows).repartition(5), bench)
    assert got.columns == ["doc", "n_words", "n_features", "weight", "score", "rank"]
    found = got.collect()
    assert sorted(str((r.doc, r.n_features, r.weight, r.score, r["rank"])) for r in found) == plain_draw(rows, target)
    drawn = importance.resample(make(rows), bench)
    assert drawn.columns == make(rows).columns
    text = {i: t for i, t in rows}
    ids = Counter(r.doc for r in found if r["rank"] is not None)
    assert Counter(r.doc_id for r in drawn.collect()) >= ids and all(text[r.doc_id] == r.text for r in drawn.collect())


def test_draw_of_few_and_none(spark, make):
    bench = spark.createDataFrame([], "text string")
    few = make([(1, "a " * 30), (2, "b")])
    assert sorted(str((r.doc, r["rank"])) for r in importance.importance_scores(few, bench).collect()) == ["(1, None)", "(2, None)"]
    assert importance.importance_scores(make([(1, "x")]).limit(0), bench).count() == 0
    assert importance.resample(few, bench).count() == 0


def test_equal_rows_have_adjoining_ranks(spark, make):
    rows = [(7, "same words in every row " * 6)] * 400
    got = importance.importance_scores(make(rows), spark.createDataFrame([("same words",)], "text string"))
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 21))


# -- alignment --------------------------------------------------------------------------------

A, B = queries.tokenizer_path(), queries.tokenizer_path(queries.PIECES)


@pytest.fixture(scope="module")
def plain_tokens():
    """Ids and bytes of a text's tokens by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(byte[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode())
             for i, p in ((i, second.id_to_piece(i)) for i in second.encode(text))]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == whole else ([], [])
    return tokens


def plain_alignment(docs, tokens):
    rows, count = [], Counter()
    for d, text in docs:
        a, b = tokens(text)
        ends = []
        for side in (a, b):
            at, mine = 0, {}
            for k, (_, x) in enumerate(side):
                at += len(x)
                mine[at] = k
            ends.append(mine)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(a[ends[0][c]][0], b[ends[1][c]][0]) for c in cuts]
        count.update(links)
        groups, x, y = [], 0, 0
        for c in cuts:
            p, q = ends[0][c] + 1, ends[1][c] + 1
            groups.append(",".join(str(i) for i, _ in a[x:p]) + "|" + ",".join(str(i) for i, _ in b[y:q]))
            x, y = p, q
        rows.append((d, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(str((d, na, nb, g, len(ls), sum(count[x] == most[x[1]] for x in ls), sum(count[x] for x in ls), sha)) for d, na, nb, g, ls, sha in rows)


COLUMNS = ["doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [(60, "<|endoftext|> and </s> <s> <unk> <0x41>"), (61, "a▁b"), (62, " leading, two  blanks and a tail "), (63, "\ttab\nline\r\n  end\n"),
       (64, "日本語のテキスト 🙂🙂 ﬁ① Å"), (65, "don't   stop"), (66, "x" * 3000), (67, "0x1F600 \x00 nul"), (68, " "), (69, "   ")]


def test_alignment_matches_plain(spark, make, edge_rows, plain_tokens):
    rows = edge_rows + ODD + [(70 + i, f"the words of text {i} and some more of them, it's {i * 7919}") for i in range(60)]
    got = align.cross_align(make(rows).repartition(3), A, B)
    assert got.columns == COLUMNS
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_alignment(rows, plain_tokens)
    # chunks of a few documents each: the same result
    small = align.cross_align(make(rows), A, B, how=align.Chunking(chunk_bytes=500, slice_bytes=200))
    assert sorted(str(tuple(r)) for r in small.collect()) == plain_alignment(rows, plain_tokens)


def test_alignment_query_matches_plain(spark, plain_tokens):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op13_align(spark, sf)
    assert sorted(str(tuple(r[c] for c in ["doc_id", *COLUMNS[1:]])) for r in got.collect()) == plain_alignment(rows, plain_tokens)


def test_no_documents_to_align(spark, make):
    assert align.cross_align(make([(1, "x")]).limit(0), A, B).count() == 0
    only_null = align.cross_align(make([(1, None), (None, "")]), A, B).collect()
    assert sorted(str(tuple(r)) for r in only_null) == ["(1, 0, 0, 0, 0, 0, 0, '')", "(None, 0, 0, 0, 0, 0, 0, '')"]


def test_common_ends_of_any_arrays():
    rng = random.Random(2)
    for _ in range(500):
        x = sorted(rng.sample(range(1, 300), rng.randrange(0, 120)))
        y = [e for e in x if rng.random() < .95] if rng.random() < .5 else sorted(rng.sample(range(1, 300), rng.randrange(0, 120)))
        x, y = [*x, 300], [*y, 300]
        at = {e: i for i, e in enumerate(x)}
        a, b = align.common_ends(x, y)
        assert list(zip(a.tolist(), b.tolist())) == [(at[e], j) for j, e in enumerate(y) if e in at]
    assert align.common_ends([], [])[0].tolist() == []

"""Line dedup, SimHash, decontamination, packing, quality rules against the plain versions."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unfurl.llm import common, decontaminate, line_dedup, packing, quality_rules, queries, simhash

from . import brute

WORDS = "the of and tion ing er re on at en blue green Red ÉTÉ straße 12 x-y".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice("abcdefg") if rng.random() < 0.5 else "") for _ in range(n))


@pytest.fixture()
def corpus(edge_rows):
    rng = random.Random(5)
    shared = [prose(rng, 12) for _ in range(6)]
    rows = []
    for d in range(10, 90):
        lines = [prose(rng, rng.randint(1, 14)) for _ in range(rng.randint(1, 6))]
        for s in rng.sample(shared, rng.randint(0, 3)):
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(["", "  "]) + (s.upper() if rng.random() < 0.3 else s) + rng.choice(["", "\t"]))
        rows.append((d, "\n".join(lines)))
    base = prose(rng, 300).split()
    for d in range(100, 160):       # near copies
        w = list(base)
        for _ in range(d % 7):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((d, " ".join(w)))
    return edge_rows + rows + [(200, rows[0][1]), (201, rows[1][1])]


def _lines(spark, make, rows):
    docs = make(rows)
    out = T.StructType([T.StructField("_kept", T.StringType()), T.StructField("_n", T.LongType()), T.StructField("_dropped", T.LongType())])

    def show(keep, texts):
        got = [line_dedup.kept_lines(k, t) for k, t in zip(keep.to_pylist(), common.text_bytes(texts))]
        return [[g[0].decode() for g in got], [g[1] for g in got], [g[2] for g in got]]

    df = line_dedup.apply_bitmaps(docs, line_dedup.line_dedup(docs), out, show, [])
    return sorted(((r.doc_id, r._n, r._dropped, r.sha) for r in df.withColumn("sha", F.sha2("_kept", 256)).collect()), key=str)


def test_line_dedup(spark, make, corpus):
    assert _lines(spark, make, corpus) == sorted(brute.lines_kept(corpus), key=str)


def test_line_dedup_hot_line_over_partitions(spark, make):
    # one line in all documents, dealt over many partitions; ids repeat
    line = "this very line is found in every document"
    rows = [(i // 2 if i % 5 == 0 else i, f"{line}\nown {i} line of the document {i}\n {line.upper()} ") for i in range(3000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 37)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _lines(spark, make, rows) == sorted(brute.lines_kept(rows), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_line_dedup_stage_keeps_rows_and_columns(spark, make, corpus):
    docs = make(corpus)
    got = line_dedup.drop_repeated_lines(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    rows = got.collect()
    assert len(rows) == len(corpus)
    assert all((r.text is None and r.n_chars is None) or r.n_chars == len(r.text) for r in rows)


def test_simhash(spark, make, corpus):
    got = sorted(((r.doc, f"{r.fp % (1 << 64):016x}", r.component) for r in simhash.simhash_components(make(corpus)).collect()), key=str)
    assert got == brute.linked_components(corpus)
    assert len({c for d, _, c in got if d and d >= 100 and d < 160}) < 40      # near copies are linked


def test_simhash_hot_buckets_are_cut_anew(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {base} | {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(700)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.root for r in common.components(simhash.links(df, 3, bucket=16)).collect()}
    want = {}
    for f in fps:
        want[f] = f

    def find(x):
        while want[x] != x:
            x = want[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                x, y = find(a), find(b)
                want[max(x, y)] = min(x, y)
    assert {f: got.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_components_of_long_chain(spark):
    n = 200
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(ids[i], ids[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in common.components(df).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def test_near_duplicate_stage(spark, make, corpus):
    docs = make(corpus)
    kept = sorted((r.doc_id for r in simhash.drop_near_duplicates(docs).collect()), key=str)
    want = sorted((d for d, _, c in brute.linked_components(corpus) if d is None or d == c), key=str)
    assert kept == want


@pytest.mark.parametrize("block", [16 << 20, 60])
def test_decontaminate(spark, make, corpus, block):
    rng = random.Random(9)
    items = [(i, prose(rng, n)) for i, n in enumerate([4, 9, 10, 25, 40, 60])] + [(10, None), (11, ""), (12, "!!"), (None, prose(rng, 12)), (3, prose(rng, 11))]
    rows = list(corpus)
    for k, (i, t) in enumerate(items):
        if t:
            w = t.split()
            a = rng.randrange(max(1, len(w) - 14))
            rows.append((300 + k, prose(rng, 20) + " " + " ".join(w[a:a + 15]).upper() + "! " + prose(rng, 5) + " " + t))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.match(make(rows), bench, block_bytes=block, shard_bytes=20_000).select(
        "doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.concat_ws(",", "items"), 256).alias("sha"),
        (F.col("n_hit") > 0).alias("hit2"), "longest", "longest_start").collect()
    want = brute.contaminated(rows, items)
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert {r.doc_id: r.longest for r in got}[304] == len(decontaminate.words(items[4][1].encode()))     # the whole item, after a piece of it
    clean = decontaminate.match(make(rows), bench, block_bytes=block, clean_only=True)
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((w[0] for w in want if not w[5]), key=str)


def test_decontaminate_holds_one_block(spark, make, monkeypatch):
    # copies of one passage in many blocks: same findings as with one block, and no two blocks at once
    from pyspark import Broadcast, SparkContext
    rng = random.Random(12)
    shared, other = prose(rng, 14), prose(rng, 30)
    items = [(f"i{k}", f"{shared} {prose(rng, 3)}") for k in range(12)] + [("x", other), ("x", other)]
    docs = make([(1, f"{prose(rng, 5)} {shared}"), (2, other), (3, prose(rng, 40)), (4, None), (1, f"{shared} {other}")])
    bench = spark.createDataFrame(items, "item_id string, text string")
    columns = ["doc_id", "n_words", "n_hit", F.concat_ws(",", "items").alias("items"), "longest", "longest_item", "longest_start"]
    want = sorted(decontaminate.match(docs, bench).select(*columns).collect(), key=str)
    alive, most = set(), []
    send, destroy = SparkContext.broadcast, Broadcast.destroy

    def sending(self, value):
        out = send(self, value)
        alive.add(id(out))
        most.append(len(alive))
        return out

    def destroying(self, *args, **kw):
        alive.discard(id(self))
        destroy(self, *args, **kw)

    monkeypatch.setattr(SparkContext, "broadcast", sending)
    monkeypatch.setattr(Broadcast, "destroy", destroying)
    got = sorted(decontaminate.match(docs, bench, block_bytes=400).select(*columns).collect(), key=str)
    assert got == want and len(most) > 2 and max(most) == 1 and not alive
    n = len(decontaminate.words(shared.encode()))
    assert {r.longest_item for r in got if r.longest == n} == {"i0"}
    clean = decontaminate.match(docs, bench, block_bytes=400, clean_only=True)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4]


def test_packing(spark, make, corpus):
    docs = make(corpus)
    path = queries.tokenizer_path()
    got = packing.pack(docs, path, window=40).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(brute.pieces(corpus, path), key=str)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_tokenizer_chunks_equal_whole_texts():
    rng = random.Random(2)
    alphabet = [" ", " ", "\n", "\t", "a", "B", "é", "'s", "'ll", "1", "23", "!", "…", " ", "　", "中", "<|endoftext|>", "\r\n", "_"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    tok = packing.ByteLevelTokenizer(queries.tokenizer_path())
    assert tok.encode(texts) == tok.whole(texts)


def test_best_fit_capacities():
    rng = random.Random(4)
    for rule in ("residual", "dot"):
        for cap in (packing.Capacity(rule=rule), packing.Capacity(100, 3, 5000, rule=rule), packing.Capacity(64, 64, 900, (1, 1, 1), rule)):
            lengths = [rng.randint(1, min(cap.tokens, int(cap.attention ** 0.5))) for _ in range(600)]
            placed = packing.best_fit(lengths, cap)
            load = {}
            for n, (seq, off) in zip(lengths, placed):
                load.setdefault(seq, []).append((off, n))
            for parts in load.values():
                parts.sort()
                assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
                assert sum(n for _, n in parts) <= cap.tokens and len(parts) <= cap.documents and sum(n * n for _, n in parts) <= cap.attention
            if cap.documents >= 2048 and rule == "residual":
                assert len(load) <= sum(lengths) / cap.tokens * 1.02 + 1


def test_best_fit_picks_the_best_of_all():
    # against a scan of all open sequences
    rng = random.Random(8)
    cap = packing.Capacity(50, 4, 900, (1.0, 0.5, 0.5))
    lengths = [rng.randint(1, 30) for _ in range(200)]
    state, want = [], [None] * len(lengths)
    w = [a / c ** 2 for a, c in zip(cap.weights, (cap.tokens, cap.documents, cap.attention))]
    for i in sorted(range(200), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fits = [(w[0] * (t - n) ** 2 + w[1] * (d - 1) ** 2 + w[2] * (a - n * n) ** 2, k)
                for k, (t, d, a) in enumerate(state) if t >= n and d >= 1 and a >= n * n]
        k = min(fits)[1] if fits else len(state)
        if not fits:
            state.append((cap.tokens, cap.documents, cap.attention))
        t, d, a = state[k]
        want[i] = (k, cap.tokens - t)
        state[k] = (t - n, d - 1, a - n * n)
    assert packing.best_fit(lengths, cap) == want


def test_quality_base(spark, make, corpus):
    got = quality_rules.quality_rules(make(corpus)).collect()
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(brute.quality(corpus), key=str)


def plain_kept(rows, max_docs=20, left=0.3):
    """The method by itself: lines in texts of a host, words lost, depleted documents."""
    held = {}
    lines = lambda t: [" ".join(x.lower().split()) for x in t.split("\n") if x.split()]
    for _, t, h in rows:
        for k in set(lines(t)):
            held.setdefault((h, k), set()).add(t)
    out = {}
    for d, t, h in rows:
        own = lines(t)
        n = sum(len(k.split()) for k in own)
        lost = sum(len(k.split()) for k in own if len(held[h, k]) > max_docs)
        out[d] = (lost, not n - lost < left * n)
    return out


def test_quality_depleted(spark):
    """Repeated passages: documents that are little else go, whatever the size of the host; others stay."""
    rng = random.Random(6)
    notice, passage, licence = prose(rng, 40), prose(rng, 55), prose(rng, 12)
    own = lambda i, n: " ".join(f"own{i}x{k}" for k in range(n))
    rows = [(i, f"{notice.upper()}\n {passage}\n{own(i, 5)}", "small") for i in range(22)]                # depleted, a host of few
    rows += [(100 + i, f"{own(i, 80)}\n{licence}", "large") for i in range(1500)]                         # clean: one short line in all
    rows += [(2000 + i, f"{notice}\n{passage}\n{own(i, 6)}", "large") for i in range(30)]                 # depleted, 2 % of the host
    rows += [(3000 + i, f"{passage}\n{own(i, 90)}", "large") for i in range(30)]                           # the passage in a longer text
    rows += [(4000 + i, f"{own(0, 60)}\n{own(1, 60)}", "copies") for i in range(50)]                       # fifty copies of one text
    rows += [(5000 + i, f"{notice}\n{passage}", f"host{i}") for i in range(40)]                            # one a host
    rows += [(6000 + i, f"{notice}\n{passage} {own(i, 3)}", "twenty") for i in range(20)]                  # at the limit, not above it
    df = spark.createDataFrame([(i, t, "en", h, 0) for i, t, h in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc: r for r in quality_rules.quality_rules(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {d: (r.n_frequent_words, r.kept) for d, r in got.items()} == plain_kept(rows)
    assert {d for d, r in got.items() if not r.kept} == {*range(22), *range(2000, 2030)}


def test_empty_tables(spark, make):
    docs = make([(1, "x")]).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert line_dedup.line_dedup(docs).count() == 0
    assert simhash.simhash_components(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0
    assert decontaminate.match(docs, bench).count() == 0
    assert decontaminate.match(make([(1, "x y")]), bench).first().n_hit == 0
    assert packing.pack(docs, queries.tokenizer_path()).count() == 0
    assert quality_rules.quality_rules(docs).count() == 0


def test_simhash_variants_are_not_broadcast(spark, monkeypatch):
    """64 rows a fingerprint, of which Spark's size estimate knows nothing."""
    from tests.conftest import plan_text
    plans, plain = {}, simhash.common.stage

    def staged(df, name):
        plans[name] = plan_text(df, "simple")
        return plain(df, name)

    monkeypatch.setattr(simhash.common, "stage", staged)
    fps = spark.createDataFrame([(x,) for x in (0, 1, 3, 1 << 40)], "fp long")
    assert len(simhash.links(fps).collect()) >= 2
    assert "SortMergeJoin" in plans["variants"] and "Broadcast" not in plans["variants"]


def test_simhash_small_tables_take_few_tasks(spark, make, corpus, monkeypatch):
    """However many shuffle partitions there are, a few rows are not written by as many tasks."""
    files, plain = {}, simhash.common.stage

    def staged(df, name):
        out = plain(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(simhash.common, "stage", staged)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 37)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = simhash.simhash_components(make(corpus))
        got = sorted(((r.doc, f"{r.fp % (1 << 64):016x}", r.component) for r in out.collect()), key=str)
        assert out.rdd.getNumPartitions() <= 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == brute.linked_components(corpus)
    assert {n: k for n, k in files.items() if n != "fingerprints" and k > 4} == {}

"""Secret scan: three base patterns, and strings that pass for random in their encoding.

DataFrame functions only. Candidates (long runs of encoding characters) get the smallest
standard encoding that holds them and a battery of tests of the hypothesis "drawn uniformly
from its alphabet": chi-squared over the symbols and over their classes (capitals, small
letters, the rest), runs above and below the middle of the alphabet, and lag-1 serial
correlation. The smallest p-value counts, times their number, as the tests are not independent. Within each encoding and
length class a Benjamini-Hochberg step, on counts over all documents, decides which
candidates are no random strings; those that remain and carry enough bits are reported.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: fixed values: base patterns, their kinds in reporting order, and the groups whose length counts
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"        # the whole run of 20 or more: shorter runs hold no such match
HEX = r"[0-9a-f]{24,}"
#: fixed values: the encodings' alphabets
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: encodings written in letters of one case, either one: tested in lower case
ONE_CASE = ("hex", "base32", "base36")
BINS = 120
#: degrees of freedom with the skewness that the symbols' statistic has over these alphabets and lengths
SKEW_DF = 12.5


@dataclass(frozen=True)
class Battery:
    """``min_chars`` of a candidate, false-discovery rate ``fdr`` of "not random" per class
    (encoding and power of two of the length), and the bits a reported string must carry."""

    min_chars: int = 20
    fdr: float = 0.01
    min_bits: int = 80
    assign_chars: int = 6


def _found(text: Column, pattern: str, value: int = 0) -> Column:
    """(gap before, characters, value) of each match; text is only split where one is."""
    gaps, hits = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    # split leaves one piece more than there are matches
    rows = F.zip_with(F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("n"))),
                      values, lambda a, v: F.struct(a["gap"].alias("gap"), a["n"].alias("n"), v.alias("value")))
    return F.when(text.rlike(pattern), rows)


def candidates(docs: DataFrame, id_col: str, text_col: str, how: Battery) -> DataFrame:
    """rid, doc, hits: all matches of all kinds as arrays inside the row."""
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    token = "[A-Za-z0-9+/_-]{%d,}={0,2}" % how.min_chars
    text = F.col("text")
    return d.select("rid", "doc", _found(text, ASSIGN, 2).alias("k0"), _found(text, ACCESS).alias("k1"),
                    _found(text, HEX).alias("k2"), _found(text, token).alias("k3"))


def _placed(found: DataFrame, how: Battery) -> DataFrame:
    """rid, kind (number), start, end, value of the matches that count."""
    out = None
    for k in range(4):
        rows = found.where(F.col(f"k{k}").isNotNull()).select("rid", F.posexplode(f"k{k}"))
        rows = rows.select("rid", F.lit(k).alias("kind"), "pos", "col.*")
        out = rows if out is None else out.union(rows)
    w = Window.partitionBy("rid", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("n")).over(w))
    return (out.where((F.col("kind") != 0) | (F.length("value") >= how.assign_chars))
            .select("rid", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "value"))


def encoding(token: Column) -> Column:
    """The smallest standard encoding that holds a token (padding cut off); null if none does.

    Digits alone are a number; letters of one case with digits are hex, base32 or base36;
    letters of one case alone are tested as base62, which they do not fill.
    """
    return (F.when(token.rlike("^[0-9]*$"), F.lit(None).cast("string"))
            .when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$") & token.rlike("[0-9]"), "hex")
            .when(token.rlike("^([A-Z2-7]+|[a-z2-7]+)$") & token.rlike("[2-7]"), "base32")
            .when(token.rlike("^([A-Z0-9]+|[a-z0-9]+)$") & token.rlike("[0-9]"), "base36")
            .when(token.rlike("^[A-Za-z0-9]+$"), "base62")
            .when(token.rlike("^[A-Za-z0-9+/]+$"), "base64")
            .when(token.rlike("^[A-Za-z0-9_-]+$"), "base64url"))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation, error below 0.0002)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(F.lit(600.0), F.lit(1.5976) * z + F.lit(0.07056) * z * z * z)))


def tested(tokens: DataFrame, how: Battery) -> DataFrame:
    """The rows of ``tokens`` (value) that have an encoding, with enc, len, bin of the combined p-value, strong."""
    t = tokens.withColumn("token", F.regexp_replace("value", "=+$", "")).withColumn("enc", encoding(F.col("token")))
    t = t.where(F.col("enc").isNotNull())
    alphabet = size = None
    for name, a in ALPHABETS.items():
        alphabet = F.when(F.col("enc") == name, F.lit(a)) if alphabet is None else alphabet.when(F.col("enc") == name, F.lit(a))
        size = F.when(F.col("enc") == name, F.lit(float(len(a)))) if size is None else size.when(F.col("enc") == name, F.lit(float(len(a))))
    same = F.when(F.col("enc").isin(*ONE_CASE), F.lower("token")).otherwise(F.col("token"))
    t = t.withColumns({"k": size, "alphabet": alphabet, "len": F.length("token")})
    t = t.withColumn("x", F.transform(F.split(same, ""), lambda c: (F.position(c, F.col("alphabet")) - 1).cast("double")))
    t = t.withColumn("sorted", F.sort_array("x"))
    n, k, x, s = F.col("len").cast("double"), F.col("k"), F.col("x"), F.col("sorted")
    zero = F.lit(0.0)
    # sum of squared counts: each symbol adds twice its rank among its equals, less one
    squares = F.aggregate(s, F.struct(zero.alias("sum"), zero.alias("rank"), F.lit(-1.0).alias("last")), lambda a, v: F.struct(
        (a["sum"] + 2.0 * F.when(v == a["last"], a["rank"] + 1.0).otherwise(1.0) - 1.0).alias("sum"),
        F.when(v == a["last"], a["rank"] + 1.0).otherwise(1.0).alias("rank"), v.alias("last")), lambda a: a["sum"])
    mid = (k - 1.0) / 2.0
    runs = F.aggregate(F.transform(x, lambda v, i: F.when((i > 0) & ((v > mid) != (x[i - 1] > mid)), 1.0).otherwise(0.0)), F.lit(1.0), lambda a, v: a + v)
    lag = F.aggregate(F.transform(x, lambda v, i: F.when(i > 0, (v - mid) * (x[i - 1] - mid)).otherwise(0.0)), zero, lambda a, v: a + v)
    t = t.withColumns({"squares": squares, "runs": runs, "lag": lag, "same": same,
                       "up": n - F.length(F.regexp_replace(same, "[A-Z]", "")), "low": n - F.length(F.regexp_replace(same, "[a-z]", ""))})
    up, low = F.col("up"), F.col("low")
    chi = (k / n * F.col("squares") - n - (k - 1.0)) / F.sqrt(2.0 * (k - 1.0) * (n - 1.0) / n)
    run = (F.col("runs") - 1.0 - (n - 1.0) / 2.0) / F.sqrt((n - 1.0) / 4.0)
    ser = F.col("lag") / ((k * k - 1.0) / 12.0) / F.sqrt(n - 1.0)
    # the statistic is skewed to the right: its tail is that of a chi-squared one with SKEW_DF
    # degrees of freedom (Wilson and Hilferty's cube root)
    y = F.greatest(zero, 1.0 + chi * math.sqrt(2 / SKEW_DF))
    chi = (F.pow(y, F.lit(1 / 3)) - (1 - 2 / (9 * SKEW_DF))) / math.sqrt(2 / (9 * SKEW_DF))
    e1, e2 = n * 26.0 / k, n * (k - 52.0) / k
    three = F.exp(-((up - e1) * (up - e1) / e1 + (low - e1) * (low - e1) / e1 + (n - up - low - e2) * (n - up - low - e2) / e2) / 2.0)
    letters = F.least(F.lit(26.0), k - 10.0)        # hex has six, base32 twenty-six of 32
    part = F.when(k == 32.0, 26.0 / 32.0).otherwise(letters / k)
    two = 2.0 * _tail(F.abs(up + low - n * part) / F.sqrt(n * part * (1.0 - part)))
    least = F.least(_tail(F.greatest(F.lit(-8.0), chi)), F.when(k > 36.0, three).otherwise(two), 2.0 * _tail(F.abs(run)), 2.0 * _tail(F.abs(ser)))
    minus_log_p = -F.log(F.greatest(F.lit(1e-12), least) * 4.0)
    return t.withColumns({"bin": F.least(F.lit(BINS), F.floor(F.round(F.greatest(zero, minus_log_p), 6) * 4.0)).cast("int"),
                          "class": F.floor(F.log2(n)).cast("int"), "strong": n * F.log2(k) >= how.min_bits}) \
            .drop("k", "alphabet", "x", "sorted", "squares", "runs", "lag", "same", "up", "low", "token")


def rejected_from(tokens: DataFrame, fdr: float) -> DataFrame:
    """enc, class, cut: from this bin of the p-value on, candidates are not random (null: none).

    Benjamini-Hochberg over a histogram: at most encodings x lengths' powers of two x BINS rows.
    """
    hist = tokens.groupBy("enc", "class", "bin").agg(F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy("enc", "class")
    above = over.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumns({"k": F.sum("n").over(above), "m": F.sum("n").over(over)})
    ok = F.exp(-F.col("bin") / 4.0) * F.col("m") <= F.lit(fdr) * F.col("k")     # the largest p-value of the bin
    return hist.groupBy("enc", "class").agg(F.min(F.when(ok, F.col("bin"))).alias("cut"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Battery = Battery()) -> DataFrame:
    """doc, n_assign, n_access, n_hex, base, spans: one row per row of ``docs``.

    ``base`` and ``spans`` are arrays of (start, kind, end), by start, then kind; positions are
    code points of the text, ends exclusive. A span is the whole match, for assignments with
    the name. Random strings that overlap a base span are not added. A null or empty text has
    no spans; repeated rows have equal ones; an empty table gives no rows.
    """
    found = common.stage(candidates(docs, id_col, text_col, how), "candidates")
    placed = common.stage(_placed(found, how), "placed")
    # base spans that begin before a candidate's end: does one of them end after its start?
    w = Window.partitionBy("rid").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    base_end = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(w)
    free = (placed.withColumn("at", F.when(F.col("kind") < 3, F.col("start")).otherwise(F.col("end") - 1))
            .withColumn("covered", base_end).where("kind = 3 and (covered is null or covered <= start)"))
    tokens = common.stage(tested(free.select("rid", "kind", "start", "end", "value"), how), "tokens")
    cuts = rejected_from(tokens, how.fdr)       # a few hundred rows, whatever the input
    random = (tokens.join(F.broadcast(cuts), ["enc", "class"])
              .where("strong and (cut is null or bin < cut)").select("rid", "kind", "start", "end"))
    spans = placed.where("kind < 3").select("rid", "kind", "start", "end").union(random)
    listed = spans.groupBy("rid").agg(
        *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{KINDS[i]}") for i in range(3)],
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))     # of one document
    out = found.select("rid", "doc").join(listed, "rid", "left")
    counts = [F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS[:3]]
    none = F.array().cast(listed.schema["spans"].dataType)
    return (out.select("doc", *counts, F.coalesce("spans", none).alias("spans"))
            .withColumn("base", F.filter("spans", lambda s: s["kind"] < 3)))


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sql(how: Battery = Battery()) -> str:
    """The contract's columns over ``documents`` in DuckDB SQL."""
    patterns = (ASSIGN, ACCESS, HEX, "[A-Za-z0-9+/_-]{%d,}={0,2}" % how.min_chars)
    matches = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS kind, unnest(range(1, len(h) + 1)) AS pos, g, h, v FROM (SELECT doc_id, "
        f"string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}', 0) AS h, regexp_extract_all(text, '{p}', {2 if k == 0 else 0}) AS v FROM d)"
        for k, p in enumerate(q.replace("'", "''") for q in patterns))
    alphabet = " ".join(f"WHEN '{n}' THEN '{a}'" for n, a in ALPHABETS.items())
    tail = "(1.0 / (1.0 + exp(least(600.0, 1.5976 * {z} + 0.07056 * {z} * {z} * {z}))))"
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({matches}),
e AS (SELECT doc_id, kind, v[pos] AS value, length(h[pos]) AS n,
             sum(length(g[pos]) + length(h[pos])) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS stop FROM m),
p AS (SELECT doc_id, kind, stop - n AS start, stop, value FROM e WHERE kind <> 0 OR length(value) >= {how.assign_chars}),
t AS (SELECT row_number() OVER () AS id, doc_id, start, stop, regexp_replace(value, '=+$', '') AS token FROM p c
      WHERE kind = 3 AND NOT EXISTS (SELECT 1 FROM p b WHERE b.doc_id = c.doc_id AND b.kind < 3 AND b.start < c.stop AND b.stop > c.start)),
c AS (SELECT *, CASE WHEN regexp_matches(token, '^[0-9]*$') THEN NULL
                     WHEN regexp_matches(token, '^([0-9a-f]+|[0-9A-F]+)$') AND regexp_matches(token, '[0-9]') THEN 'hex'
                     WHEN regexp_matches(token, '^([A-Z2-7]+|[a-z2-7]+)$') AND regexp_matches(token, '[2-7]') THEN 'base32'
                     WHEN regexp_matches(token, '^([A-Z0-9]+|[a-z0-9]+)$') AND regexp_matches(token, '[0-9]') THEN 'base36'
                     WHEN regexp_matches(token, '^[A-Za-z0-9]+$') THEN 'base62'
                     WHEN regexp_matches(token, '^[A-Za-z0-9+/]+$') THEN 'base64'
                     WHEN regexp_matches(token, '^[A-Za-z0-9_-]+$') THEN 'base64url' END AS enc FROM t),
a AS (SELECT *, CASE enc {alphabet} END AS alphabet, length(token)::DOUBLE AS n FROM c WHERE enc IS NOT NULL),
x AS (SELECT id, i, strpos(alphabet, substr(CASE WHEN enc IN {ONE_CASE} THEN lower(token) ELSE token END, i::INT, 1)) - 1.0 AS x, length(alphabet)::DOUBLE AS k
      FROM (SELECT *, unnest(range(1, length(token) + 1)) AS i FROM a)),
sq AS (SELECT id, sum(o * o)::DOUBLE AS squares FROM (SELECT id, x, count(*) AS o FROM x GROUP BY id, x) GROUP BY id),
nb AS (SELECT id, k, x, lag(x) OVER (PARTITION BY id ORDER BY i) AS y FROM x),
st AS (SELECT id, any_value(k) AS k, 1.0 + count(*) FILTER (WHERE y IS NOT NULL AND (x > (k - 1) / 2) <> (y > (k - 1) / 2)) AS runs,
              coalesce(sum((x - (k - 1) / 2) * (y - (k - 1) / 2)), 0.0) AS lag FROM nb GROUP BY id),
z AS (SELECT a.*, k, (k / n * squares - n - (k - 1)) / sqrt(2 * (k - 1) * (n - 1) / n) AS z1,
             abs((runs - 1 - (n - 1) / 2) / sqrt((n - 1) / 4)) AS z2, abs(lag / ((k * k - 1) / 12) / sqrt(n - 1)) AS z3
      FROM a JOIN sq USING (id) JOIN st USING (id)),
g AS (SELECT *, (pow(greatest(0.0, 1.0 + z1 * {math.sqrt(2 / SKEW_DF)}), {1 / 3}) - {1 - 2 / (9 * SKEW_DF)}) / {math.sqrt(2 / (9 * SKEW_DF))} AS z0,
             n - length(regexp_replace(same, '[A-Z]', '', 'g')) AS up, n - length(regexp_replace(same, '[a-z]', '', 'g')) AS low,
             n * 26 / k AS e1, n * (k - 52) / k AS e2, CASE k WHEN 32 THEN 26.0 / 32.0 ELSE least(26.0, k - 10) / k END AS part
      FROM (SELECT *, CASE WHEN enc IN {ONE_CASE} THEN lower(token) ELSE token END AS same FROM z)),
f AS (SELECT *, abs(up + low - n * part) / sqrt(n * part * (1 - part)) AS z4,
             exp(-((up - e1) * (up - e1) / e1 + (low - e1) * (low - e1) / e1 + (n - up - low - e2) * (n - up - low - e2) / e2) / 2) AS p3 FROM g),
v AS (SELECT *, -ln(greatest(1e-12, least({tail.format(z="greatest(-8.0, z0)")}, CASE WHEN k > 36 THEN p3 ELSE 2 * {tail.format(z="z4")} END,
                                          2 * {tail.format(z="z2")}, 2 * {tail.format(z="z3")})) * 4) AS v FROM f),
b AS (SELECT *, least({BINS}, floor(round(greatest(0, v), 6) * 4)) AS bin, floor(log2(n)) AS class FROM v),
h AS (SELECT enc, class, bin, count(*) AS c FROM b GROUP BY ALL),
r AS (SELECT *, sum(c) OVER (PARTITION BY enc, class ORDER BY bin DESC) AS above, sum(c) OVER (PARTITION BY enc, class) AS m FROM h),
cut AS (SELECT enc, class, min(CASE WHEN exp(-bin / 4.0) * m <= {how.fdr} * above THEN bin END) AS cut FROM r GROUP BY ALL),
s AS (SELECT doc_id, kind, start, stop FROM p WHERE kind < 3 UNION ALL
      SELECT doc_id, 3, start, stop FROM b JOIN cut USING (enc, class) WHERE n * log2(k) >= {how.min_bits} AND (cut IS NULL OR bin < cut)),
l AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n0, count(*) FILTER (WHERE kind = 1) AS n1, count(*) FILTER (WHERE kind = 2) AS n2,
             string_agg(CASE kind {names} END || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
             string_agg(CASE kind {names} END || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN l USING (doc_id)"""

"""Language ID by Bayesian evidence fusion.

For each document the log posterior of a language is the sum of
* the text's log-likelihood under byte trigram models, fitted on a bounded labelled sample,
* the log-likelihood of the language the markup declares, from how declarations and texts
  agree over all documents,
* the log-likelihood of the address suffix (last label of the host), and
* the log prior of the host, smoothed towards its domain and that towards the whole corpus.
The last three come from one grouped aggregation over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BUCKET_BITS = 16
#: letters stay (A-Z lower-cased), non-ASCII bytes stay, all else separates words
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
CHUNK = 1 << 20
SALTS = 16


@dataclass
class TextModel:
    """log P(trigram bucket | language): buckets x languages."""

    languages: list[str]
    logp: np.ndarray

    def score(self, text: bytes) -> tuple[np.ndarray, int]:
        """Mean log-likelihood of each language and the trigrams it rests on (0: no letters)."""
        total, n = np.zeros(len(self.languages)), 0
        for grams in trigrams(text):
            total += self.logp[grams].sum(axis=0, dtype=np.float64)
            n += len(grams)
        return (total / n if n else total), n


def trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Hash buckets of the byte trigrams of the words, in chunks."""
    w = text.translate(FOLD).split()
    if not w:
        return
    a = np.frombuffer(b" " + b" ".join(w) + b" ", np.uint8)
    for lo in range(0, len(a) - 2, CHUNK):
        c = a[lo:lo + CHUNK + 2].astype(np.uint32)
        key = c[:-2] << np.uint32(16) | c[1:-1] << np.uint32(8) | c[2:]
        yield (key * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)


@dataclass(frozen=True)
class Fusion:
    """Parameters of the fusion.

    Trigram models are fitted on a sample of the labelled rows (all else uses every row): of a
    language, ``sample_rows`` by its share of them, or ``language_rows`` if that is more, or all
    it has; ``sample_rows + max_languages * language_rows`` in all at most, in expectation. The
    ``max_languages`` declared most often are modelled, the others count as "other". ``independent`` is the number of trigrams a text counts for at most, as
    neighbouring trigrams are not independent. ``pull`` is the weight, in documents, of the
    level above in the smoothing. Documents whose best posterior is below ``min_posterior``,
    or whose text has no letter, are rejected.
    """

    sample_rows: int = 8_000
    independent: int = 60
    pull: float = 20.0
    min_posterior: float = 0.6
    max_languages: int = 256
    language_rows: int = 200


#: what trigrams() finds something in
LETTER = r"[A-Za-z]|[^\x00-\x7F]"


def primary(label: Column) -> Column:
    """The language of a declared label (``en`` of ``en-US`` and ``EN_gb``); '' for what is no language code."""
    return F.regexp_extract(F.lower(F.coalesce(label.cast("string"), F.lit(""))), r"^\s*([a-z]{2,8})(?![a-z])", 1)


def fit_text_model(docs: DataFrame, text: Column, label: Column, sample_rows: int,
                   max_languages: int = 256, language_rows: int = 200, alpha: float = 0.5) -> TextModel:
    """Trigram models of the languages declared most often on rows that have a letter.

    Languages are counted over all rows; the rows of each that are fitted on are chosen by hash
    (see ``Fusion``). The driver gets one packed row of counts per language.
    """
    rows = docs.select(text.cast("string").alias("text"), primary(label).alias("lang"))
    rows = rows.where((F.col("lang") != "") & F.col("text").rlike(LETTER))
    most = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages)
    sizes = {r["lang"]: r["count"] for r in most.collect()}
    if not sizes:
        return TextModel([], np.zeros((1 << BUCKET_BITS, 1), np.float32))
    n = sum(sizes.values())
    # of a million, how many of a language's rows are taken
    part = {lang: min(1.0, max(sample_rows / n, language_rows / k)) if n > sample_rows else 1.0 for lang, k in sizes.items()}
    limit = F.create_map(*[F.lit(x) for lang, p in part.items() for x in (lang, int((1 << 30) * p))])
    chance = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 30))
    rows = rows.where(chance < F.element_at(limit, F.col("lang")))      # null for languages that are not modelled

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[str, np.ndarray] = {}
            for t, lang in zip(common.text_bytes(b.column(0)), b.column(1).to_pylist()):
                for g in trigrams(t):
                    sums.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                    sums[lang] += np.bincount(g, minlength=1 << BUCKET_BITS)
            for lang, s in sums.items():
                at = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(s[at])],
                                                 ["lang", "gram", "n"])

    def packed(table: pa.Table) -> pa.Table:
        sums = np.zeros(1 << BUCKET_BITS, np.int64)
        sums[table["gram"].to_numpy()] = table["n"].to_numpy()
        return pa.table({"lang": table["lang"][:1], "n": pa.array([zstandard.compress(sums.tobytes())], pa.binary())})

    counted = (rows.mapInArrow(count, "lang string, gram int, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    got = {r["lang"]: np.frombuffer(zstandard.decompress(r["n"]), np.int64)
           for r in counted.groupBy("lang").applyInArrow(packed, "lang string, n binary").collect()}
    languages = sorted(got)
    table = np.full((1 << BUCKET_BITS, max(1, len(languages))), alpha)
    for i, lang in enumerate(languages):
        table[:, i] += got[lang]
    return TextModel(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def _numbers(codes: pa.Array, languages: list[str]) -> list[int | None]:
    """Number of each declared language; the number of languages for others, None for none."""
    number = {lang: i for i, lang in enumerate(languages)}
    return [None if c == "" else number.get(c, len(languages)) for c in codes.to_pylist()]


def evidence(host: np.ndarray, domain: np.ndarray, suffix: np.ndarray | None, total: np.ndarray, pull: float) -> np.ndarray:
    """Log prior of a host and log-likelihood ratio of its address suffix, by language; arguments are
    documents by language. A host is smoothed towards its domain, that towards the whole corpus."""
    base = (total + 1) / (total + 1).sum()
    near = (domain + pull * base) / (domain.sum() + pull)
    out = np.log((host + pull * near) / (host.sum() + pull))
    if suffix is not None:
        # P(suffix | language) against P(suffix)
        share = (suffix.sum() + 1.0) / ((total.sum() or 1.0) + 1.0)
        out += np.log((suffix + pull * share) / (total + pull) / share)
    return out


def _host_evidence(seen: DataFrame, n_lang: int, pull: float) -> tuple[DataFrame, np.ndarray]:
    """_li_host, _li_prior (doubles as bytes, by language), and the table of declared languages.

    ``seen``: host, declared, best, n. Counts are rows of (host, language), so no plan grows with
    the number of languages.
    """
    def listed(counts: DataFrame, key: str) -> DataFrame:
        """One row per key; its list has an entry per language at most."""
        sums = counts.groupBy(key, "best").agg(F.sum("n").alias("n"))
        return sums.groupBy(key).agg(F.collect_list(F.struct("best", "n")).alias(f"{key}_n"))

    labels = F.split("host", r"\.")
    dotted = F.size(labels) > 1
    counts = common.stage(seen.groupBy("host", "best").agg(F.sum("n").alias("n")).withColumns({
        "domain": F.when(dotted, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")),
        "suffix": F.when(dotted, F.element_at(labels, -1)).otherwise(F.lit(""))}), "hosts")
    total = np.zeros(n_lang)
    for r in counts.where("best >= 0").groupBy("best").agg(F.sum("n").alias("n")).collect():
        total[r["best"]] = r["n"]
    names = counts.select("host", "domain", "suffix").distinct()
    rows = (names.join(listed(counts, "host"), "host").join(listed(counts, "domain"), "domain")
            .join(listed(counts, "suffix"), "suffix"))

    def dense(pairs: list[dict]) -> np.ndarray:
        out = np.zeros(n_lang)
        for p in pairs:
            if p["best"] >= 0:      # texts without letters speak for no language
                out[p["best"]] = p["n"]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [evidence(dense(h), dense(d), dense(s) if suffix else None, total, pull).tobytes()
                   for suffix, h, d, s in zip(*[b.column(i).to_pylist() for i in range(1, 5)])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], ["_li_host", "_li_prior"])

    out = rows.select("host", "suffix", "host_n", "domain_n", "suffix_n").mapInArrow(run, "_li_host string, _li_prior binary")
    pairs = seen.where("declared is not null").groupBy("declared", "best").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((n_lang + 1, n_lang))
    for r in pairs:     # (languages + 1) x languages rows at most
        if r.best >= 0:
            table[r.declared, r.best] = r.n
    agree = (table + 1.0) / (table + 1.0).sum(axis=0)
    return out, np.log(agree)


def identify(docs: DataFrame, text: Column | str = "text", declared: Column | str = "lang", host: Column | str = "source",
             how: Fusion = Fusion(), kept_only: bool = False) -> DataFrame:
    """``docs`` with language, posterior, text_language, declared_known and kept, or its kept rows.

    The models are fitted on the rows' own declared languages. A null or empty text, or one
    without letters, has no language (null), posterior 0 and is not kept. Without a declared
    language that evidence is left out; declared labels count by their primary code, and one
    that is not modelled counts as "other". Null hosts share one prior. Repeated rows get equal results; ties go to the
    language first in the alphabet. Without any labelled row nothing can be identified.
    """
    def col(c):
        return F.col(c) if isinstance(c, str) else c
    text, declared = col(text).cast("string"), col(declared)
    host = F.lower(F.coalesce(col(host).cast("string"), F.lit("")))
    spark = docs.sparkSession
    common.bound_batches(spark)
    model = fit_text_model(docs, text, declared, how.sample_rows, how.max_languages, how.language_rows)
    n_lang = len(model.languages)
    if not n_lang:      # nothing to learn from
        none = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("language", "posterior", "text_language", "kept")],
                           F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"),
                           F.lit(None).cast("string").alias("text_language"), F.lit(False).alias("kept"))
        return docs.where(F.lit(False)) if kept_only else none
    sent = spark.sparkContext.broadcast(model)      # buckets x languages, 64 MB at most

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            out = []
            for t in common.text_bytes(b.column(2)):
                s, n = m.score(t)
                out.append(int(s.argmax()) if n else -1)
            said = pa.array(_numbers(b.column(1), m.languages), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), said, pa.array(out, pa.int32())], ["host", "declared", "best"])

    seen = (docs.select(host.alias("host"), primary(declared).alias("declared"), text.alias("text"))
            .mapInArrow(best, "host string, declared int, best int")
            .groupBy("host", "declared", "best").agg(F.count(F.lit(1)).alias("n")))
    priors, agree = _host_evidence(common.stage(seen, "language_seen"), n_lang, how.pull)
    # Staged, so its size is known: Spark broadcasts it if it is small; else the salt spreads a hot host.
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_li_salt")
    priors = common.stage(priors.select("_li_host", "_li_prior", salts), "host_priors")
    own = docs.columns
    keyed = docs.withColumns({"_li_key": host, "_li_text": text, "_li_declared": primary(declared)})
    keyed = keyed.withColumn("_li_pick", F.pmod(F.xxhash64("_li_text", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    joined = keyed.join(priors, (F.col("_li_key") == F.col("_li_host")) & (F.col("_li_pick") == F.col("_li_salt")), "left")
    out = T.StructType([T.StructField("language", T.StringType()), T.StructField("posterior", T.DoubleType()),
                        T.StructField("text_language", T.StringType()), T.StructField("kept", T.BooleanType())])

    def fuse(texts: pa.Array, said: pa.Array, prior: pa.Array) -> list:
        m, lang, post, by_text, kept = sent.value, [], [], [], []
        for t, d, p in zip(common.text_bytes(texts), _numbers(said, m.languages), prior.to_pylist()):
            mean, n = m.score(t)
            if not n:
                lang.append(None), post.append(0.0), by_text.append(None), kept.append(False)
                continue
            log = mean * min(n, how.independent)
            if p is not None:
                log = log + np.frombuffer(p)
            if d is not None:
                log = log + agree[d]
            share = np.exp(log - log.max())
            share /= share.sum()
            i = int(share.argmax())
            lang.append(m.languages[i]), post.append(float(share[i]))
            by_text.append(m.languages[int(mean.argmax())]), kept.append(bool(share[i] >= how.min_posterior))
        return [lang, post, by_text, kept]

    inputs = [F.col("_li_text"), F.col("_li_declared"), F.col("_li_prior")]
    base = joined.drop("_li_key", "_li_host", "_li_pick", "_li_salt")
    if kept_only:
        flag = T.StructType([out["kept"]])
        slim = common.append_columns(base, inputs, lambda *a: [fuse(*a)[3]], flag, keep=lambda k: pc.fill_null(k, False))
        return slim.select(*[F.col(f"`{c}`") for c in own])
    renamed = T.StructType([T.StructField(f"_li_{f.name}", f.dataType) for f in out.fields])
    done = common.append_columns(base, inputs, fuse, renamed)
    mine = set(out.names)
    return done.select(*[F.col(f"`{c}`") for c in own if c not in mine], *[F.col(f"_li_{n}").alias(n) for n in out.names])


def keep_identified(docs: DataFrame, how: Fusion = Fusion()) -> DataFrame:
    """The rows of ``docs`` (columns of documents) whose language is settled."""
    return identify(docs, how=how, kept_only=True)


#: markup that is no text: comments, scripts, styles and tags
MARKUP = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>"


def page_columns() -> dict[str, Column]:
    """Text, declared language and host of a page (columns url and html)."""
    return {"text": F.regexp_replace(F.col("html"), MARKUP, " "),
            "declared": F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1),
            "host": F.regexp_extract("url", r"^[^:]*://([^/?#:]*)", 1)}

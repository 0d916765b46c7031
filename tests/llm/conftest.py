import pytest

from unfurl.session import ensure_checkpoint_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shared_folder(spark):
    ensure_checkpoint_dir(spark)


@pytest.fixture()
def make(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash with internal ones."""
    def build(rows, extra=True):
        df = spark.createDataFrame([(d, t, None if t is None else "en", "src" if i % 3 else None, None if t is None else len(t))
                                    for i, (d, t) in enumerate(rows)], DOCS)
        if extra:
            for c in ("row", "hit", "kept", "doc", "text2", "n", "key", "a.b"):
                df = df.withColumn(c, df["doc_id"])
        return df
    return build


@pytest.fixture()
def edge_rows():
    """Nulls, empty, blank, very long, repeated and non-ASCII texts; null and repeated ids."""
    long = " ".join(f"w{i % 977} x{i % 13}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, "One line only"), (5, "Été ÜBER straße İstanbul ſ K"), (6, long), (6, long),
            (7, "a\x0bb\x0cc\rd"), (None, "no id here at all, none"), (None, "no id here at all, none"), (8, "\n\n"), (9, "x" * 5000)]

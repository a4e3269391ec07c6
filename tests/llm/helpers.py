"""Tables with odd rows, for all operators."""

from pyspark.sql import functions as F

from quaymart.llm.common import show_package

FOLDER = "/root/testdata/sf0.001"
# Names that operators might use themselves.
CLASHING = ("row", "text_hash", "fingerprint", "words", "part", "leaf", "id", "hash", "of", "copies")
LONG = "alpha beta\tgamma delta. " * 20_000

TEXTS = [
    (1, "one two three four five six\nshared line of words\n", "en", "a"),
    (2, None, "en", "b"),
    (3, "", None, None),
    (4, "one two three four five six\nshared line of words\n", "en", "c"),
    (4, "one two three four five six\nshared line of words\n", "en", "c"),
    (5, "other text with null id", "en", "d"),
    (None, "no id here, but\nshared line of words", "en", "e"),
    (6, " \t\n\x0b\f\r", "en", "f"),
    (7, "Ünï ß 漢字 \U0001f600 e\u0301 \u00a0x\u2003y", "de", "a"),
    (8, LONG, "en", "b"),
    (9, "a\nshared line of words\na\nb\nshared line of words", "en", "b"),
    (10, "shared line of words\nz", "en", "d"),
    (5, "other text of the same id", "en", "d"),
    (11, "word", "en", "a"),
]


def documents(spark, rows=TEXTS):
    """Documents with odd rows and extra columns whose names clash."""
    show_package(spark)
    docs = spark.createDataFrame(
        [(*r, len(r[1] or "")) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    return docs.withColumns({name: F.lit("x") for name in CLASHING})


def empty(spark):
    return documents(spark).where("doc_id < 0")


def table(spark, name):
    show_package(spark)
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def values(df, *columns):
    """Rows as sorted tuples, nulls first."""
    found = map(tuple, df.select(*columns).collect() if columns else df.collect())
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) for v in r])

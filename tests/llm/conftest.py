import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(start: int, count: int) -> str:
    return " ".join(f"w{i}" for i in range(start, start + count))


ODD_TEXTS = [
    (1, prose(0, 60), "en", "a"),
    (2, prose(0, 60), "en", "a"),
    (3, prose(0, 60) + " other", "en", None),
    (4, None, "en", "a"),
    (5, "", "en", "b"),
    (6, " \t\n \x0b", "en", "b"),
    (7, "One two", "de", "b"),
    (8, "one TWO", "de", "b"),
    (9, "\n".join(["Same line here again"] * 30), None, "b"),
    (10, prose(5000, 40_000), "fr", "c"),
    (None, prose(0, 60), "en", "a"),
    (None, None, None, None),
    (11, prose(100, 30), "en", "a"),
    (11, prose(100, 30), "en", "a"),
    (12, "\u00e9 \u00fc\u00a0\u00c0B|c #x *y\nline\n\nline\n \n", "fr", "c"),
    (13, "x " * 2000, "fr", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with every oddity: NULLs, no words, repeated rows, ties, a very long text, a constant text."""
    rows = [(i, text, lang, source, None if text is None else len(text)) for i, text, lang, source in ODD_TEXTS]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(odd):
    """More columns, called like what operators use or return."""
    from pyspark.sql import functions as F

    names = ["shard", "slot", "size", "_id", "_nth", "_text", "value", "label", "kept", "component_id", "rank", "key", "_doc"]
    return odd.withColumns({name: F.lit(f"own {name}") for name in names})


def rows_of(df, *names):
    """Rows as sorted tuples; NULLs first."""
    found = [tuple(r) for r in (df.select(*names) if names else df).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in r))

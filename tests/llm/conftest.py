import duckdb
import pytest

SF01 = "/root/testdata/sf0.01"

# null and empty texts, only white space, repeated rows, ties, a very long text, null in every column
EDGE = [
    (5, "a b  c\n", "en", "s1", 7),
    (3, "abc", "en", "s1", 3),
    (9, " a\tb\x0bc ", "de", "s2", 7),
    (4, None, None, None, None),
    (8, "", "en", "s2", 0),
    (7, " \n\t ", None, "s3", 4),
    (2, "zebra " * 30_000, "fr", "s1", 180_000),
    (6, "Ünïcödé — 日本語 \U0001f600 text with\xa0nbsp", "de", "s1", 30),
    (6, "Ünïcödé — 日本語 \U0001f600 text with\xa0nbsp", "de", "s1", 30),
    (1, "abd", "en", None, 3),
    (None, "abc", "en", "s1", 3),
    (None, None, None, None, None),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside or return
CLASH = ("_id long, _text string, size long, kept boolean, shard int, component_id long, n_tokens long, k long, _n long, "
         + ", ".join(f"{c} long" for c in ("_k", "_f", "_r", "_s", "_off", "_copies", "_copy", "_key", "_of", "_block", "_p", "_row", "_size",
                                           "_crc", "_shard", "_rank", "_base", "_lang", "_words", "_ids", "_pair", "_fp", "_c", "_b", "_lo",
                                           "_hi", "_comp", "_node", "_first", "_all", "_kept_key", "text_sha256", "copies", "target")))


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(*r, 1, "x", 2, True, 3, 4, 5, 6, 7, *range(8, 42)) for r in EDGE]
    return spark.createDataFrame(rows, f"{COLUMNS}, {CLASH}").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], f"{COLUMNS}, {CLASH}")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


@pytest.fixture(scope="session")
def texts():
    return dict(duckdb.connect().execute(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall())

import pytest

SF = "/root/testdata/sf0.001"

EDGE_TEXTS = [None, "", " \t\n", "a", "One two", "the same words again and again", "the same words again and again",
              "THE SAME words again and again", "é ÀÉ naïve 漢字 \x1c\x85\xa0 x", "word " * 30000, "x" * 60000]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with NULLs in all columns, repeated rows, ties, very long
    texts and extra columns whose names clash with those used inside."""
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 1 else f"s{i % 2}", None if t is None else len(t), i, "x", 1.5)
            for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[5], rows[5], (None, None, None, None, None, None, None, None),
             (None, "the same words again and again", "en", "s0", 30, 1, "y", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, key string, score double"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: columns whose names the operators use inside
EXTRA = "size long, key string, bucket long, part string, tail int, shard int, component_id long, kept boolean, spans string, score double"


def edge_rows():
    """Nulls in every column, empty and blank texts, one word, a very long text,
    a very long word, equal rows, equal texts, characters beyond the BMP."""
    long_text = " ".join(f"wort{i % 977} und" for i in range(30_000))
    base = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank", "en", "a", 10),
        (2, "the quick brown fox jumps over the lazy dog near the river bank", "en", "b", 10),
        (2, "the quick brown fox jumps over the lazy dog near the river bank", "en", "b", 10),
        (3, "", "en", "a", 0),
        (4, " \t\n\x0b\x0c\r ", None, None, None),
        (5, None, None, "a", None),
        (None, "a text of nobody without any number at all", None, "a", 5),
        (7, "word", "de", None, 4),
        (8, long_text, "de", "c", len(long_text)),
        (9, "x" * 70_000, "de", "c", 70_000),
        (10, "𝔘nicode 𐐷 été ÉTÉ naïve 漢字 \U0010ffff <|endoftext|>", "fr", "c", 30),
        (11, "12345 67890 !!! ###", "fr", "c", 20),
    ]
    return base


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(*r, 1, "k", 2, "p", 3, 4, 5, True, "s", 0.5) for r in edge_rows()]
    return spark.createDataFrame(rows, f"{DOCS}, {EXTRA}").cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_texts():
    """Null, empty, blank, one word, repeats, ties, a very long text, odd letters."""
    long = " ".join(f"word{k % 977}x{k % 13}" for k in range(30_000))
    base = " ".join(f"alpha{k} beta{k % 7}" for k in range(60))
    return [None, "", " \n\t ", "one", "one", base, base, base.replace("alpha3 ", "gamma "), base.upper(), long, long + " end", "日本語 ΣΑΣ é́ <|endoftext|>", "###$$$ 123", "a\n\nb\n" * 30]


@pytest.fixture(scope="session")
def edge(spark, edge_texts):
    rows = [(k, t, [None, "en", "de"][k % 3], [None, "a", "b", ""][k % 4], None) for k, t in enumerate(edge_texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)

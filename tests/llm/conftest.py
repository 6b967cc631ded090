import pytest

SCHEMA = "text string, extra int, doc_id long, k1 string, source string, words int, lang string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Texts with nulls, ties, repeated rows, a very long text, odd white space; columns in another order, with clashing names."""
    passage = " ".join(f"wort{i}" for i in range(60))
    long = " ".join(f"tok{i % 977}x{i}" for i in range(20_000))
    base = " ".join(f"alpha{i}" for i in range(120))
    near = base.replace("alpha60", "omega")
    texts = [
        (1, base), (2, near), (3, base), (4, None), (5, ""), (6, " \t\r\n"), (7, "one two"), (7, "one two"), (8, "ONE\x0bTWO"), (9, passage + " end a"), (10, "start b " + passage),
        (11, long), (12, "the same line\nunique eleven\n\nThe Same Line  "), (None, "row without id"), (None, None), (13, "é́ß <|endoftext|> don't\x1cx"), (14, "one\ntwo"),
    ]
    texts += [(100 + i, f"own {i}\n  THE same LINE\nlast {i}") for i in range(12)]
    rows = [(t, i % 3, d, "x", None if d is None else f"s{d % 4}", 7, "en", len(t or "")) for i, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)

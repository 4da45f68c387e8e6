import pytest

LONG = "Lang " + " ".join(f"wort{k % 977}x{k % 13}" for k in range(30_000))
#: doc_id, text: nulls, empties, a very long text, copies, ties and repeated rows.
ODD = [
    (None, "no id here"), (1, None), (2, ""), (3, "   \n\t \n"), (4, LONG), (5, "Same text."), (6, "Same text."), (6, "Same text."), (7, "same TEXT."), (8, "ÄÖÜ straße İstanbul x"),
    (9, "don't we'll  two  spaces \n\n and <|endoftext|> inside <|startoftext|>"), (10, "a"), (11, "日本語 テキスト 🙂 é"), (12, "line one\nline two\nline one"), (13, "x\x1cy\x85z"), (-5, "Same text."), (14, LONG), (None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with columns whose names operators use themselves."""
    rows = [(i, text, "src", "en", len(text or ""), 1, 2, "h", 3) for i, text in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, h long, tidemark_0 int, host string, gone_id long")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]

import pytest

#: Names that the operators use inside, as columns that a caller's table may have.
CLASHING = ("h", "doc", "t", "words", "row", "node", "bucket", "spans", "score", "bands", "failed", "class_id", "ids")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from matchmart.llm import queries
    queries.ship(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows, with clashing extra columns."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", len(r[1] or ""), *["x"] * len(CLASHING)) for r in rows]
        extra = ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    return make


@pytest.fixture(scope="session")
def edge_rows():
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [(None, None), (None, "a b c"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long_text), (6, long_text),
            (7, "y" * 700_000), (8, "äöü ßé 日本 \u00a0 \u2003 x"), (9, "same text here"), (9, "same text here"),
            (10, "same text here"), (11, "a@" * 2000 + "1" * 5000 + "+" * 3000)]

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, "The cat sat on the mat and looked at the dog by the door.", "en", 1.0),
        (2, "", "en", 2.0),
        (3, None, None, None),
        (4, "word " * 30000, "en", 4.0),
        (5, "The cat sat on the mat and looked at the dog by the door.", "en", 5.0),
        (5, "The cat sat on the mat and looked at the dog by the door.", "en", 5.0),
        (None, "Das Haus ist sehr schön und der Garten auch, sagte sie.", "de", 6.0),
        (7, "  \n\t ", "fr", 7.0),
        (8, "Le chat est sur la table et il regarde la fenêtre.", "fr", 8.0),
        (9, "日本語のテキスト 123 ??", "en", 9.0),
        (10, "😀 é ΑΣ <|endoftext|> it's  a \n \n b ", "en", 10.0),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double").selectExpr("doc_id", "text", "lang", "score", "1 AS bucket", "'x' AS held_out", "2 AS fp", "3L AS n_chars")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")

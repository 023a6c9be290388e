import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """texts (or (doc_id, text) pairs) -> a documents table."""

    def make(texts, **more):
        rows = []
        for i, t in enumerate(texts):
            doc_id, text = t if isinstance(t, tuple) else (i, t)
            rows.append((doc_id, text, more.get("lang", [None] * len(texts))[i] if "lang" in more else "en", more["source"][i] if "source" in more else f"src{i % 3}", len(text) if text is not None else None))
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, tiny, repeated, very long, and not ASCII."""
    return [None, "", " \n\t ", "one", "one two three", "one two three", "größer été 日本 😀 x", "word " * 3000, "a" * 5000, "x\x1cy z w", "The end.\nThe end.\nThe end."]

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples."""
    def make(rows, extra=False):
        full = [(r + (None, None))[:4] if len(r) < 4 else r for r in rows]
        df = spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)
        if extra:  # names that operators might use inside
            for name in ("row", "lines", "n", "size", "key", "bucket", "fingerprint", "_hot", "kept", "class_id"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df
    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic words: prose(seed, n)."""
    import random

    def make(seed, n, vocabulary=400):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))
    return make

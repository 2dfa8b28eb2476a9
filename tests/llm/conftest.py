"""Small tables for the training-data operators."""

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, extra=False):
        """Rows of (doc_id, text[, source]); ``extra`` adds columns with names operators use inside."""
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for c in ("size", "block", "bytes", "line", "lines", "hash", "h1", "spans", "depth", "key",
                      "text_hash", "start", "copies", "before", "rule", "_id", "host", "token", "band"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df
    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

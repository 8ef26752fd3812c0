from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Make a documents table from (doc_id, text[, source[, lang]]) rows."""

    def make(rows, extra=""):
        full = []
        for r in rows:
            doc_id, text, source, lang = (*r, *(None, "src0", "en")[len(r) - 1 :])
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, SCHEMA)
        # Columns whose names the operators use themselves.
        for name in extra.split():
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "word"),
    (None, "no id here"),
    (None, None, None, None),
    (5, "again and again", None),
    (5, "again and again", None),
    (6, "naïve “quotes” 漢字 🙂 end", "", None),
    (7, "long text of many words, " * 20_000),
]
CLASH = "row size rate kept n first rule line key site pos hits p score fp root band target copies"


@pytest.fixture
def odd(docs):
    return docs(ODD, CLASH)


@pytest.fixture
def none(docs):
    return docs([])

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Names that operators use for columns of their own.
CLASHING = ["row", "row_id", "spans", "items", "n_words", "key", "marks", "term", "email", "near", "score", "lang_pred",
            "rejected", "ids", "shard", "node", "shingles", "at", "s", "window", "start"]


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents: null, empty and long texts, null ids, repeated rows, columns with names of the operators."""
    word = "Whereas the parties agree that nothing in this note shall limit any other right of either party hereto"
    long = " ".join(f"{w}{k % 97}" for k in range(3000) for w in ("alpha", "Beta", "gamma", "délta"))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, word), (7, word.upper()), (7, word), (8, word),
            (None, word), (9, long), (10, long + " tail"), (11, "12 34 !!"), (12, "two words"), (12, "two words"),
            (13, "<|endoftext|> x <|startoftext|>"), (14, "Ελλάδα ½ ² İstanbul ﬁne ́ \x85 \x1c end")]
    extra = tuple("x" for _ in CLASHING)
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, "en", *extra) for i, t in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)


def pairs(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)

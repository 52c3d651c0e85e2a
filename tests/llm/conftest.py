import pytest


@pytest.fixture(scope="session")
def worker_code(spark):
    """The Python workers get the package, as on a cluster."""
    from kpiloom.llm.common import ship
    ship(spark)
    return spark


ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "two words", "a b c", "a b c", "A  b\tc", "x" * 5000, "the quick brown fox " * 3000,
    "Mail me: a.b@c-d.org or +1 (555) 123-4567, 10.0.0.1 and 4111 1111 1111 1111.", "日本語 text\x00 with nul",
    "line one is here\nline one is here\nLINE ONE is  here\nanother line of words that differs", "<|endoftext|> inside <|endof", "é" * 300,
]


@pytest.fixture(scope="session")
def odd_docs(worker_code):
    """Nulls in any column, empty and very long texts, repeated rows and extra columns whose names clash with results."""
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else f"s{i % 2}", len(t or ""), 1, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], (None, "a text without an id here", "de", "s", 3, 2, "y"), (None, None, None, None, None, None, None)]
    return worker_code.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp long, `spans` string")

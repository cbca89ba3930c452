"""Small tables with what the operators must stand: nulls, empty and long texts, repeats, other columns."""

import random

import pytest

#: Columns that clash with names the operators use inside.
EXTRA = "score double, copy int, digest long, node string, ids binary, fp long, n_words long, `a.b` int"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def rows_of(*pairs):
    """Rows of (id, text[, source])."""
    return [
        (i, t, "en", s[0] if s else "web", len(t or ""), 0.5, 7, 1, "n", b"x", 3, 2, 1) for i, t, *s in pairs
    ]


def words(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice("ar be co du el fo gi hu in jo ka lu me no".split()) + draw.choice("mar ten dor vis ola".split()) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    long = words(9, 6000)
    return spark.createDataFrame(
        rows_of(
            (1, words(1, 90)),
            (2, words(2, 90), "rare"),
            (3, words(1, 90), None),
            (3, words(1, 90), None),
            (4, None),
            (5, ""),
            (6, "  \n\t "),
            (None, words(3, 40)),
            (None, words(4, 40)),
            (7, long),
            (8, "Ünïcödé İstanbul ΣΑΣ é ẞ  中文 \U0001f600 don't STOP!!! 3.14 a_b"),
            (9, "one two"),
            (10, words(5, 4) + "\n\n" + words(6, 300)),
        ),
        DOCS,
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

"""Small tables for the operators' tests."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept_text string, g string, h long"


def make_words(rng, n):
    syllables = ["ba", "ko", "ri", "tun", "shel", "mor", "du", "fa", "ghe", "lin"]
    return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]


def odd_rows():
    """(doc_id, text): nulls, empty, long, repeated, tied and shared texts."""
    rng = random.Random(5)
    passage = " ".join(make_words(rng, 60))
    line = "A Line That Many Documents Share"
    base = " ".join(make_words(rng, 200))
    near = base.split()
    near[100] = "changed"
    rows = [
        (1, None), (2, ""), (3, "   \t\n "), (4, base), (5, base), (6, " ".join(near)),
        (7, f"{line}\nown words of seven\n  {line.upper()} \t"), (8, f"first of eight\n{line}\r\n\n"),
        (9, passage + " tail nine"), (10, "head ten " + passage), (11, "x"), (11, "x"),
        (12, "ÉTÉ à l'école ñandú"), (13, "ÉTÉ à l'école ñandú"), (14, "été À L'ÉCOLE Ñandú"),
        (15, " ".join(make_words(rng, 30_000))), (16, "y" * 50_000), (17, "\n" * 3000),
        (None, base), (None, None), (18, "\x0b\x0cword\x0bword  word "),
        (19, "12345 67890 !!! ???"), (20, " non breaking　spaces \U0001f600 é ﬁ"),
    ]
    for i in range(21, 60):
        own = " ".join(make_words(rng, rng.randint(1, 80)))
        rows.append((i, own + ("\n" + line if i % 3 == 0 else "") + (" " + passage if i % 7 == 0 else "")))
    return rows


def as_docs(spark, rows):
    """The rows with the columns of documents and some with clashing names."""
    full = [(i, t, ["en", "de", None][k % 3], "s", None if t is None else len(t), "other", "g", k)
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd():
    return odd_rows()


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    return as_docs(spark, odd).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

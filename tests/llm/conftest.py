"""Awkward rows that every operator must take, and small texts with known copies."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, hash string, row long, mix_size long"


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeiou") + r.choice("bcdfgt") for _ in range(r.randrange(1, 4))) for _ in range(words))


def frame(spark, rows):
    """rows (doc_id, text, source) with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", 7, 9) for i, t, s in rows], DOCS)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, white, very long and repeated texts, many bytes a character."""
    long = prose(1, 30_000)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n\x0b ", None), (4, "word", "b"), (None, "no id at all", "b"), (5, long, "b"), (6, long, None), (7, "été über 漢字 🙂 " * 40, "a"), (7, "été über 漢字 🙂 " * 40, "a"), (8, "<|endoftext|> it's <|endoftext|>", "c")]
    return frame(spark, rows).coalesce(2)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def copies(spark):
    """Copies, near copies, a passage that many documents share, and clean ones."""
    base, passage = prose(2, 200), prose(3, 90)
    near = base.split()
    near[50], near[120] = "changed", "words"
    rows = [(i, prose(100 + i, 120), "s0") for i in range(12)]
    rows += [(20, base, "s0"), (21, base, "s1"), (22, " ".join(near), "s1"), (23, base, "s2")]
    rows += [(30 + i, prose(200 + i, 60) + "\n" + passage + "\n" + prose(300 + i, 60), "s2") for i in range(6)]
    return frame(spark, rows).repartition(3)

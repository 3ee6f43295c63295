"""Small tables for the tests of the training-text operators."""

import random
import re

import pytest

WORDS = "alpha beta gamma delta omega river stone cloud maple ember quartz violet harbor lantern meadow copper".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(40)) if rng.random() < 0.6 else "") for _ in range(n))


def edge_rows(rng):
    """Nulls in any column, empty, blank and long texts, equal texts, repeated rows."""
    long_ = "\n".join(sentence(rng, 60) for _ in range(120))
    same = sentence(rng, 40)
    return [(1, same, "en", "a", 5), (2, same, None, None, None), (3, None, "en", "a", 0), (4, "", "en", "b", 0), (5, " \n\t ", "en", "b", 4),
            (6, long_, "en", "c", 9), (None, same, "en", "a", 1), (7, "one", "de", "a", 3), (8, "one", "de", "a", 3), (9, "Ünï çødé " * 9, "fr", None, 1),
            (10, "same line again and again here\n" * 5, "en", "a", 1), (6, long_, "en", "c", 9)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("score", "TEXT", "n_shingles", "size", "ord", "gone", "key", "component_id", "Doc_id", "pos")


def clashing(df):
    """The table with more columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    names = df.columns
    return df.select(*df.columns, *[F.lit(i).alias(f"_x{i}") for i in range(len(CLASHING))]).toDF(*names, *CLASHING)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.fixture
def rng():
    return random.Random(5)

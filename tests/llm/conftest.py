import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(7)
    return ["".join(rng.choice("abcdefghijklmnoprstuvwxyzéß") for _ in range(rng.randint(1, 12))) for _ in range(3000)]


@pytest.fixture(scope="session")
def prose(vocabulary):
    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    return make


#: Names the operators use inside; rows of the fixtures carry them as further columns.
CLASHING = ("node", "component", "text_key", "kept_id", "changed_key", "changed_text", "found_key", "host", "row", "body", "n_words", "base_failed", "item_id",
            "start", "keys", "seeds", "places", "label", "pos", "window", "head", "span", "x", "low", "_words", "url_host")


@pytest.fixture(scope="session")
def with_clashes():
    from pyspark.sql import functions as F

    def add(df, *without):
        return df.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHING if c not in df.columns and c not in without])

    return add


@pytest.fixture(scope="session")
def odd_docs(spark, prose, with_clashes):
    """Null and repeated ids and texts, empty, blank, tiny and very long texts, exact copies."""
    long_text = prose(1, 30_000)
    copy = prose(2, 120)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "One", "en", "a"), (5, "one", "de", "b"),
        (6, long_text, "en", "a"), (7, copy, "en", "b"), (8, copy, None, "b"), (9, "".join(c.upper() if "a" <= c <= "z" else c for c in copy), "en", "b"),
        (None, prose(3, 60), "en", "a"), (None, copy, "en", None), (10, prose(4, 200), "de", "b"),
        (10, prose(4, 200), "de", "b"), (11, "x " * 500, "en", "a"), (12, "y" * 50_000, "en", "c"), (13, "<|endoftext|> a", "en", "c"),
    ]
    return with_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))

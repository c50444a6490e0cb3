import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text):
    """Distinct five-word shingles, by definition."""
    words = WORD.findall(lower_ascii(text))
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


@pytest.fixture(scope="session", autouse=True)
def package_on_executors(spark):
    from shipwright.llm.common import ship_package
    ship_package(spark)


@pytest.fixture()
def rnd():
    return random.Random(11)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows that every operator has to take: nulls, empty and long texts, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 997}" for i in range(20_000))
    rows = [(1, "One two three four five six seven.", "en", "a", 9, "x", 1), (2, None, "en", "a", None, "x", 2),
            (3, "", None, None, 0, None, 3), (None, "One two three four five six seven.", "en", "b", 9, "x", 4),
            (4, "   \n\t ", "de", "b", 5, "x", 5), (5, long_text, "en", "a", len(long_text), "x", 6),
            (6, "One two three four five six seven.", None, "c", 9, "x", 7), (6, "One two three four five six seven.", None, "c", 9, "x", 7),
            (7, "éé 漢字 !!! <|endoftext|> ß", "fr", "c", 3, "x", 8)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, size int")

import random

import pytest

SF = "/root/testdata/sf0.001"
WORDS = ["river", "stone", "light", "under", "over", "quick", "brown", "lazy", "seven", "ocean", "paper", "glass"]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " _id string, _text string, key int, node int, length string, unit int, n int, word string"
)


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) * (rng.random() < 0.3) for _ in range(n))


def rows():
    """Nulls in every column, empty, wordless, foreign and long texts, repeated rows and ids, clashing columns."""
    passage, extra = sentence(1, 60), ["x", "y", 1, 2, "z", 3, 4, "w"]
    nothing = [None] * 8
    long = sentence(2, 30_000)
    return [
        (1, None, None, None, None, *nothing),
        (2, "", "en", "a", 0, *extra),
        (3, " \n\t ", None, "a", 4, *extra),
        (4, passage, "en", "a", 1, *extra),
        (4, passage, "en", "a", 1, *extra),
        (4, "another text of the same id " + sentence(3, 40), "en", "a", 1, *extra),
        (None, "no id here " + passage, None, "b", 1, *extra),
        (None, "no id there " + sentence(4, 30), "en", "b", 1, *extra),
        (5, long, "en", "b", 1, *extra),
        (6, "日本語の文章 русский текст ελληνικά é e\u0301 <|endoftext|> ſ\u00a0x\x0by\u2003z", "xx", "c", 1, *extra),
        (7, passage.upper(), "en", "c", 1, *extra),
        (8, "in between " + passage + " and after", "en", "c", 1, *extra),
        (9, "stop stop stop " * 20, "en", "c", 1, *extra),
        (10, "... !!! ---", "en", None, 1, *extra),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

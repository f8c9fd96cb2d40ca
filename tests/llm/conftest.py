import random

import pytest

SYLLABLES = "ka lo mi ren tu sha vel dor pin ash eth gul".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, score double, fp string, epoch int"


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and blank and very long texts, ties, repeated rows and ids, columns whose names clash."""
    rng = random.Random(5)
    row = lambda i, t, lang="en", source="a": (i, t, lang, source, len(t or ""), "x", 0.5, "y", 3)
    texts = [prose(rng, rng.randint(20, 60)) for _ in range(12)]
    rows = [row(i, t, "en" if i % 2 else "xx", "ab"[i % 2]) for i, t in enumerate(texts)]
    rows += [row(20, texts[0]), row(21, texts[0].replace(" ", "\n\t ")), row(0, texts[0], "xx", "a"), row(0, texts[1])]
    rows += [row(30, None), row(31, ""), row(32, " \t\n"), row(33, "!!! ..."), row(34, " é 日本"), row(None, texts[2]), row(None, None),
             row(35, texts[3], None, None), row(36, texts[4] + " extra"), row(37, "a" * 70000), row(38, prose(rng, 30000))]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

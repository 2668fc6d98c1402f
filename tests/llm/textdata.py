import random
import string

import pytest

SF_DIR = "/root/testdata/sf0.001"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, part string"


def prose(seed, words, alphabet="abcdefgh"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(alphabet, k=draw.randint(2, 9))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    copied = prose(1, 80)
    near = copied.split()
    near[40] = "other"
    long = prose(2, 6000, string.ascii_lowercase)
    texts = [
        (1, copied, "aa"),
        (2, copied, "aa"),
        (3, " ".join(near), None),
        (4, None, "aa"),
        (5, "", "bb"),
        (6, " \n\t ", None),
        (7, long, "bb"),
        (8, "one two three", "bb"),
        (8, "one two three", "bb"),
        (9, "one two three", "aa"),
        (10, "Ünï çödé 漢字 ßtraße", "aa"),
        (None, prose(3, 60), "bb"),
        (None, None, None),
        (11, prose(4, 50) + "\n" + prose(4, 50), "aa"),
        (12, prose(5, 70), None),
        (12, prose(6, 70), None),
    ]
    return [(i, t, g, None if n % 3 else "s", None if n % 2 else 7, None, "x") for n, (i, t, g) in enumerate(texts)]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def table(spark):
    def build(rows):
        full = [(*r, *[None] * (7 - len(r))) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build

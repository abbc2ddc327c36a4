import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, place int, fp string, n_hit string, _hash int"


def rows():
    """Documents with nulls, empty, blank and very long texts, near and exact copies, repeated rows, and columns of clashing names."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passage = text(40)
    found = [(i, text(rng.randint(20, 220)), "en" if i % 3 else "fr", f"s{i % 3}") for i in range(40)]
    found += [(100 + i, found[i][1], "en", "s0") for i in range(6)]
    found += [(110 + i, found[i][1] + " tail", None, "s1") for i in range(4)]
    found += [(120 + i, text(15) + "\n" + passage + "\n" + text(15), "en", None) for i in range(5)]
    found += [(130, None, "en", "s1"), (131, "", None, None), (132, " \n\t ", "en", "s2"), (133, "x", "en", "tiny"), (None, text(30), "en", "s0"), (None, None, None, None)]
    found += [(140, text(30_000), "en", "s2"), (141, "w " * 4000, "en", "s2"), (142, "É<|endoftext|> ½  　ñ 日本 " * 4, "es", "s2")]
    found += [(150, text(60), "en", "s1")] * 3
    return [(*r, 1, "clash", "clash", 7, "clash", "clash", 5) for r in found]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain():
    """The same rows as (doc_id, text, lang, source)."""
    return [r[:4] for r in rows()]

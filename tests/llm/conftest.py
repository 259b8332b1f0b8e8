import random

import pytest

from tablewright.llm.common import find_package

# Columns beside the four that operators use, with names that they use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size int, score double, r1 long, fp long, kept string"


def noise(seed: int, words: int) -> str:
    dice = random.Random(seed)
    return " ".join("".join(dice.choices("abcdefghij", k=dice.randint(1, 9))) for _ in range(words))


def tricky() -> list[tuple]:
    """(doc_id, text, source): nulls, empty and very long texts, ties, copies, repeated rows, odd characters."""
    common = "A line that many documents share\n"
    passage = noise(7, 45)
    rows = [(i, common + noise(i, 30 + i) + "\n" + ("  a LINE that many documents SHARE\t" if i % 3 else "x"), f"s{i % 4}") for i in range(20)]
    rows += [(100 + i, noise(50, 60), "s0") for i in range(15)]  # copies
    rows += [(200 + i, f"{noise(60 + i, 10)} {passage} {noise(80 + i, 5)}", None) for i in range(6)]
    rows += [(300, None, "s1"), (301, "", "s1"), (302, "   \n\t ", "é"), (303, "word", "ß"), (304, "two words", "")]
    rows += [(305, noise(9, 9000), "s2"), (306, "x" * 70_000, "s2"), (307, "la " * 3000, "s3")]
    rows += [(308, "Éa 日本 👍🏽 ñ İ ſ K b c\x1c d", "s3"), (309, "A\r\nB\r\n\n\nC", None)]
    rows += [(310, "mail x.y@z.co or +1 (555) 555-2368 at 10.0.0.256 and 1.2.3.4", "s1"), (311, "4111 1111 1111 1111", "s1")]
    rows += [(None, noise(11, 30), "s1"), (None, noise(12, 30), "s1"), (None, None, None)]
    rows += [(400, noise(13, 40), "s1")] * 3  # repeated rows
    rows += [(401, noise(14, 40), "s1"), (401, noise(15, 40), "s2")]  # a key with two texts
    return rows


@pytest.fixture(scope="session")
def tricky_rows():
    return tricky()


@pytest.fixture(scope="session")
def as_documents(spark):
    find_package(spark)

    def build(rows):
        filled = [(k, t, "en", s, len(t or ""), "k", 1, 0.5, 3, 4, "z") for k, t, s in rows]
        return spark.createDataFrame(filled, SCHEMA).repartition(3)

    return build


@pytest.fixture(scope="session")
def tricky_docs(as_documents, tricky_rows):
    return as_documents(tricky_rows)


@pytest.fixture(scope="session")
def no_docs(as_documents):
    return as_documents([])

"""Documents with every awkward case, and the bench tables."""

import os
import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy int, n_lines string, rating double, mix_key int, _tw_bits int"


def documents(spark, rows):
    """Rows (doc_id, text, source) with extra columns whose names clash with what operators add."""
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), 7, "x", 0.5, 9, 1) for d, t, s in rows], SCHEMA)


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("aeioulmnrst") for _ in range(pick.randint(2, 8))) for _ in range(n))


SHARED = "This line of Forty or more characters is in many documents."
AWKWARD = [
    (1, None, "a"), (2, "", "a"), (3, "one two", None), (4, "one two", "b"), (4, "one two", "b"), (None, "no id here", "b"),
    (5, prose(1, 30_000), "a"), (6, f"{SHARED}\nmine\n{SHARED}", "a"), (7, f"  {SHARED.upper()}\t\n\n", "a"), (8, f"x\n{SHARED}", "c"),
    (9, SHARED, "c"), (10, f"{SHARED}\nlast", "a"), (11, " \t\n\x0b\x0c\r ", "a"), (12, "　\x85 a \x1cb", "a"), (13, "Ünïcode ÀÉ\x00 \\ 日本語テキスト。", "d"),
    *((100 + k, prose(50, 60) + f" end{k % 3}", "a") for k in range(9)), *((200 + k, prose(60 + k, 40), f"s{k % 3}") for k in range(9)),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return documents(spark, AWKWARD)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, []).limit(0)


@pytest.fixture(scope="session")
def folder():
    found = os.environ.get("TILLWRIGHT_TABLES", "/root/testdata/sf0.001")
    if not os.path.isdir(found):
        pytest.skip("no tables")
    return found

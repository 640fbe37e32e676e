import random

import pytest

SMALL = "/root/testdata/sf0.001"
# Further columns, named like columns the operators use themselves.
CLASHING = "key long, context long, tag long, fp long, spans string, kept string, n long, carried string"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def odd_rows():
    """Ids and texts with nulls, blanks, ties, repeated rows, shared passages and one long text."""
    pick = random.Random(3)
    words = [f"w{pick.randrange(400)}" + "äé☃"[i % 3] * (i % 5 == 0) for i in range(6000)]
    passage = " ".join(words[100:160])
    rows = [
        (1, " ".join(words[:90])),
        (2, " ".join(words[:90])),
        (2, " ".join(words[:90])),
        (3, "Before it " + passage + " after it."),
        (4, passage + "\n" + " ".join(words[200:260]) + "\n" + passage),
        (5, " ".join(words[155:240]) + " " + passage),
        (None, passage + " of a row without id"),
        (6, None),
        (7, ""),
        (8, " \n\t \n"),
        (9, "short"),
        (10, "same line\nsame line\nother\n\nsame line"),
        (11, " ".join(words)),
        (12, "ab" * 900),
        (13, "x" * 1500),
        (14, "☃" * 300),
        (-5, "Before it " + passage + " after that."),
        (7, "another text under an id that is taken"),
        *((20 + i, " ".join(words[300 + i % 2 : 314 + i % 3])) for i in range(9)),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, *[1, 2, 3, 4, "s", "k", 5, "c"]) for i, t in odd_rows()]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {CLASHING}")

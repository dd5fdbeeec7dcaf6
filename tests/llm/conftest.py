import random

import pytest

#: Columns that operators do not know, named like columns they use inside.
CLASHING = "id no n h key keep root size sha md5 start run anchor digest text1 share pivot __of __id __words __order of own order nth c0 C1".split()


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a very long one, ties and repeated rows."""
    random.seed(5)
    words = lambda n: " ".join("".join(random.choice("abcdefg") for _ in range(random.randint(1, 6))) for _ in range(n))
    base = words(60)
    rows = [
        (1, None, "b"), (2, "", "a"), (3, "  \n ", None), (4, "one", "a"), (5, base, "b"), (6, base, "a"), (7, base + " tail", None),
        (8, words(30_000), "c"), (9, "Ünïcode \u00df\u4e2d\u6587 \U0001f600 text.", "c"), (10, words(40) + "\n" + base[:150], "a"),
        (10, "same id, other text", "b"), (11, words(200), None), (11, None, "b"), (None, "no id", "a"), (None, base, "a"),
    ]
    return rows + [rows[4], rows[10], (12, "x" * 5000, "a"), (13, "ab " * 700, "a")]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING)
    rows = [(*row, *["z"] * len(CLASHING)) for row in odd_rows]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("doc_id < 0").cache()

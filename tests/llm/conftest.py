import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, size string, "
        "shard string, kept string, node string, token string, row string, host string")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from logfeat.llm.common import ship

    ship(spark)


def awkward_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with any names."""
    long = " ".join(f"word{i * i % 997} of the" for i in range(6000))
    same = "one text that some rows have in common\nwith a second line of it"
    texts = [
        (1, same, "a"), (2, same, "a"), (3, same, None), (4, "", "a"), (5, None, "b"),
        (6, long, "b"), (7, " \t\n ", None), (8, "Ünïcode wörds: naïve façade 日本語 text", "b"),
        (8, "Ünïcode wörds: naïve façade 日本語 text", "b"), (9, same, "a"), (9, same, "a"),
        (None, "a text without an id\nand a second line", "a"), (None, None, None),
        (10, "again and again and again and again and again and again and again", "c"),
        (11, "\n".join(["the same line here"] * 8), "c"), (12, "x", "c"),
        (13, long + " end", "b"), (14, "### $$$ *** &&& |||", "c"), (15, "\x0b\x0c words\r\nmore", "a"),
    ]
    return [(i, t, None, s, None if t is None else len(t), None, "s", None, "n", None, "r", "h")
            for i, t, s in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)

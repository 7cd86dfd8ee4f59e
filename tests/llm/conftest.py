import re

import pytest

from tidemark.llm.common import documents

SMALL = "/root/testdata/sf0.001"
PROSE = " ".join(f"word{i % 97}x{i % 13}" for i in range(120))


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark, SMALL).cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


EDGE = [
    (1, PROSE + ".", "src0"), (2, None, "src0"), (3, "", None), (4, " \t\n\r\x0b\x0c ", "src1"), (5, PROSE + ".", None),
    (6, "one two", "src1"), (7, "one  two", "src1"), (None, "Ünï cödé – text here", "src2"), (9, PROSE.upper(), "src0"),
    (9, PROSE.upper(), "src0"), (10, "long " * 30_000 + "end", "src0"), (11, "\n".join([PROSE] * 3) + "\nlast one.", "src2"),
    (12, "a <|endoftext|> b  c\n\n d", "src2"), (13, PROSE.replace("word5x5", "other") + ".", "src0"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names
    clash with those the operators use."""
    extra = ["doc", "line", "row", "key", "size", "id", "s", "shard", "n", "h", "words", "start", "spans", "hot", "part"]
    schema = "doc_id long, text string, source string, n_chars long, lang string, " + ", ".join(f"{c} string" for c in extra)
    data = [(i, t, s, None if t is None else len(t), None, *["x"] * len(extra)) for i, t, s in EDGE]
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def none(edge):
    return edge.where("1 = 0")
